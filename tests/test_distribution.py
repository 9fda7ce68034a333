"""Exact ranks and quantiles, with very uneven categories and many equal values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import distribution as dist
from reviewlens.operators import terms
from tests.test_traps import as_dict


@pytest.fixture(scope="module")
def uneven():
    """One category with most rows, a third of them one value; a null category."""
    rng = np.random.default_rng(5)
    hot = np.where(rng.random(6_000) < 0.4, 7.0, rng.lognormal(2, 1, 6_000))
    frame = pd.DataFrame(
        {
            "g": ["hot"] * 6_000 + ["few"] * 3 + [None] * 50 + ["one"],
            "x": np.concatenate([hot, [1.0, 1.0, 2.0], rng.normal(size=50), [4.0]]),
        }
    )
    frame["k"] = np.arange(len(frame))
    return frame


@pytest.mark.parametrize("slots", [2, 16, 64, 1024])
def test_ecdf(spark, uneven, slots):
    df = spark.createDataFrame(uneven).repartition(5)
    ours = dist.ecdf(df, "g", "x", "k", slots=slots).toPandas().sort_values("k")
    ordered = uneven.sort_values(["x", "k"])
    groups = ordered.groupby("g", dropna=False)
    expected = ((groups.cumcount() + 1) / groups["k"].transform("count")).sort_index()
    assert np.allclose(ours["cdf"].to_numpy(), expected.to_numpy())


@pytest.mark.parametrize("slots", [2, 64, 500])
def test_quantiles(spark, uneven, slots):
    df = spark.createDataFrame(uneven)
    wanted = {"low": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "high": 1.0}
    ours = dist.quantiles(df, "g", "x", wanted, slots=slots).toPandas().set_index("g")
    for group, values in uneven.groupby("g", dropna=False)["x"]:
        row = ours.loc[group] if isinstance(group, str) else ours[ours.index.isna()].iloc[0]
        for name, p in wanted.items():
            assert row[name] == pytest.approx(values.quantile(p))


def test_both_quantile_forms_agree(spark, uneven):
    df = spark.createDataFrame(uneven.dropna())
    few = dist.box_summary(df, "g", "x", few_values=True).toPandas().set_index("g")
    many = dist.box_summary(df, "g", "x").toPandas().set_index("g")
    for column in few.columns:
        assert np.allclose(few[column], many.loc[few.index, column], equal_nan=True)
    hot = uneven[uneven.g == "hot"]["x"]
    assert many.loc["hot", "sd"] == pytest.approx(hot.std())
    assert np.isnan(many.loc["one", "sd"])
    reach = 1.5 * (hot.quantile(0.75) - hot.quantile(0.25))
    inside = hot[hot <= hot.quantile(0.75) + reach]
    assert many.loc["hot", "upper_fence"] == pytest.approx(inside.max())


def test_histogram_keeps_every_row(spark, uneven):
    bins = dist.histogram(spark.createDataFrame(uneven), "g", "x", 0.0, 10.0, 5).toPandas()
    assert bins["n"].sum() == len(uneven)
    assert bins["bin"].between(0, 6).all()


def test_keyword_labels(spark):
    rows = [
        ("a", 1, "broken launcher, broken menus"),
        ("a", 2, "launcher broken again today"),
        ("a", 3, "terrible broken launcher"),
        ("b", 4, "only one usable text here"),
        ("b", 5, "short"),
        ("c", 6, "the and of with from that"),
        ("c", 7, "and the of with from this"),
        ("c", 8, "of and the from with those"),
    ]
    df = spark.createDataFrame(rows, "g string, k long, t string")
    found = terms.group_keywords(df, "g", "t")
    assert as_dict(found, "g", "texts") == {"a": 3, "b": 1, "c": 3}
    assert as_dict(found, "g", "keywords") == {
        "a": "broken, broken launcher, broken menus, broken today, launcher, launcher broken, menus",
        "b": terms.FEW_TEXTS_LABEL,
        "c": terms.NO_TERMS_LABEL,
    }
    weighted = as_dict(terms.group_keywords(df, "g", "t", key="k", by_weight=True, k=2), "g", "keywords")
    assert weighted["a"] == "broken, launcher"


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1, "apple apple banana"), ("a", 2, "banana cherry pie")], "g string, k long, t string"
    )
    found = {(r.k, r.term): r.weight for r in terms.tfidf(df, "g", "k", "t").collect()}
    rare, common = np.log(3 / 2) + 1, np.log(3 / 3) + 1
    raw = {"apple": (1 + np.log(2)) * rare, "apple apple": rare, "apple banana": rare, "banana": common}
    length = np.sqrt(sum(v * v for v in raw.values()))
    for term, value in raw.items():
        assert found[(1, term)] == pytest.approx(value / length)
    assert sum(w * w for (k, _), w in found.items() if k == 2) == pytest.approx(1.0)


@pytest.mark.parametrize("rows", [20_000, 200_000])
def test_slots_have_equally_many_rows_at_any_size(spark, rows):
    """A third of the rows is one category, and values are very uneven."""
    df = spark.range(rows, numPartitions=7).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.exp(F.pmod(F.xxhash64("id"), F.lit(20))).alias("x"),
    )
    placed = dist._with_slot(df, ["g", "x", "id"], 2_000, None, "slot")
    sizes = [r["count"] for r in placed.groupBy("slot").count().collect()]
    assert rows / 2_000 * 0.7 < len(sizes) < rows / 2_000 * 1.4
    assert max(sizes) <= 2 * rows / len(sizes)
    again = dist._with_slot(df.repartition(3), ["g", "x", "id"], 2_000, None, "slot")
    assert placed.exceptAll(again).count() == 0


def test_positions_over_many_slots(spark, uneven):
    df = spark.createDataFrame(uneven)
    ours = dist.with_position(df, "g", ["x", "k"], rows_per_slot=100).toPandas().sort_values("k")
    ordered = uneven.sort_values(["x", "k"])
    groups = ordered.groupby("g", dropna=False)
    assert (ours["position"].to_numpy() == (groups.cumcount() + 1).sort_index().to_numpy()).all()
    assert (ours["total"].to_numpy() == groups["k"].transform("count").sort_index().to_numpy()).all()
    assert dist.with_position(df.where("k < 0"), "g", ["x", "k"]).count() == 0


def test_positions_take_one_shuffle_of_the_rows(spark):
    """Few of many categories cross a slot; the totals of the others come from their own slot."""
    df = spark.range(5_000, numPartitions=4).select((F.col("id") % 1_200).alias("g"), F.col("id").alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large table
    try:
        placed = dist.with_position(df, "g", ["x"], rows_per_slot=500)
        rows = {(r.g, r.x): (r.position, r.total) for r in placed.collect()}
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == {(x % 1_200, x): (x // 1_200 + 1, len(range(x % 1_200, 5_000, 1_200))) for x in range(5_000)}
    assert "SortMergeJoin" not in plan
