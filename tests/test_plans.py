"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reviewlens.catalog import queries
from reviewlens.catalog.testdata import Tables
from reviewlens.operators import members, rollups, series, terms
from reviewlens.plans import anomalies, authors, medallion, reviews
from reviewlens.sources import writers

FOLDER = "/root/testdata/sf0.001"
ON_SERIES = {"w01", "w02", "w03", "w04", "a19", "q15", "q16", "q17", "q18", "h04"}


def plan(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


NAMED = sorted(n for n in entry.queries() if n.startswith(("q", "j", "a", "w", "x", "l")))


@pytest.mark.parametrize("name", NAMED)
def test_no_nested_loops_python_or_whole_input_windows(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "Python" not in text and "Arrow" not in text
    if name[:3] not in ON_SERIES:
        assert not re.search(r"\+- Window .*\n.*\n.*Exchange SinglePartition", text)


def test_projection_reaches_the_scan(spark):
    text = plan(spark, "q02_category_volume")
    fact = next(line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line)
    assert "l_extendedprice" not in fact and "l_shipdate" not in fact


def test_filters_reach_the_scan(spark):
    text = plan(spark, "p08_equality_filter")
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text


def test_top_per_group_is_cut_before_the_shuffle(spark):
    text = plan(spark, "w05_top_per_group")
    assert text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def test_top_k_is_not_a_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "q09_most_active_users")


def test_fact_is_aggregated_before_it_meets_a_bridge(spark):
    lines = plan(spark, "q05_category_sentiment").splitlines()
    join = next(i for i, line in enumerate(lines) if "Join [item_id" in line)
    assert any("partial_count(" in line for line in lines[join:])


def test_days_are_broadcast_and_the_fact_is_not_shuffled_for_them(spark):
    text = plan(spark, "q16_anomaly_top_items")
    assert re.search(r"BroadcastHashJoin \[review_date.*LeftSemi", text)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, column):
    """Scans of a stored table that read the column."""
    return sum("FileScan" in line and f"{column}#" in line for line in plan_of(df).splitlines())


def month_fact(spark, folder):
    fact = Tables(spark, FOLDER).reviews()
    writers.write_by_month(fact, f"{folder}/reviews.parquet", "created_at")
    return spark.read.parquet(f"{folder}/reviews.parquet")


def test_drill_down_reads_flagged_months_only(spark, tmp_path):
    fact = month_fact(spark, tmp_path)
    months = {p.name for p in (tmp_path / "reviews.parquet").iterdir() if "=" in p.name}
    assert len(months) > 50
    daily = reviews.daily_volume(Tables(spark, FOLDER).reviews(), 3, ordered=False)
    days = anomalies.flagged_days(anomalies.negativity_anomalies(daily))
    hits = anomalies.reviews_on(fact, days.limit(2))
    assert "dynamicpruning" in plan_of(hits).lower()
    flagged = {r.review_date for r in days.limit(2).collect()}
    assert {r.review_date for r in hits.select("review_date").collect()} == flagged
    read = hits.collect() and hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(review_month" in read
    plain = Tables(spark, FOLDER).reviews()
    same = [c for c in plain.columns]
    assert sorted(map(str, hits.select(*same).collect())) == sorted(
        map(str, anomalies.reviews_on(plain, days.limit(2)).select(*same).collect())
    )


def test_report_reads_the_fact_twice(spark, tmp_path, monkeypatch):
    """The series and the flagged reviews are stored; nothing else scans the fact."""
    from reviewlens.catalog import queries
    fact, found, real = month_fact(spark, tmp_path), [], writers.store

    def counting(df, path):
        found.append(scans(df, "created_at"))
        return real(df, path)

    monkeypatch.setattr(writers, "store", counting)
    report = queries._report(Tables(spark, FOLDER), fact)
    assert sum(found) == 2 and scans(report, "created_at") == 0


def test_terms_meet_the_vocabulary_before_their_shuffle(spark):
    texts = Tables(spark, FOLDER).texts()
    df = terms.tfidf(texts, "grp", "doc_id", "review_text")
    plan = plan_of(df)
    exchange = plan.index("hashpartitioning(grp")  # the first in the text is the last to run
    assert "BroadcastHashJoin [grp" in plan and "texts_with_term" in plan
    per_text = plan.index("BroadcastHashJoin [grp")
    assert exchange < per_text < plan.index("Generate")
    assert "SortMergeJoin" not in plan


def test_gold_is_built_in_three_passes_over_the_fact(spark, tmp_path):
    t = Tables(spark, FOLDER)
    t.reviews(author=True).write.parquet(f"{tmp_path}/reviews.parquet")
    fact = spark.read.parquet(f"{tmp_path}/reviews.parquet")
    tables = {
        "reviews": fact, "items": t.items(), "genres": t.genres(), "owners": t.owners(),
        "genre_bridge": t.genre_bridge(), "owner_bridge": t.owner_bridge(),
    }
    base = writers.store(rollups.item_day_summary(fact), f"{tmp_path}/base.parquet")
    by_author = writers.store(authors.author_summary(fact), f"{tmp_path}/authors.parquet")
    limits = medallion.Thresholds(20, 10, 100, 10, 20, 3, 3, 3, 200)
    shared = medallion.gold_frames(tables, limits, base=base, by_author=by_author)
    direct = medallion.gold_frames(tables, limits)
    passes = [rollups.item_day_summary(fact), authors.author_summary(fact), *shared.values()]
    assert sum(scans(df, "review_id") for df in passes) == 3
    assert set(shared) == set(direct)
    for name, df in shared.items():
        order = [c for c, kind in df.dtypes if kind != "double"] + [c for c, kind in df.dtypes if kind == "double"]
        ours, theirs = (
            sorted((tuple(r) for r in x.select(*order).collect()), key=str) for x in (df, direct[name])
        )
        assert len(ours) == len(theirs) > 0, name
        for a, b in zip(ours, theirs):
            assert list(a) == [pytest.approx(v) if isinstance(v, float) else v for v in b], name


def test_only_heavy_items_are_repeated(spark):
    labels = spark.createDataFrame(
        [(1, f"o{k}", 1) for k in range(50)] + [(2, "a", 1), (3, "b", 2)], "item_id long, owner string, links long"
    )
    summary = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "item_id long, reviews long")
    joined = members.join_labels(summary, labels, salts=8, heavy=20)
    plain = summary.join(labels, "item_id")
    key = ["item_id", "reviews", "owner", "links"]
    assert sorted(map(tuple, joined.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))
    # below the bound an item row stays one row
    generated = members.join_labels(summary, labels.where("item_id > 1"), salts=8, heavy=20)
    assert generated.count() == 2
    assert "Generate explode" in plan_of(joined)


def test_grid_of_many_categories(spark):
    df = spark.range(3_000).select((F.col("id") % 3).alias("i"), F.concat(F.lit("c"), "id").alias("c"), F.lit(1).alias("v"))
    grid = series.dense_grid(df, "i", "c", "v")
    assert "collect_set" not in plan_of(grid) and "CartesianProduct" not in plan_of(grid)
    assert "NestedLoop" not in plan_of(grid)
    assert grid.count() == 9_000 and grid.agg(F.sum("v")).first()[0] == 3_000
