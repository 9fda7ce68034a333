"""Hand-made rows for the cases the driver tables do not have."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import dates, labels, measures, sampling, words
from reviewlens.operators import members, ranking, restrict, rollups, series
from reviewlens.plans import anomalies, authors, categories, items, owners, reviews

FACT = (
    "review_id long, item_id long, author_id long, recommended boolean, minutes_played double,"
    " minutes_at_review double, items_owned long, early_access boolean, created_at long"
)


def fact(spark, rows):
    """Rows given as dicts; missing columns are null."""
    names = [column.split()[0] for column in FACT.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], FACT)


def many(n, **values):
    return [{"review_id": i, **values} for i in range(n)]


def items_frame(spark, rows):
    return spark.createDataFrame(
        rows, "item_id long, item_name string, is_free boolean, price double"
    )


def bridge(spark, rows, member):
    return spark.createDataFrame(rows, f"item_id long, {member} long")


def dimension(spark, rows, key, name):
    return spark.createDataFrame(rows, f"{key} long, {name} string")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_null_vote_counts_differently_per_measure(spark):
    df = fact(
        spark,
        [
            {"review_id": 1, "item_id": 1, "recommended": True, "minutes_played": 60.0},
            {"review_id": 2, "item_id": 1, "recommended": False, "minutes_played": 120.0},
            {"review_id": 3, "item_id": 1, "recommended": None, "minutes_played": 6000.0},
            {"review_id": None, "item_id": 1, "recommended": True, "minutes_played": None},
        ],
    )
    row = df.groupBy("item_id").agg(
        measures.rate("recommended").alias("rate"),
        measures.rate("recommended", null_as_zero=False).alias("known"),
        measures.mean_where("recommended", measures.hours("minutes_played")).alias("up"),
        measures.count_where(~F.col("recommended")).alias("down"),
    ).first()
    assert (row.rate, row.known, row.up, row.down) == (0.5, pytest.approx(2 / 3), 1.0, 1)
    summary = rollups.item_summary(df).first()
    assert (summary.rows, summary.reviews, summary.positive, summary.negative) == (4, 3, 2, 1)
    assert (summary.played_reviews, summary.hours_up_rows) == (3, 1)


def test_null_vote_is_labelled_negative_and_zero_hours_are_dropped(spark):
    df = fact(
        spark,
        [
            {"review_id": 1, "recommended": None, "minutes_played": 60.0},
            {"review_id": 2, "recommended": True, "minutes_played": 0.0},
            {"review_id": 3, "recommended": True, "minutes_played": None},
        ],
    )
    found = reviews.log_hours_sample(df, fraction=1.0).collect()
    assert [(r.sentiment, r.log_playtime) for r in found] == [
        (labels.NEGATIVE_LABEL, pytest.approx(math.log(2)))
    ]


def test_contrast_threshold_is_strict_and_needs_both_votes(spark):
    rows = many(50, item_id=1, recommended=True, minutes_played=60.0)
    rows += many(50, item_id=2, recommended=True, minutes_played=60.0)
    rows += [{"review_id": 99, "item_id": 2, "recommended": False, "minutes_played": 180.0}]
    rows += many(60, item_id=3, recommended=True, minutes_played=60.0)
    rows += many(60, item_id=4, recommended=True, minutes_played=None)
    names = items_frame(spark, [(i, f"item {i}", False, 1.0) for i in range(1, 5)])
    found = items.engagement_contrast(rollups.item_summary(fact(spark, rows)), names).collect()
    assert [(r.item_id, r.avg_hours_positive, r.avg_hours_negative, r.total_reviews)
            for r in found] == [(2, 1.0, 3.0, 51)]


def test_rating_threshold_is_inclusive_and_negativity_strict(spark):
    rows = many(50, item_id=1, recommended=True) + many(49, item_id=2, recommended=True)
    rows += many(30, item_id=3, recommended=False) + many(31, item_id=4, recommended=False)
    summary = rollups.item_summary(fact(spark, rows))
    dims = items_frame(spark, [(i, f"item {i}", None, None) for i in range(1, 5)])
    none = bridge(spark, [], "owner_id"), dimension(spark, [], "owner_id", "owner_name")
    assert [r.item_id for r in items.item_ratings(summary, dims, *none).collect()] == [1]
    tiers = as_dict(items.negativity_by_tier(summary, dims), "item_id", "price_tier")
    assert set(tiers) == {1, 2, 4}


def test_price_tiers(spark):
    rows = [
        (1, None, None, None), (2, None, False, None), (3, None, True, 99.0),
        (4, None, False, 14.99), (5, None, False, 15.0), (6, None, False, 49.99),
        (7, None, False, 50.0), (8, None, None, 3.0),
    ]
    df = items_frame(spark, rows).select(
        "item_id", labels.price_tier("is_free", "price").alias("tier")
    )
    found = {k: v[0] for k, v in as_dict(df, "item_id", "tier").items()}
    assert found == {1: "3", 2: "3", 3: "1", 4: "2", 5: "3", 6: "3", 7: "4", 8: "2"}


def test_access_needs_more_than_half_and_null_flag_is_zero(spark):
    rows = [{"review_id": i, "item_id": 1, "early_access": f} for i, f in enumerate([True, False])]
    rows += [{"review_id": i, "item_id": 2, "early_access": f} for i, f in enumerate([True, True, None])]
    rows += [{"review_id": i, "item_id": 3, "early_access": f} for i, f in enumerate([True, None])]
    df = rollups.item_summary(fact(spark, rows)).withColumn("access", items.access_label())
    assert as_dict(df, "item_id", "access") == {
        1: labels.RELEASED_LABEL, 2: labels.EARLY_LABEL, 3: labels.RELEASED_LABEL
    }


def test_flag_split_drops_unknown(spark):
    rows = [{"review_id": i, "early_access": f} for i, f in enumerate([True, None, False, True])]
    split = reviews.flag_split(fact(spark, rows))
    assert as_dict(split, "early_access", "total_reviews") == {True: 2, False: 1}
    assert sum(r.share for r in reviews.flag_shares(split).collect()) == pytest.approx(1.0)


def test_primary_owner_is_smallest_id_in_bridge(spark):
    owned = bridge(spark, [(1, 5), (1, 3), (2, 4), (2, 9)], "owner_id")
    names = dimension(spark, [(5, "Five"), (3, "Three"), (9, "Nine")], "owner_id", "owner_name")
    found = members.primary_member(owned, names, "owner_id", "owner_name")
    assert as_dict(found, "item_id", "owner_name") == {1: "Three", 2: None}


def test_duplicate_links_and_equal_names_count_twice(spark):
    summary = rollups.item_summary(fact(spark, many(10, item_id=1, recommended=True)
                                        + many(5, item_id=2, recommended=None)))
    links = bridge(spark, [(1, 1), (1, 1), (1, 2), (2, 2), (7, 1)], "genre_id")
    names = dimension(spark, [(1, "A"), (2, "B"), (3, "C")], "genre_id", "genre_name")
    volume = categories.category_volume(summary, categories.genre_labels(links, names))
    assert as_dict(volume, "genre_name", "review_count") == {"A": 20, "B": 15}

    owned = bridge(spark, [(1, 1), (2, 2)], "owner_id")
    studios = dimension(spark, [(1, "Same"), (2, "Same")], "owner_id", "owner_name")
    dims = items_frame(spark, [(1, "x", None, None), (2, "y", None, None)])
    found = owners.owner_performance(
        summary, dims, owners.owner_labels(owned, studios), min_items=2, min_reviews=15
    ).first()
    assert (found.num_games, found.total_reviews) == (2, 15)
    assert found.positivity_rate == pytest.approx(10 / 15)


@pytest.mark.parametrize("salts", [1, 8])
def test_aggregate_before_join_equals_fan_out(spark, salts):
    rows = [{"review_id": i, "item_id": i % 7, "recommended": i % 3 == 0} for i in range(500)]
    df = fact(spark, rows)
    links = bridge(spark, [(i % 9, i % 4) for i in range(60)], "genre_id")
    names = dimension(spark, [(i, f"g{i % 3}") for i in range(4)], "genre_id", "genre_name")
    direct = (
        df.join(links, "item_id").join(names, "genre_id").groupBy("genre_name")
        .agg(F.count("review_id").alias("reviews"), F.count_if("recommended").alias("positive"))
    )
    ours = members.sum_by_label(
        rollups.item_summary(df),
        members.item_labels(links, names, "genre_id", "genre_name"),
        "genre_name", ["reviews", "positive"], salts=salts,
    ).select("genre_name", "reviews", "positive")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, ours.collect()))


def test_keys_and_numbers_that_do_not_parse(spark):
    df = spark.createDataFrame([("abc",), ("",), ("12",), (None,)], "k string")
    found = df.select(measures.to_key("k").alias("k"), measures.to_number("k").alias("n")).collect()
    assert [(r.k, r.n) for r in found] == [(None, None), (None, None), (12, 12.0), (None, None)]


def test_days_are_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(86_399,), (86_400,), (-1,), (None,)], "s long")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        found = [r[0] for r in df.select(dates.epoch_to_date("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1969, 12, 31), None]


def test_ties_are_broken_the_same_way(spark):
    df = spark.createDataFrame([(i, 5) for i in range(40)], "item_id long, n long").repartition(7)
    assert [r.item_id for r in ranking.top_k(df, "n", 20, ["item_id"]).collect()] == list(range(20))
    grouped = df.withColumn("g", F.col("item_id") % 2)
    top = ranking.top_k_per_group(grouped, "g", "n", 3, ["item_id"])
    assert sorted(r.item_id for r in top.collect()) == [0, 1, 2, 3, 4, 5]


def test_bottom_k_puts_unknown_last(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.1)], "item_id long, p double")
    assert [r.item_id for r in ranking.bottom_k(df, "p", 2, ["item_id"]).collect()] == [3, 2]


def test_author_profiles_filters(spark):
    rows = many(3, author_id=1, items_owned=4, recommended=True, minutes_played=60.0)
    rows += many(3, author_id=2, items_owned=0) + many(3, author_id=3, items_owned=None)
    rows += many(2, author_id=4, items_owned=1) + many(3, author_id=None, items_owned=1)
    found = authors.author_profiles(fact(spark, rows), fraction=1.0).collect()
    assert [(r.author_id, r.games_owned, r.reviews_written, r.positivity_rate,
             r.avg_playtime_hours) for r in found] == [(1, 4.0, 3, 1.0, 1.0)]


def test_hash_sample_depends_on_key_only(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    first = {r.k for r in sampling.hash_sample(df.repartition(3), "k", 0.15).collect()}
    second = {r.k for r in sampling.hash_sample(df.repartition(11), "k", 0.15).collect()}
    assert first == second
    assert abs(len(first) / 20_000 - 0.15) < 0.01


@pytest.mark.parametrize("days", [9, 10, 15, 40])
def test_rolling_band_equals_pandas(spark, days):
    import numpy as np
    import pandas as pd

    values = np.random.default_rng(days).uniform(0, 100, days)
    day0 = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [(day0 + dt.timedelta(days=2 * i), float(v)) for i, v in enumerate(values)],
        "day date, x double",
    )
    for rows in (30, 7):
        ours = series.rolling_band(df, "day", "x", rows=rows, min_rows=5).orderBy("day").toPandas()
        theirs = pd.Series(values).rolling(rows, center=True, min_periods=5)
        assert np.allclose(ours["rolling_mean"], theirs.mean(), equal_nan=True)
        assert np.allclose(ours["rolling_std"], theirs.std(), equal_nan=True)


def test_flat_series_has_no_anomaly(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 12, 1, 11) for i in range(40)]
    daily = spark.createDataFrame(rows, "review_date date, total long, negative long, positive long")
    assert anomalies.negativity_anomalies(daily).filter("anomaly").count() == 0


def test_unknown_band_is_no_anomaly(spark):
    rows = [(dt.date(2024, 1, i + 1), 10, i, 10 - i) for i in range(9)]
    daily = spark.createDataFrame(rows, "review_date date, total long, negative long, positive long")
    found = anomalies.negativity_anomalies(daily)
    assert found.filter("upper_band IS NOT NULL OR anomaly IS NULL OR anomaly").count() == 0


def test_existence_join_never_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert [r.k for r in restrict.keep_known(df, keys, "k").collect()] == [1]


def test_display_text(spark):
    df = spark.createDataFrame(
        [(999,), (1_000,), (1_250,), (999_999,), (1_234_567,), (2_500_000_000,)], "n long"
    )
    found = df.select(
        labels.compact_count("n").alias("c"),
        labels.axis_count("n").alias("a"),
        labels.grouped_count("n").alias("g"),
    ).collect()
    assert [r.c for r in found] == ["999", "1.0K", "1.2K", "1000.0K", "1.2M", "2500.0M"]
    assert [r.a for r in found] == ["0K", "1K", "1K", "999K", "1M", "2500M"]
    assert found[4].g == "1,234,567"


def test_half_even_cap_and_search(spark):
    df = spark.createDataFrame([(0.5, "Red Ring"), (1.5, None), (2.5, "ring"), (None, "x")],
                               "v double, s string")
    found = df.select(
        measures.half_even("v").alias("h"),
        measures.cap("v", 2.0).alias("c"),
        labels.contains_text("s", " RING ").alias("m"),
        labels.contains_text("s", "").alias("all"),
    ).collect()
    assert [r.h for r in found] == [0.0, 2.0, 2.0, None]
    assert [r.c for r in found] == [0.5, 1.5, 2.0, None]
    assert [r.m for r in found] == [True, False, True, False]
    assert all(r.all for r in found)


def test_category_vote_engagement_ignores_incomplete_rows(spark):
    rows = [
        {"review_id": 1, "item_id": 1, "recommended": True, "minutes_at_review": 60.0},
        {"review_id": 2, "item_id": 1, "recommended": True, "minutes_at_review": 120.0},
        {"review_id": 3, "item_id": 1, "recommended": None, "minutes_at_review": 9e9},
        {"review_id": 4, "item_id": 1, "recommended": False, "minutes_at_review": None},
        {"review_id": 5, "item_id": None, "recommended": False, "minutes_at_review": 60.0},
        {"review_id": 6, "item_id": 2, "recommended": False, "minutes_at_review": 60.0},
    ]
    links = bridge(spark, [(1, 1), (2, 1)], "genre_id")
    names = dimension(spark, [(1, "A")], "genre_id", "genre_name")
    dims = items_frame(spark, [(1, "x", None, None), (1, "x", None, None), (None, "n", None, None)])
    found = categories.category_vote_engagement(
        fact(spark, rows), dims, categories.genre_labels(links, names)
    ).collect()
    assert [tuple(r) for r in found] == [("A", True, 1.5)]


def test_empty_input_gives_empty_results(spark):
    df = fact(spark, [])
    summary = rollups.item_summary(df)
    dims = items_frame(spark, [])
    genre = categories.genre_labels(
        bridge(spark, [], "genre_id"), dimension(spark, [], "genre_id", "genre_name")
    )
    frames = [
        items.engagement_contrast(summary, dims),
        items.tier_access_matrix(summary, dims),
        categories.category_volume(summary, genre),
        reviews.flag_shares(reviews.flag_split(df)),
        authors.most_active_authors(df),
        anomalies.negativity_anomalies(reviews.daily_volume(df)),
        items.negative_hours_cdf(
            items.negativity_by_tier(summary, dims), items.engagement_contrast(summary, dims)
        ),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_normalised_words_and_pairs(spark):
    df = spark.createDataFrame(
        [("The CAT's hat,\n\t isn't RED-hot!",), ("x y",), ("",), (None,)], "t string"
    )
    found = df.select(
        words.unigrams_and_bigrams(words.words(words.normalise_text("t"))).alias("w"),
        words.stripped_length(words.normalise_text("t")).alias("n"),
    ).collect()
    assert found[0].w == [
        "cat", "hat", "isn", "red", "hot", "cat hat", "hat isn", "isn red", "red hot",
    ]
    assert found[1].w == [] and found[1].n == 3
    assert found[2].w == [] and found[3].w is None


def test_samples_near_none_and_all(spark):
    df = spark.range(100_000)
    from reviewlens.functions.sampling import hash_sample

    assert hash_sample(df, "id", 0.999995).count() > 99_900
    assert hash_sample(df, "id", 0.0).count() == 0
    assert hash_sample(df, "id", 1e-5).count() < 30
    assert hash_sample(df, "id", 1.0).count() == 100_000
    keyless = df.select(F.lit(None).cast("long").alias("key"), "id")
    assert 4_500 < hash_sample(keyless, "key", 0.05).count() < 5_500


def test_keywords_by_weight_need_a_key(spark):
    import pytest as _pytest

    from reviewlens.operators.terms import group_keywords

    with _pytest.raises(ValueError, match="key"):
        group_keywords(spark.range(1).selectExpr("id", "'x' AS t"), "id", "t", by_weight=True)


def test_stop_words_are_the_written_list(spark):
    from reviewlens.catalog.oracles import STOP_LIST
    from reviewlens.functions.words import default_stop_words

    assert {w.strip("' ") for w in STOP_LIST.split(",")} == set(default_stop_words())


def test_words_cut_at_single_blanks(spark):
    """Any white space, other letters, lengths and empty texts: the same words as by a regular expression."""
    from reviewlens.functions import words as w

    texts = ["The  cat\tsat\non\x0bthe\x0c mat\r\n", "", " ", None, "a b é cd ef", "don't STOP--now", "x", "İstanbul ok"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        w.words(w.normalise_text("t")).alias("old"), w.words(w.spaced_text("t"), spaced=True).alias("new"),
        w.stripped_length(w.normalise_text("t")).alias("old_size"), w.stripped_length(w.spaced_text("t")).alias("new_size"),
    ).collect()
    assert all(r["old"] == r["new"] and r["old_size"] == r["new_size"] for r in rows)
    assert rows[0]["new"] == ["cat", "sat", "mat"]
