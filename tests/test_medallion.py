"""CSV files through silver and gold to feeds, on hand-made review data."""

import csv
import datetime as dt
import random

import pytest

from reviewlens.plans import medallion
from reviewlens.plans.medallion import Thresholds
from reviewlens.sources import files

LIMITS = Thresholds(
    contrast_more_than=2,
    negativity_more_than=2,
    sentiment_more_than=2,
    rating_at_least=2,
    profile_at_least=1,
    day_at_least=1,
    owner_items=1,
    owner_reviews=1,
    hours_sample=1.0,
    profile_sample=1.0,
)
DAYS = 40


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("medallion")
    raw = root / "raw"
    raw.mkdir()
    rng = random.Random(3)
    rows = []
    for day in range(DAYS):
        for n in range(12):
            bad = day == 20 or n == 0
            rows.append(
                [
                    day * 100 + n,
                    1 + n % 4,
                    76_561_198_000_000_001 + n,
                    "False" if bad else "True",
                    60 * (n + 1) if n != 5 else "",
                    30.0,
                    n,
                    "True" if n % 2 else "False",
                    int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
                    + day * 86_400
                    + rng.randrange(86_400),
                    "english",
                    'Crashes "always",\nrefund the broken launcher' if bad else "fine, works",
                ]
            )
    write(
        raw / "reviews_2024.csv",
        "recommendationid appid author_steamid voted_up author_playtime_forever"
        " author_playtime_at_review author_num_games_owned written_during_early_access"
        " timestamp_created language review_text".split(),
        rows,
    )
    write(
        raw / "applications.csv",
        ["appid", "name", "is_free", "mat_initial_price"],
        [[1, "Alpha", "True", 0], [2, "Beta", "False", 9.99], [3, "", "False", 20], [4, "Delta", "False", ""]],
    )
    write(raw / "genres.csv", ["id", "name"], [[1, "Action"], [2, "Puzzle"]])
    write(
        raw / "application_genres.csv", ["appid", "genre_id"], [[1, 1], [1, 2], [2, 1], [3, 2], [4, 1]]
    )
    write(raw / "developers.csv", ["id", "name"], [[7, "Studio"], [8, "House"]])
    write(
        raw / "application_developers.csv", ["appid", "developer_id"], [[1, 8], [1, 7], [2, 6], [4, 8]]
    )
    silver, gold = f"{root}/silver", f"{root}/gold"
    medallion.build_silver(spark, str(raw), silver)
    written = medallion.build_gold(spark, silver, gold, LIMITS)
    assert len(written) == 13
    return silver, gold


def rows(spark, folder, table):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/{table}.parquet").collect()]


def test_silver_keeps_text_and_wide_ids(spark, folders):
    fact = medallion.load_silver(spark, folders[0])["reviews"]
    assert fact.count() == DAYS * 12
    found = fact.filter("review_id = 2000").first()
    assert found.review_text == 'Crashes "always",\nrefund the broken launcher'
    assert found.author_id == 76_561_198_000_000_001
    assert fact.filter("minutes_played IS NULL").count() == DAYS


def test_gold_has_published_columns(spark, folders):
    expected = {
        "gm_hater_paradox": "appid app_name avg_hours_positive avg_hours_negative total_reviews",
        "gm_top_genres": "genre_name review_count",
        "gm_toxicity_base": "appid total_reviews negative_reviews toxicity_percent price_tier",
        "gm_early_access_split": "written_during_early_access total_reviews",
        "gm_sentiment_by_genre": "genre_name positive negative total pct_positive pct_negative",
        "gm_playtime_distribution": "log_playtime sentimiento",
        "gm_toxicity_heatmap": "price_tier acceso_anticipado avg_toxicity",
        "gm_game_ratings": "appid app_name developer_name total_reviews positive_reviews pct_positive",
        "gm_top_users": "author_steamid num_reviews positivity_rate avg_games_owned",
        "gm_user_profiles": "author_steamid games_owned reviews_written positivity_rate"
        " avg_playtime_hours",
        "gm_daily_reviews": "review_date total negative positive",
        "gm_developer_performance": "developer_name num_games total_reviews positivity_rate"
        " avg_playtime_hours",
        "gm_genre_timeline": "review_month genre_name review_count",
    }
    for table, columns in expected.items():
        path = f"{folders[1]}/{table}.parquet"
        assert spark.read.parquet(path).columns == columns.split(), table
        assert len(files.data_files(spark, path)) == 1


def test_gold_values(spark, folders):
    gold = folders[1]
    # Items 1..4 have 120 reviews each; item 1 has n = 0, 4, 8 and is bad on n = 0.
    ratings = {r["appid"]: r for r in rows(spark, gold, "gm_game_ratings")}
    assert set(ratings) == {1, 2, 4}  # the unnamed item is left out
    assert ratings[1]["developer_name"] == "Studio"  # smallest id
    assert ratings[2]["developer_name"] is None  # id 6 is unknown
    assert ratings[1]["positive_reviews"] == 120 - 40 - 2
    assert ratings[1]["pct_positive"] == 65.0
    volume = {r["genre_name"]: r["review_count"] for r in rows(spark, gold, "gm_top_genres")}
    assert volume == {"Action": 360, "Puzzle": 240}
    tiers = {r["appid"]: r["price_tier"] for r in rows(spark, gold, "gm_toxicity_base")}
    assert [t[0] for _, t in sorted(tiers.items())] == ["1", "2", "3", "3"]
    studios = {r["developer_name"]: r for r in rows(spark, gold, "gm_developer_performance")}
    assert (studios["House"]["num_games"], studios["House"]["total_reviews"]) == (2, 240)
    assert (studios["Studio"]["num_games"], studios["Studio"]["total_reviews"]) == (1, 120)


def test_feeds_and_report(spark, folders):
    gold, missing = medallion.load_gold(spark, folders[1])
    assert missing == []
    feeds = medallion.chart_feeds(gold)
    assert all(df.count() > 0 for df in feeds.values())
    report = medallion.anomaly_report(medallion.load_silver(spark, folders[0]), gold)
    flagged = report.filter("anomaly").collect()
    assert [r.review_date for r in flagged] == [dt.date(2024, 1, 21)]
    # Equal counts go by name; the unnamed third item comes first and is not printed.
    assert flagged[0].top_items == "• Alpha  (3 neg)<br>• Beta  (3 neg)"
    assert flagged[0].keywords.split(", ")[:2] == ["always", "always refund"]
    assert report.filter("NOT anomaly AND (top_items <> '' OR keywords <> '')").count() == 0


def test_second_run_gives_the_same_tables(spark, folders):
    silver, gold = folders
    before = {t: sorted(map(str, rows(spark, gold, t))) for t, _ in medallion.GOLD_TABLES.values()}
    medallion.build_gold(spark, silver, gold, LIMITS)
    for table, content in before.items():
        assert sorted(map(str, rows(spark, gold, table))) == content


def test_feeds_without_their_tables_are_left_out(spark, folders):
    gold, _ = medallion.load_gold(spark, folders[1])
    del gold["item_ratings"], gold["log_hours_sample"]
    found = medallion.chart_feeds(gold)
    assert set(medallion.FEEDS) - set(found) == {
        "kpis", "best_items", "worst_items", "owner_engagement_contrast", "hours_box", "hours_histogram",
    }
    assert medallion.chart_feeds({}) == {}


def test_extras_and_profile(spark, folders, tmp_path):
    silver, _ = folders
    written = medallion.build_gold(spark, silver, str(tmp_path), LIMITS, extras=True)
    assert len(written) == 14
    found = rows(spark, str(tmp_path), medallion.EXTRA_TABLE)
    assert {(r["genre_name"], r["recommended"]) for r in found} == {
        (g, v) for g in ("Action", "Puzzle") for v in (True, False)
    }
    profile = {(r["table"], r["column"]): r for r in medallion.silver_profile(spark, silver).collect()}
    assert profile["reviews", "recommendationid"]["rows"] == DAYS * 12
    assert profile["reviews", "author_playtime_forever"]["non_null"] == DAYS * 11


def test_fact_by_month_gives_the_same_report(spark, folders, tmp_path):
    silver, gold_folder = folders
    raw = silver.removesuffix("silver") + "raw"
    medallion.build_silver(spark, raw, f"{tmp_path}/silver", by_month=True)
    months = {p.name for p in (tmp_path / "silver" / "reviews_2024.parquet").iterdir() if "=" in p.name}
    assert months == {"review_month=2024-01-01", "review_month=2024-02-01"}
    gold, _ = medallion.load_gold(spark, gold_folder)
    stored = medallion.load_silver(spark, f"{tmp_path}/silver")
    ours = medallion.anomaly_report(stored, gold)
    assert "dynamicpruning" in ours._jdf.queryExecution().executedPlan().toString()
    theirs = medallion.anomaly_report(medallion.load_silver(spark, silver), gold)
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))
    assert any(r.keywords for r in ours.collect())
