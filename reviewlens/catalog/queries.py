"""One registered query per operator and per named analytic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.catalog import testdata as td
from reviewlens.catalog.testdata import Tables
from reviewlens.functions import dates, labels, measures, sampling, words
from reviewlens.operators import distribution as dist
from reviewlens.operators import members, ranking, reshape, restrict, rollups, series, terms
from reviewlens.plans import anomalies, authors, categories, feeds, items, owners, reviews
from reviewlens.sources import files, ingest, readers, writers
from reviewlens.sources.csv import read_csv, read_csv_in_parallel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLACES = 6
NUDGE = 1e-9


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the tables under its own name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show.

    Means of amounts in cents often end in an exact half; the nudge keeps those
    on one side whichever way the last bit of the sum fell.
    """
    return df.select(
        *[
            F.round(F.col(c) + NUDGE, places).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# Shared inputs -------------------------------------------------------------


def _summary(t: Tables) -> DataFrame:
    return rollups.item_summary(t.reviews())


def _stored_summary(t: Tables) -> DataFrame:
    """The item summary as a table, for queries that need it more than once."""
    return writers.store(_summary(t), f"{_scratch(t)}/item_summary.parquet")


def _genre_labels(t: Tables) -> DataFrame:
    return categories.genre_labels(t.genre_bridge(), t.genres())


def _owner_labels(t: Tables) -> DataFrame:
    return owners.owner_labels(t.owner_bridge(), t.owners())


def _contrast(t: Tables, summary: DataFrame | None = None) -> DataFrame:
    summary = summary or _summary(t)
    return items.engagement_contrast(summary, t.items(), td.CONTRAST_MORE_THAN)


def _volume(t: Tables, summary: DataFrame | None = None) -> DataFrame:
    summary = summary or _summary(t)
    return categories.category_volume(summary, _genre_labels(t))


def _negativity(t: Tables, summary: DataFrame | None = None) -> DataFrame:
    summary = summary or _summary(t)
    return items.negativity_by_tier(summary, t.items(), td.NEGATIVITY_MORE_THAN)


def _matrix(t: Tables) -> DataFrame:
    return items.tier_access_matrix(_summary(t), t.items(), td.NEGATIVITY_MORE_THAN)


def _sentiment(t: Tables) -> DataFrame:
    return categories.category_sentiment(_summary(t), _genre_labels(t), td.SENTIMENT_MORE_THAN)


def _ratings(t: Tables, summary: DataFrame | None = None) -> DataFrame:
    summary = summary or _summary(t)
    return items.item_ratings(
        summary, t.items(), t.owner_bridge(), t.owners(), td.RATING_AT_LEAST
    )


def _performance(t: Tables, summary: DataFrame | None = None) -> DataFrame:
    summary = summary or _summary(t)
    return owners.owner_performance(
        summary, t.items(), _owner_labels(t), td.OWNER_ITEMS, td.OWNER_REVIEWS
    )


def _timeline(t: Tables) -> DataFrame:
    """Months and totals of the categories from one summary, so the fact is read once."""
    months = rollups.item_month_summary(t.reviews())
    months = writers.store(months, f"{_scratch(t)}/item_months.parquet")
    totals = rollups.roll_up(months, "item_id", sums=["reviews"])
    return categories.category_timeline(months, _genre_labels(t), _volume(t, totals))


def _daily(t: Tables) -> DataFrame:
    return reviews.daily_volume(t.reviews(), td.DAY_AT_LEAST, ordered=False)


def _anomalies(t: Tables) -> DataFrame:
    return anomalies.negativity_anomalies(_daily(t))


def _flagged(t: Tables) -> DataFrame:
    return anomalies.flagged_days(_anomalies(t))


def _top_items(t: Tables) -> DataFrame:
    return anomalies.top_items(t.reviews(), _flagged(t), t.items())


def _day_keywords(t: Tables) -> DataFrame:
    flagged = anomalies.reviews_on(t.reviews(), _flagged(t)).filter(~F.col("recommended"))
    return anomalies.keywords(t.with_text(flagged), "review_date", language="en")


def _profiles(t: Tables) -> DataFrame:
    return authors.author_profiles(t.reviews(author=True), td.PROFILE_AT_LEAST)


def _log_hours(t: Tables) -> DataFrame:
    return reviews.log_hours_sample(t.reviews())


def _scratch(t: Tables) -> str:
    return files.scratch_folder(t.spark)


# Sources -------------------------------------------------------------------


def _documents_csv(t: Tables) -> str:
    """The documents as CSV: texts with commas, quotes and line breaks."""
    path = f"{_scratch(t)}/documents.csv"
    t.raw("documents").write.options(
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


@query
def s01_csv_scan(t: Tables) -> DataFrame:
    return read_csv(t.spark, _documents_csv(t), t.raw("documents").schema)


@query
def s01_csv_scan_in_parallel(t: Tables) -> DataFrame:
    return read_csv_in_parallel(t.spark, _documents_csv(t), t.raw("documents").schema)


def _inches_csv(t: Tables) -> tuple[str, T.StructType]:
    """Inches without quoting, as review texts have them, and the schema of the file."""
    path = f"{_scratch(t)}/inches.csv"
    wide = F.concat(F.col("n_chars").cast("string"), F.lit('" wide')).alias("width")
    t.raw("documents").select("doc_id", wide, "lang").write.options(
        header=True, quote="", escapeQuotes=False
    ).csv(path)
    return path, T.StructType().add("doc_id", "long").add("width", "string").add("lang", "string")


@query
def s01_csv_stray_quotes(t: Tables) -> DataFrame:
    return read_csv(t.spark, *_inches_csv(t))


@query
def s01_csv_stray_quotes_in_parallel(t: Tables) -> DataFrame:
    return read_csv_in_parallel(t.spark, *_inches_csv(t), strict=False)


@query
def s02_ingest_extra_columns(t: Tables) -> DataFrame:
    """A declared key in another case, and columns that no schema declares."""
    folder = _scratch(t)
    nations = t.raw("nation").select(F.col("n_nationkey").alias("N_NATIONKEY"), "n_name", "n_regionkey")
    nations.write.options(header=True, escape='"').csv(f"{folder}/csv/nation.csv")
    schemas = {"nation": T.StructType().add("n_nationkey", "long")}
    tables = ingest.ingest_folder(t.spark, f"{folder}/csv", f"{folder}/tables", schemas)
    return tables["nation"].select("n_nationkey", "n_name", "n_regionkey")


@query
def s02_ingest_folder(t: Tables) -> DataFrame:
    folder = _scratch(t)
    names = ["region", "nation", "supplier", "customer", "part"]
    for name in names:
        t.raw(name).write.options(header=True, escape='"').csv(f"{folder}/csv/{name}.csv")
    tables = ingest.ingest_folder(
        t.spark, f"{folder}/csv", f"{folder}/tables", {n: t.raw(n).schema for n in names}
    )
    return readers.union_parts(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(ingest.display_name(name)).alias("display_name"),
                "rows",
            )
            for name, df in tables.items()
        ]
    )


@query
def s03_multipart_scan(t: Tables) -> DataFrame:
    folder = _scratch(t)
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    for number, flag in enumerate(["A", "N", "R"], start=1):
        part = lines.filter(F.col("l_returnflag") == flag)
        part.write.parquet(f"{folder}/reviews_part{number:02d}.parquet")
    return readers.read_parts(t.spark, folder, "reviews")


@query
def s04_dimension_scan(t: Tables) -> DataFrame:
    return readers.read_table(t.spark, f"{t.folder}/part.parquet", t.raw("part").schema)


@query
def s05_projected_scan(t: Tables) -> DataFrame:
    columns = ["l_partkey", "l_returnflag"]
    return readers.read_table(t.spark, f"{t.folder}/lineitem.parquet", columns=columns)


@query
def s06_load_tables(t: Tables) -> DataFrame:
    found, missing = readers.load_tables(
        t.spark, t.folder, ["region", "nation", "supplier", "no_such_table"]
    )
    present = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(True).alias("found"), "rows"
        )
        for name, df in found.items()
    ]
    absent = t.spark.createDataFrame(
        [(name, False, 0) for name in missing], "table_name string, found boolean, rows long"
    )
    return readers.union_parts([*present, absent])


@query
def s07_load_profile(t: Tables) -> DataFrame:
    names = ["region", "nation", "supplier", "orders", "lineitem"]
    profile = readers.load_profile({n: t.raw(n) for n in names})
    return profile.select(
        F.col("table").alias("table_name"),
        F.col("column").alias("column_name"),
        F.col("type").alias("column_type"),
        "rows",
        "non_null",
    )


# Sinks ---------------------------------------------------------------------


@query
def k01_overwrite_table(t: Tables) -> DataFrame:
    path = f"{_scratch(t)}/orders.parquet"
    writers.write_table(t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return t.spark.read.parquet(path)


@query
def k02_balanced_files(t: Tables) -> DataFrame:
    path = f"{_scratch(t)}/lineitem.parquet"
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    writers.write_balanced(lines, path, max_bytes=200_000, target_bytes=150_000)
    return t.spark.read.parquet(path)


@query
def k02_file_sizes(t: Tables) -> DataFrame:
    """Files of a balanced write: more than one, none above the limit, none of half the mean."""
    path = f"{_scratch(t)}/lineitem.parquet"
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    n = writers.write_balanced(lines, path, max_bytes=20_000, target_bytes=15_000)
    found = t.spark.read.parquet(path).groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    )
    return found.agg(F.count(F.lit(1)).alias("rows")).agg(
        (F.count(F.lit(1)) == n).alias("all_files_counted"),
        (F.count(F.lit(1)) > 1).alias("several"),
        (F.max("bytes") <= 20_000).alias("within_limit"),
        (F.min("bytes") >= F.avg("bytes") / 2).alias("even"),
        F.sum("rows").alias("rows"),
    )


@query
def k03_single_file(t: Tables) -> DataFrame:
    path = f"{_scratch(t)}/ratings.parquet"
    writers.write_balanced(_ratings(t), path)
    stored = t.spark.read.parquet(path).withColumn("file", F.input_file_name())
    return stored.agg(
        F.count_distinct("file").alias("files"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("total_reviews").alias("total_reviews"),
    )


@query
def k04_partition_refresh(t: Tables) -> DataFrame:
    path = f"{_scratch(t)}/orders_by_status"
    orders = t.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write_partitions(orders, path, "o_orderstatus")
    writers.write_partitions(orders.filter(F.col("o_orderstatus") == "F"), path, "o_orderstatus")
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query
def k05_shared_result(t: Tables) -> DataFrame:
    summary = _stored_summary(t)
    negativity = items.negativity_by_tier(summary, t.items(), td.NEGATIVITY_MORE_THAN)
    matrix = items.tier_access_matrix(summary, t.items(), td.NEGATIVITY_MORE_THAN)
    per_tier = negativity.groupBy("price_tier").agg(F.count(F.lit(1)).alias("items"))
    return rounded(matrix.join(per_tier, "price_tier"))


# Projections, filters, predicates, samples ---------------------------------


@query
def p01_select_rename(t: Tables) -> DataFrame:
    return t.items().withColumnRenamed("item_name", "app_name").select("item_id", "app_name")


@query
def p02_unit_conversion(t: Tables) -> DataFrame:
    return rounded(t.reviews().select("review_id", measures.hours("minutes_played").alias("hours")))


@query
def p03_key_cast(t: Tables) -> DataFrame:
    digits = F.regexp_replace("p_brand", "Brand#", "")
    return t.raw("part").select(
        "p_partkey",
        measures.to_key(digits).alias("brand_key"),
        measures.to_key("p_brand").alias("malformed_key"),
        measures.to_number(digits).alias("brand_number"),
    )


@query
def p04_not_null(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    return joined.filter(F.col("toxic").isNotNull()).select("doc_id", "toxic")


@query
def p05_conjunction(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    wanted = F.col("toxic").isNotNull() & F.col("quality").isNotNull() & (F.col("quality") > 0)
    return joined.filter(wanted).select("doc_id", "source", "quality")


@query
def p06_non_empty_text(t: Tables) -> DataFrame:
    letters = F.regexp_replace("text", "[A-Za-z]", "")
    return (
        t.documents()
        .filter(labels.non_empty("text") & labels.non_empty(letters))
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("texts"))
    )


@query
def p07_boolean_filter(t: Tables) -> DataFrame:
    flagged = t.raw("documents").join(t.raw("labels"), "doc_id", "left").select(
        "source", (F.col("toxic") == 1).alias("negative")
    )
    yes = flagged.filter("negative").withColumn("kind", F.lit("true"))
    no = flagged.filter(~F.col("negative")).withColumn("kind", F.lit("false"))
    return (
        yes.unionByName(no).groupBy("source", "kind").agg(F.count(F.lit(1)).alias("texts"))
    )


@query
def p08_equality_filter(t: Tables) -> DataFrame:
    return t.raw("documents").filter(F.col("lang") == "en").select("doc_id", "source", "n_chars")


@query
def p09_in_result(t: Tables) -> DataFrame:
    largest = ranking.top_k(_summary(t), "reviews", 10, ["item_id"])
    return restrict.keep_top(t.reviews(), largest, "item_id").select("review_id", "item_id")


@query
def p10_drop_null_subset(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    return joined.dropna(subset=["quality", "toxic"]).select("doc_id", "quality", "toxic")


@query
def p11_drop_null_any(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    return joined.groupBy("toxic").agg(F.count("doc_id").alias("texts")).dropna()


@query
def p12_having(t: Tables) -> DataFrame:
    summary = _summary(t)
    strict = summary.filter(F.col("reviews") > 30).withColumn("kind", F.lit("over 30"))
    inclusive = summary.filter(F.col("reviews") >= 30).withColumn("kind", F.lit("at least 30"))
    return strict.unionByName(inclusive).select("kind", "item_id", "reviews")


@query
def p13_price_tier(t: Tables) -> DataFrame:
    return t.items().select("item_id", labels.price_tier("is_free", "price").alias("price_tier"))


@query
def p14_two_way_label(t: Tables) -> DataFrame:
    return _summary(t).select(
        "item_id",
        items.access_label().alias("access"),
        labels.flag_label(F.col("early") > 0, "some", "none").alias("any_early"),
    )


@query
def p15_clip_range(t: Tables) -> DataFrame:
    contrast = _contrast(t)
    return rounded(
        contrast.filter(
            (F.col("avg_hours_positive") <= td.CLIP_HOURS)
            & (F.col("avg_hours_negative") <= td.CLIP_HOURS)
        )
    )


@query
def p16_cap_value(t: Tables) -> DataFrame:
    return _summary(t).select("item_id", measures.cap("reviews", 30).alias("capped"))


@query
def p17_search_label(t: Tables) -> DataFrame:
    matches = t.items().filter(labels.contains_text("item_name", "  RED "))
    return matches.groupBy("item_name").agg(F.count(F.lit(1)).alias("matches"))


@query
def p18_hash_sample(t: Tables) -> DataFrame:
    return sampling.hash_sample(t.reviews(), "review_id", 0.05).select("review_id", "item_id")


@query
def p18_bernoulli_sample(t: Tables) -> DataFrame:
    """Spark's own sample: its share within five deviations, its rows all of the fact."""
    fact = t.reviews().select("review_id", "item_id")
    taken = sampling.bernoulli_sample(fact, 0.05, seed=7)
    total = fact.agg(F.count(F.lit(1))).scalar()
    known = taken.join(fact.distinct(), ["review_id", "item_id"], "left_semi")
    slack = 5 * F.sqrt(F.lit(0.05 * 0.95) * total)
    return taken.agg(
        (F.abs(F.count(F.lit(1)) - 0.05 * total) <= slack).alias("share_in_bounds"),
        (F.count(F.lit(1)) == known.agg(F.count(F.lit(1))).scalar()).alias("rows_of_the_fact"),
    )


# Joins ---------------------------------------------------------------------


@query
def j01_aggregate_dimension(t: Tables) -> DataFrame:
    names = t.items().select("item_id", "item_name")
    return _summary(t).select("item_id", "reviews").join(names, "item_id")


@query
def j02_bridge_dimension(t: Tables) -> DataFrame:
    return _genre_labels(t)


@query
def j03_fact_bridge(t: Tables) -> DataFrame:
    sums = ["reviews", "positive", "rows"]
    return members.sum_by_label(_summary(t), _genre_labels(t), "genre_name", sums)


@query
def j03_fact_bridge_salted(t: Tables) -> DataFrame:
    sums = ["reviews", "positive", "rows"]
    return members.sum_by_label(
        _summary(t), _owner_labels(t), "owner_name", sums, salts=members.SALTS, heavy=20
    )


@query
def j04_left_join(t: Tables) -> DataFrame:
    first = members.primary_member(t.owner_bridge(), t.owners(), "owner_id", "owner_name")
    return t.items().select("item_id", "item_name").join(first, "item_id", "left")


@query
def j05_existence(t: Tables) -> DataFrame:
    free = t.items().filter("is_free")
    return restrict.keep_known(_summary(t), free, "item_id").select("item_id", "reviews")


@query
def j06_aggregate_aggregate(t: Tables) -> DataFrame:
    summary = _stored_summary(t)
    means = _contrast(t, summary).select("item_id", "avg_hours_negative")
    return rounded(_negativity(t, summary).select("item_id", "price_tier").join(means, "item_id"))


@query
def j07_three_results(t: Tables) -> DataFrame:
    summary = _stored_summary(t)
    means = _contrast(t, summary).select("item_id", "avg_hours_positive", "avg_hours_negative")
    rated = _ratings(t, summary).select("item_id", "owner_name", "pct_positive")
    owned = _performance(t, summary).select("owner_name", "num_games")
    return rounded(rated.join(means, "item_id").join(owned, "owner_name"))


@query
def j08_semi_top(t: Tables) -> DataFrame:
    largest = ranking.top_k(_volume(t), "review_count", 5, ["genre_name"])
    return restrict.keep_top(_genre_labels(t), largest, "genre_name")


@query
def j09_star_chain(t: Tables) -> DataFrame:
    return (
        restrict.keep_known(t.genre_bridge(), t.items(), "item_id")
        .join(t.genres(), "genre_id")
        .join(_summary(t).select("item_id", "reviews"), "item_id")
        .select("item_id", "genre_id", "genre_name", "reviews")
    )


# Aggregations --------------------------------------------------------------


@query
def a01_group_count(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels").withColumnRenamed("doc_id", "d"),
                                     F.col("doc_id") == F.col("d"), "left")
    return joined.groupBy("source").agg(F.count("d").alias("labelled"))


@query
def a02_conditional_count(t: Tables) -> DataFrame:
    return t.reviews().groupBy("item_id").agg(
        measures.count_where("recommended").alias("positive"),
        measures.count_where(~F.col("recommended")).alias("negative"),
    )


@query
def a03_conditional_mean(t: Tables) -> DataFrame:
    return rounded(
        t.reviews().groupBy("item_id").agg(
            measures.mean_where("recommended", measures.hours("minutes_played")).alias("up"),
            measures.mean_where(~F.col("recommended"), measures.hours("minutes_played")).alias(
                "down"
            ),
        )
    )


@query
def a04_rate(t: Tables) -> DataFrame:
    flagged = t.raw("documents").join(t.raw("labels"), "doc_id", "left").withColumn(
        "negative", F.col("toxic") == 1
    )
    return rounded(
        flagged.groupBy("source").agg(
            measures.rate("negative").alias("rate_of_all"),
            measures.rate("negative", null_as_zero=False).alias("rate_of_known"),
        )
    )


@query
def a05_mean(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    return rounded(joined.groupBy("source").agg(F.avg("quality").alias("mean_quality")))


@query
def a06_distinct_count(t: Tables) -> DataFrame:
    return t.raw("lineitem").groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("items")
    )


@query
def a06_distinct_count_approx(t: Tables) -> DataFrame:
    return t.raw("lineitem").groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("items"),
        # five times the relative deviation that is asked for
        (
            F.abs(F.approx_count_distinct("l_partkey", 0.05) - F.count_distinct("l_partkey"))
            <= 1 + 5 * 0.05 * F.count_distinct("l_partkey")
        ).alias("near"),
    )


@query
def a07_group_minimum(t: Tables) -> DataFrame:
    return t.owner_bridge().groupBy("item_id").agg(F.min("owner_id").alias("owner_id"))


@query
def a08_primary_member(t: Tables) -> DataFrame:
    return members.primary_member(t.owner_bridge(), t.owners(), "owner_id", "owner_name")


@query
def a09_rounded_percentage(t: Tables) -> DataFrame:
    return _summary(t).select(
        "item_id",
        measures.pct("positive", "reviews", 1).alias("one_place"),
        measures.pct("negative", "reviews", 2).alias("two_places"),
    )


@query
def a10_rounded_mean_sorted(t: Tables) -> DataFrame:
    return (
        t.reviews()
        .groupBy("early_access", "recommended")
        .agg(F.round(F.avg(measures.hours("minutes_played")), 2).alias("avg_hours"))
        .orderBy(F.desc("recommended"), F.desc("avg_hours"))
    )


@query
def a11_multi_key_group(t: Tables) -> DataFrame:
    return rollups.item_month_summary(t.reviews())


@query
def a12_mean_of_means(t: Tables) -> DataFrame:
    means = ["avg_hours_positive", "avg_hours_negative"]
    summary = _stored_summary(t)
    joined = _ratings(t, summary).select("item_id", "owner_name").join(
        _contrast(t, summary).select("item_id", *means), "item_id"
    )
    return rounded(joined.groupBy("owner_name").agg(*[F.avg(c).alias(c) for c in means]))


@query
def a13_mean_of_percentages(t: Tables) -> DataFrame:
    return rounded(_matrix(t))


@query
def a14_share_of_total(t: Tables) -> DataFrame:
    return rounded(dist.share_of_total(_volume(t), "review_count"))


@query
def a15_scalar_figures(t: Tables) -> DataFrame:
    return rounded(
        _ratings(t).agg(
            F.count(F.lit(1)).alias("items"),
            F.sum("total_reviews").alias("reviews"),
            F.avg("pct_positive").alias("mean_positivity"),
        )
    )


@query
def a16_box_summary(t: Tables) -> DataFrame:
    return rounded(dist.box_summary(_negativity(t), "price_tier", "toxicity_percent"), 4)


@query
def a16_box_summary_approx(t: Tables) -> DataFrame:
    probabilities = dict(zip(("q1", "median", "q3"), dist.QUARTILES))
    found = dist.quantiles_approx(_negativity(t), "price_tier", "toxicity_percent", probabilities)
    value, n = F.col("toxicity_percent"), F.count(F.lit(1))
    # ranks within the accuracy asked for (1 in 10,000) and one row
    near = [
        (
            (F.count_if(value <= F.col(name)) >= n * (p - 1e-4) - 1)
            & (F.count_if(value < F.col(name)) <= n * (p + 1e-4) + 1)
        ).alias(f"{name}_near")
        for name, p in probabilities.items()
    ]
    return _negativity(t).join(found, "price_tier").groupBy("price_tier").agg(n.alias("items"), *near)


@query
def a17_distribution_summary(t: Tables) -> DataFrame:
    labelled = t.reviews().select(
        labels.two_way(F.col("recommended"), "up", "down").alias("vote"),
        measures.log_hours("minutes_played").alias("log_hours"),
    )
    return dist.histogram(labelled, "vote", "log_hours", 0.0, 8.0, 32)


@query
def a17_exact_quantiles(t: Tables) -> DataFrame:
    probabilities = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    return rounded(dist.quantiles(t.reviews(), "recommended", "minutes_played", probabilities), 4)


@query
def a18_scaled_by_max(t: Tables) -> DataFrame:
    summary = _summary(t).select("item_id", "reviews")
    largest = dist.column_max(summary, "reviews")
    return rounded(
        summary.withColumn("size", measures.relative_size("reviews", largest, 400, 20))
    )


@query
def a19_row_count(t: Tables) -> DataFrame:
    return _anomalies(t).groupBy("anomaly").agg(F.count(F.lit(1)).alias("days"))


# Ordered analytics ---------------------------------------------------------


def _band(t: Tables) -> DataFrame:
    shares = _daily(t).withColumn("neg_ratio", measures.pct("negative", "total"))
    return series.rolling_band(shares, "review_date", "neg_ratio")


@query
def w01_rolling_mean(t: Tables) -> DataFrame:
    return rounded(_band(t).select("review_date", "rolling_mean"))


@query
def w02_rolling_deviation(t: Tables) -> DataFrame:
    return rounded(_band(t).select("review_date", "rolling_std"))


@query
def w03_bands(t: Tables) -> DataFrame:
    return rounded(_band(t).select("review_date", "lower_band", "upper_band"))


@query
def w04_flag_above(t: Tables) -> DataFrame:
    return series.flag_above(_band(t), "neg_ratio", "upper_band").select("review_date", "anomaly")


@query
def w05_top_per_group(t: Tables) -> DataFrame:
    counts = (
        t.reviews()
        .withColumn("review_date", dates.epoch_to_date("created_at"))
        .groupBy("review_date", "item_id")
        .agg(F.count("review_id").alias("n"))
    )
    return ranking.top_k_per_group(counts, "review_date", "n", 3, ["item_id"])


@query
def w06_ecdf(t: Tables) -> DataFrame:
    lines = t.raw("lineitem").select(
        "l_returnflag",
        "l_extendedprice",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                 "l_shipdate").alias("key"),
    )
    placed = dist.ecdf(lines, "l_returnflag", "l_extendedprice", "key")
    return rounded(placed.select("l_returnflag", "l_extendedprice", "cdf"), 8)


@query
def w07_ranked_text(t: Tables) -> DataFrame:
    counts = t.reviews().join(t.items().select("item_id", "item_name", "price"), "item_id")
    per_name = counts.groupBy("price", "item_name").agg(F.count("review_id").alias("n"))
    top = ranking.top_k_per_group(per_name, "price", "n", 3, ["item_name"])
    text = F.concat("item_name", F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    return ranking.ranked_text(top, "price", "rank", text, "; ", "top_names")


# Sort, limit, top-k --------------------------------------------------------


@query
def l01_global_sort(t: Tables) -> DataFrame:
    return t.items().orderBy(F.desc("price"), "item_id").select("price", "item_id")


@query
def l02_top_k(t: Tables) -> DataFrame:
    return ranking.top_k(_summary(t), "reviews", 20, ["item_id"]).select("item_id", "reviews")


@query
def l03_bottom_k(t: Tables) -> DataFrame:
    return ranking.bottom_k(_summary(t), "reviews", 20, ["item_id"]).select("item_id", "reviews")


@query
def l04_top_categories_restrict(t: Tables) -> DataFrame:
    largest = ranking.top_k(_volume(t), "review_count", 5, ["genre_name"])
    return restrict.keep_top(t.genres(), largest, "genre_name")


@query
def l05_top_resorted(t: Tables) -> DataFrame:
    top = ranking.top_k(_sentiment(t), "pct_positive", 15, ["genre_name"])
    return top.orderBy("pct_positive", "genre_name").select("genre_name", "pct_positive")


# Set operations ------------------------------------------------------------


@query
def u01_bag_union(t: Tables) -> DataFrame:
    lines = t.raw("lineitem").select("l_orderkey", "l_linestatus")
    return readers.union_parts(
        [lines.filter("l_linestatus = 'F'"), lines.filter("l_linestatus = 'O'"), lines]
    ).groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("rows"))


@query
def u02_distinct_sorted(t: Tables) -> DataFrame:
    return _negativity(t).select("price_tier").distinct().orderBy("price_tier")


# Reshape -------------------------------------------------------------------


@query
def h01_pivot_matrix(t: Tables) -> DataFrame:
    wide = items.tier_access_pivot(_matrix(t))
    early, released = labels.EARLY_LABEL, labels.RELEASED_LABEL
    return rounded(
        wide.select("price_tier", F.col(early).alias("early"), F.col(released).alias("released"))
    )


def _months_by_tier(t: Tables) -> DataFrame:
    tiers = t.items().select("item_id", labels.price_tier("is_free", "price").alias("tier"))
    monthly = rollups.item_month_summary(t.reviews()).join(tiers, "item_id")
    return monthly.groupBy("review_month", "tier").agg(F.sum("reviews").alias("n"))


@query
def h02_pivot_filled(t: Tables) -> DataFrame:
    wide = reshape.pivot_matrix(
        _months_by_tier(t), "review_month", "tier", "n", labels.TIERS, fill=0
    )
    names = dict(zip(labels.TIERS, ("free", "low", "mid", "high")))
    return wide.select("review_month", *[F.col(f"`{a}`").alias(b) for a, b in names.items()])


@query
def h03_unpivot(t: Tables) -> DataFrame:
    return reshape.unpivot_matrix(
        h02_pivot_filled(t), "review_month", ["free", "low", "mid", "high"], "tier", "n"
    )


@query
def h04_lookup_default(t: Tables) -> DataFrame:
    text = anomalies.top_items_text(_top_items(t))
    return reshape.with_lookup(
        _daily(t).select("review_date", "total"), text, "review_date", "top_items"
    )


# Scalar functions ----------------------------------------------------------


@query
def f01_math(t: Tables) -> DataFrame:
    share = measures.ratio("positive", "reviews") * 100
    return rounded(
        _summary(t).select(
            "item_id",
            F.log1p("reviews").alias("log_reviews"),
            F.expm1(F.log1p("reviews")).alias("back"),
            measures.half_even(F.col("reviews") / 4, 1).alias("half_even"),
            F.round(F.col("reviews") / 4, 1).alias("half_up"),
            F.floor(share).alias("whole_share"),
        )
    )


@query
def f02_dates(t: Tables) -> DataFrame:
    day = dates.epoch_to_date("created_at")
    return t.reviews().select(
        "review_id",
        day.alias("review_date"),
        dates.month_start(day).alias("review_month"),
        dates.iso_text(day).alias("date_text"),
        dates.parse_date(dates.iso_text(day)).alias("parsed"),
        dates.parse_date(F.col("created_at").cast("string")).alias("malformed"),
    )


@query
def f03_strings(t: Tables) -> DataFrame:
    normalised = words.normalise_text("review_text")
    return t.texts().select(
        "doc_id",
        F.col("doc_id").cast("string").alias("doc_text"),
        words.stripped_length(normalised).cast("bigint").alias("letters"),
        F.md5(normalised.cast("binary")).alias("normalised_md5"),
    )


@query
def f04_formatting(t: Tables) -> DataFrame:
    summary = _summary(t)
    scaled = summary.select("item_id", (F.col("reviews") * F.col("item_id")).alias("n"),
                            measures.pct("positive", "reviews").alias("p"))
    return scaled.select(
        "item_id",
        labels.compact_count("n").alias("compact"),
        labels.axis_count("n").alias("axis"),
        labels.grouped_count("n").alias("grouped"),
        labels.percent_text(F.round("p", 3)).alias("percent"),
    )


@query
def f05_conditionals(t: Tables) -> DataFrame:
    joined = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    return joined.select(
        "doc_id",
        labels.flag_label(F.col("toxic") == 1, "toxic", "clean").alias("label"),
        F.coalesce(labels.flag_label(F.col("toxic") == 1, "toxic", "clean"), F.lit("")).alias(
            "filled"
        ),
        labels.bucketize(
            [(F.col("quality") == 1, "good"), (F.col("quality") == 0, "poor")], "unknown"
        ).alias("quality"),
    )


@query
def f06_marker_sizes(t: Tables) -> DataFrame:
    summary = _summary(t).select("item_id", "reviews")
    largest = dist.column_max(summary, "reviews")
    return rounded(
        summary.select(
            "item_id",
            measures.relative_size("reviews", largest, 400, 20).alias("wide"),
            measures.relative_size("reviews", largest, 30, 4).alias("narrow"),
            (measures.cap("reviews", 50) * 2 + 5).alias("capped"),
        )
    )


# Text analytics ------------------------------------------------------------


def _english(t: Tables) -> DataFrame:
    return t.texts().filter((F.col("language") == "en") & labels.non_empty("review_text"))


@query
def x01_normalised_texts(t: Tables) -> DataFrame:
    texts = terms.normalised_texts(t.texts(), "review_text")
    return texts.select("doc_id", F.md5(F.col("normalised").cast("binary")).alias("text_md5"))


@query
def x02_terms(t: Tables) -> DataFrame:
    found = terms.exploded_terms(_english(t), ["doc_id"], "review_text")
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.count_distinct("term").alias("distinct_terms")
    )


@query
def x02_term_counts(t: Tables) -> DataFrame:
    return terms.term_totals(terms.exploded_terms(_english(t), ["grp"], "review_text"), "grp")


@query
def x03_vocabulary(t: Tables) -> DataFrame:
    return terms.vocabulary(x02_term_counts(t), "grp")


@query
def x04_tfidf(t: Tables) -> DataFrame:
    return rounded(terms.tfidf(_english(t), "grp", "doc_id", "review_text"))


@query
def x05_keywords_alphabetical(t: Tables) -> DataFrame:
    return terms.alphabetical_keywords(_english(t), "grp", "review_text")


@query
def x05_keywords_by_weight(t: Tables) -> DataFrame:
    return terms.weighted_keywords(_english(t), "grp", "doc_id", "review_text")


@query
def x06_group_minimum(t: Tables) -> DataFrame:
    return anomalies.keywords(t.texts(), "grp", language="en")


# Named analytics -----------------------------------------------------------


@query
def q01_item_engagement_contrast(t: Tables) -> DataFrame:
    return rounded(_contrast(t))


@query
def q02_category_volume(t: Tables) -> DataFrame:
    return _volume(t)


@query
def q03_item_negativity_by_tier(t: Tables) -> DataFrame:
    return _negativity(t)


@query
def q04_flag_split(t: Tables) -> DataFrame:
    return rounded(reviews.flag_shares(reviews.flag_split(t.reviews())))


@query
def q05_category_sentiment(t: Tables) -> DataFrame:
    return _sentiment(t)


@query
def q06_log_measure_sample(t: Tables) -> DataFrame:
    return rounded(_log_hours(t))


@query
def q07_tier_access_matrix(t: Tables) -> DataFrame:
    return rounded(_matrix(t))


@query
def q08_item_ratings(t: Tables) -> DataFrame:
    return _ratings(t)


@query
def q09_most_active_users(t: Tables) -> DataFrame:
    return rounded(authors.most_active_authors(t.reviews(author=True)))


@query
def q10_user_profiles(t: Tables) -> DataFrame:
    return rounded(_profiles(t))


@query
def q11_daily_volume(t: Tables) -> DataFrame:
    return reviews.daily_volume(t.reviews(), td.DAY_AT_LEAST)


@query
def q12_owner_performance(t: Tables) -> DataFrame:
    return rounded(_performance(t))


@query
def q13_category_timeline(t: Tables) -> DataFrame:
    return _timeline(t)


@query
def q14_category_vote_engagement(t: Tables) -> DataFrame:
    return categories.category_vote_engagement(t.reviews(), t.items(), _genre_labels(t))


@query
def q15_negativity_anomalies(t: Tables) -> DataFrame:
    return rounded(_anomalies(t))


@query
def q16_anomaly_top_items(t: Tables) -> DataFrame:
    return _top_items(t)


@query
def q16_anomaly_top_items_text(t: Tables) -> DataFrame:
    return anomalies.top_items_text(_top_items(t))


@query
def q17_anomaly_keywords(t: Tables) -> DataFrame:
    return _day_keywords(t)


@query
def q17_anomaly_keywords_sampled(t: Tables) -> DataFrame:
    return anomalies.keywords(t.texts(), "grp", language="en", key="doc_id", fraction=0.4)


@query
def q17_anomaly_keywords_by_weight(t: Tables) -> DataFrame:
    return anomalies.keywords(t.texts(), "grp", language="en", key="doc_id", by_weight=True)


def _flagged_texts(t: Tables) -> DataFrame:
    """Down-voted reviews of unusual days with their texts and a key for each."""
    flagged = anomalies.reviews_on(t.reviews(key=True), _flagged(t)).filter(~F.col("recommended"))
    return t.with_text(flagged)


@query
def q17_flagged_day_keywords_sampled(t: Tables) -> DataFrame:
    texts = _flagged_texts(t)
    return anomalies.keywords(texts, "review_date", language="en", key="text_key", fraction=0.4)


@query
def q17_flagged_day_keywords_by_weight(t: Tables) -> DataFrame:
    texts = _flagged_texts(t)
    return anomalies.keywords(texts, "review_date", language="en", key="text_key", by_weight=True)


def _report(t: Tables, fact: DataFrame) -> DataFrame:
    """The fact is read twice: for the daily series, and for the reviews of unusual days."""
    scratch = _scratch(t)
    daily = reviews.daily_volume(fact, td.DAY_AT_LEAST, ordered=False)
    series = anomalies.negativity_anomalies(writers.store(daily, f"{scratch}/daily.parquet"))
    hits = anomalies.reviews_on(fact, anomalies.flagged_days(series)).filter(~F.col("recommended"))
    hits = hits.select("review_id", "item_id", "review_date", "recommended")
    hits = writers.store(hits, f"{scratch}/flagged.parquet")
    said = anomalies.keywords(t.with_text(hits), "review_date", language="en")
    text = anomalies.top_items_text(anomalies.top_items_of(hits, t.items()))
    return rounded(anomalies.anomaly_report(series, text, said.select("review_date", "keywords")))


@query
def q18_anomaly_report(t: Tables) -> DataFrame:
    return _report(t, t.reviews())


@query
def q18_anomaly_report_by_month(t: Tables) -> DataFrame:
    """The same from a fact stored by month, of which only the flagged months are read again."""
    path = f"{_scratch(t)}/reviews.parquet"
    writers.write_by_month(t.reviews(), path, "created_at")
    return _report(t, t.spark.read.parquet(path))


@query
def q19_best_items(t: Tables) -> DataFrame:
    return feeds.best_items(_ratings(t))


@query
def q19_worst_items(t: Tables) -> DataFrame:
    return feeds.worst_items(_ratings(t))


@query
def q20_tier_box_summary(t: Tables) -> DataFrame:
    return rounded(feeds.tier_box_summary(_negativity(t)), 4)


@query
def q21_sentiment_distribution(t: Tables) -> DataFrame:
    box, _ = feeds.hours_distribution(_log_hours(t))
    return rounded(box, 4)


@query
def q21_sentiment_histogram(t: Tables) -> DataFrame:
    _, bins = feeds.hours_distribution(_log_hours(t))
    return bins


@query
def q22_top_category_sentiment(t: Tables) -> DataFrame:
    return feeds.top_category_sentiment(_sentiment(t))


@query
def q23_top_categories(t: Tables) -> DataFrame:
    return feeds.top_categories(_volume(t))


@query
def q24_owner_ranking(t: Tables) -> DataFrame:
    return rounded(owners.owner_ranking(_performance(t)))


@query
def q25_owner_engagement_contrast(t: Tables) -> DataFrame:
    summary = _stored_summary(t)
    return rounded(
        owners.owner_engagement_contrast(
            _ratings(t, summary), _contrast(t, summary), _performance(t, summary)
        )
    )


@query
def q26_category_timeline_dense(t: Tables) -> DataFrame:
    return feeds.category_timeline_dense(_timeline(t))


@query
def q27_negative_hours_cdf(t: Tables) -> DataFrame:
    summary = _stored_summary(t)
    return rounded(items.negative_hours_cdf(_negativity(t, summary), _contrast(t, summary)))


@query
def q28_kpi_summary(t: Tables) -> DataFrame:
    split = reviews.flag_split(t.reviews())
    summary = _stored_summary(t)
    return rounded(
        feeds.kpi_summary(
            split, _ratings(t, summary), _performance(t, summary), _volume(t, summary)
        )
    )


@query
def q29_engagement_contrast_feed(t: Tables) -> DataFrame:
    return rounded(feeds.engagement_contrast_feed(_contrast(t), td.CLIP_HOURS, "ring"))


@query
def q30_user_profile_feed(t: Tables) -> DataFrame:
    return rounded(feeds.author_profile_feed(_profiles(t)))


@query
def q31_most_active_users_feed(t: Tables) -> DataFrame:
    return rounded(
        feeds.most_active_authors_feed(authors.most_active_authors(t.reviews(author=True)))
    )
