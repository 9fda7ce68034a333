"""SQL equivalents of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from reviewlens.catalog import testdata as td
from reviewlens.functions.labels import (
    EARLY_LABEL,
    NEGATIVE_LABEL,
    POSITIVE_LABEL,
    RELEASED_LABEL,
    TIER_FREE,
    TIER_HIGH,
    TIER_LOW,
    TIER_MID,
)
from reviewlens.functions.sampling import hash_threshold
from reviewlens.operators.terms import FEW_TEXTS_LABEL, NO_TERMS_LABEL
from reviewlens.plans.anomalies import NO_ITEMS_LABEL

TIER_CASE = f"""CASE WHEN is_free THEN '{TIER_FREE}' WHEN price < 15 THEN '{TIER_LOW}'
 WHEN price >= 50 THEN '{TIER_HIGH}' ELSE '{TIER_MID}' END"""
# English stop words without the forms that hold an apostrophe,
# written out here so that a wrong list in the library shows.
STOP_LIST = ", ".join(
    f"'{w}'"
    for w in """
    a about above after again against all am an and any are as at be because
    been before being below between both but by can cannot could did do does
    doing don down during each few for from further had has have having he her
    here hers herself him himself his how i if in into is it its itself just me
    more most my myself no nor not now of off on once only or other ought our
    ours ourselves out over own s same she should so some such t than that the
    their theirs them themselves then there these they this those through to
    too under until up very was we were what when where which while who whom
    why will with would you your yours yourself yourselves
    """.split()
)
HOURS = "minutes_played / 60.0"


def in_sample(key: str, fraction: float) -> str:
    return f"substr(md5(CAST({key} AS VARCHAR)), 1, 4) < '{hash_threshold(fraction)}'"


def normalised(text: str) -> str:
    return f"regexp_replace(lower({text}), '[^a-z\\s]', ' ', 'g')"


def stripped_length(text: str) -> str:
    return f"length(regexp_replace({text}, '^\\s+|\\s+$', '', 'g'))"


# Common table expressions: name -> (names it needs, text).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "reviews": (
        (),
        """SELECT l_orderkey AS review_id, l_partkey AS item_id, o_custkey AS author_id,
        l_returnflag <> 'R' AS recommended, l_extendedprice AS minutes_played,
        l_quantity AS items_owned, l_linestatus = 'F' AS early_access,
        CAST(epoch(l_shipdate) AS BIGINT) AS created_at,
        CAST(l_shipdate AS DATE) AS review_date,
        CAST(date_trunc('month', l_shipdate) AS DATE) AS review_month
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "items": (
        (),
        """SELECT p_partkey AS item_id, p_name AS item_name, p_brand = 'Brand#1' AS is_free,
        CAST(p_size AS DOUBLE) AS price FROM part""",
    ),
    "genre_bridge": (
        (),
        """SELECT DISTINCT l_partkey AS item_id, s_nationkey AS genre_id
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "owner_bridge": (
        (),
        """SELECT DISTINCT l_partkey AS item_id, l_suppkey AS owner_id
        FROM lineitem""",
    ),
    "item_genres": (
        ("genre_bridge",),
        """SELECT item_id, genre_id, n_name AS genre_name
        FROM genre_bridge JOIN nation ON genre_id = n_nationkey""",
    ),
    "item_owners": (
        ("owner_bridge",),
        """SELECT item_id, owner_id, s_name AS owner_name
        FROM owner_bridge JOIN supplier ON owner_id = s_suppkey""",
    ),
    "labelled": (
        (),
        """SELECT d.doc_id, d.source, d.lang, d.text, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "contrast": (
        ("reviews", "items"),
        f"""SELECT g.item_id, item_name, avg_hours_positive, avg_hours_negative, total_reviews
        FROM (SELECT item_id, avg({HOURS}) FILTER (recommended) AS avg_hours_positive,
              avg({HOURS}) FILTER (NOT recommended) AS avg_hours_negative,
              count(review_id) AS total_reviews
              FROM reviews WHERE minutes_played IS NOT NULL GROUP BY item_id
              HAVING count(review_id) > {td.CONTRAST_MORE_THAN}) g
        JOIN items USING (item_id)
        WHERE avg_hours_positive IS NOT NULL AND avg_hours_negative IS NOT NULL""",
    ),
    "volume": (
        ("reviews", "item_genres"),
        """SELECT genre_name, count(review_id) AS review_count
        FROM reviews JOIN item_genres USING (item_id) GROUP BY genre_name""",
    ),
    "negativity": (
        ("reviews", "items"),
        f"""SELECT item_id, total_reviews, negative_reviews,
        round(negative_reviews / total_reviews * 100, 2) AS toxicity_percent,
        {TIER_CASE} AS price_tier
        FROM (SELECT item_id, count(review_id) AS total_reviews,
              count(*) FILTER (NOT recommended) AS negative_reviews
              FROM reviews GROUP BY item_id
              HAVING count(review_id) > {td.NEGATIVITY_MORE_THAN}) g
        JOIN items USING (item_id)""",
    ),
    "access": (
        ("reviews",),
        f"""SELECT item_id, CASE WHEN avg(CASE WHEN early_access THEN 1 ELSE 0 END) > 0.5
        THEN '{EARLY_LABEL}' ELSE '{RELEASED_LABEL}' END AS access
        FROM reviews GROUP BY item_id""",
    ),
    "matrix": (
        ("negativity", "access"),
        """SELECT price_tier, access, avg(toxicity_percent) AS avg_toxicity
        FROM negativity JOIN access USING (item_id) GROUP BY price_tier, access""",
    ),
    "sentiment": (
        ("reviews", "item_genres"),
        f"""SELECT genre_name, positive, negative, total,
        round(positive / total * 100, 1) AS pct_positive,
        round(negative / total * 100, 1) AS pct_negative
        FROM (SELECT genre_name, count(*) FILTER (recommended) AS positive,
              count(*) FILTER (NOT recommended) AS negative, count(review_id) AS total
              FROM reviews JOIN item_genres USING (item_id) GROUP BY genre_name)
        WHERE total > {td.SENTIMENT_MORE_THAN}""",
    ),
    "primary_owner": (
        ("owner_bridge",),
        """SELECT item_id, s_name AS owner_name
        FROM (SELECT item_id, min(owner_id) AS owner_id FROM owner_bridge GROUP BY item_id)
        LEFT JOIN supplier ON owner_id = s_suppkey""",
    ),
    "ratings": (
        ("reviews", "items", "primary_owner"),
        f"""SELECT item_id, item_name, owner_name, total_reviews, positive_reviews,
        round(positive_reviews / total_reviews * 100, 1) AS pct_positive
        FROM (SELECT item_id, count(review_id) AS total_reviews,
              count(*) FILTER (recommended) AS positive_reviews
              FROM reviews GROUP BY item_id HAVING count(review_id) >= {td.RATING_AT_LEAST})
        JOIN items USING (item_id) LEFT JOIN primary_owner USING (item_id)
        WHERE item_name IS NOT NULL AND item_name <> ''""",
    ),
    "performance": (
        ("reviews", "items", "item_owners"),
        f"""SELECT owner_name, count(DISTINCT item_id) AS num_games,
        count(review_id) AS total_reviews,
        avg(CASE WHEN recommended THEN 1 ELSE 0 END) AS positivity_rate,
        avg({HOURS}) AS avg_playtime_hours
        FROM reviews JOIN items USING (item_id) JOIN item_owners USING (item_id)
        GROUP BY owner_name
        HAVING count(DISTINCT item_id) >= {td.OWNER_ITEMS}
        AND count(review_id) >= {td.OWNER_REVIEWS}""",
    ),
    "top_genres": (
        ("volume",),
        "SELECT genre_name FROM volume ORDER BY review_count DESC, genre_name LIMIT 5",
    ),
    "timeline": (
        ("reviews", "item_genres", "top_genres"),
        """SELECT review_month, genre_name, count(review_id) AS review_count
        FROM reviews JOIN item_genres USING (item_id)
        WHERE genre_name IN (SELECT genre_name FROM top_genres)
        GROUP BY review_month, genre_name""",
    ),
    "daily": (
        ("reviews",),
        f"""SELECT review_date, count(review_id) AS total,
        count(*) FILTER (NOT recommended) AS negative, count(*) FILTER (recommended) AS positive
        FROM reviews GROUP BY review_date HAVING count(review_id) >= {td.DAY_AT_LEAST}""",
    ),
    "rolling": (
        ("daily",),
        """SELECT *, CASE WHEN count(neg_ratio) OVER w >= 10
        THEN avg(neg_ratio) OVER w END AS rolling_mean,
        CASE WHEN count(neg_ratio) OVER w >= 10
        THEN stddev_samp(neg_ratio) OVER w END AS rolling_std
        FROM (SELECT *, negative / total * 100 AS neg_ratio FROM daily)
        WINDOW w AS (ORDER BY review_date ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""",
    ),
    "anomalies": (
        ("rolling",),
        """SELECT *, rolling_mean - rolling_std * 2 AS lower_band,
        rolling_mean + rolling_std * 2 AS upper_band,
        coalesce(neg_ratio > rolling_mean + rolling_std * 2, FALSE) AS anomaly FROM rolling""",
    ),
    "top_items": (
        ("reviews", "items", "anomalies"),
        """SELECT review_date, CAST(rank AS INTEGER) AS rank, item_id, item_name, neg_count
        FROM (SELECT *, row_number() OVER (PARTITION BY review_date
                     ORDER BY neg_count DESC, item_name, item_id) AS rank
              FROM (SELECT review_date, item_id, count(review_id) AS neg_count FROM reviews
                    WHERE NOT recommended
                    AND review_date IN (SELECT review_date FROM anomalies WHERE anomaly)
                    GROUP BY review_date, item_id)
              LEFT JOIN items USING (item_id))
        WHERE rank <= 3""",
    ),
    "top_items_text": (
        ("top_items",),
        f"""SELECT review_date, coalesce(string_agg(CASE WHEN item_name <> ''
        THEN '• ' || item_name || '  (' || format('{{:,}}', neg_count) || ' neg)' END, '<br>'
        ORDER BY rank), '{NO_ITEMS_LABEL}') AS top_items
        FROM top_items GROUP BY review_date""",
    ),
    "profiles": (
        ("reviews",),
        f"""SELECT author_id, avg(items_owned) AS games_owned, count(review_id) AS reviews_written,
        avg(CASE WHEN recommended THEN 1 ELSE 0 END) AS positivity_rate,
        avg({HOURS}) AS avg_playtime_hours
        FROM reviews WHERE author_id IS NOT NULL AND items_owned > 0 GROUP BY author_id
        HAVING count(review_id) >= {td.PROFILE_AT_LEAST} AND {in_sample("author_id", 0.15)}""",
    ),
    "active_authors": (
        ("reviews",),
        """SELECT author_id, count(review_id) AS num_reviews,
        avg(CASE WHEN recommended THEN 1 ELSE 0 END) AS positivity_rate,
        avg(items_owned) AS avg_games_owned
        FROM reviews WHERE author_id IS NOT NULL GROUP BY author_id
        ORDER BY num_reviews DESC, author_id LIMIT 20""",
    ),
    "log_hours": (
        ("reviews",),
        f"""SELECT ln(1 + {HOURS}) AS log_playtime,
        CASE WHEN recommended THEN '{POSITIVE_LABEL}' ELSE '{NEGATIVE_LABEL}' END AS sentiment
        FROM reviews WHERE minutes_played / 60.0 > 0 AND {in_sample("review_id", 0.05)}""",
    ),
    "doc_texts": (
        ("labelled",),
        """SELECT doc_id AS text_key, doc_id, source AS grp, text FROM labelled
        WHERE lang = 'en' AND text <> ''""",
    ),
    "negative_doc_texts": (
        ("labelled",),
        """SELECT doc_id AS text_key, doc_id, source AS grp, text FROM labelled
        WHERE lang = 'en' AND text <> '' AND toxic = 1""",
    ),
    "sampled_doc_texts": (
        ("negative_doc_texts",),
        f"SELECT * FROM negative_doc_texts WHERE {in_sample('doc_id', 0.4)}",
    ),
    "day_texts": (
        ("anomalies",),
        f"""SELECT l_orderkey * 1000 + l_linenumber AS text_key,
        CAST(l_shipdate AS DATE) AS grp, text
        FROM lineitem JOIN documents ON l_orderkey // {td.ORDERS_PER_DOCUMENT} = doc_id
        WHERE l_returnflag = 'R' AND lang = 'en' AND text <> ''
        AND CAST(l_shipdate AS DATE) IN (SELECT review_date FROM anomalies WHERE anomaly)""",
    ),
    "sampled_day_texts": (
        ("day_texts",),
        f"SELECT * FROM day_texts WHERE {in_sample('text_key', 0.4)}",
    ),
}


def text_parts(source: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """Terms, vocabulary, weights and keywords of one set of texts."""
    p = source
    return {
        f"{p}_clean": (
            (source,),
            f"""SELECT text_key, grp, norm FROM
            (SELECT text_key, grp, {normalised("text")} AS norm FROM {source})
            WHERE {stripped_length("norm")} > 10""",
        ),
        f"{p}_words": (
            (f"{p}_clean",),
            f"""SELECT text_key, grp, list_filter(regexp_extract_all(norm, '[a-z]{{2,}}'),
            lambda w: w NOT IN ({STOP_LIST})) AS ws FROM {p}_clean""",
        ),
        f"{p}_terms": (
            (f"{p}_words",),
            f"""SELECT text_key, grp, unnest(list_concat(ws, list_transform(
            range(1, greatest(len(ws), 1)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term
            FROM {p}_words""",
        ),
        f"{p}_totals": (
            (f"{p}_terms",),
            f"SELECT grp, term, count(*) AS total FROM {p}_terms GROUP BY grp, term",
        ),
        f"{p}_vocabulary": (
            (f"{p}_totals",),
            f"""SELECT * FROM (SELECT grp, term, total,
            row_number() OVER (PARTITION BY grp ORDER BY total DESC, term) AS rank
            FROM {p}_totals) WHERE rank <= 60""",
        ),
        f"{p}_alphabetical": (
            (f"{p}_vocabulary",),
            f"""SELECT grp, string_agg(term, ', ' ORDER BY term) AS keywords
            FROM (SELECT grp, term, row_number() OVER (PARTITION BY grp ORDER BY term) AS r
                  FROM {p}_vocabulary) WHERE r <= 7 GROUP BY grp""",
        ),
        f"{p}_counts": (
            (f"{p}_terms",),
            f"""SELECT grp, text_key, term, count(*) AS occurrences
            FROM {p}_terms GROUP BY grp, text_key, term""",
        ),
        f"{p}_weights": (
            (f"{p}_counts", f"{p}_vocabulary", f"{p}_clean"),
            f"""SELECT grp, text_key, term, occurrences, idf,
            raw / sqrt(sum(raw * raw) OVER (PARTITION BY grp, text_key)) AS weight
            FROM (SELECT c.grp, text_key, c.term, occurrences, idf,
                  (1 + ln(occurrences)) * idf AS raw
                  FROM {p}_counts c
                  JOIN (SELECT grp, term, ln((1 + n) / (1 + count(*))) + 1 AS idf
                        FROM {p}_counts JOIN
                        (SELECT grp, count(*) AS n FROM {p}_clean GROUP BY grp) USING (grp)
                        GROUP BY grp, term, n) i USING (grp, term)
                  JOIN {p}_vocabulary v USING (grp, term))""",
        ),
        f"{p}_by_weight": (
            (f"{p}_weights", f"{p}_clean"),
            f"""SELECT grp, string_agg(term, ', ' ORDER BY r) AS keywords
            FROM (SELECT grp, term, row_number() OVER (PARTITION BY grp ORDER BY m DESC, term) AS r
                  FROM (SELECT grp, term, round(sum(weight) / any_value(n), 9) AS m
                        FROM {p}_weights JOIN
                        (SELECT grp, count(*) AS n FROM {p}_clean GROUP BY grp) USING (grp)
                        GROUP BY grp, term))
            WHERE r <= 7 GROUP BY grp""",
        ),
    }


for _source in ("doc_texts", "negative_doc_texts", "sampled_doc_texts", "day_texts", "sampled_day_texts"):
    PARTS.update(text_parts(_source))


def sql(body: str, *needs: str) -> str:
    """A statement with the common table expressions it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in PARTS[name][0]:
                add(other)
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + "\n" + body


def keyword_labels(source: str, found: str, group: str = "grp") -> str:
    """Keywords per group of texts with the labels of small and empty groups."""
    return f"""SELECT s.grp AS {group}, s.texts, CASE WHEN s.texts < 3 THEN '{FEW_TEXTS_LABEL}'
    ELSE coalesce(keywords, '{NO_TERMS_LABEL}') END AS keywords
    FROM (SELECT grp, count(*) FILTER ({stripped_length(normalised("text"))} > 10) AS texts
          FROM {source} GROUP BY grp) s
    LEFT JOIN {source}_{found} k ON s.grp = k.grp"""


def box(source: str, by: str, value: str, places: int) -> str:
    """Box-plot numbers; fences are the furthest values within the whiskers."""
    return f"""SELECT {by}, round(q1 + 1e-9, {places}) AS q1, round(median + 1e-9, {places}) AS median,
    round(q3 + 1e-9, {places}) AS q3, count({value}) AS n, round(min({value}) + 1e-9, {places}) AS min,
    round(max({value}) + 1e-9, {places}) AS max,
    round(min({value}) FILTER ({value} >= q1 - 1.5 * (q3 - q1)) + 1e-9, {places}) AS lower_fence,
    round(max({value}) FILTER ({value} <= q3 + 1.5 * (q3 - q1)) + 1e-9, {places}) AS upper_fence,
    round(avg({value}) + 1e-9, {places}) AS mean, round(stddev_samp({value}) + 1e-9, {places}) AS sd
    FROM {source} JOIN (SELECT {by}, quantile_cont({value}, 0.25) AS q1,
    quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
    FROM {source} GROUP BY {by}) USING ({by}) GROUP BY {by}, q1, median, q3"""


def compact(n: str) -> str:
    return f"""CASE WHEN {n} >= 1000000 THEN printf('%.1f', {n} / 1e6) || 'M'
    WHEN {n} >= 1000 THEN printf('%.1f', {n} / 1e3) || 'K' ELSE CAST({n} AS VARCHAR) END"""


def bar_text(percent: str, n: str) -> str:
    return f"printf('%.1f', {percent}) || '% (' || format('{{:,}}', {n}) || ')'"


def profile_sql() -> str:
    """Rows and non-null values per column; names and types are the tables' own."""
    columns = {
        "region": {"r_regionkey": "int", "r_name": "string"},
        "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
        "supplier": {
            "s_suppkey": "bigint",
            "s_name": "string",
            "s_nationkey": "int",
            "s_acctbal": "double",
        },
        "orders": {
            "o_orderkey": "bigint",
            "o_custkey": "bigint",
            "o_orderstatus": "string",
            "o_totalprice": "double",
            "o_orderdate": "timestamp_ntz",
            "o_orderpriority": "string",
        },
        "lineitem": {
            "l_orderkey": "bigint",
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "l_linenumber": "int",
            "l_quantity": "double",
            "l_extendedprice": "double",
            "l_discount": "double",
            "l_tax": "double",
            "l_returnflag": "string",
            "l_linestatus": "string",
            "l_shipdate": "timestamp_ntz",
        },
    }
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS column_type,"
        f' count(*) AS "rows", count({column}) AS non_null FROM {table}'
        for table, kinds in columns.items()
        for column, kind in kinds.items()
    )


CONTRAST_ROUNDED = """SELECT item_id, item_name, round(avg_hours_positive + 1e-9, 6) AS avg_hours_positive,
round(avg_hours_negative + 1e-9, 6) AS avg_hours_negative, total_reviews FROM contrast"""
PERFORMANCE_ROUNDED = """SELECT owner_name, num_games, total_reviews,
round(positivity_rate + 1e-9, 6) AS positivity_rate,
round(avg_playtime_hours + 1e-9, 6) AS avg_playtime_hours FROM performance"""
ANOMALY_COLUMNS = """review_date, total, negative, positive, round(neg_ratio + 1e-9, 6) AS neg_ratio,
round(rolling_mean + 1e-9, 6) AS rolling_mean, round(rolling_std + 1e-9, 6) AS rolling_std,
round(lower_band + 1e-9, 6) AS lower_band, round(upper_band + 1e-9, 6) AS upper_band, anomaly"""
MONTH_TIER = f"""SELECT review_month, {TIER_CASE} AS tier, count(review_id) AS n
FROM reviews JOIN items USING (item_id) GROUP BY ALL"""
WIDE = f"""SELECT review_month,
CAST(coalesce(sum(n) FILTER (tier = '{TIER_FREE}'), 0) AS DOUBLE) AS free,
CAST(coalesce(sum(n) FILTER (tier = '{TIER_LOW}'), 0) AS DOUBLE) AS low,
CAST(coalesce(sum(n) FILTER (tier = '{TIER_MID}'), 0) AS DOUBLE) AS mid,
CAST(coalesce(sum(n) FILTER (tier = '{TIER_HIGH}'), 0) AS DOUBLE) AS high
FROM ({MONTH_TIER}) GROUP BY review_month"""
TOP_ITEMS_PER_DAY = """SELECT review_date, item_id, n, CAST(r AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY review_date ORDER BY n DESC, item_id) AS r
      FROM (SELECT review_date, item_id, count(review_id) AS n FROM reviews
            GROUP BY review_date, item_id)) WHERE r <= 3"""

ORACLES: dict[str, str] = {
    # Sources and sinks
    "s01_csv_scan": "SELECT * FROM documents",
    "s01_csv_stray_quotes": """SELECT doc_id, CAST(n_chars AS VARCHAR) || '" wide' AS width, lang
    FROM documents""",
    "s01_csv_stray_quotes_in_parallel": """SELECT doc_id, CAST(n_chars AS VARCHAR) || '" wide' AS width, lang
    FROM documents""",
    "s02_ingest_extra_columns": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
    CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""",
    "s01_csv_scan_in_parallel": "SELECT * FROM documents",
    "s02_ingest_folder": "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{n.title()}' AS display_name, count(*) AS \"rows\" FROM {n}"
        for n in ("region", "nation", "supplier", "customer", "part")
    ),
    "s03_multipart_scan": "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem",
    "s04_dimension_scan": "SELECT * FROM part",
    "s05_projected_scan": "SELECT l_partkey, l_returnflag FROM lineitem",
    "s06_load_tables": """SELECT 'region' AS table_name, TRUE AS found, count(*) AS "rows" FROM region
    UNION ALL SELECT 'nation', TRUE, count(*) FROM nation
    UNION ALL SELECT 'supplier', TRUE, count(*) FROM supplier
    UNION ALL SELECT 'no_such_table', FALSE, CAST(0 AS BIGINT)""",
    "s07_load_profile": profile_sql(),
    "k01_overwrite_table": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "k02_balanced_files": "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem",
    "k03_single_file": sql(
        """SELECT CAST(1 AS BIGINT) AS files, count(*) AS "rows",
        CAST(sum(total_reviews) AS BIGINT) AS total_reviews FROM ratings""",
        "ratings",
    ),
    "k04_partition_refresh": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "k05_shared_result": sql(
        """SELECT price_tier, access, round(avg_toxicity + 1e-9, 6) AS avg_toxicity, items
        FROM matrix JOIN (SELECT price_tier, count(*) AS items FROM negativity GROUP BY price_tier)
        USING (price_tier)""",
        "matrix",
    ),
    # Projections, filters, predicates, samples
    "p01_select_rename": "SELECT p_partkey AS item_id, p_name AS app_name FROM part",
    "p02_unit_conversion": sql(
        f"SELECT review_id, round({HOURS} + 1e-9, 6) AS hours FROM reviews", "reviews"
    ),
    "p03_key_cast": """SELECT p_partkey,
    TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_key,
    TRY_CAST(p_brand AS BIGINT) AS malformed_key,
    TRY_CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_number FROM part""",
    "p04_not_null": sql("SELECT doc_id, toxic FROM labelled WHERE toxic IS NOT NULL", "labelled"),
    "p05_conjunction": sql(
        """SELECT doc_id, source, quality FROM labelled
        WHERE toxic IS NOT NULL AND quality IS NOT NULL AND quality > 0""",
        "labelled",
    ),
    "p06_non_empty_text": """SELECT lang, count(*) AS texts FROM documents
    WHERE text IS NOT NULL AND text <> '' AND regexp_replace(text, '[A-Za-z]', '', 'g') <> ''
    GROUP BY lang""",
    "p07_boolean_filter": sql(
        """SELECT source, CASE WHEN toxic = 1 THEN 'true' ELSE 'false' END AS kind,
        count(*) AS texts FROM labelled WHERE toxic IS NOT NULL GROUP BY ALL""",
        "labelled",
    ),
    "p08_equality_filter": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'",
    "p09_in_result": sql(
        """SELECT review_id, item_id FROM reviews WHERE item_id IN
        (SELECT item_id FROM reviews GROUP BY item_id ORDER BY count(review_id) DESC, item_id
         LIMIT 10)""",
        "reviews",
    ),
    "p10_drop_null_subset": sql(
        """SELECT doc_id, quality, toxic FROM labelled
        WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
        "labelled",
    ),
    "p11_drop_null_any": sql(
        """SELECT toxic, count(doc_id) AS texts FROM labelled WHERE toxic IS NOT NULL
        GROUP BY toxic""",
        "labelled",
    ),
    "p12_having": sql(
        """SELECT 'over 30' AS kind, item_id, count(review_id) AS reviews FROM reviews
        GROUP BY item_id HAVING count(review_id) > 30
        UNION ALL SELECT 'at least 30', item_id, count(review_id) FROM reviews
        GROUP BY item_id HAVING count(review_id) >= 30""",
        "reviews",
    ),
    "p13_price_tier": sql(f"SELECT item_id, {TIER_CASE} AS price_tier FROM items", "items"),
    "p14_two_way_label": sql(
        """SELECT item_id, access, any_early FROM access JOIN
        (SELECT item_id, CASE WHEN bool_or(early_access) THEN 'some' ELSE 'none' END AS any_early
         FROM reviews GROUP BY item_id) USING (item_id)""",
        "access",
    ),
    "p15_clip_range": sql(
        f"""{CONTRAST_ROUNDED} WHERE contrast.avg_hours_positive <= {td.CLIP_HOURS}
        AND contrast.avg_hours_negative <= {td.CLIP_HOURS}""",
        "contrast",
    ),
    "p16_cap_value": sql(
        """SELECT item_id, least(count(review_id), 30) AS capped FROM reviews
        GROUP BY item_id""",
        "reviews",
    ),
    "p17_search_label": """SELECT p_name AS item_name, count(*) AS matches FROM part
    WHERE contains(lower(p_name), 'red') GROUP BY p_name""",
    "p18_hash_sample": sql(
        f"SELECT review_id, item_id FROM reviews WHERE {in_sample('review_id', 0.05)}", "reviews"
    ),
    "p18_bernoulli_sample": "SELECT true AS share_in_bounds, true AS rows_of_the_fact",
    # Joins
    "j01_aggregate_dimension": sql(
        """SELECT item_id, reviews, item_name FROM
        (SELECT item_id, count(review_id) AS reviews FROM reviews GROUP BY item_id)
        JOIN items USING (item_id)""",
        "reviews", "items",
    ),
    "j02_bridge_dimension": sql(
        "SELECT item_id, genre_name, count(*) AS links FROM item_genres GROUP BY ALL",
        "item_genres",
    ),
    "j03_fact_bridge": sql(
        """SELECT genre_name, count(DISTINCT item_id) AS items, count(review_id) AS reviews,
        count(*) FILTER (recommended) AS positive, count(*) AS "rows"
        FROM reviews JOIN item_genres USING (item_id) GROUP BY genre_name""",
        "reviews", "item_genres",
    ),
    "j03_fact_bridge_salted": sql(
        """SELECT owner_name, count(DISTINCT item_id) AS items, count(review_id) AS reviews,
        count(*) FILTER (recommended) AS positive, count(*) AS "rows"
        FROM reviews JOIN item_owners USING (item_id) GROUP BY owner_name""",
        "reviews", "item_owners",
    ),
    "j04_left_join": sql(
        """SELECT item_id, item_name, owner_name FROM items LEFT JOIN primary_owner
        USING (item_id)""",
        "items", "primary_owner",
    ),
    "j05_existence": sql(
        """SELECT item_id, count(review_id) AS reviews FROM reviews
        WHERE item_id IN (SELECT item_id FROM items WHERE is_free) GROUP BY item_id""",
        "reviews", "items",
    ),
    "j06_aggregate_aggregate": sql(
        """SELECT item_id, price_tier, round(avg_hours_negative + 1e-9, 6) AS avg_hours_negative
        FROM negativity JOIN contrast USING (item_id)""",
        "negativity", "contrast",
    ),
    "j07_three_results": sql(
        """SELECT item_id, owner_name, pct_positive,
        round(avg_hours_positive + 1e-9, 6) AS avg_hours_positive,
        round(avg_hours_negative + 1e-9, 6) AS avg_hours_negative, num_games
        FROM ratings JOIN contrast USING (item_id) JOIN performance USING (owner_name)""",
        "ratings", "contrast", "performance",
    ),
    "j08_semi_top": sql(
        """SELECT item_id, genre_name, count(*) AS links FROM item_genres
        WHERE genre_name IN (SELECT genre_name FROM top_genres) GROUP BY ALL""",
        "item_genres", "top_genres",
    ),
    "j09_star_chain": sql(
        """SELECT item_id, genre_id, genre_name, reviews FROM item_genres
        JOIN (SELECT item_id, count(review_id) AS reviews FROM reviews GROUP BY item_id)
        USING (item_id) JOIN items USING (item_id)""",
        "item_genres", "reviews", "items",
    ),
    # Aggregations
    "a01_group_count": sql(
        "SELECT source, count(toxic) AS labelled FROM labelled GROUP BY source", "labelled"
    ),
    "a02_conditional_count": sql(
        """SELECT item_id, count(*) FILTER (recommended) AS positive,
        count(*) FILTER (NOT recommended) AS negative FROM reviews GROUP BY item_id""",
        "reviews",
    ),
    "a03_conditional_mean": sql(
        f"""SELECT item_id, round(avg({HOURS}) FILTER (recommended) + 1e-9, 6) AS up,
        round(avg({HOURS}) FILTER (NOT recommended) + 1e-9, 6) AS down FROM reviews GROUP BY item_id""",
        "reviews",
    ),
    "a04_rate": sql(
        """SELECT source, round(avg(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) + 1e-9, 6) AS rate_of_all,
        round(avg(toxic) + 1e-9, 6) AS rate_of_known FROM labelled GROUP BY source""",
        "labelled",
    ),
    "a05_mean": sql(
        "SELECT source, round(avg(quality) + 1e-9, 6) AS mean_quality FROM labelled GROUP BY source",
        "labelled",
    ),
    "a06_distinct_count": """SELECT l_suppkey, count(DISTINCT l_partkey) AS items
    FROM lineitem GROUP BY l_suppkey""",
    "a06_distinct_count_approx": """SELECT l_suppkey, count(DISTINCT l_partkey) AS items,
    true AS near FROM lineitem GROUP BY l_suppkey""",
    "a07_group_minimum": sql(
        "SELECT item_id, min(owner_id) AS owner_id FROM owner_bridge GROUP BY item_id",
        "owner_bridge",
    ),
    "a08_primary_member": sql("SELECT item_id, owner_name FROM primary_owner", "primary_owner"),
    "a09_rounded_percentage": sql(
        """SELECT item_id, round(count(*) FILTER (recommended) / count(review_id) * 100, 1)
        AS one_place, round(count(*) FILTER (NOT recommended) / count(review_id) * 100, 2)
        AS two_places FROM reviews GROUP BY item_id""",
        "reviews",
    ),
    "a10_rounded_mean_sorted": sql(
        f"""SELECT early_access, recommended, round(avg({HOURS}), 2) AS avg_hours FROM reviews
        GROUP BY early_access, recommended ORDER BY recommended DESC, avg_hours DESC""",
        "reviews",
    ),
    "a11_multi_key_group": sql(
        """SELECT item_id, review_month, count(review_id) AS reviews FROM reviews
        GROUP BY item_id, review_month""",
        "reviews",
    ),
    "a12_mean_of_means": sql(
        """SELECT owner_name, round(avg(avg_hours_positive) + 1e-9, 6) AS avg_hours_positive,
        round(avg(avg_hours_negative) + 1e-9, 6) AS avg_hours_negative
        FROM ratings JOIN contrast USING (item_id) GROUP BY owner_name""",
        "ratings", "contrast",
    ),
    "a13_mean_of_percentages": sql(
        "SELECT price_tier, access, round(avg_toxicity + 1e-9, 6) AS avg_toxicity FROM matrix", "matrix"
    ),
    "a14_share_of_total": sql(
        """SELECT genre_name, review_count,
        round(review_count / sum(review_count) OVER () + 1e-9, 6) AS share FROM volume""",
        "volume",
    ),
    "a15_scalar_figures": sql(
        """SELECT count(*) AS items, CAST(sum(total_reviews) AS BIGINT) AS reviews,
        round(avg(pct_positive) + 1e-9, 6) AS mean_positivity FROM ratings""",
        "ratings",
    ),
    "a16_box_summary": sql(box("negativity", "price_tier", "toxicity_percent", 4), "negativity"),
    "a16_box_summary_approx": sql(
        """SELECT price_tier, count(*) AS items, true AS q1_near, true AS median_near,
        true AS q3_near FROM negativity GROUP BY price_tier""",
        "negativity",
    ),
    "a17_distribution_summary": sql(
        f"""SELECT vote, CAST(CASE WHEN v < 0 THEN 0 WHEN v >= 8 THEN 33
        ELSE floor(v / 0.25) + 1 END AS INTEGER) AS bin, count(*) AS n
        FROM (SELECT CASE WHEN recommended THEN 'up' ELSE 'down' END AS vote,
              ln(1 + {HOURS}) AS v FROM reviews) GROUP BY ALL""",
        "reviews",
    ),
    "a17_exact_quantiles": sql(
        """SELECT recommended, round(quantile_cont(minutes_played, 0.25) + 1e-9, 4) AS q1,
        round(quantile_cont(minutes_played, 0.5) + 1e-9, 4) AS median,
        round(quantile_cont(minutes_played, 0.75) + 1e-9, 4) AS q3,
        round(quantile_cont(minutes_played, 0.99) + 1e-9, 4) AS p99 FROM reviews GROUP BY recommended""",
        "reviews",
    ),
    "a18_scaled_by_max": sql(
        """SELECT item_id, reviews, round(reviews / max(reviews) OVER () * 400 + 20 + 1e-9, 6) AS size
        FROM (SELECT item_id, count(review_id) AS reviews FROM reviews GROUP BY item_id)""",
        "reviews",
    ),
    "a19_row_count": sql(
        "SELECT anomaly, count(*) AS days FROM anomalies GROUP BY anomaly", "anomalies"
    ),
    # Ordered analytics
    "w01_rolling_mean": sql(
        "SELECT review_date, round(rolling_mean + 1e-9, 6) AS rolling_mean FROM anomalies", "anomalies"
    ),
    "w02_rolling_deviation": sql(
        "SELECT review_date, round(rolling_std + 1e-9, 6) AS rolling_std FROM anomalies", "anomalies"
    ),
    "w03_bands": sql(
        """SELECT review_date, round(lower_band + 1e-9, 6) AS lower_band,
        round(upper_band + 1e-9, 6) AS upper_band FROM anomalies""",
        "anomalies",
    ),
    "w04_flag_above": sql("SELECT review_date, anomaly FROM anomalies", "anomalies"),
    "w05_top_per_group": sql(TOP_ITEMS_PER_DAY, "reviews"),
    "w06_ecdf": """SELECT l_returnflag, l_extendedprice, round(row_number() OVER
    (PARTITION BY l_returnflag ORDER BY l_extendedprice) / count(*) OVER
    (PARTITION BY l_returnflag) + 1e-9, 8) AS cdf FROM lineitem""",
    "w07_ranked_text": sql(
        """SELECT price, string_agg(item_name || ' (' || CAST(n AS VARCHAR) || ')', '; ' ORDER BY r)
        AS top_names FROM (SELECT *, row_number() OVER
        (PARTITION BY price ORDER BY n DESC, item_name) AS r
        FROM (SELECT price, item_name, count(review_id) AS n
              FROM reviews JOIN items USING (item_id) GROUP BY price, item_name))
        WHERE r <= 3 GROUP BY price""",
        "reviews", "items",
    ),
    # Sort, limit, top-k
    "l01_global_sort": sql("SELECT price, item_id FROM items ORDER BY price DESC, item_id", "items"),
    "l02_top_k": sql(
        """SELECT item_id, count(review_id) AS reviews FROM reviews GROUP BY item_id
        ORDER BY reviews DESC, item_id LIMIT 20""",
        "reviews",
    ),
    "l03_bottom_k": sql(
        """SELECT item_id, count(review_id) AS reviews FROM reviews GROUP BY item_id
        ORDER BY reviews, item_id LIMIT 20""",
        "reviews",
    ),
    "l04_top_categories_restrict": sql(
        """SELECT n_nationkey AS genre_id, n_name AS genre_name FROM nation
        WHERE n_name IN (SELECT genre_name FROM top_genres)""",
        "top_genres",
    ),
    "l05_top_resorted": sql(
        """SELECT genre_name, pct_positive FROM
        (SELECT * FROM sentiment ORDER BY pct_positive DESC, genre_name LIMIT 15)
        ORDER BY pct_positive, genre_name""",
        "sentiment",
    ),
    # Set operations
    "u01_bag_union": """SELECT l_linestatus, count(*) AS "rows" FROM
    (SELECT l_linestatus FROM lineitem UNION ALL SELECT l_linestatus FROM lineitem)
    GROUP BY l_linestatus""",
    "u02_distinct_sorted": sql(
        "SELECT DISTINCT price_tier FROM negativity ORDER BY price_tier", "negativity"
    ),
    # Reshape
    "h01_pivot_matrix": sql(
        f"""SELECT price_tier, round(max(avg_toxicity) FILTER (access = '{EARLY_LABEL}') + 1e-9, 6) AS early,
        round(max(avg_toxicity) FILTER (access = '{RELEASED_LABEL}') + 1e-9, 6) AS released
        FROM matrix GROUP BY price_tier""",
        "matrix",
    ),
    "h02_pivot_filled": sql(WIDE, "reviews", "items"),
    "h03_unpivot": sql(
        f"""SELECT review_month, tier, n FROM ({WIDE})
        UNPIVOT (n FOR tier IN (free, low, mid, high))""",
        "reviews", "items",
    ),
    "h04_lookup_default": sql(
        """SELECT review_date, total, coalesce(top_items, '') AS top_items
        FROM daily LEFT JOIN top_items_text USING (review_date)""",
        "daily", "top_items_text",
    ),
    # Scalar functions
    "f01_math": sql(
        """SELECT item_id, round(ln(1 + n) + 1e-9, 6) AS log_reviews, round(exp(ln(1 + n)) - 1 + 1e-9, 6) AS back,
        round_even(n / 4, 1) AS half_even, round(n / 4, 1) AS half_up,
        CAST(floor(up / n * 100) AS BIGINT) AS whole_share
        FROM (SELECT item_id, count(review_id) AS n, count(*) FILTER (recommended) AS up
              FROM reviews GROUP BY item_id)""",
        "reviews",
    ),
    "f02_dates": sql(
        """SELECT review_id, review_date, review_month,
        strftime(review_date, '%Y-%m-%d') AS date_text, review_date AS parsed,
        CAST(NULL AS DATE) AS malformed FROM reviews""",
        "reviews",
    ),
    "f03_strings": f"""SELECT doc_id, CAST(doc_id AS VARCHAR) AS doc_text,
    {stripped_length("norm")} AS letters, md5(norm) AS normalised_md5
    FROM (SELECT doc_id, {normalised("text")} AS norm FROM documents)""",
    "f04_formatting": sql(
        f"""SELECT item_id, {compact("n")} AS compact,
        CASE WHEN n >= 1000000 THEN CAST(n // 1000000 AS VARCHAR) || 'M'
        ELSE CAST(n // 1000 AS VARCHAR) || 'K' END AS axis,
        format('{{:,}}', n) AS grouped, printf('%.1f', round(p, 3)) || '%' AS percent
        FROM (SELECT item_id, count(review_id) * item_id AS n,
              count(*) FILTER (recommended) / count(review_id) * 100 AS p
              FROM reviews GROUP BY item_id)""",
        "reviews",
    ),
    "f05_conditionals": sql(
        """SELECT doc_id, CASE toxic WHEN 1 THEN 'toxic' WHEN 0 THEN 'clean' END AS label,
        CASE toxic WHEN 1 THEN 'toxic' WHEN 0 THEN 'clean' ELSE '' END AS filled,
        CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' ELSE 'unknown' END AS quality
        FROM labelled""",
        "labelled",
    ),
    "f06_marker_sizes": sql(
        """SELECT item_id, round(n / max(n) OVER () * 400 + 20 + 1e-9, 6) AS wide,
        round(n / max(n) OVER () * 30 + 4 + 1e-9, 6) AS narrow, least(n, 50) * 2 + 5 AS capped
        FROM (SELECT item_id, count(review_id) AS n FROM reviews GROUP BY item_id)""",
        "reviews",
    ),
    # Text analytics
    "x01_normalised_texts": f"""SELECT doc_id, md5(norm) AS text_md5
    FROM (SELECT doc_id, {normalised("text")} AS norm FROM documents)
    WHERE {stripped_length("norm")} > 10""",
    "x02_terms": sql(
        """SELECT text_key AS doc_id, count(*) AS terms, count(DISTINCT term) AS distinct_terms
        FROM doc_texts_terms GROUP BY text_key""",
        "doc_texts_terms",
    ),
    "x02_term_counts": sql("SELECT grp, term, total FROM doc_texts_totals", "doc_texts_totals"),
    "x03_vocabulary": sql(
        "SELECT grp, term, total, CAST(rank AS INTEGER) AS rank FROM doc_texts_vocabulary",
        "doc_texts_vocabulary",
    ),
    "x04_tfidf": sql(
        """SELECT grp, text_key AS doc_id, term, occurrences, round(idf + 1e-9, 6) AS idf,
        round(weight + 1e-9, 6) AS weight FROM doc_texts_weights""",
        "doc_texts_weights",
    ),
    "x05_keywords_alphabetical": sql(
        "SELECT grp, keywords FROM doc_texts_alphabetical", "doc_texts_alphabetical"
    ),
    "x05_keywords_by_weight": sql(
        "SELECT grp, keywords FROM doc_texts_by_weight", "doc_texts_by_weight"
    ),
    "x06_group_minimum": sql(
        keyword_labels("negative_doc_texts", "alphabetical"), "negative_doc_texts_alphabetical"
    ),
    # Named analytics
    "q01_item_engagement_contrast": sql(CONTRAST_ROUNDED, "contrast"),
    "q02_category_volume": sql(
        "SELECT * FROM volume ORDER BY review_count DESC, genre_name", "volume"
    ),
    "q03_item_negativity_by_tier": sql("SELECT * FROM negativity", "negativity"),
    "q04_flag_split": sql(
        """SELECT early_access, total_reviews,
        round(total_reviews / sum(total_reviews) OVER () + 1e-9, 6) AS share
        FROM (SELECT early_access, count(review_id) AS total_reviews FROM reviews
              WHERE early_access IS NOT NULL GROUP BY early_access)""",
        "reviews",
    ),
    "q05_category_sentiment": sql("SELECT * FROM sentiment", "sentiment"),
    "q06_log_measure_sample": sql(
        "SELECT round(log_playtime + 1e-9, 6) AS log_playtime, sentiment FROM log_hours", "log_hours"
    ),
    "q07_tier_access_matrix": sql(
        "SELECT price_tier, access, round(avg_toxicity + 1e-9, 6) AS avg_toxicity FROM matrix", "matrix"
    ),
    "q08_item_ratings": sql("SELECT * FROM ratings", "ratings"),
    "q09_most_active_users": sql(
        """SELECT author_id, num_reviews, round(positivity_rate + 1e-9, 6) AS positivity_rate,
        round(avg_games_owned + 1e-9, 6) AS avg_games_owned FROM active_authors""",
        "active_authors",
    ),
    "q10_user_profiles": sql(
        """SELECT author_id, round(games_owned + 1e-9, 6) AS games_owned, reviews_written,
        round(positivity_rate + 1e-9, 6) AS positivity_rate,
        round(avg_playtime_hours + 1e-9, 6) AS avg_playtime_hours FROM profiles""",
        "profiles",
    ),
    "q11_daily_volume": sql("SELECT * FROM daily ORDER BY review_date", "daily"),
    "q12_owner_performance": sql(PERFORMANCE_ROUNDED, "performance"),
    "q13_category_timeline": sql(
        "SELECT * FROM timeline ORDER BY review_month, genre_name", "timeline"
    ),
    "q14_category_vote_engagement": sql(
        f"""SELECT genre_name, recommended, round(avg({HOURS}), 2) AS avg_playtime_hours
        FROM reviews JOIN items USING (item_id) JOIN item_genres USING (item_id)
        GROUP BY genre_name, recommended ORDER BY recommended DESC, avg_playtime_hours DESC""",
        "reviews", "items", "item_genres",
    ),
    "q15_negativity_anomalies": sql(f"SELECT {ANOMALY_COLUMNS} FROM anomalies", "anomalies"),
    "q16_anomaly_top_items": sql("SELECT * FROM top_items", "top_items"),
    "q16_anomaly_top_items_text": sql(
        "SELECT review_date, top_items FROM top_items_text", "top_items_text"
    ),
    "q17_anomaly_keywords": sql(
        keyword_labels("day_texts", "alphabetical", "review_date"), "day_texts_alphabetical"
    ),
    "q17_anomaly_keywords_sampled": sql(
        keyword_labels("sampled_doc_texts", "alphabetical"), "sampled_doc_texts_alphabetical"
    ),
    "q17_anomaly_keywords_by_weight": sql(
        keyword_labels("negative_doc_texts", "by_weight"), "negative_doc_texts_by_weight"
    ),
    "q17_flagged_day_keywords_sampled": sql(
        keyword_labels("sampled_day_texts", "alphabetical", "review_date"), "sampled_day_texts_alphabetical"
    ),
    "q17_flagged_day_keywords_by_weight": sql(
        keyword_labels("day_texts", "by_weight", "review_date"), "day_texts_by_weight"
    ),
    "q18_anomaly_report": sql(
        f"""SELECT {ANOMALY_COLUMNS}, coalesce(top_items, '') AS top_items,
        coalesce(keywords, '') AS keywords FROM anomalies
        LEFT JOIN top_items_text USING (review_date)
        LEFT JOIN ({keyword_labels("day_texts", "alphabetical", "review_date")})
        USING (review_date)""",
        "anomalies", "top_items_text", "day_texts_alphabetical",
    ),
    "q19_best_items": sql(
        f"""SELECT *, {bar_text("pct_positive", "total_reviews")} AS bar_text FROM
        (SELECT * FROM ratings ORDER BY pct_positive DESC, item_id LIMIT 20)""",
        "ratings",
    ),
    "q19_worst_items": sql(
        f"""SELECT *, {bar_text("pct_positive", "total_reviews")} AS bar_text FROM
        (SELECT * FROM ratings ORDER BY pct_positive, item_id LIMIT 20)""",
        "ratings",
    ),
    "q20_tier_box_summary": sql(
        box("negativity", "price_tier", "toxicity_percent", 4), "negativity"
    ),
    "q21_sentiment_distribution": sql(
        box("log_hours", "sentiment", "log_playtime", 4), "log_hours"
    ),
    "q21_sentiment_histogram": sql(
        """SELECT sentiment, CAST(CASE WHEN log_playtime >= ln(2001) THEN 25
        ELSE floor(log_playtime / ln(2001) * 24) + 1 END AS INTEGER) AS bin, count(*) AS n
        FROM log_hours GROUP BY ALL""",
        "log_hours",
    ),
    "q22_top_category_sentiment": sql(
        """SELECT * FROM (SELECT * FROM sentiment ORDER BY pct_positive DESC, genre_name LIMIT 15)
        ORDER BY pct_positive, genre_name""",
        "sentiment",
    ),
    "q23_top_categories": sql(
        f"""SELECT genre_name, review_count, {compact("review_count")} AS count_text FROM volume
        ORDER BY review_count DESC, genre_name LIMIT 20""",
        "volume",
    ),
    "q24_owner_ranking": sql(
        PERFORMANCE_ROUNDED + " ORDER BY total_reviews DESC, owner_name LIMIT 20", "performance"
    ),
    "q25_owner_engagement_contrast": sql(
        """SELECT owner_name, round(avg_hours_positive + 1e-9, 6) AS avg_hours_positive,
        round(avg_hours_negative + 1e-9, 6) AS avg_hours_negative, num_games,
        round(positivity_rate + 1e-9, 6) AS positivity_rate, total_reviews,
        least(num_games, 50) * 2 + 5 AS marker_size
        FROM (SELECT owner_name, avg(avg_hours_positive) AS avg_hours_positive,
              avg(avg_hours_negative) AS avg_hours_negative
              FROM ratings JOIN contrast USING (item_id) WHERE owner_name IS NOT NULL
              GROUP BY owner_name) JOIN performance USING (owner_name)""",
        "ratings", "contrast", "performance",
    ),
    "q26_category_timeline_dense": sql(
        """SELECT m.review_month, g.genre_name, coalesce(review_count, 0) AS review_count
        FROM (SELECT DISTINCT review_month FROM timeline) m
        CROSS JOIN (SELECT DISTINCT genre_name FROM timeline) g
        LEFT JOIN timeline t ON t.review_month = m.review_month AND t.genre_name = g.genre_name""",
        "timeline",
    ),
    "q27_negative_hours_cdf": sql(
        """SELECT price_tier, round(avg_hours_negative + 1e-9, 6) AS avg_hours_negative, item_id,
        round(row_number() OVER (PARTITION BY price_tier ORDER BY avg_hours_negative, item_id)
        / count(*) OVER (PARTITION BY price_tier) + 1e-9, 6) AS cdf
        FROM negativity JOIN contrast USING (item_id)""",
        "negativity", "contrast",
    ),
    "q28_kpi_summary": sql(
        f"""SELECT 'reviews' AS metric, CAST(n AS DOUBLE) AS value, {compact("n")} AS text
        FROM (SELECT count(review_id) AS n FROM reviews WHERE early_access IS NOT NULL)
        UNION ALL SELECT 'items', CAST(n AS DOUBLE), {compact("n")}
        FROM (SELECT count(*) AS n FROM ratings)
        UNION ALL SELECT 'mean_positivity', round(m + 1e-9, 6), printf('%.1f', m) || '%'
        FROM (SELECT avg(pct_positive) AS m FROM ratings)
        UNION ALL SELECT 'owners', CAST(n AS DOUBLE), format('{{:,}}', n)
        FROM (SELECT count(*) AS n FROM performance)
        UNION ALL SELECT 'categories', CAST(n AS DOUBLE), format('{{:,}}', n)
        FROM (SELECT count(*) AS n FROM volume)""",
        "reviews", "ratings", "performance", "volume",
    ),
    "q29_engagement_contrast_feed": sql(
        f"""SELECT item_id, item_name, round(avg_hours_positive + 1e-9, 6) AS avg_hours_positive,
        round(avg_hours_negative + 1e-9, 6) AS avg_hours_negative, total_reviews,
        round(marker_size + 1e-9, 6) AS marker_size
        FROM (SELECT *, total_reviews / max(total_reviews) OVER () * 30 + 4 AS marker_size
              FROM contrast WHERE avg_hours_positive <= {td.CLIP_HOURS}
              AND avg_hours_negative <= {td.CLIP_HOURS})
        WHERE contains(lower(item_name), 'ring')""",
        "contrast",
    ),
    "q30_user_profile_feed": sql(
        """SELECT CAST(author_id AS VARCHAR) AS author_text,
        CAST(round_even(games_owned, 0) AS BIGINT) AS games_owned, reviews_written,
        round(positivity_rate + 1e-9, 6) AS positivity_rate,
        round_even(positivity_rate * 100, 1) AS positivity_pct,
        round_even(avg_playtime_hours, 1) AS avg_playtime_hours FROM profiles""",
        "profiles",
    ),
    "q31_most_active_users_feed": sql(
        """SELECT author_id, num_reviews, round(positivity_rate + 1e-9, 6) AS positivity_rate,
        round(avg_games_owned + 1e-9, 6) AS avg_games_owned, CAST(author_id AS VARCHAR) AS author_text
        FROM active_authors ORDER BY num_reviews, author_id""",
        "active_authors",
    ),
}
ORACLES["q18_anomaly_report_by_month"] = ORACLES["q18_anomaly_report"]
ORACLES["k02_file_sizes"] = """SELECT true AS all_files_counted, true AS several, true AS within_limit,
true AS even, count(*) AS rows FROM lineitem"""
