"""Terms, vocabularies, relational TF-IDF and keywords per group of texts.

Texts become (group, term) rows through built-in array functions.  Counting is
partial before every shuffle, so neither a very large group nor a very common
term reaches one task as raw rows.

Weights per text are found in two passes.  The first counts terms per group and
keeps each group's vocabulary, a few dozen terms; the second meets only those, so
that of the terms of a text no others are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.words import (
    MIN_TEXT_LENGTH,
    is_long_enough,
    normalise_text,
    spaced_text,
    unigrams_and_bigrams,
    words,
)
from reviewlens.operators.ranking import ranked_text, top_k_per_group
from reviewlens.sources.files import scratch_folder
from reviewlens.sources.writers import store

VOCABULARY_SIZE = 60
KEYWORDS = 7
MIN_TEXTS = 3
SEPARATOR = ", "
# Vocabulary rows that may go to all tasks (some tens of megabytes); more are joined
# by a shuffle.
BROADCAST_TERMS = 500_000
USABLE_MARK = "+"
SHORT_MARK = "-"

# Labels of groups without keywords, as the published report has them.
FEW_TEXTS_LABEL = "Pocas reseñas en inglés"
NO_TERMS_LABEL = "Error NLP"


def normalised_texts(
    df: DataFrame, text: str, name: str = "normalised", longer_than: int = MIN_TEXT_LENGTH
) -> DataFrame:
    """Normalised text of every row whose text is long enough to use."""
    normalised = df.withColumn(name, normalise_text(text))
    return normalised.filter(is_long_enough(name, longer_than))


def exploded_terms(
    df: DataFrame,
    keys: list[str],
    text: str,
    stop_words: Iterable[str] | None = None,
    longer_than: int = MIN_TEXT_LENGTH,
    mark_texts: bool = False,
) -> DataFrame:
    """One row per occurrence of a word or a pair of neighbouring words.

    Texts that are too short give no rows.  The length is tested inside the
    projection and not as a filter, which Spark would push below it and then
    normalise every text twice.

    With ``mark_texts`` every text also gives one row with a marker for its
    term, which lets one pass count texts and terms.  Markers are not made of
    letters, so no term equals one.
    """
    long_enough = is_long_enough("_text", longer_than)
    found = unigrams_and_bigrams("_words")
    if mark_texts:
        found = F.when(
            F.col("_words").isNotNull(), F.concat(found, F.array(F.lit(USABLE_MARK)))
        ).otherwise(F.array(F.lit(SHORT_MARK)))
    return (
        df.select(*keys, spaced_text(text).alias("_text"))
        .select(*keys, F.when(long_enough, words("_text", stop_words, spaced=True)).alias("_words"))
        .select(*keys, F.explode(found).alias("term"))
    )


def usable_texts(
    df: DataFrame, group: str, text: str, longer_than: int = MIN_TEXT_LENGTH
) -> DataFrame:
    """Texts per group that are long enough; a group with none counts zero."""
    usable = is_long_enough(normalise_text(text), longer_than)
    return df.groupBy(group).agg(F.count_if(usable).alias("texts"))


def term_totals(terms: DataFrame, group: str) -> DataFrame:
    return terms.groupBy(group, "term").agg(F.count(F.lit(1)).alias("total"))


def vocabulary(totals: DataFrame, group: str, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The most frequent terms of each group; equal counts in alphabetical order."""
    return top_k_per_group(totals, group, "total", size, ["term"])


def group_vocabulary(
    df: DataFrame,
    group: str,
    text: str,
    size: int = VOCABULARY_SIZE,
    stop_words: Iterable[str] | None = None,
    longer_than: int = MIN_TEXT_LENGTH,
) -> DataFrame:
    """``group, term, total, texts_with_term, texts``: each group's vocabulary, stored.

    One pass over the texts, combined map-side.  ``texts`` counts the usable texts of
    the group; a group without any has one row, with a null term.
    """
    long_enough = is_long_enough("_text", longer_than)
    terms = unigrams_and_bigrams("_words")

    def marked(found: Column, first: bool) -> Column:
        return F.transform(found, lambda t: F.struct(t.alias("term"), F.lit(first).alias("first")))

    one = lambda mark: F.array(F.struct(F.lit(mark).alias("term"), F.lit(True).alias("first")))
    counted = F.when(
        F.col("_words").isNotNull(),
        F.concat(marked(F.col("_terms"), False), marked(F.array_distinct("_terms"), True), one(USABLE_MARK)),
    ).otherwise(one(SHORT_MARK))
    is_mark = F.col("term").isin(USABLE_MARK, SHORT_MARK)
    totals = (
        df.select(group, spaced_text(text).alias("_text"))
        .select(group, F.when(long_enough, words("_text", stop_words, spaced=True)).alias("_words"))
        .select(group, "_words", terms.alias("_terms"))
        .select(group, F.inline(counted))
        .groupBy(group, "term")
        .agg(F.count_if(~F.col("first")).alias("total"), F.count_if("first").alias("texts_with_term"))
    )
    order = Window.partitionBy(group, "_mark").orderBy(F.desc("total"), "term")
    kept = (
        totals.withColumn("_mark", is_mark)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= size)
    )
    # At most `size` terms and two marks per group are left.
    usable = F.max(F.when(F.col("term") == USABLE_MARK, F.col("texts_with_term"))).over(Window.partitionBy(group))
    sized = kept.withColumn("texts", F.coalesce(usable, F.lit(0)))
    shown = F.when(~F.col("_mark"), F.col("term"))
    out = sized.filter(~F.col("_mark") | (F.col("term") == USABLE_MARK) | (F.col("texts") == 0)).select(
        group, shown.alias("term"), "total", "texts_with_term", "texts"
    )
    return store(out, f"{scratch_folder(df.sparkSession)}/vocabulary.parquet")


def tfidf(
    df: DataFrame,
    group: str,
    key: str,
    text: str,
    size: int = VOCABULARY_SIZE,
    stop_words: Iterable[str] | None = None,
    longer_than: int = MIN_TEXT_LENGTH,
    known: DataFrame | None = None,
) -> DataFrame:
    """TF-IDF weight of each vocabulary term in each text.

    Sublinear term frequency, smoothed inverse document frequency within the
    group, and unit length per text over the group's vocabulary.  ``known`` is the
    vocabulary from :func:`group_vocabulary` where it has been counted already.
    """
    if known is None:
        known = group_vocabulary(df, group, text, size, stop_words, longer_than)
    known = known.filter(F.col("term").isNotNull())
    idf = F.log((F.col("texts") + 1) / (F.col("texts_with_term") + 1)) + 1
    known = known.select(group, "term", idf.alias("idf"))
    if known.count() <= BROADCAST_TERMS:
        known = F.broadcast(known)
    per_text = (
        exploded_terms(df, [group, key], text, stop_words, longer_than)
        .join(known, [group, "term"])
        .groupBy(group, key, "term", "idf")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    raw = (F.log("occurrences") + 1) * F.col("idf")
    # At most `size` rows per text, so a window over one text is small.
    one_text = Window.partitionBy(group, key)
    return (
        per_text.withColumn("_raw", raw)
        .withColumn("weight", F.col("_raw") / F.sqrt(F.sum(F.col("_raw") ** 2).over(one_text)))
        .select(group, key, "term", "occurrences", "idf", "weight")
    )


def alphabetical_keywords(
    df: DataFrame,
    group: str,
    text: str,
    k: int = KEYWORDS,
    size: int = VOCABULARY_SIZE,
    stop_words: Iterable[str] | None = None,
    longer_than: int = MIN_TEXT_LENGTH,
    name: str = "keywords",
) -> DataFrame:
    """First k terms, in alphabetical order, of each group's vocabulary."""
    totals = term_totals(exploded_terms(df, [group], text, stop_words, longer_than), group)
    # At most `size` rows per group are left to order.
    order = Window.partitionBy(group).orderBy("term")
    first = (
        vocabulary(totals, group, size)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )
    return ranked_text(first, group, "rank", "term", SEPARATOR, name)


def _sizes_and_keywords(
    df: DataFrame,
    group: str,
    text: str,
    k: int,
    size: int,
    stop_words: Iterable[str] | None,
    longer_than: int,
    name: str,
) -> DataFrame:
    """Usable texts and alphabetical keywords per group, from one pass over the texts."""
    marked = exploded_terms(df, [group], text, stop_words, longer_than, mark_texts=True)
    is_mark = F.col("term").isin(USABLE_MARK, SHORT_MARK)
    order = Window.partitionBy(group, "_mark").orderBy(F.desc("total"), "term")
    kept = (
        term_totals(marked, group)
        .withColumn("_mark", is_mark)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= size)
    )
    # At most `size` terms and two marks per group are left.
    found = F.array_sort(F.collect_list(F.when(~F.col("_mark"), F.col("term"))))
    first = F.slice(found, 1, k)
    return kept.groupBy(group).agg(
        F.coalesce(F.max(F.when(F.col("term") == USABLE_MARK, F.col("total"))), F.lit(0)).alias(
            "texts"
        ),
        F.when(F.size(first) > 0, F.array_join(first, SEPARATOR)).alias(name),
    )


def weighted_keywords(
    df: DataFrame,
    group: str,
    key: str,
    text: str,
    k: int = KEYWORDS,
    size: int = VOCABULARY_SIZE,
    stop_words: Iterable[str] | None = None,
    longer_than: int = MIN_TEXT_LENGTH,
    name: str = "keywords",
    known: DataFrame | None = None,
) -> DataFrame:
    """The k terms of each group with the largest mean TF-IDF weight.

    Weights are compared at nine decimals so that the order does not depend on
    the order of summation.
    """
    if known is None:
        known = group_vocabulary(df, group, text, size, stop_words, longer_than)
    weights = tfidf(df, group, key, text, size, stop_words, longer_than, known)
    means = (
        weights.groupBy(group, "term")
        .agg(F.sum("weight").alias("weight"))
        .join(_sizes(known, group), group)
        .withColumn("weight", F.round(F.col("weight") / F.col("texts"), 9))
    )
    return ranked_text(
        top_k_per_group(means, group, "weight", k, ["term"]),
        group, "rank", "term", SEPARATOR, name,
    )


def _sizes(known: DataFrame, group: str) -> DataFrame:
    """Usable texts of each group, from its vocabulary."""
    return known.groupBy(group).agg(F.max("texts").alias("texts"))


def group_keywords(
    df: DataFrame,
    group: str,
    text: str,
    key: str | None = None,
    by_weight: bool = False,
    min_texts: int = MIN_TEXTS,
    few_label: str = FEW_TEXTS_LABEL,
    empty_label: str = NO_TERMS_LABEL,
    longer_than: int = MIN_TEXT_LENGTH,
    k: int = KEYWORDS,
    size: int = VOCABULARY_SIZE,
    stop_words: Iterable[str] | None = None,
    name: str = "keywords",
) -> DataFrame:
    """Keywords of every group that has a text; labels where there are too few.

    Alphabetical keywords are the published behaviour; ``by_weight`` (which
    needs a unique ``key``) gives the most relevant terms instead.
    """
    limits = {
        "k": k, "size": size, "stop_words": stop_words, "longer_than": longer_than,
        "name": name,
    }
    if by_weight:
        if key is None:
            raise ValueError("keywords by weight need the key of a text")
        known = group_vocabulary(df, group, text, size, stop_words, longer_than)
        best = weighted_keywords(df, group, key, text, **limits, known=known)
        found = _sizes(known, group).join(best, group, "left")
    else:
        found = _sizes_and_keywords(df, group, text, **limits)
    label = F.when(F.col("texts") < min_texts, F.lit(few_label)).otherwise(
        F.coalesce(F.col(name), F.lit(empty_label))
    )
    return found.select(group, "texts", label.alias(name))
