"""How far sources of one language differ, priced on hash-consed segment trees.

*Counts.*  Tasks count terms per (language, source); the sums are shuffled by
term.  A language keeps the terms that enough of its documents hold.

*Trees.*  The kept terms of a language are cut by hash into blocks.  In a block each
group of documents (a source, and the language itself) has a segment tree over the
term ids: a leaf is a count, an inner node is its pair of children.  Nodes are
hash-consed level by level over all groups, so equal count subtrees, above all the
empty ones, are one node wherever they stand.

*Prices.*  Two trees are walked together from their roots.  On each level every
different pair of nodes is kept once for a pair of groups; a price is computed for
the different pairs of leaves and summed on the way back, each node pair once.
What a pair of groups costs thus follows the distinct pairs of subtrees, not the
number of terms.

All arithmetic is on whole numbers.  A block holds about ``CELLS`` counts, so a task
is bounded whatever the size of a language; prices of blocks are summed by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.store import share_code, stored

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Counts (groups times terms) that one block holds, about.
CELLS = 1_000_000
#: Node pairs that one walk holds on a level, about.
WALK = 1_000_000

#: Bytes after normalisation: letters a-z and all bytes of other characters stay.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

_COUNTS = "lang string, source string, term string, docs bigint, n bigint"
_PRICES = "part string, lang string, source string, item string, value bigint"
#: Child ids of a node are packed into one number.
_WIDE = np.int64(1) << np.int64(32)


def term_counts(texts: pa.Array, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Per group number and term: texts that hold the term, and its occurrences."""
    values, starts = W.split_words(W.translated(texts, NORMAL))
    ids, dictionary = W.word_ids(values)
    if not len(ids):
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = max(1, len(dictionary))
    cell, n = np.unique(W.owners(starts) * wide + ids, return_counts=True)
    key, at = np.unique(group[cell // wide] * wide + cell % wide, return_inverse=True)
    docs = np.bincount(at, minlength=len(key))
    occurrences = np.zeros(len(key), np.int64)
    np.add.at(occurrences, at, n)
    return key // wide, dictionary.take(pa.array(key % wide)), docs.astype(np.int64), occurrences


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            names = {}
            pairs = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            group = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
            owner, term, docs, n = term_counts(W.text_column(part.column("text")), group)
            lang, source = (pa.array([p[k] for p in names], pa.string()) for k in (0, 1))
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [lang.take(owner), source.take(owner), term, pa.array(docs), pa.array(n)],
                ["lang", "source", "term", "docs", "n"],
            )


def smoothed(counts: np.ndarray, mass: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / mass), without overflow: three steps of a thousand."""
    rest = counts + 2
    out = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // mass
        rest = rest % mass
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Trees of the rows of ``counts`` (a power of two wide), hash-consed.

    Returns the different leaves, for each level from the leaves up the children of
    its different nodes, and the root of each row.
    """
    leaves, ids = np.unique(counts, return_inverse=True)
    ids = ids.reshape(counts.shape).astype(np.int64)
    levels = []
    while ids.shape[1] > 1:
        pairs, up = np.unique(ids[:, 0::2] * _WIDE + ids[:, 1::2], return_inverse=True)
        levels.append((pairs // _WIDE, pairs % _WIDE))
        ids = up.reshape(ids.shape[0], -1).astype(np.int64)
    return leaves, levels, ids[:, 0]


def walk(levels, roots: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Different (pair, leaf, leaf) that pairs of trees reach, and how to sum their prices.

    ``left`` and ``right`` are the rows of each pair of trees.  The returned function
    takes a price for each of the different leaf pairs and gives the sum of each pair.
    """
    pair, u, v = np.arange(len(left)), roots[left], roots[right]
    steps = []
    for a, b in reversed(levels):
        pair, u, v = np.concatenate([pair, pair]), np.concatenate([a[u], b[u]]), np.concatenate([a[v], b[v]])
        order = np.lexsort((v, u, pair))
        p, x, y = pair[order], u[order], v[order]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        at = np.empty(len(p), np.int64)
        at[order] = np.cumsum(new) - 1
        steps.append(at)
        pair, u, v = p[new], x[new], y[new]

    def summed(prices: np.ndarray) -> np.ndarray:
        for at in reversed(steps):
            half = len(at) // 2
            prices = prices[at[:half]] + prices[at[half:]]
        return prices

    return (pair, u, v), summed


class Block:
    """Counts of some terms of a language: a row for each source, then the language."""

    def __init__(self, counts: np.ndarray, mass: np.ndarray):
        self.terms = counts.shape[1]
        width = 1 << max(0, self.terms - 1).bit_length()
        padded = np.full((len(counts), width), -1, np.int64)
        padded[:, : self.terms] = counts
        self.mass = mass
        self.leaves, self.levels, self.roots = consed(padded)
        self.width = width

    def leaf_prices(self, left: np.ndarray, right: np.ndarray, u: np.ndarray, v: np.ndarray):
        """Both probabilities and the price of leaf pairs; padding costs nothing."""
        x, y = self.leaves[u], self.leaves[v]
        p = smoothed(np.maximum(x, 0), self.mass[left])
        q = smoothed(np.maximum(y, 0), self.mass[right])
        return p, q, np.where(x < 0, 0, price(p, q))

    def divergences(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Sum of prices over the terms of the block for each two sources, a run of pairs at a time."""
        sources = len(self.roots) - 1
        step = max(1, WALK // self.width)
        for a in range(sources):
            for low in range(a + 1, sources, step):
                right = np.arange(low, min(sources, low + step))
                left = np.full(len(right), a)
                (pair, u, v), summed = walk(self.levels, self.roots, left, right)
                yield left, right, summed(self.leaf_prices(left[pair], right[pair], u, v)[2])

    def typical(self, counts: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each source the terms it has more of than the language, the k dearest."""
        whole = len(self.roots) - 1
        for a in range(whole):
            (_, u, v), _ = walk(self.levels, self.roots, np.array([a]), np.array([whole]))
            p, q, value = self.leaf_prices(np.array([a]), np.array([whole]), u, v)
            leaf = np.searchsorted(self.leaves, counts[[a, whole]])
            known = u * _WIDE + v  # sorted, as the walk orders them
            at = np.searchsorted(known, leaf[0] * _WIDE + leaf[1])
            term = np.flatnonzero((counts[a] > 0) & (p[at] > q[at]))
            best = term[np.lexsort((term, -value[at[term]]))][:k]
            yield a, best, value[at[best]]


def _price_block(key, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Prices of one block: part ``pair`` for each two sources, part ``term`` for the dearest terms."""
    import pyarrow.compute as pc

    columns: list[list] = [[], [], [], []]

    def put(part: str, source: list, item: list, value: np.ndarray) -> None:
        for column, more in zip(columns, ([part] * len(source), source, item, value.tolist())):
            column.extend(more)

    if terms.num_rows and groups.num_rows:
        words = terms.column("term").cast(pa.binary()).combine_chunks()  # compared as bytes
        terms = terms.take(pc.sort_indices(words))
        names = sorted(zip(groups.column("source").to_pylist(), groups.column("mass").to_pylist()))
        source = [name for name, _ in names]
        counts = np.zeros((len(names) + 1, terms.num_rows), np.int64)
        found = terms.column("sources").combine_chunks()
        each = found.flatten()
        row = pc.index_in(each.field("source"), value_set=pa.array(source, pa.string())).to_numpy()
        counts[row, pc.list_parent_indices(found).to_numpy()] = each.field("n").to_numpy()
        counts[-1] = terms.column("n").to_numpy()
        mass = np.array([m for _, m in names] + [groups.column("lang_mass")[0].as_py()], np.int64)
        block = Block(counts, mass)
        for left, right, value in block.divergences():
            a, b = ([source[k] for k in side.tolist()] for side in (left, right))
            put("pair", a, b, value)
        word = terms.column("term").to_pylist()
        for a, best, value in block.typical(counts, TOP_TERMS):
            put("term", [source[a]] * len(best), [word[t] for t in best.tolist()], value)
    lang = key[0].as_py()
    part, source, item, value = columns
    return pa.table(
        {
            "part": pa.array(part, pa.string()),
            "lang": pa.array([lang] * len(part), pa.string()),
            "source": pa.array(source, pa.string()),
            "item": pa.array(item, pa.string()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _mass(n: str, v: str) -> Column:
    return F.coalesce(n, F.lit(0)) + 2 * F.col(v)


def source_divergence(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets sources of a language apart.

    Terms are runs of letters a-z (A-Z are lower-cased) and of any character outside
    ASCII.  A language keeps the terms in at least ``min_documents`` of its rows, V of
    them.  A group, (lang, source) or a whole lang, gives a kept term with ``count``
    occurrences p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), N being its occurrences
    of kept terms.  Two groups differ on a term by floor((p - q)**2 / (p + q)).

    Part ``pair`` has for each group every other source of its language, with the sum
    over all kept terms (0 where there are none).  Part ``term`` has the kept terms
    that occur in the group and have p above the language's q, the ``TOP_TERMS``
    dearest.  Ranks count from 1 by value descending, then item in UTF-8 order.

    Null text, language or source is read as the empty string.  Repeated rows count
    each.  A language with one source has no pairs.  An empty table gives no rows.
    Other columns are ignored.
    """
    spark = documents.sparkSession
    share_code(spark)
    blank = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    rows = documents.select(blank(text, "text"), blank(lang, "lang"), blank(source, "source"))
    groups = rows.groupBy("lang", "source").agg(F.count("*").alias("rows")).drop("rows")

    counted = rows.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term")
    counted = counted.agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    # as many sources meet in a row as the language has
    terms = counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("n").alias("n"),
        F.collect_list(F.struct("source", "n")).alias("sources"),
    )
    terms = stored(terms.where(F.col("docs") >= min_documents).drop("docs"), "divergence-terms")

    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("n"))
    sizes = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source"))
    sizes = sizes.agg(F.sum("s.n").alias("own"))
    known = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    known = known.withColumn("v", F.coalesce("v", F.lit(0)))
    known = stored(
        known.select("lang", "source", "v", _mass("own", "v").alias("mass"), _mass("n", "v").alias("lang_mass")),
        "divergence-groups",
    )
    cut = known.groupBy("lang", "v").agg((F.count("*") + 1).alias("groups"))
    cut = cut.select("lang", F.ceil(F.col("v") * F.col("groups") / CELLS).cast("int").alias("blocks"))

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    left = terms.join(cut, "lang").select("lang", block, "term", "n", "sources")
    right = known.join(cut.where("blocks > 0"), "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "mass", "lang_mass"
    )
    prices = stored(
        left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(_price_block, _PRICES),
        "divergence-prices",
    )

    # every two sources of a language are an output row, also where no term is kept
    other = known.where("v = 0").select("lang", F.col("source").alias("item"))
    empty = known.where("v = 0").join(other, "lang").where("source < item")
    empty = empty.select(F.lit("pair").alias("part"), "lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    once = prices.unionByName(empty).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    turned = F.struct(F.col("item").alias("source"), F.col("source").alias("item"))
    sides = F.when(F.col("part") == "pair", F.array(F.struct("source", "item"), turned)).otherwise(
        F.array(F.struct("source", "item"))
    )
    summed = once.select("lang", "part", "value", F.inline(sides))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS)).select(
        "lang", "source", "part", "item", "value", "rank"
    )
