"""N-gram Jaccard join by vertical partitioning.

Two texts link when their sets of word n-grams overlap enough.  All n-grams
stand in one global order, rare ones (by hash) before frequent ones.

*Nodes.*  Equal sets are one node, so copies never meet each other.
*Candidates.*  Two sets that link share an n-gram among the first few of each, so
only such prefixes are shuffled.  In each list of nodes with a common prefix
n-gram, every node is first paired with one leader, the member with most frequent
n-grams (of a group of near copies: the most typical).  Links found that way
join most of a group with one pair a node.  After that only nodes of different
groups are paired, with the tighter prefix that their sizes ask for, and only
while their positions leave room for enough overlap.  Nothing is capped: a group
whose members all link through leaders costs one pair a member, and any pair that
could still join two groups is checked.
*Partial overlaps.*  The order is cut into ``FRAGMENTS`` fragments.  Counts per
fragment bound a pair's overlap first (the sum of the smaller counts); for the
pairs left, the overlap is counted in each fragment by itself and summed per pair.
*Components.*  Links are contracted by alternating stars.

Frequent n-grams need not be known exactly, as any common order is right: each
slice of text names its most repeated n-grams, and the ``FREQUENT`` largest sums
are sent to all tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.store import share_code, stored

NGRAM = 5
PERCENT = 75
#: Fragments of the order for exact counts.
FRAGMENTS = 8
#: For the bound before, a set has a fragment for about each two to four shingles, within these limits.
LEAST_BITS, MOST_BITS = 6, 20
#: Bytes of text that are worked on at once.
SLICE = 4 << 20
#: N-grams that go last in the order, at most, and how many a slice of text names.
FREQUENT = 50_000
NAMED = 2_000
#: Sizes in one class differ by this factor at most.
CLASS = 1.05
#: Document ids that may go to all tasks; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
LAST = 1 << 62
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


def shingle_sets(texts: pa.Array, size: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different shingle hashes (63 bits) of each text, and where each text's begin."""
    values, starts = W.split_words(W.translated(texts, W.LOWER))
    ids, dictionary = W.word_ids(values)
    word = W.word_hashes(dictionary)[ids]
    sizes = np.diff(starts)
    rows = W.owners(starts)
    at = np.flatnonzero(rows[: max(0, len(rows) - size + 1)] == rows[size - 1 :])
    factor = np.resize(_FACTORS, size) + np.arange(size, dtype=np.uint64) * np.uint64(2)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += word[at + k] * factor[k]
    row = rows[at]
    short = np.flatnonzero((sizes > 0) & (sizes < size))
    if len(short):  # the whole sequence is one shingle; its length keeps it apart from longer ones
        whole = [
            sum(int(w) * int(f) for w, f in zip(word[starts[r] : starts[r + 1]], factor)) + int(sizes[r])
            for r in short.tolist()
        ]
        total = np.concatenate([total, np.array([x & (2**64 - 1) for x in whole], np.uint64)])
        row = np.concatenate([row, short])
    hashed = W.mixed(total) >> np.uint64(1)
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    hashed, row = hashed[new], row[new]
    return hashed, np.searchsorted(row, np.arange(len(texts) + 1))


def node_ids(hashed: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One number for each set; equal sets have equal numbers."""
    total = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(W.mixed(hashed ^ np.uint64(0x5DEECE66D)), out=total[1:])
    sizes = np.diff(starts).astype(np.uint64)
    return W.mixed(total[starts[1:]] - total[starts[:-1]] + sizes).view(np.int64)


def fragment_counts(hashed: np.ndarray, starts: np.ndarray) -> pa.Array:
    """For each text the shingles in each of its fragments, a byte each; 255 stands for 255 or more."""
    sizes = np.diff(starts)
    bits = np.clip(np.log2(np.maximum(sizes, 1)).astype(np.int64) - 1, LEAST_BITS, MOST_BITS)
    begin = np.concatenate([[0], np.cumsum(np.where(sizes > 0, 1 << bits, 0))])
    rows = W.owners(starts)
    cell = begin[rows] + (hashed >> (63 - bits[rows]).astype(np.uint64)).astype(np.int64)
    counts = np.minimum(np.bincount(cell, minlength=int(begin[-1])), 255).astype(np.uint8)
    offsets = pa.py_buffer(begin.astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(counts.tobytes())])


def _describe(size: int):
    """A row for each document, and rows with the most repeated shingles of each slice."""

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                hashed, starts = shingle_sets(W.text_column(part.column("text")), size)
                docs = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(node_ids(hashed, starts)),
                        pa.array(np.diff(starts)),
                        fragment_counts(hashed, starts),
                        pa.nulls(docs, pa.int64()),
                        part.column("text_hash"),
                    ],
                    ["doc_id", "node", "n", "counts", "times", "text_hash"],
                )
                value, times = np.unique(hashed, return_counts=True)
                named = np.flatnonzero(times > 1)
                named = named[np.argsort(-times[named], kind="stable")[:NAMED]]
                if len(named):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.nulls(len(named), part.column("doc_id").type),
                            pa.array(value[named].view(np.int64)),
                            pa.nulls(len(named), pa.int64()),
                            pa.nulls(len(named), pa.binary()),
                            pa.array(times[named]),
                            pa.nulls(len(named), pa.int64()),
                        ],
                        ["doc_id", "node", "n", "counts", "times", "text_hash"],
                    )

    return run


def _ordered(hashed: np.ndarray, starts: np.ndarray, frequent: np.ndarray):
    """Places in the global order, sorted inside each text, and the owners."""
    place = (hashed >> np.uint64(1)).view(np.int64)
    last = np.zeros(len(hashed), bool)
    if len(frequent) and len(hashed):
        at = np.minimum(np.searchsorted(frequent, hashed), len(frequent) - 1)
        last = frequent[at] == hashed
    place = place + np.where(last, LAST, 0)
    rows = W.owners(starts)
    order = np.lexsort((place, rows))
    return place[order], rows, last


def _prefixes(size: int, percent: int, frequent):
    """Prefix shingles: place in the order, node, size of the set, position, frequent share."""

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                hashed, starts = shingle_sets(W.text_column(part.column("text")), size)
                place, rows, last = _ordered(hashed, starts, frequent.value)
                nodes, n = node_ids(hashed, starts), np.diff(starts)
                share = 1000 * W.sums_by_row(last, starts) // np.maximum(n, 1)
                position = np.arange(len(place)) - starts[rows]
                first = np.zeros(part.num_rows, bool)
                first[np.unique(nodes, return_index=True)[1]] = True
                keep = first[rows] & (position < (n - -(-percent * n // 100) + 1)[rows])
                rows = rows[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place[keep]),
                        pa.array(nodes[rows]),
                        pa.array(n[rows].astype(np.int32)),
                        pa.array(position[keep].astype(np.int32)),
                        pa.array(share[rows].astype(np.int32)),
                    ],
                    ["place", "node", "n", "position", "share"],
                )

    return run


def _fragments(size: int, frequent):
    """Each set cut into fragments of the order."""

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                hashed, starts = shingle_sets(W.text_column(part.column("text")), size)
                place, rows, _ = _ordered(hashed, starts, frequent.value)
                fragment = np.where(place >= LAST, FRAGMENTS - 1, place // (LAST // (FRAGMENTS - 1) + 1))
                cell = rows * FRAGMENTS + fragment
                ends = np.searchsorted(cell, np.arange(part.num_rows * FRAGMENTS + 1)).astype(np.int32)
                inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(place))
                sets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * FRAGMENTS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node_ids(hashed, starts)), pa.ListArray.from_arrays(sets, inner)],
                    ["node", "fragments"],
                )

    return run


def overlap_bound(left: pd.Series, right: pd.Series) -> pd.Series:
    """Most that two sets can share: the sum of the smaller counts over common fragments."""
    out = np.empty(len(left), np.int64)
    for k, (a, b) in enumerate(zip(left, right)):
        a, b = (np.frombuffer(x, np.uint8) for x in (a, b))
        open_ = ((a == 255).any() or (b == 255).any()) if len(a) else False
        size = min(len(a), len(b))
        a, b = (x.reshape(size, -1).sum(axis=1, dtype=np.int64) for x in (a, b))
        out[k] = 1 << 40 if open_ else np.minimum(a, b).sum()
    return pd.Series(out)


class Join:
    """One run of the join over one table; holds what its steps share."""

    def __init__(self, documents: DataFrame, doc: str, text: str, size: int, percent: int):
        self.spark = documents.sparkSession
        share_code(self.spark)
        self.size, self.percent = size, percent
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.texts = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
        self.kind = self.texts.schema["doc_id"].dataType.simpleString()
        described = stored(
            self.texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
                _describe(size),
                f"doc_id {self.kind}, node bigint, n bigint, counts binary, times bigint, text_hash bigint",
            ),
            "join-documents",
        )
        self.docs = described.where("times is null")
        named = described.where("times is not null").groupBy("node").agg(F.sum("times").alias("times"))
        top = named.orderBy(F.desc("times"), "node").limit(FREQUENT).select("node").collect()
        frequent = np.sort(np.array([r["node"] for r in top], np.int64).view(np.uint64))
        self.frequent = self.spark.sparkContext.broadcast(frequent)

    def needed(self, n: Column, m: Column) -> Column:
        """Least overlap of linked sets of these sizes."""
        return F.ceil(F.lit(self.percent) * (n + m) / (100 + self.percent) - 1e-9)

    def comparable(self, n: Column, m: Column) -> Column:
        return F.lit(100) * F.least(n, m) >= F.lit(self.percent) * F.greatest(n, m)

    def postings(self) -> DataFrame:
        """Prefix shingles that several nodes have, with each list's leader."""
        rows = self.texts.mapInArrow(
            _prefixes(self.size, self.percent, self.frequent),
            "place bigint, node bigint, n int, position int, share int",
        ).repartition(self.parts, "place")
        rows = rows.groupBy("place", "node").agg(
            *[F.first(c).alias(c) for c in ("n", "position", "share")]
        )
        same = Window.partitionBy("place")
        leader = F.max(F.struct("share", "node", "n")).over(same)
        rows = rows.withColumn("members", F.count("*").over(same)).withColumn("leader", leader)
        return stored(rows.where("members > 1").drop("members", "share"), "join-postings")

    def leader_pairs(self, postings: DataFrame) -> DataFrame:
        """Each node with the leader it meets most often."""
        met = postings.where(
            (F.col("leader.node") != F.col("node")) & self.comparable(F.col("n"), F.col("leader.n"))
        )
        met = met.groupBy("node", "n", F.col("leader.node").alias("other"), F.col("leader.n").alias("m")).count()
        best = met.groupBy("node", "n").agg(F.max(F.struct("count", "other", "m")).alias("best"))
        return best.select("node", "n", F.col("best.other").alias("other"), F.col("best.m").alias("m"))

    def other_pairs(self, postings: DataFrame, groups: DataFrame) -> DataFrame:
        """All pairs of nodes of different groups that may link."""
        rows = postings.drop("leader").join(groups, "node", "left")
        rows = rows.withColumn("group", F.coalesce("group", "node"))
        step = float(np.log(CLASS))
        rows = rows.withColumn("own", F.floor(F.log("n") / step + 1e-9).cast("int"))
        same = Window.partitionBy("place")
        rows = (
            rows.withColumn("several", F.min("group").over(same) != F.max("group").over(same))
            .withColumn("classes", F.collect_set("own").over(same))  # as many as size classes at most
            .where("several")
            .withColumn("class", F.explode("classes"))
        )
        low = F.floor(F.exp(F.col("class") * step) * (1 - 1e-9))
        high = F.ceil(F.exp((F.col("class") + 1) * step) * (1 + 1e-9))
        n, p = F.col("n"), F.lit(self.percent)
        least = F.greatest(low, F.ceil(p * n / 100 - 1e-9))
        rows = rows.where(
            (p * n <= 100 * high) & (p * low <= 100 * n) & (F.col("position") < n - self.needed(n, least) + 1)
        )
        pair = Window.partitionBy("place", F.least("own", "class"), F.greatest("own", "class"))
        rows = rows.withColumn("several", F.min("group").over(pair) != F.max("group").over(pair)).where("several")
        rows = stored(rows.select("place", "node", "n", "position", "group", "own", "class"), "join-prefixes")
        right = rows.select(
            "place",
            F.col("node").alias("other"),
            F.col("n").alias("m"),
            F.col("position").alias("place_m"),
            F.col("group").alias("group_m"),
            F.col("own").alias("class"),
            F.col("class").alias("own"),
        )
        met = rows.join(right, ["place", "own", "class"]).where(
            (F.col("group") != F.col("group_m"))
            & (F.col("node") < F.col("other"))
            & self.comparable(F.col("n"), F.col("m"))
        )
        met = met.groupBy("node", "n", "other", "m").agg(
            F.count("*").alias("shared"), F.max("position").alias("i"), F.max("place_m").alias("j")
        )
        room = F.col("shared") + F.least(F.col("n") - 1 - F.col("i"), F.col("m") - 1 - F.col("j"))
        return met.where(room >= self.needed(F.col("n"), F.col("m"))).select("node", "n", "other", "m")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose overlap, summed over fragments, is enough: ``node, other, overlap``."""
        known = self.docs.where("n > 0").groupBy("node").agg(
            F.first("counts").alias("counts"), F.min("doc_id").alias("doc_id")
        )
        left = known.select("node", "counts", F.col("doc_id").alias("doc"))
        right = known.select(
            F.col("node").alias("other"), F.col("counts").alias("counts_m"), F.col("doc_id").alias("doc_m")
        )
        bound = F.pandas_udf(overlap_bound, "bigint")
        bounded = pairs.join(left, "node").join(right, "other")
        bounded = bounded.where(bound("counts", "counts_m") >= self.needed(F.col("n"), F.col("m")))
        bounded = stored(bounded.select("node", "n", "other", "m", "doc", "doc_m"), "join-pairs")
        wanted = bounded.select(F.explode(F.array("doc", "doc_m")).alias("wanted")).distinct()
        if wanted.count() <= BROADCAST_IDS:
            wanted = F.broadcast(wanted)
        texts = self.texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
        cut = texts.mapInArrow(
            _fragments(self.size, self.frequent), "node bigint, fragments array<array<bigint>>"
        )
        # both sets of a pair meet there; each fragment is counted by itself
        end = lambda k, name: F.struct(F.lit(k).alias("end"), F.col(name).alias("node"))
        ends = bounded.select(
            F.struct("node", "n", "other", "m").alias("pair"),
            F.explode(F.array(end(0, "node"), end(1, "other"))).alias("e"),
        ).select("pair", "e.end", "e.node")
        if ends.count() <= BROADCAST_IDS:
            ends = F.broadcast(ends)
        side = lambda k: F.first(F.when(F.col("end") == k, F.col("fragments")), ignorenulls=True)
        met = cut.join(ends, "node").groupBy("pair").agg(side(0).alias("a"), side(1).alias("b"))
        partial = F.zip_with("a", "b", lambda x, y: F.size(F.array_intersect(x, y)))
        overlap = met.where("a is not null and b is not null").select(
            "pair.*", F.aggregate(partial, F.lit(0), lambda total, x: total + x).alias("overlap")
        )
        union = F.col("n") + F.col("m") - F.col("overlap")
        return stored(
            overlap.where(F.lit(100) * F.col("overlap") >= F.lit(self.percent) * union).select(
                "node", "other", "overlap"
            ),
            "join-links",
        )


def components(links: DataFrame) -> DataFrame:
    """``node, group``: the smallest node reachable from each node that has a link.

    Alternating large and small stars (Kiveris et al. 2014); every round is a
    stored table and the driver sees only a checksum.
    """
    edges = links.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v"))
    edges, seen = stored(edges.where("u != v").distinct(), "edges"), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u != v").distinct(), "edges")
        sums = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == tuple(sums):
            break
        seen = tuple(sums)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("group")).union(roots)


def grouped_rows(documents: DataFrame, doc: str, text: str, size: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, group, component_id``; ``group`` is null for an empty set."""
    join = Join(documents, doc, text, size, percent)
    postings = join.postings()
    first = join.links(join.leader_pairs(postings))
    second = join.links(join.other_pairs(postings, components(first)))
    groups = components(first.unionByName(second))
    docs = join.docs.select("doc_id", "text_hash", "node", "n")
    names = docs.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    names = names.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    least = names.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    label = names.join(least, "group").select("node", "group", "component_id")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = docs.join(label, "node", "left").withColumn("component_id", own)
    return out.select("doc_id", "text_hash", "n", "group", "component_id")


def jaccard_groups(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", size: int = NGRAM, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    A-Z are lower-cased; words are runs of bytes other than 0x20 and 0x09-0x0D.
    The set of a text is its different n-grams of words; with fewer words, all of
    them as one.  Texts link when 100 * intersection >= percent * union;
    ``component_id`` is the smallest id reachable by links.  A null text or one
    without words has an empty set, links with nothing and is its own component.
    Null ids are never the smallest; a component without any id has a null one.
    Repeated rows are one node and give equal rows.  An empty table gives no
    rows.  Other columns are ignored.
    """
    rows = grouped_rows(documents, doc, text, size, percent)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", size: int = NGRAM, percent: int = PERCENT
) -> DataFrame:
    """The documents, all columns, with one row of each group of linked texts.

    The row with the smallest id stays (no id counts as the largest, ties go to a
    hash of the text; of equal rows any one).  Rows with an empty set all stay.
    """
    rows = stored(grouped_rows(documents, doc, text, size, percent), "join-groups").where("n > 0")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = rows.groupBy("group").agg(F.min(rank).alias("best"))
    ranked = rows.join(best, "group").select("doc_id", "text_hash", (rank == F.col("best")).alias("stays"))
    key = ["doc_id", "text_hash"]
    removed = stored(ranked.where("not coalesce(stays, false)").select(*key).distinct(), "join-removed")
    again = ranked.where("stays").groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1").select(*key)
    again = stored(again, "join-again")

    mark = "__join"
    while any(c.startswith(mark) for c in documents.columns):
        mark += "_"
    hashed = documents.withColumn(mark, F.xxhash64(F.col(f"`{text}`")))

    def matched(df: DataFrame, keys: DataFrame, kind: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias(f"{mark}_id"), F.col("text_hash").alias(f"{mark}_hash"))
        if keys.count() <= BROADCAST_IDS:
            keys = F.broadcast(keys)
        same = F.col(f"`{doc}`").eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_hash"))
        return df.join(keys, same, kind)

    out = matched(hashed, removed, "left_anti")
    if again.take(1):
        one = matched(out, again, "left_semi").dropDuplicates([doc, mark])
        out = matched(out, again, "left_anti").unionByName(one)
    return out.drop(mark)
