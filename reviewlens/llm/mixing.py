"""Mixing sources to target weights by exact block quotas.

1. *Targets.*  Sources share a total by weight; a target stops at
   ``MAX_EPOCHS`` times its source's size and the excess is reshared.
2. *Blocks.*  The documents of a source are put in a random but repeatable order
   (a hash) and cut into blocks of consecutive hashes, so a block is found
   without sorting a source.  A target is a number of whole passes plus a rest;
   the rest takes the first blocks of the order and, of the block where it ends,
   the first documents.  That fixes each source's block quota exactly.
3. *Splitting tree.*  The output shards are the leaves of a binary tree.  At each
   node the quotas of all sources are split between the halves by a multivariate
   hypergeometric draw: as if as many block tickets as the left half has slots
   were drawn without replacement from all tickets of the node.  Only quotas per
   source pass through the tree, so it is as small as sources times shards.
4. *Blocks of a shard.*  A source's block tickets stand in a permuted order; each
   shard owns the next run of them, so shards are disjoint and together complete.
   Documents are shuffled inside their shard by another hash.

The driver holds one row per source.  The tree is never laid out: a task walks from the
root to the shards its tickets fall in and draws the nodes on the way, whose seeds depend
on their place only.  Running sums and ranks over a source are taken in stretches of its
blocks, so that no source is one window.  The mix is written as shards; what was taken is
counted from them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.store import stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Mean documents of a block.
BLOCK_DOCS = 64
#: Mean block tickets of an output shard.
SHARD_BLOCKS = 64
#: Blocks or tickets of a source that one window puts in order, about.
STRETCH = 4_096
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def water_fill(sizes: list[int], weights: list[float], total: float, most: float = MAX_EPOCHS) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size."""
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = float(total)
    while open_ and left > 0:
        unit = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if weights[k] * unit > most * sizes[k]]
        if not full:
            for k in open_:
                out[k] = weights[k] * unit
            break
        for k in full:
            out[k] = float(most * sizes[k])
            left -= out[k]
            open_.remove(k)
    return out


class SplittingTree:
    """Tickets of each source in each shard, drawn where they are needed.

    Shards hold equal numbers of tickets (within one); a source's add up to its quota.
    """

    def __init__(self, quotas: list[int], shards: int, seed: int = SEED):
        self.quotas, self.count, self.seed = np.array(quotas, np.int64), shards, seed
        self.total = int(sum(quotas))

    def _end(self, shard: int) -> int:
        return self.total * shard // self.count

    def _left(self, quotas: np.ndarray, low: int, high: int) -> np.ndarray:
        """Quotas of the left half of the node over the shards from low to high."""
        slots = self._end((low + high) // 2) - self._end(low)
        draw = np.random.Generator(np.random.PCG64([self.seed, low, high]))
        part, rest = np.zeros_like(quotas), int(quotas.sum())
        for k, own in enumerate(quotas.tolist()):  # one source after the other
            if slots and own:
                part[k] = _hypergeometric(draw, own, rest - own, slots)
            rest -= own
            slots -= int(part[k])
        return part

    def shards_of(self, source: int, ranks: np.ndarray, known: dict | None = None) -> np.ndarray:
        """Shard of each ticket of a source, by rank (from 1) in the permuted order.

        ``known`` keeps nodes between calls.
        """
        known = {} if known is None else known
        order = np.argsort(ranks, kind="stable")
        sorted_, out = ranks[order], np.zeros(len(ranks), np.int64)
        open_ = [(self.quotas, 0, self.count, 0, len(ranks), 0)]
        while open_:
            quotas, low, high, first, last, before = open_.pop()
            if first == last:
                continue
            if high - low == 1:
                out[first:last] = low
                continue
            if (low, high) not in known:
                known[low, high] = self._left(quotas, low, high)
            part, middle = known[low, high], (low + high) // 2
            cut = first + int(np.searchsorted(sorted_[first:last], before + int(part[source]), side="right"))
            open_.append((part, low, middle, first, cut, before))
            open_.append((quotas - part, middle, high, cut, last, before + int(part[source])))
        shards = np.empty_like(out)
        shards[order] = out
        return shards


def _hypergeometric(draw, good: int, bad: int, picks: int) -> int:
    if good + bad < 10**9:  # as many as numpy's generator takes
        return int(draw.hypergeometric(good, bad, picks))
    return inverted_hypergeometric(draw.random(), good, bad, picks)


def inverted_hypergeometric(u: float, good: int, bad: int, picks: int) -> int:
    """The hypergeometric variate at ``u``: probabilities are used up from the mode outwards."""
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    least, most = max(0, picks - bad), min(good, picks)
    mode = min(most, max(least, (picks + 1) * (good + 1) // (good + bad + 2)))
    up = down = mode
    p_up = p_down = math.exp(choose(good, mode) + choose(bad, picks - mode) - choose(good + bad, picks))
    u -= p_up
    while u > 0 and (up < most or down > least):
        if up < most:
            p_up *= (good - up) / (up + 1) * (picks - up) / (bad - picks + up + 1)
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > least:
            p_down *= down / (good - down + 1) * (bad - picks + down) / (picks - down + 1)
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if p_up + p_down == 0.0:
            break
    return mode


def sources(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_EPOCHS) -> list[dict]:
    """Source, size, documents and target of each source, by code point, null last."""
    words = F.sum(F.col("size") * F.col("repeats"))
    found = rows.groupBy("source").agg(words.alias("size"), F.count("*").alias("docs")).collect()
    found = sorted((r.asDict() for r in found), key=lambda r: (r["source"] is None, r["source"] or ""))
    own = [weights[k % len(weights)] for k in range(len(found))]
    total = sum(r["size"] for r in found)
    for r, target in zip(found, water_fill([r["size"] for r in found], own, total, most)):
        r["target"] = target
    return found


def plan(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS,
    block_docs: int = BLOCK_DOCS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
) -> DataFrame:
    """How often each document is taken, and into which shards.

    One row per different (id, source, text): ``doc_id, source, text_hash, size,
    repeats, source_size, target, copies, shards`` (an array, one entry a copy).
    ``repeats`` rows are that document; they are placed together and each is
    taken ``copies`` times.  A null text has size 0; null is a source of its own,
    last in order.  An empty table gives no rows; documents of size 0 are not
    taken.  Other columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(doc).alias("doc_id"),
        F.col(source).alias("source"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        word_count(F.col(text)).alias("size"),
    )
    unit = ["doc_id", "source", "text_hash", "size"]
    rows = stored(rows.groupBy(*unit).agg(F.count("*").alias("repeats")), "mix-sizes")
    found = sources(rows, weights, most)
    frame = spark.createDataFrame(
        [
            (k, r["source"], r["size"], r["target"], max(1, -(-r["docs"] // block_docs)))
            for k, r in enumerate(found)
        ],
        "source_number int, source string, source_size bigint, target double, blocks bigint",
    )
    placed = (  # the broadcast side has a row per source, which the driver holds anyway
        rows.join(F.broadcast(frame), rows["source"].cast("string").eqNullSafe(frame["source"]))
        .drop(frame["source"])
        .withColumn("place", F.xxhash64("doc_id", "text_hash", F.lit(seed)))
        .withColumn("block", _slice_of("place", "blocks"))
        .withColumn("words", F.col("size") * F.col("repeats"))
    )
    tickets = _tickets(placed, seed)
    counts = {r["source_number"]: r["count"] for r in tickets.groupBy("source_number").count().collect()}
    quotas = [counts.get(k, 0) for k in range(len(found))]
    tree = SplittingTree(quotas, max(1, sum(quotas) // shard_blocks), seed)
    dealt = _dealt(tickets, tree)

    inside = Window.partitionBy("source_number", "block").orderBy("place", "doc_id", "text_hash")
    ended = F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # of the open block, a document is in when its middle lies before the cut
    more = F.col("whole") | (F.col("ended") - F.col("words") / 2 < F.col("open"))
    copies = F.col("passes") + F.when(more & (F.col("open") > 0), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, F.coalesce(copies, F.lit(0))).otherwise(0).cast("int")
    return (
        placed.join(dealt, ["source_number", "block"], "left")
        .withColumn("ended", ended)
        .withColumn("copies", copies)
        .withColumn("shards", F.expr("transform(slice(coalesce(places, array()), 1, copies), p -> p.shard)"))
        .select(*unit, "repeats", "source_size", "target", "copies", "shards")
    )


def _slice_of(hashed: str, parts: str) -> Column:
    """Number from 0 of the equal slice of the 64-bit range that a hash falls in."""
    unit = (F.col(hashed).cast("double") + float(2**63)) / float(2**64)
    return F.least(F.floor(unit * F.col(parts)), F.col(parts) - 1).cast("bigint")


def _sum_before(rows: DataFrame, stretch: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over a source's earlier rows.

    ``stretch`` numbers bounded runs of the order.  A window covers one of them; only
    their totals, a row each, are put in order for a source.
    """
    keys = ["source_number", "_stretch"]
    rows = rows.withColumn("_stretch", stretch).withColumn("_value", value)
    earlier = Window.partitionBy("source_number").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("_value").over(inside), F.lit(0))
    joined = rows.join(totals, keys).withColumn(name, F.col("_start") + own)
    return joined.drop("_stretch", "_value", "_start")


def _tickets(placed: DataFrame, seed: int) -> DataFrame:
    """A row for each time a block is taken, with the block's passes and open words."""
    blocks = placed.groupBy("source_number", "source_size", "target", "block").agg(
        F.sum("words").alias("block_size")
    )
    blocks = stored(blocks, "mix-blocks")
    stretch = F.floor(F.col("block") / STRETCH)
    blocks = _sum_before(blocks, stretch, ["block"], F.col("block_size"), "start")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    open_ = F.greatest(F.lit(0.0), F.least(F.col("block_size").cast("double"), rest - F.col("start")))
    taken = F.col("passes") + F.when((F.col("open") > 0) & (F.col("block_size") > 0), 1).otherwise(0)
    return stored(
        blocks.withColumn("passes", passes.cast("int"))
        .withColumn("open", open_)
        .withColumn("whole", F.col("open") >= F.col("block_size"))
        .withColumn("tickets", taken.cast("int"))
        .where("tickets > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("tickets"))))
        .withColumn("draw", F.xxhash64("source_number", "block", "copy", F.lit(seed + 1)))
        .select("source_number", "block", "passes", "open", "whole", "copy", "draw"),
        "mix-tickets",
    )


def _dealt(tickets: DataFrame, tree: SplittingTree) -> DataFrame:
    """Shards of each block's tickets: a shard owns the next run of a source's tickets."""
    shared = tickets.sparkSession.sparkContext.broadcast(tree)  # a number for each source

    @F.pandas_udf("bigint")
    def shard(source: pd.Series, rank: pd.Series) -> pd.Series:
        out, known = np.zeros(len(source), np.int64), {}
        for k in np.unique(source):
            own = (source == k).to_numpy()
            out[own] = shared.value.shards_of(int(k), rank.to_numpy()[own], known)
        return pd.Series(out)

    sizes = tickets.groupBy("source_number").agg(F.ceil(F.count("*") / STRETCH).alias("stretches"))
    sized = tickets.join(F.broadcast(sizes), "source_number")  # a row for each source
    order = ["draw", "block", "copy"]
    ranked = _sum_before(sized, _slice_of("draw", "stretches"), order, F.lit(1), "before")
    return (
        ranked.withColumn("shard", shard("source_number", F.col("before") + 1))
        .groupBy("source_number", "block", "passes", "open", "whole")
        .agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("places"))
    )


def _mixed(documents: DataFrame, planned: DataFrame, doc: str, text: str, source: str) -> tuple[DataFrame, str]:
    """Rows of the mix with their shard, in the order of the shards, and the shard's column."""
    names, mark = documents.columns, "__mix"
    while any(n.startswith(mark) for n in names):
        mark += "_"
    keys = [f"{mark}_{k}" for k in ("doc", "source", "text")]
    number = f"{mark}_shard"
    taken = planned.where("copies > 0").select(
        F.col("doc_id").alias(keys[0]),
        F.col("source").alias(keys[1]),
        F.col("text_hash").alias(keys[2]),
        F.explode("shards").alias(number),
    )
    own = [F.col(f"`{doc}`"), F.col(f"`{source}`"), F.xxhash64(F.col(f"`{text}`"))]
    left = documents.withColumns({f"{k}_own": c for k, c in zip(keys, own)})
    same = [left[f"{k}_own"].eqNullSafe(taken[k]) for k in keys]
    place = F.xxhash64(*keys, number)
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        left.join(taken, same[0] & same[1] & same[2])
        .repartition(parts, number)
        .sortWithinPartitions(number, place)
        .select(*[F.col(f"`{c}`") for c in names], number)
    )
    return rows, number


def mix(
    documents: DataFrame, planned: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The mixed corpus with the columns of ``documents``.

    A document taken n times gives n rows.  The rows of a shard lie in one
    partition, in a shuffled order.
    """
    return _mixed(documents, planned, doc, text, source)[0].select(*[F.col(f"`{c}`") for c in documents.columns])


def write_shards(
    documents: DataFrame, planned: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source"
) -> tuple[DataFrame, str]:
    """The mix as a written table, read back, and the name of its shard column."""
    rows, number = _mixed(documents, planned, doc, text, source)
    return stored(rows, "mix-shards", compression="zstd"), number


def taken(
    shards: DataFrame, number: str, doc: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """What the shards hold of each different (id, source, text): ``doc_id, source,
    text_hash, words, in_shards``."""
    return shards.groupBy(
        F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
    ).agg(
        F.sum(word_count(F.col(f"`{text}`"))).alias("words"),
        F.array_sort(F.collect_set(number)).alias("in_shards"),  # as many as copies at most
    )
