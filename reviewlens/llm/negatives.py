"""Hard negatives by Kronecker-packed products.

Vectors become whole numbers, so scores are exact and ties are real.

*Packing.*  The rows are packed into blocks.  For each dimension the components of
all rows of a block, biased so that none is negative, are written into the fields of
one wide integer.  Multiplying it by an anchor's (biased) component multiplies all of
them at once; the sum over the dimensions holds all inner products, each in its own
field, because a field is wide enough for the largest sum the block can give.  Taking
the biases off again gives the exact scores.  Integers have as many bits as they
need, so components of any size are exact.

*Searching.*  Anchor blocks meet row blocks, never rows rows: each pair of blocks gives
the best few of its rows for each anchor, and a ranked window keeps the best few of
all blocks.  One search finds an anchor's positives; their scores are the limits of
the second, for the negatives.  Anchors go to all tasks only if they are small;
otherwise both sides are dealt out by pairs of blocks, evenly whatever the labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.store import share_code, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least this share, in percent, of the positive's score.
LEAST_PERCENT = 80
#: Rows and bytes of one block, at most (a block has a row at least).
BLOCK_ROWS = 2_048
BLOCK_BYTES = 4 << 20
#: Bytes of anchor blocks that may go to all tasks; more are dealt out with the rows.
BROADCAST_BYTES = 64 << 20
#: Row blocks that meet one anchor block in one place of the shuffle.
ROW_SLOT = 64
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1

_BLOCK = "ids array<bigint>, labels array<bigint>, dim int, vectors binary"
_POSITIVE = "block bigint, place int, anchor_id bigint, item_id bigint, score bigint"
_NEGATIVE = "block bigint, place int, choice int, anchor_id bigint, positive_id bigint, positive_score bigint, item_id bigint, score bigint"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks: ids, labels, and vectors padded with zeros to the longest one."""
    for batch in batches:
        start, sizes = 0, batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
        while start < batch.num_rows:
            longest = np.maximum.accumulate(sizes[start : start + BLOCK_ROWS])
            fits = 8 * longest.astype(np.int64) * np.arange(1, len(longest) + 1) <= BLOCK_BYTES
            n = max(1, int(fits.sum()))
            part, own, dim = batch.slice(start, n), sizes[start : start + n], int(longest[n - 1])
            vectors = np.zeros((n, dim))
            vectors[np.arange(dim) < own[:, None]] = part.column("vec").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column("label").to_pylist()], pa.list_(pa.int64())),
                    pa.array([dim], pa.int32()),
                    pa.array([vectors.tobytes()], pa.binary()),
                ],
                ["ids", "labels", "dim", "vectors"],
            )
            start += n


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as whole numbers of any size."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * SCALE)
    if (np.abs(scaled) < 2.0**31).all():
        return scaled.astype(np.int64)
    exact = [x if x == x // 1 and abs(x) > 2.0**52 else None for x in vectors.ravel().tolist()]
    out = [int(s) if x is None else int(x) * SCALE for x, s in zip(exact, scaled.ravel().tolist())]
    return np.array(out, object).reshape(vectors.shape)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all rows by packed multiplication.

    A score beyond 64 bits counts as the largest or smallest long.
    """
    dim = min(anchors.shape[1], rows.shape[1])
    anchors, rows = anchors[:, :dim], rows[:, :dim]
    if not dim or not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    up_a, up_r = (max(0, -int(m.min())) for m in (anchors, rows))
    a, r = anchors + up_a, rows + up_r
    most = dim * max(1, int(a.max())) * max(1, int(r.max()))
    size = next((s for s in (1, 2, 4, 8) if most < 1 << (8 * s)), -(-most.bit_length() // 8))
    small = size <= 8 and 4 * dim * int(abs(anchors).max() + 1) * int(abs(rows).max() + 1) < 1 << 62
    if size <= 8:
        fields = np.ascontiguousarray(r.T.astype(f"<u{size}"))
        wide = [int.from_bytes(f.tobytes(), "little") for f in fields]
    else:
        wide = [int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in f), "little") for f in r.T]
    length = size * len(rows)
    bias = (up_a * r.sum(axis=1)) - dim * up_a * up_r  # of each row; the anchor's part comes below
    out = np.empty((len(anchors), len(rows)), np.int64)
    for k, anchor in enumerate(a.tolist()):
        total = sum(map(mul, anchor, wide)).to_bytes(length, "little")
        own = up_r * sum(anchor)
        if small:
            out[k] = np.frombuffer(total, f"<u{size}").astype(np.int64) - bias - own
        else:
            exact = (int.from_bytes(total[j : j + size], "little") for j in range(0, length, size))
            out[k] = [min(max(x - int(b) - own, LONG_MIN), LONG_MAX) for x, b in zip(exact, bias)]
    return out


class Block:
    def __init__(self, row: dict):
        known = np.array([i is not None for i in row["ids"]])
        self.ids = np.array([i or 0 for i in row["ids"]], np.int64)
        self.known = known
        self.labels = np.array(row["labels"], np.int64)
        self.rows = whole(np.frombuffer(row["vectors"], np.float64).reshape(len(known), row["dim"]))

    def best(self, which: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """The k of these rows with the highest scores; ties by id, rows without one last."""
        if len(which) > k:
            least = np.partition(score[which], len(which) - k)[len(which) - k]
            which = which[score[which] >= least]
        return which[np.lexsort((self.ids[which], ~self.known[which], ~score[which]))][:k]


def _pairs(batches: Iterator[pa.RecordBatch]):
    """Each joined row as its anchor block, the row block, and their scores."""
    for batch in batches:
        for row in batch.to_pylist():
            anchors = Block({k: row[f"a_{k}"] for k in ("ids", "labels", "dim", "vectors")})
            rows = Block(row)
            yield row, anchors, rows, scores(anchors.rows, rows.rows)


def _table(kind: str, columns: list[list]) -> pa.RecordBatch:
    fields = [f.split() for f in kind.split(", ")]
    types = {"bigint": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _positives(k: int):
    def run(batches):
        for row, anchors, rows, score in _pairs(batches):
            out: list[list] = [[] for _ in range(5)]
            for p, own in enumerate(score):
                other = (rows.labels == anchors.labels[p]) & ~(rows.known & (rows.ids == anchors.ids[p]))
                for at in rows.best(np.flatnonzero(other), own, k).tolist():
                    item = int(rows.ids[at]) if rows.known[at] else None
                    for column, value in zip(out, (row["block"], p, int(anchors.ids[p]), item, int(own[at]))):
                        column.append(value)
            yield _table(_POSITIVE, out)

    return run


def _negatives(k: int, percent: int):
    def run(batches):
        for row, anchors, rows, score in _pairs(batches):
            out: list[list] = [[] for _ in range(8)]
            for one in row["positives"]:
                p, most = one["place"], one["score"]
                own = score[p]
                least = -(-percent * most // 100)  # rounded up
                if least > most:
                    continue
                fits = (own <= most) & (own >= max(least, LONG_MIN)) & (rows.labels != anchors.labels[p])
                for at in rows.best(np.flatnonzero(fits), own, k).tolist():
                    item = int(rows.ids[at]) if rows.known[at] else None
                    found = (row["block"], p, one["choice"], int(anchors.ids[p]), one["item_id"], most, item, int(own[at]))
                    for column, value in zip(out, found):
                        column.append(value)
            yield _table(_NEGATIVE, out)

    return run


def usable(vector: str, label: str) -> Column:
    """Rows with a label and a vector of finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, odd)


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()), name)


class Pairing:
    """Which row blocks and anchor blocks meet where: every pair once.

    Small anchors go to all tasks.  Larger ones are dealt with the rows by (anchor slot,
    row slot); a slot has about one anchor block or ``ROW_SLOT`` row blocks, so each key
    holds equally much.
    """

    def __init__(self, rows: DataFrame, anchors: DataFrame):
        size, count = anchors.agg(F.coalesce(F.sum(F.length("a_vectors")), F.lit(0)), F.count("*")).first()
        self.rows, self.small = rows, size <= BROADCAST_BYTES
        self.anchor_slots = 1 if self.small else count
        self.row_slots = 1 if self.small else max(1, rows.count() // ROW_SLOT)

    def pairs(self, anchors: DataFrame) -> DataFrame:
        def slotted(df: DataFrame, number: str, own: str, own_slots: int, other: str, other_slots: int) -> DataFrame:
            every = F.explode(F.sequence(F.lit(0), F.lit(other_slots - 1)).cast("array<bigint>"))
            return df.withColumn(own, F.pmod(F.xxhash64(number), F.lit(own_slots))).withColumn(other, every)

        left = self.rows.withColumnRenamed("block", "row_block")
        left = slotted(left, "row_block", "row_slot", self.row_slots, "anchor_slot", self.anchor_slots)
        right = slotted(anchors, "block", "anchor_slot", self.anchor_slots, "row_slot", self.row_slots)
        if self.small:
            right = F.broadcast(right)
        return left.join(right, ["anchor_slot", "row_slot"]).drop("anchor_slot", "row_slot", "row_block")


def _first(found: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("item_id"))
    return found.withColumn(name, F.row_number().over(order).cast("int")).where(F.col(name) <= k)


def hard_negatives(
    embeddings: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows without a label, without a vector or with a null or non-finite component take
    no part.  A component x becomes floor(256 x); a score is the inner product of whole
    numbers, higher first, ties by smaller id, rows without an id last.  An anchor's
    positives are the first ``positives`` rows of its label with another id.  For each
    positive the first ``negatives`` rows of other labels follow whose score is at most
    the positive's and at least ``least_percent`` percent of it; ranks count from 1.

    Vectors of different lengths are compared as if the shorter ended in zeros, an empty
    one scores 0, and a score beyond 64 bits counts as the nearest long.  Equal anchor
    rows are one anchor; other repeated rows each take a place.  Anchors without an id
    are none.  An empty table gives no rows.  Other columns are ignored.
    """
    spark = embeddings.sparkSession
    share_code(spark)
    col = lambda name: F.col(f"`{name}`")
    rows = embeddings.where(usable(f"`{vector}`", f"`{label}`")).select(
        col(id).cast("bigint").alias("id"),
        col(label).cast("bigint").alias("label"),
        col(vector).cast("array<double>").alias("vec"),
        (anchor & col(id).isNotNull()).alias("anchor"),
    )
    chosen = rows.where("anchor").drop("anchor").dropDuplicates()
    blocks = _numbered(rows.select("id", "label", "vec").mapInArrow(_pack, _BLOCK), "negatives-rows")
    parts = max(1, -(-chosen.count() // BLOCK_ROWS))
    packed = _numbered(chosen.repartition(parts).mapInArrow(_pack, _BLOCK), "negatives-anchors")
    anchors = packed.select("block", *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "dim", "vectors")])
    pairing = Pairing(blocks, anchors)

    found = pairing.pairs(anchors).mapInArrow(_positives(positives), _POSITIVE)
    chosen = _first(found, ["block", "place"], positives, "choice")
    limits = chosen.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "choice", "item_id", "score"))).alias("positives")
    )  # a block of anchors has a bounded number
    limited = stored(anchors.join(limits, "block"), "negatives-limits")
    found = pairing.pairs(limited).mapInArrow(_negatives(negatives, least_percent), _NEGATIVE)
    out = _first(found, ["block", "place", "choice"], negatives, "rank")
    return out.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("item_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
