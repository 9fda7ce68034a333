"""SimHash near duplicates by meeting in the middle of Hamming balls.

*Fingerprints.*  A text's 64 bits are the majority vote of the hashes of its word
3-grams, repeats included.  Equal fingerprints are one node.

*Balls.*  Two fingerprints at distance 3 meet at a point one flip from one of
them and two flips from the other.  The distance is odd, so exactly one of the
two has an odd number of set bits, and it is enough that one parity, the rarer,
emits the two-flip variants.  Of any three differing bits two lie in the same half
of the fingerprint, so only two flips within one half are emitted.  Everything up
to distance 2 meets at variants of one flip.  A fingerprint thus emits 65 variants,
and 992 more if it is of the rarer parity.

*Meeting.*  Variants are shuffled by their own bits.  Fingerprints of one variant
differ by the exclusive or of their flips, which is an exact check without the
texts.  Where one of them is at most one flip away, it links with all others there
(1 + 2 flips at most); fingerprints that are all two flips away differ by 4 bits, or
by 2 and then meet elsewhere.  So a variant gives a star of true links, never all
pairs of its group, and no link is lost to reachability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.overlap import components
from reviewlens.llm.store import share_code, stored

SHINGLE = 3
#: Bytes of text that are worked on at once.
SLICE = 1 << 20
SEED = 42
BITS = 64
#: Fingerprints whose variants are made at once.
BATCH = 1_024
#: Variants that one task sorts at once, about.
PART_VARIANTS = 500_000
#: Texts whose votes are counted at once.
VOTE_ROWS = 2_048

_ONE = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
_HALF = [(i, j) for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)]
_TWO = np.array([(1 << i) | (1 << j) for i, j in _HALF], np.uint64)
#: All flips, by number: none, one bit, two bits of one half.
FLIPS = np.concatenate([np.zeros(1, np.uint64), _ONE, _TWO])
NEAR = 1 + BITS
#: The bits of each byte value.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)

_PARTS = "part int, variants binary"
_LINKS = "node bigint, other bigint"


def shingle_hashes(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each word n-gram of each text, and the row it belongs to, in order."""
    values, starts = W.split_words(W.translated(texts, W.LOWER))
    n = np.diff(starts)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), " ")
    data = joined[0].as_buffer().to_pybytes() if len(values) else b""
    ends = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    rows = W.owners(starts)
    at = np.flatnonzero(rows[: max(0, len(rows) - size + 1)] == rows[size - 1 :])
    first, last, row = begins[at], ends[at + size - 1], rows[at]
    short = np.flatnonzero((n > 0) & (n < size))  # the whole sequence is one shingle
    if len(short):
        first = np.concatenate([first, begins[starts[short]]])
        last = np.concatenate([last, ends[starts[short + 1] - 1]])
        row = np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        first, last, row = first[order], last[order], row[order]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(row)
    )
    return hashes, row


def majority(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Fingerprint of each row: the bits set in over half of its hashes."""
    out = np.zeros(rows, np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    edges = np.searchsorted(row, np.arange(0, rows + VOTE_ROWS, VOTE_ROWS))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        first = k * VOTE_ROWS
        some = min(VOTE_ROWS, rows - first)
        own = row[a:b] - first
        total = np.bincount(own, minlength=some)
        for octet in range(8):
            votes = np.bincount(own * 256 + octets[a:b, octet], minlength=some * 256).reshape(some, 256) @ _BYTE_BITS
            bits = np.packbits(2 * votes > total[:, None], axis=1, bitorder="little")[:, 0]
            out[first : first + some] |= bits.astype(np.uint64) << np.uint64(8 * octet)
    return out


def fingerprints(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    return majority(*shingle_hashes(texts, size), len(texts))


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                bits = fingerprints(W.text_column(part.column("text")), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "bits"]
                )

    return run


def odd(bits: np.ndarray) -> np.ndarray:
    """Whether the number of set bits is odd."""
    return (np.bitwise_count(bits) & 1).astype(bool)


def _variants(parts: int, wide_odd: bool):
    """Variants of each batch, packed by the part of the shuffle they go to.

    A packed row holds variants (8 bytes each) and then the numbers of their flips
    (2 bytes each); the fingerprint is the variant with those bits flipped back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(every), BATCH):
                bits = every[k : k + BATCH]
                wide = bits[odd(bits) == wide_odd]
                points = np.concatenate([(bits[:, None] ^ FLIPS[:NEAR]).ravel(), (wide[:, None] ^ FLIPS[NEAR:]).ravel()])
                flips = np.concatenate(
                    [np.tile(np.arange(NEAR), len(bits)), np.tile(np.arange(NEAR, len(FLIPS)), len(wide))]
                ).astype(np.uint16)
                part = (W.mixed(points) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                points, flips = points[order], flips[order]
                at = np.searchsorted(part[order], np.arange(parts + 1))
                full = np.flatnonzero(np.diff(at))
                packed = [points[at[p] : at[p + 1]].tobytes() + flips[at[p] : at[p + 1]].tobytes() for p in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array(packed, pa.binary())], ["part", "variants"]
                )

    return run


def stars(points: np.ndarray, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints that share a variant: one centre with each other one."""
    order = np.argsort(points)
    points = points[order]
    same = points[1:] == points[:-1]
    met = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    points, flips = points[met], flips[order][met].astype(np.int64)
    bits = points ^ FLIPS[flips]
    # the nearest of a variant comes first, then the smallest
    order = np.lexsort((bits, (flips > 0).astype(np.int8) + (flips >= NEAR), points))
    points, flips, bits = points[order], flips[order], bits[order]
    first = np.ones(len(points), bool)
    first[1:] = points[1:] != points[:-1]
    centre = np.flatnonzero(first)[np.cumsum(first) - 1]
    keep = ~first & (flips[centre] < NEAR)
    a, b = bits[centre[keep]], bits[keep]
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _meet(table: pa.Table) -> pa.Table:
    """All variants of one part of the shuffle."""
    points, flips = [], []
    for packed in table.column("variants").to_pylist():
        n = len(packed) // 10
        points.append(np.frombuffer(packed, np.uint64, n))
        flips.append(np.frombuffer(packed, np.uint16, n, 8 * n))
    node, other = stars(np.concatenate(points), np.concatenate(flips))
    return pa.table({"node": node.view(np.int64), "other": other.view(np.int64)})


def links(nodes: DataFrame) -> DataFrame:
    """Links between different fingerprints (column ``bits``): enough to reach all within 3 bits."""
    even, all_ = nodes.agg(
        F.count_if(F.bit_count("bits") % 2 == 0), F.count("*")
    ).first()
    wide_odd = 2 * even > all_
    wide = all_ - even if wide_odd else even
    parts = max(1, -(-(all_ * NEAR + wide * len(_TWO)) // PART_VARIANTS))
    packed = nodes.select("bits").mapInArrow(_variants(parts, wide_odd), _PARTS)
    return packed.groupBy("part").applyInArrow(_meet, _LINKS).distinct()


def simhash_groups(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    A-Z are lower-cased; words are runs of bytes other than 0x20 and 0x09-0x0D;
    shingles are ``size`` words joined by a space, as often as they occur; a text of
    fewer words is one shingle.  A fingerprint bit is 1 if it is set in over half the
    hashes.  Fingerprints link at 3 or fewer differing bits; ``component_id`` is the
    smallest id reachable by links.  A null text or one without words has
    fingerprint zero and is linked like any other.  Null ids are never the smallest;
    a component without any id has a null one.  Repeated rows give equal rows.  An
    empty table gives no rows.  Other columns are ignored.
    """
    spark = documents.sparkSession
    share_code(spark)
    texts = documents.select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    docs = stored(texts.mapInArrow(_describe(size), f"doc_id {kind}, bits bigint"), "simhash-documents")
    nodes = stored(docs.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = stored(links(nodes), "simhash-links")
    groups = stored(
        nodes.join(components(found).withColumnRenamed("node", "bits"), "bits", "left").select(
            "bits", "least", F.coalesce("group", "bits").alias("group")
        ),
        "simhash-groups",
    )
    least = groups.groupBy("group").agg(F.min("least").alias("component_id"))
    label = groups.join(least, "group").select("bits", "component_id")
    shown = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return docs.join(label, "bits").select("doc_id", shown.alias("fingerprint"), "component_id")
