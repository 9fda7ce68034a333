"""Token ids of documents as binary shards with Elias-Fano boundaries.

A shard file holds the ids of consecutive documents back to back (little-endian,
two bytes each when the vocabulary allows), then two Elias-Fano sequences: where
each document starts, and the document ids counted from the smallest.  The last
bytes say where these lie.  A reader finds any document with two ``select``
calls and one byte-range read; there is no table of 64-bit offsets.

Documents are dealt out by ranges of their id and sorted inside a task, which
writes shards of bounded size.  A task's files count only when its manifest
rows are committed, so a repeated task leaves no trace but an unused file.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import eliasfano
from reviewlens.llm import words as W
from reviewlens.llm.store import open_folder, share_code, shared_folder, stored
from reviewlens.llm.subwords import subwords

#: A shard is closed after so many ids or documents.
SHARD_IDS = 64 << 20
SHARD_DOCS = 1 << 20
#: Ids that are read at once.
READ_IDS = 4 << 20
ENCODE_BYTES = 8 << 20
MAGIC = b"EFTOKEN1"
#: bytes per id, documents without id, smallest id, ids, then sizes of the two sequences
_TAIL = struct.Struct("<BQqQQQ8s")
MANIFEST = "part int, number int, file string, n_docs bigint, n_ids bigint"


class ShardWriter:
    """Appends documents in ascending order of id (null ids first)."""

    def __init__(self, system, path: str, kind):
        self.out = system.open_output_stream(path)
        self.kind = np.dtype(kind).newbyteorder("<")
        self.starts, self.docs = [np.zeros(1, np.int64)], []
        self.n_ids = self.n_docs = self.nulls = 0

    def add(self, ids: np.ndarray, starts: np.ndarray, docs: pa.Array) -> None:
        self.out.write(ids.astype(self.kind).tobytes())
        self.starts.append(starts[1:] + self.n_ids)
        self.n_ids += len(ids)
        self.n_docs += len(docs)
        self.nulls += docs.null_count
        self.docs.append(docs.drop_null().cast(pa.int64()).to_numpy())

    def close(self) -> None:
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int64)
        smallest = int(docs[0]) if len(docs) else 0
        starts = eliasfano.encode(np.concatenate(self.starts))
        names = eliasfano.encode(docs.astype(np.uint64) - np.uint64(smallest & (2**64 - 1)))
        tail = (self.kind.itemsize, self.nulls, smallest, self.n_ids, len(starts), len(names), MAGIC)
        self.out.write(starts + names + _TAIL.pack(*tail))
        self.out.close()


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, system, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        width, self.nulls, self.smallest, self.n_ids, a, b, magic = tail
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard")
        self.kind = np.dtype(f"<u{width}")
        both = self.file.read_at(a + b, size - _TAIL.size - a - b)
        self.starts, self.names = eliasfano.Sequence(both[:a]), eliasfano.Sequence(both[a:])
        self.n_docs = self.starts.n - 1

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * width, start * width), self.kind)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document."""
        return self.ids(self.starts.select(k), self.starts.select(k + 1))

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        known = self.names.slice(max(0, start - self.nulls), max(0, stop - self.nulls))
        return [None] * (min(stop, self.nulls) - min(start, self.nulls)) + [
            int(x) + self.smallest for x in known
        ]


def _write(folder: str, vocabulary: str, end: int, shard_ids: int, shard_docs: int):
    def run(batches):
        system, path = open_folder(folder)
        encoder, part = subwords(vocabulary), TaskContext.get().partitionId()
        shard, number = None, 0

        def row():
            shard.close()
            return pa.RecordBatch.from_pylist(
                [{"part": part, "number": number, "file": name, "n_docs": shard.n_docs, "n_ids": shard.n_ids}],
                schema=schema,
            )

        schema = pa.schema(
            [("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()),
             ("n_docs", pa.int64()), ("n_ids", pa.int64())]
        )
        for batch in batches:
            for rows in W.slices(batch, "text", ENCODE_BYTES):
                ids, starts = encoder.encode(W.text_column(rows.column("text")))
                ids = np.insert(ids, starts[1:], end)
                starts = starts + np.arange(len(starts))
                if shard is None:
                    name = f"part-{part:05d}-{number:05d}-{uuid.uuid4().hex}.ids"
                    shard = ShardWriter(system, f"{path}/{name}", encoder.kind)
                shard.add(ids, starts, rows.column("doc_id"))
                if shard.n_ids >= shard_ids or shard.n_docs >= shard_docs:
                    yield row()
                    shard, number = None, number + 1
        if shard is not None:
            yield row()

    return run


def _read(folder: str):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches):
        system, path = open_folder(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                shard = Shard(system, f"{path}/{entry['file']}")
                at = 0
                while at < shard.n_docs:
                    starts = shard.starts.slice(at, at + 8193)
                    count = max(1, int(np.searchsorted(starts, starts[0] + READ_IDS, side="right")) - 1)
                    starts = starts[: count + 1]
                    ids = memoryview(shard.ids(int(starts[0]), int(starts[-1])).astype("<u4").tobytes())
                    cuts = ((starts - starts[0]) * 4).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids(at, at + count), pa.int64()),
                            pa.array(starts[:-1] + entry["base"]),
                            pa.array(np.diff(starts)),
                            pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                        ],
                        schema=schema,
                    )
                    at += count

    return run


def write_shards(
    documents: DataFrame, vocabulary: str, doc: str = "doc_id", text: str = "text", end: int = 0,
    shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS,
) -> tuple[str, DataFrame]:
    """Folder of the shards and their manifest with the ids before each (``base``).

    ``doc`` must be an integer column.  A null text is empty: its document is
    the end id alone.  Null ids come first; equal ids are ordered by a hash of
    the text, then the text, so repeated rows are packed as often as they occur.
    An empty table gives an empty manifest.  Other columns are ignored.
    """
    spark = documents.sparkSession
    share_code(spark)
    folder = shared_folder(spark, "token-shards")
    rows = documents.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
    written = dealt.mapInArrow(_write(folder, vocabulary, end, shard_ids, shard_docs), MANIFEST)
    manifest = stored(written, "token-manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return folder, manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_shards(folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    share_code(manifest.sparkSession)
    rows = manifest.select("file", "base").repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file"
    )
    return rows.mapInArrow(_read(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
