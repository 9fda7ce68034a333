"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Test items and documents are normalised alike: A-Z in lower case, words are runs
of digits, letters a-z and any character outside ASCII.  Each window of ten
consecutive item words (a shorter item is one window) becomes a key of the
automaton, whose symbols are word numbers.  A document is scanned once; the
automaton only walks stretches of words that occur in some item, because any
other word returns it to its root.  Hits are word numbers of the document and
lead back to positions in the original text.

Every worker gets the automaton.  Its size is bounded by ``max_words`` item
words; a larger set of items is cut into several automata that follow one
another, each in a worker process of its own, and add to the same rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.store import share_code

WINDOW = 10
MAX_WORDS = 2_000_000
#: Bytes after normalisation: a-z and digits stay, other ASCII is a separator.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


class Items:
    """Automaton over the windows of some test items."""

    def __init__(self, rows: list[tuple[str | None, list[str]]], window: int = WINDOW):
        self.names = sorted({name for name, _ in rows if name is not None})
        place = {name: k for k, name in enumerate(self.names)}
        vocabulary: dict[str, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        for name, item in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in item]
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                of = windows.setdefault(tuple(ids[start : start + window]), set())
                if name is not None:
                    of.add(place[name])
        self.vocabulary = list(vocabulary)
        self.shortest = min(map(len, windows), default=0)
        self.windows = [(key, tuple(sorted(of))) for key, of in windows.items()]

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, of in self.windows:
            out.add_word(key, (len(key), of))
        out.make_automaton()
        return out


def normal_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return W.split_words(W.translated(texts, NORMAL))


def known_runs(ids: np.ndarray, starts: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of known words within a text that can hold a window."""
    known = ids >= 0
    edge = np.zeros(len(ids) + 1, bool)
    edge[starts] = True
    begins = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
    ends = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    long = ends - begins >= shortest
    return begins[long], ends[long]


def scan(texts: pa.Array, items: Items, automaton, vocabulary: pa.Array):
    """Number of words, hit flag of each word, starts of the texts, items found by row."""
    values, starts = normal_words(texts)
    ids = pc.fill_null(pc.index_in(values, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    hit = np.zeros(len(ids) + 1, np.int32)
    found: dict[int, set[int]] = {}
    if items.windows:
        begins, ends = known_runs(ids, starts, items.shortest)
        rows = np.searchsorted(starts, begins, side="right") - 1
        for begin, end, row in zip(begins.tolist(), ends.tolist(), rows.tolist()):
            for last, (length, of) in automaton.iter(tuple(ids[begin:end].tolist())):
                hit[begin + last + 1 - length] += 1
                hit[begin + last + 1] -= 1
                found.setdefault(row, set()).update(of)
    return values, np.cumsum(hit[:-1]) > 0, starts, found


def spans(text: str | None, items: Items, automaton=None) -> list[tuple[int, int]]:
    """Hit stretches of one text as code point ranges of the original text."""
    text = text or ""
    automaton = automaton or items.automaton()
    data = text.encode().translate(NORMAL)
    _, hit, _, _ = scan(pa.array([text]), items, automaton, pa.array(items.vocabulary, pa.string()))
    raw = np.frombuffer(data, np.uint8) != 32
    edge = np.diff(np.concatenate([[0], raw.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)])
    out: list[tuple[int, int]] = []
    for k in np.flatnonzero(hit):
        start, end = int(points[begins[k]]), int(points[ends[k]])
        if out and k and hit[k - 1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


_LOADED: dict[bytes, tuple] = {}


def _loaded(blob: bytes) -> tuple:
    """The automaton is built once in each worker process."""
    key = hashlib.sha256(blob).digest()
    if key not in _LOADED:
        _LOADED.clear()
        items = pickle.loads(blob)
        _LOADED[key] = (items, items.automaton(), pa.array(items.vocabulary, pa.string()))
    return _LOADED[key]


def item_blocks(benchmark: DataFrame, item: str, text: str, max_words: int, window: int) -> Iterator[Items]:
    """Test items in blocks of at most ``max_words`` words (or one item) each.

    The items come to the driver one block at a time.
    """
    rows, held = [], 0
    for name, value in benchmark.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        own = normal_words(pa.array([value or ""]))[0].to_pylist()
        if held and held + len(own) > max_words:
            yield Items(rows, window)
            rows, held = [], 0
        rows.append((name, own))
        held += len(own)
    yield Items(rows, window)


def _scanner(blob, more: bool):
    """Adds what one automaton finds to what earlier ones found."""

    def run(batches):
        items, automaton, vocabulary = _loaded(blob.value)
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = W.text_column(part.column("text"))
                _, hit, starts, found = scan(texts, items, automaton, vocabulary)
                earlier = part.column("hit_words")
                if len(earlier.flatten()):
                    rows = np.repeat(np.arange(part.num_rows), pc.list_value_length(earlier).to_numpy())
                    hit[starts[rows] + earlier.flatten().to_numpy()] = True
                at = np.flatnonzero(hit)
                of = np.searchsorted(starts, at, side="right") - 1
                ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=part.num_rows))])
                names = part.column("found").to_pylist()
                for row, places in found.items():
                    names[row] = sorted({*names[row], *(items.names[k] for k in places)})
                columns = [part.column("doc_id"), *([part.column("text")] if more else [])] + [
                    pa.array(np.diff(starts), pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array((at - starts[of]).astype(np.int32))
                    ),
                    pa.array(names, pa.list_(pa.string())),
                ]
                head = ["doc_id", "text"] if more else ["doc_id"]
                yield pa.RecordBatch.from_arrays(columns, [*head, "n_words", "hit_words", "found"])

    return run


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, hit_words, items``.

    ``hit_words`` are the numbers of the words inside occurrences, ``items`` the
    ids of the test items as sorted strings.  A null text has no words, and a
    text without words is clean.  A null item text has no window; windows of an
    item with null id hit but name no item.  Repeated item ids count once,
    repeated documents give repeated rows.  No items: every document is clean.
    Other columns of either table are ignored.
    """
    spark = documents.sparkSession
    share_code(spark)
    kind = documents.schema[doc].dataType.simpleString()
    rows = documents.select(
        F.col(doc).alias("doc_id"),
        F.col(text).alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<int>)").alias("hit_words"),
        F.expr("cast(array() as array<string>)").alias("found"),
    )
    blocks = item_blocks(benchmark, item, item_text, max_words, window)
    block = next(blocks)
    while block is not None:
        later = next(blocks, None)
        blob = spark.sparkContext.broadcast(pickle.dumps(block))
        texts = "text string, " if later is not None else ""
        rows = rows.mapInArrow(
            _scanner(blob, later is not None),
            f"doc_id {kind}, {texts}n_words bigint, hit_words array<int>, found array<string>",
        )
        block = later
    return rows.withColumnRenamed("found", "items")


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", window: int = WINDOW,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """The documents, all columns, in which no test item occurs."""
    spark = documents.sparkSession
    share_code(spark)
    out = documents
    for block in item_blocks(benchmark, item, item_text, max_words, window):
        out = out.mapInArrow(
            _cleaner(text, spark.sparkContext.broadcast(pickle.dumps(block))), documents.schema
        )
    return out


def _cleaner(text: str, blob):
    def run(batches):
        items, automaton, vocabulary = _loaded(blob.value)
        for batch in batches:
            for part in W.slices(batch, text):
                texts = W.text_column(part.column(part.schema.get_field_index(text)))
                _, hit, starts, _ = scan(texts, items, automaton, vocabulary)
                yield part.filter(pa.array(W.sums_by_row(hit, starts) == 0))

    return run
