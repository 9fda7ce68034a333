"""Language identification by cross-parsing against labelled text.

Each language has a suffix automaton of a sample of its labelled text.  A text
is parsed greedily into phrases: the longest stretch that occurs somewhere in
the sample, then the next.  With c phrases in n characters and a sample of m
characters, c * log2(m) / n estimates the cross entropy (Ziv and Merhav); the
language with the smallest estimate wins.

Texts are normalised before (lower case, every run of other characters is one
space).  The automata become one table of transitions, so a phrase is a walk
from the root and a step is one lookup; missing transitions lead to where the
character leads from the root and count a phrase.  A character that the sample
lacks is a phrase by itself.  Whole texts are parsed, cut
into blocks of ``BLOCK`` characters that advance together; a phrase ends at the
end of its block.

The sample is bounded: ``per_language`` documents and ``max_chars`` characters
of each language, chosen by a hash of the document's id.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.store import share_code

BLOCK = 256
PER_LANGUAGE = 200
MAX_CHARS = 24_000
UNKNOWN = "und"


def normalised(text: str) -> str:
    """Letters in lower case; each run of anything else is one space."""
    out = [c if len(c) == 1 and c.isalpha() else " " for c in (x.lower() for x in text)]
    return " ".join("".join(out).split())


class SuffixAutomaton:
    """All substrings of a text as paths from the root (Blumer et al. 1985)."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            now = self._state(self.length[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = now
                p = self.link[p]
            if p < 0:
                self.link[now] = 0
            else:
                q = self.next[p][c]
                if self.length[q] == self.length[p] + 1:
                    self.link[now] = q
                else:
                    copy = self._state(self.length[p] + 1)
                    self.next[copy] = dict(self.next[q])
                    self.link[copy] = self.link[q]
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = self.link[p]
                    self.link[q] = self.link[now] = copy
            last = now

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1


class Languages:
    """The automata of all languages as one table.

    Symbols: 0 pads (no step, no phrase), 1 is any letter no sample has, then
    the characters of the samples.  An entry is twice the next row plus one when
    the step begins a phrase.
    """

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        self.alphabet = [" ", *sorted({c for s in samples.values() for c in s} - {" "})]
        width = len(self.alphabet) + 2
        symbol = {c: k + 2 for k, c in enumerate(self.alphabet)}
        tables, self.roots, self.bits, base = [], [], [], 0
        for name in self.names:
            automaton = SuffixAutomaton(samples[name])
            dead = len(automaton.next)  # after a character that the sample lacks
            table = np.full((dead + 1, width), -1, np.int64)
            for state, moves in enumerate(automaton.next):
                for c, to in moves.items():
                    table[state, symbol[c]] = to
            first = np.where(table[0] >= 0, table[0], dead)
            table = np.where(table >= 0, 2 * (base + table), 2 * (base + first) + 1)
            table[:, 0] = 2 * (base + np.arange(len(table)))
            tables.append(table)
            self.roots.append(base)
            self.bits.append(float(np.log2(max(2, len(samples[name])))))
            base += len(table)
        whole = np.concatenate(tables) if tables else np.zeros((0, width), np.int64)
        # rows are premultiplied by the width: position = row * width + symbol
        kind = np.int32 if 2 * whole.size < 2**31 else np.int64
        self.table = ((whole >> 1) * width * 2 + (whole & 1)).astype(kind).ravel()
        self.roots = np.array(self.roots, kind) * width
        self.symbols = self._symbols(symbol)

    @staticmethod
    def _symbols(own: dict[str, int]) -> np.ndarray:
        """Symbol of each code point; letters by their lower case, 0 is no letter."""
        out = np.zeros(0x110000, np.uint16)
        for point in range(0x110000):
            if (c := chr(point)).isalpha():
                out[point] = own.get(c.lower(), 1)
        out[out == 0] = own[" "]
        return out


def phrases(codes: np.ndarray, starts: np.ndarray, model: Languages) -> np.ndarray:
    """Phrases of each text (row) in each language (column); codes are symbols."""
    rows = len(starts) - 1
    counts = np.zeros((rows, len(model.names)), np.int64)
    sizes = np.diff(starts)
    per_row = -(-sizes // BLOCK)
    total = int(per_row.sum())
    if not total or not len(model.names):
        return counts
    owner = np.repeat(np.arange(rows), per_row)
    number = np.arange(total) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = starts[owner] + number * BLOCK
    size = np.minimum(BLOCK, starts[owner + 1] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    state = np.repeat(model.roots[:, None], total, axis=1)
    found = np.ones((len(model.names), total), np.int32)  # a block begins with a phrase
    for step in range(BLOCK):
        active = int(np.searchsorted(-size, -step, side="left"))  # blocks longer than step
        if not active:
            break
        symbol = codes[begin[:active] + step].astype(np.int32)
        entry = model.table.take(state[:, :active] + symbol)
        if step:
            found[:, :active] += entry & 1
        state[:, :active] = entry >> 1
    for k in range(len(model.names)):
        counts[:, k] = np.bincount(owner, found[k], minlength=rows).astype(np.int64)
    return counts


def encode(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, starts of the texts, and whether a text has a letter."""
    data, offsets = W.raw_bytes(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    codes = table[points]
    space = codes == 2
    drop = np.zeros(len(codes), bool)
    drop[1:] = space[1:] & space[:-1]
    inner = before[(before > 0) & (before < len(codes))]
    drop[inner] = False
    drop[before[:-1][(before[:-1] < len(codes))]] |= space[before[:-1][(before[:-1] < len(codes))]]
    kept = np.concatenate([[0], np.cumsum(~drop)])
    letters = W.sums_by_row(~space, before) > 0
    return codes[~drop], kept[before], letters


def _predictor(blob):
    def run(batches):
        model = pickle.loads(blob.value)
        table = model.symbols
        names, bits = np.array([*model.names, UNKNOWN], object), np.array(model.bits)
        for batch in batches:
            for part in W.slices(batch, "text"):
                codes, starts, letters = encode(W.text_column(part.column("text")), table)
                size = np.maximum(1, np.diff(starts))
                if len(bits):
                    rate = phrases(codes, starts, model) * bits / size[:, None]
                    best = np.argmin(rate, axis=1)
                    weight = 1 / np.maximum(rate, 1e-9)
                    score = weight.max(axis=1) / weight.sum(axis=1)
                else:
                    best, score = np.zeros(len(size), int), np.zeros(len(size))
                    letters = np.zeros(len(size), bool)
                best = np.where(letters, best, len(names) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in part.schema.names if c != "text"),
                        pa.array(names[best], pa.string()),
                        pa.array(np.where(letters, score, 0.0)),
                    ],
                    [*(c for c in part.schema.names if c != "text"), "lang_pred", "score"],
                )

    return run


def samples(
    labelled: DataFrame, doc: str, text: str, lang: str,
    per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS,
) -> dict[str, str]:
    """Normalised sample text of each language, at most ``max_chars`` characters.

    Only documents whose hash falls under a language's share are read on, so the
    window that takes the first ``per_language`` of them sees a bounded number
    of rows however many a language has.  A document gives the stretch of
    ``2 * max_chars / per_language`` characters that begins at a place set by its hash.
    """
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col(doc).cast("string").alias("doc"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where("text is not null and lang is not null")
    counts = rows.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(8.0 * per_language) / F.col("count"))
    shares = {r["lang"]: r["share"] for r in counts.select("lang", share.alias("share")).collect()}
    if not shares:
        return {}
    limit = spark.createDataFrame(list(shares.items()), "lang string, share double")
    draw = F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) / float(1 << 30)
    size = 2 * max_chars // per_language
    place = F.pmod(F.xxhash64("doc", F.lit(1)), F.greatest(F.lit(1), F.length("text") - size + 1))
    picked = (
        rows.join(F.broadcast(limit), "lang")
        .where(draw < F.col("share"))
        .select("lang", draw.alias("draw"), F.substring("text", place.cast("int") + 1, F.lit(size)).alias("text"))
    )
    order = Window.partitionBy("lang").orderBy("draw", "text")
    few = picked.distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
    parts: dict[str, list[str]] = {}
    for r in sorted(few.collect(), key=lambda r: (r["lang"], r["k"])):
        own = normalised(r["text"])
        if own and own not in parts.setdefault(r["lang"], []):
            parts[r["lang"]].append(own)
    joined = {name: " ".join(own)[:max_chars] for name, own in parts.items()}
    return {name: own for name, own in joined.items() if own}


def held_out(doc: str, parts: int = 5, part: int = 0) -> Column:
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % parts == part


def identify(
    documents: DataFrame, model: Languages, doc: str = "doc_id", text: str = "text",
    keep: list[Column] | None = None,
) -> DataFrame:
    """``doc_id, lang_pred, score`` of each document, and the columns in ``keep`` before.

    A text that is null or has no letter gets ``und`` and score 0; so does every
    text when there was no labelled sample.  Equal scores go to the language
    first by name.  Repeated rows get equal answers.  The score is the share of
    the winner among the inverse rates of all languages.
    """
    spark = documents.sparkSession
    share_code(spark)
    rows = documents.select(F.col(doc).alias("doc_id"), *(keep or []), F.col(text).alias("text"))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    blob = spark.sparkContext.broadcast(pickle.dumps(model))
    return rows.mapInArrow(_predictor(blob), f"{shape}, lang_pred string, score double")


def train(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS,
) -> Languages:
    """Languages of the rows that have both a text and a label."""
    return Languages(samples(documents, doc, text, lang, per_language, max_chars))
