"""Line-first cleaning: judge lines, drop failures, then judge what is left.

A line with words fails

* the navigation rule when it is a list of links or cells: at least ``MIN_CELLS``
  separators (``|``, ``>``, a bullet or a tab) and at most ``CELL_WORDS`` words per cell;
* the boilerplate rule when it is short, of at most ``PHRASE_LINE`` words, and has one
  of ``BOILERPLATE`` in it, or when it equals an earlier line of the document;
* the punctuation rule when more than ``SYMBOL_SHARE`` of its words hold
  symbols, when it has at least ``SHOUT_WORDS`` words and most end in ``!`` or
  ``?``, or when it has as many and neither a letter nor a digit.

Failing lines are removed.  A document is kept when it passes the base rules
(enough words, few repeated three-word windows) and at least ``MIN_LEFT`` of its
words are left.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.store import share_code

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_LEFT = 0.5
MIN_CELLS = 4
CELL_WORDS = 2.0
SYMBOL_SHARE = 0.3
SHOUT_WORDS = 5
#: Words of the longest line that a phrase fails: furniture is short, an article may name it.
PHRASE_LINE = 20
#: Fixed phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "accept cookies",
    "javascript is disabled",
    "enable javascript",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "click here to",
    "lorem ipsum",
)
SYMBOLS = b"#*$%&|<>"
SEPARATORS = "|>•·\t"
FIGURES = pa.schema(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_lines_removed", pa.int64()),
        ("n_words_left", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
_POINT = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _by_word(dictionary: pa.Array, flag: np.ndarray) -> np.ndarray:
    """How many bytes with the flag each word of the dictionary has."""
    data, offsets = W.raw_bytes(dictionary)
    total = np.concatenate([[0], np.cumsum(flag[data], dtype=np.int64)])
    return np.diff(total[offsets])


def repeated_words(ids: np.ndarray, starts: np.ndarray, size: int = 3) -> np.ndarray:
    """Flag of each word that lies in a window of ``size`` words found twice in its text."""
    n = len(ids)
    inside = np.zeros(n + 1, np.int32)
    if n < size:
        return inside[:-1] > 0
    row = W.owners(starts)
    at = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
    if not len(at):
        return inside[:-1] > 0
    key = row[at].astype(np.uint64)
    for k in range(size):  # equal windows of a text get equal keys; unequal ones rarely do
        key = W.mixed(key * np.uint64(0x9E3779B97F4A7C15) + ids[at + k].astype(np.uint64) + np.uint64(1))
    ordered = np.sort(key)
    at = at[np.isin(key, np.unique(ordered[1:][ordered[1:] == ordered[:-1]]))]
    if len(at):  # exact: compare the windows themselves
        parts = np.stack([row[at], *(ids[at + k] for k in range(size))])
        order = np.lexsort(parts[::-1])
        same = (parts[:, order[1:]] == parts[:, order[:-1]]).all(axis=0)
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(inside, at[twice], 1)
        np.add.at(inside, at[twice] + size, -1)
    return np.cumsum(inside[:-1]) > 0


def figures(texts: pa.Array, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> pa.RecordBatch:
    """The columns of ``FIGURES`` for each text."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    line_at = lists.offsets.to_numpy().astype(np.int64)
    line_at -= line_at[0]
    values, starts = W.split_words(lines)
    doc_at = starts[line_at]
    ids, dictionary = W.word_ids(values)
    sums = lambda of_word, at: W.sums_by_row(of_word[ids], at)
    symbols, letters = _by_word(dictionary, _SYMBOL), _by_word(dictionary, _ALNUM)
    shouts = pc.match_substring_regex(dictionary, "[!?]$").to_numpy(zero_copy_only=False)

    per_line = np.diff(starts)
    line_ids = W.word_ids(lines)[0].astype(np.int64)
    key = W.owners(line_at) * (int(line_ids.max(initial=0)) + 1) + line_ids
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    again &= per_line > 0

    cells = pc.count_substring_regex(lines, f"[{SEPARATORS}]").to_numpy(zero_copy_only=False)
    bare = sums(letters > 0, starts)
    navigation = (cells >= MIN_CELLS) & (bare <= CELL_WORDS * (cells + 1))
    phrase = pc.match_substring_regex(lines, "|".join(map(re.escape, BOILERPLATE)), ignore_case=True)
    boilerplate = again | (phrase.to_numpy(zero_copy_only=False) & (per_line <= PHRASE_LINE))
    long = per_line >= SHOUT_WORDS
    punctuation = long & (
        (sums(symbols > 0, starts) > SYMBOL_SHARE * per_line)
        | (2 * sums(shouts, starts) > per_line)
        | (bare == 0)
    )
    failed = (per_line > 0) & (navigation | boilerplate | punctuation)

    n_words = np.diff(doc_at)
    left = n_words - W.sums_by_row(np.where(failed, per_line, 0), line_at)
    repeats = W.sums_by_row(repeated_words(ids, doc_at), doc_at)
    base_failed = (n_words < min_words) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    columns = [
        n_words,
        sums(_by_word(dictionary, _POINT), doc_at),
        sums(symbols, doc_at),
        W.sums_by_row(again, line_at),
        repeats,
        W.sums_by_row(failed, line_at),
        left,
        base_failed,
        ~base_failed & (left >= min_left * n_words),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FIGURES)], schema=FIGURES)


def _judge(min_words, min_left):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                own = figures(W.text_column(part.column("text")), min_words, min_left)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *own.columns], ["doc_id", *own.schema.names]
                )

    return run


def _keep(text, min_words, min_left):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, text):
                texts = W.text_column(part.column(part.schema.get_field_index(text)))
                yield part.filter(figures(texts, min_words, min_left).column("kept"))

    return run


def quality(
    documents: DataFrame, doc: str = "doc_id", text: str = "text",
    min_words: int = MIN_WORDS, min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per document with its figures and verdict.

    A null or empty text has no words, so it fails the base rules.  Every row
    is judged by its own text, so repeated rows get equal verdicts and an empty
    table an empty result.  Other columns of the table are ignored.
    """
    share_code(documents.sparkSession)
    kind = documents.schema[doc].dataType.simpleString()
    shape = ", ".join(f"{f.name} {'boolean' if f.type == pa.bool_() else 'bigint'}" for f in FIGURES)
    rows = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_judge(min_words, min_left), f"doc_id {kind}, {shape}")


def keep_good(
    documents: DataFrame, text: str = "text", min_words: int = MIN_WORDS, min_left: float = MIN_LEFT
) -> DataFrame:
    """The documents that pass, with all their columns."""
    share_code(documents.sparkSession)
    return documents.mapInArrow(_keep(text, min_words, min_left), documents.schema)
