"""Subword ids of whole text columns with a published tokenizer."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewlens.llm import words as W

#: Bytes of pieces that the library encodes as one text.
JOINED_BYTES = 1 << 16
SPACES = np.isin(np.arange(256), [ord(c) for c in map(chr, range(128)) if c.isspace()])


class Subwords:
    """Ids as the tokenizers library gives them, with repeated pieces encoded once.

    A byte-level tokenizer never joins a character that is no white space to a
    space after it, so a text may be cut before such a space.  The different
    pieces of a column are encoded by the library once, many joined to one text, whose ids
    are dealt to the pieces by the bytes they stand for; texts with other white
    space around a cut, or with a mark such as ``<|endoftext|>``, are encoded whole.
    With ``plain`` a mark is text like any other.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: marks that the tokenizer takes out of a text before anything else
        self.marks = "|".join(map(re.escape, added))
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        #: bytes that an id stands for; a byte-level vocabulary has a character for each
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for entry, number in self.tokenizer.get_vocab().items():
            self.bytes_of[number] = len(entry)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        own = self.library(pieces)
        sizes = np.array([len(ids) for ids in own], np.int64)
        return np.fromiter(chain.from_iterable(own), self.kind, int(sizes.sum())), sizes

    def joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``one_by_one`` with a space before each piece; none may end in white space or hold a mark."""
        raw, offsets = W.raw_bytes(pieces)
        data = np.insert(raw, offsets[:-1], 32).tobytes()
        ends = offsets[1:] + np.arange(1, len(pieces) + 1)
        cuts = ends[np.flatnonzero(np.diff(ends // JOINED_BYTES, append=-1))].tolist()
        texts = [data[a:b].decode() for a, b in zip([0, *cuts], cuts)]
        ids = np.concatenate([np.array(self.library([t])[0], self.kind) for t in texts])
        reached = np.cumsum(self.bytes_of[ids])
        last = np.minimum(np.searchsorted(reached, ends), len(ids) - 1)
        if reached[-1] != len(data) or not (reached[last] == ends).all():  # no byte-level vocabulary
            return self.one_by_one([" " + p for p in pieces.to_pylist()])
        return ids, np.diff(last, prepend=-1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids start."""
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(1, np.int64)
        lists = pc.split_pattern(texts, " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        numbers, dictionary = W.word_ids(lists.flatten())
        raw, offsets = W.raw_bytes(dictionary)
        filled = np.diff(offsets) > 0
        last = np.where(filled, raw[offsets[1:] - 1] if len(raw) else 32, 32)
        safe = ~SPACES[last]
        beyond = np.flatnonzero(last > 127)
        safe[beyond] = [not p[-1].isspace() for p in dictionary.take(pa.array(beyond)).to_pylist()]
        # the last piece of a text may end in anything: no cut follows it
        open_end = ~safe[numbers]
        open_end[starts[1:] - 1] = False
        odd = W.sums_by_row(open_end, starts) > 0
        if self.marks:
            odd |= pc.match_substring_regex(texts, self.marks).to_numpy(zero_copy_only=False)
            safe &= ~pc.match_substring_regex(dictionary, self.marks).to_numpy(zero_copy_only=False)
        first = starts[:-1]
        heads, head = np.unique(numbers[first], return_inverse=True)
        known, sizes_known = np.zeros(0, self.kind), np.zeros(0, np.int64)
        if safe.any():
            known, sizes_known = self.joined(dictionary.filter(pa.array(safe)))
        others = dictionary.filter(pa.array(~safe)).to_pylist()
        alone, sizes_alone = self.one_by_one([" " + p for p in others] + dictionary.take(pa.array(heads)).to_pylist())
        learnt = np.concatenate([known, alone])
        ends = np.concatenate([[0], np.cumsum(np.concatenate([sizes_known, sizes_alone]))])
        # where a piece's ids lie: the joined pieces, then the others, then the heads, which have no space
        slot = np.empty(len(dictionary), np.int64)
        slot[safe], slot[~safe] = np.arange(len(sizes_known)), len(sizes_known) + np.arange(len(others))
        slots = slot[numbers]
        slots[first] = len(dictionary) + head
        sizes = np.diff(ends)[slots]
        total = np.concatenate([[0], np.cumsum(sizes)])
        kind = np.int32 if max(int(total[-1]), len(learnt)) < 2**31 else np.int64
        flat = np.repeat((ends[slots] - total[:-1]).astype(kind), sizes)
        flat += np.arange(total[-1], dtype=kind)
        ids, at = learnt[flat], total[starts]
        if odd.any():
            rows = np.flatnonzero(odd)
            whole = self.library([texts[int(r)].as_py() for r in rows])
            parts = np.split(ids, at[1:-1])
            for r, own in zip(rows.tolist(), whole):
                parts[r] = np.array(own, self.kind)
            ids = np.concatenate(parts)
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, at


_LOADED: dict[tuple[str, bool], Subwords] = {}


def subwords(path: str, plain: bool = False) -> Subwords:
    """The tokenizer of a vocabulary file, loaded once in each process."""
    if (path, plain) not in _LOADED:
        _LOADED[path, plain] = Subwords(path, plain)
    return _LOADED[path, plain]
