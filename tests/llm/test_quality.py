import re
from collections import Counter

import pytest

from reviewlens.llm import quality
from tests.llm.conftest import TRICKY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup, removed, left = set(), 0, 0, 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        again = bool(own) and line in seen
        seen.add(line)
        dup += again
        cells = len(re.findall("[|>•·\t]", line))
        bare = sum(any(c.isascii() and c.isalnum() or not c.isascii() for c in w) for w in own)
        bad = again or len(own) <= 20 and any(p in line.lower() for p in quality.BOILERPLATE)
        bad |= cells >= 4 and bare <= 2 * (cells + 1)
        marked = sum(bool(re.search(r"[#*$%&|<>]", w)) for w in own)
        shouted = sum(w[-1] in "!?" for w in own)
        bad |= len(own) >= 5 and (marked > 0.3 * len(own) or 2 * shouted > len(own) or not bare)
        bad = bad and bool(own)
        removed += bad
        left += 0 if bad else len(own)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    kept = not failed and left >= 0.5 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), removed, left, failed, kept


def figures(rows):
    names = [f.name for f in quality.FIGURES]
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *(r[n] for n in names)) for r in rows)


def test_equals_plain_python(tricky, documents):
    for df in (tricky, documents):
        want = sorted((r["doc_id"] is None, r["doc_id"] or 0, *by_hand(r["text"])) for r in df.collect())
        assert figures(quality.quality(df).collect()) == want


def test_dictionary_of_many_words_in_one_slice():
    import pyarrow as pa

    texts = [" ".join(f"w{i % 700}x" for i in range(5000)), "a b c a b c a", "", "a b"]
    got = quality.figures(pa.array(texts)).to_pylist()
    for text, row in zip(texts, got):
        assert tuple(row.values()) == by_hand(text)


def test_an_article_that_names_a_phrase_is_kept():
    import pyarrow as pa

    plain = " ".join(f"plain{i} words" for i in range(60))
    texts = [f"{plain} the privacy policy of a shop.", f"{plain}.\nRead our privacy policy.\nAccept cookies"]
    got = quality.figures(pa.array(texts)).to_pylist()
    assert [r["kept"] for r in got] == [True, True] and [r["n_lines_removed"] for r in got] == [0, 2]
    assert [tuple(r.values()) for r in got] == [by_hand(t) for t in texts]


def test_keeping_returns_all_columns(tricky):
    kept = quality.keep_good(tricky)
    assert kept.schema == tricky.schema
    assert [r["doc_id"] for r in kept.collect()] == [r[0] for r in TRICKY if by_hand(r[1])[-1]] == [12]


@pytest.mark.parametrize("name", ["quality", "keep_good"])
def test_empty_table(tricky, name):
    assert getattr(quality, name)(tricky.limit(0)).count() == 0
