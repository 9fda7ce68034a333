import zlib

import numpy as np
import pyarrow as pa

from reviewlens.llm import language
from reviewlens.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, TRICKY, rows_of

SAMPLES = {"en": "the cat sat on the mat and the hat", "fr": "le chat est sur la table été"}


def parse_by_hand(text, sample):
    """Phrases of greedy cross-parsing with substring search, block by block."""
    count = 0
    for begin in range(0, len(text), language.BLOCK):
        block, at = text[begin : begin + language.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at : at + size + 1] in sample:
                size += 1
            count, at = count + 1, at + size
    return count


def by_hand(text, model):
    own = []
    for c in text:
        low = c.lower()
        own.append((low if len(low) == 1 and low in model.alphabet else "\x00") if c.isalpha() else " ")
    flat = "".join(own)
    while "  " in flat:
        flat = flat.replace("  ", " ")
    return flat.removeprefix(" ")


def test_automaton_knows_exactly_the_substrings():
    text = "abracadabra"
    automaton = language.SuffixAutomaton(text)

    def known(word):
        state = 0
        for c in word:
            if c not in automaton.next[state]:
                return False
            state = automaton.next[state][c]
        return True

    parts = {text[a:b] for a in range(len(text)) for b in range(a + 1, len(text) + 1)}
    assert all(known(p) for p in parts)
    assert not any(known(p + x) for p in parts for x in "abcdrx" if p + x not in parts)


def test_phrases_equal_substring_search(documents):
    texts = [r[1] or "" for r in TRICKY if len(r[1] or "") < 2000]
    texts += [r["text"] for r in documents.limit(30).collect()]
    model = language.Languages(SAMPLES)
    codes, starts, letters = language.encode(pa.array(texts), model.symbols)
    counts = language.phrases(codes, starts, model)
    for row, text in enumerate(texts):
        flat = by_hand(text, model)
        assert starts[row + 1] - starts[row] == len(flat)
        assert letters[row] == any(c.isalpha() for c in text)
        want = [parse_by_hand(flat, SAMPLES[name]) for name in model.names]
        assert counts[row].tolist() == want


def test_sample_is_bounded_and_deterministic(spark, documents):
    model = language.samples(documents, "doc_id", "text", "lang", per_language=5, max_chars=300)
    assert set(model) == {"de", "en", "es", "fr"}
    assert all(len(s) <= 300 for s in model.values())
    assert model == language.samples(documents.repartition(7), "doc_id", "text", "lang", 5, 300)


def test_edge_rows(spark, tricky):
    model = language.train(tricky)
    got = {(r["doc_id"], r["lang_pred"] == "und") for r in language.identify(tricky, model).collect()}
    letterless = {(r[0], not any(c.isalpha() for c in r[1] or "")) for r in TRICKY}
    assert got == letterless
    assert language.identify(tricky, model).count() == len(TRICKY)
    empty = tricky.limit(0)
    nothing = language.train(empty)
    assert language.identify(empty, nothing).count() == 0
    assert {r["lang_pred"] for r in language.identify(tricky, nothing).collect()} == {"und"}


def test_query_accuracy_on_held_out_rows(spark, documents):
    out = QUERIES["op1_language_cross_parsing"](spark, FOLDER)
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = out.collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(right) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rows_do_not_depend_on_partitions(documents):
    model = language.train(documents)
    one = language.identify(documents, model)
    many = language.identify(documents.repartition(9), model)
    assert rows_of(one, "doc_id", "lang_pred") == rows_of(many, "doc_id", "lang_pred")
