import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reviewlens.llm import divergence as D
from tests.compare import connect, differences
from tests.llm.conftest import FOLDER, TRICKY, rows_of

NAMES = ("lang", "source", "part", "item", "value", "rank")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def by_hand(rows, least=10):
    """rows: text, lang, source."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)), lang, s) for t, lang, s in rows]
    docs, whole, own, groups = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for terms, lang, s in found:
        groups[lang].add(s)
        docs.update((lang, t) for t in set(terms))
        whole[lang].update(terms)
        own[lang, s].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for (g, t), n in docs.items() if g == lang and n >= least)

        def share(counts, kept=kept):
            mass = sum(counts[t] for t in kept) + 2 * len(kept)
            return [1 + 10**9 * (counts[t] + 2) // mass for t in kept]

        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(whole[lang])
        p = {s: share(own[lang, s]) for s in sources}
        utf8 = lambda x: (-x[1], x[0].encode())
        for s in sources:
            pairs = [(o, sum(map(f, p[s], p[o]))) for o in sources if o != s]
            terms = [(t, f(a, b)) for t, a, b in zip(kept, p[s], q) if own[lang, s][t] and a > b]
            for part, values, most in (("pair", pairs, None), ("term", terms, 10)):
                for k, (item, value) in enumerate(sorted(values, key=utf8)[:most]):
                    out.append((lang, s, part, item, value, k + 1))
    return sorted(out, key=repr)


def run(df, **more):
    return rows_of(D.source_divergence(df, **more), *NAMES)


def mixed_rows(seed, rows=300):
    draw = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)] + ["漢字", "é", "É", "\U0001f600", "ﬀx"]
    out = []
    for _ in range(rows):
        lang = draw.choice(["en", "en", "en", "de", None, ""])
        source = draw.choice(["hot"] * 5 + ["b", "ä", "\U0001f600", None, "B"])
        start = draw.randrange(100)
        text = " ".join(draw.choice(words[start : start + 105]).upper() if draw.random() < 0.3 else draw.choice(words) for _ in range(draw.randint(0, 60)))
        out.append((text if draw.random() > 0.05 else None, lang, source))
    return out


SHAPE = "text string, lang string, source string"


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_by_hand(spark, tricky, seed):
    rows = mixed_rows(seed)
    assert run(spark.createDataFrame(rows, SHAPE).repartition(4)) == by_hand(rows)


def test_many_blocks(spark, tricky, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 60)
    rows = mixed_rows(3)
    assert run(spark.createDataFrame(rows, SHAPE), min_documents=2) == by_hand(rows, 2)


def test_edge_rows(tricky):
    rows = [(t, lang, s) for _, t, lang, s in TRICKY]
    assert run(tricky) == by_hand(rows)
    assert run(tricky, min_documents=1) == by_hand(rows, 1)


def test_one_source_and_empty_table(spark, tricky):
    rows = [("same text", "en", "a")] * 12
    assert run(spark.createDataFrame(rows, SHAPE)) == by_hand(rows) == []
    assert run(tricky.limit(0)) == []


def test_query_equals_sql(spark, tricky):
    import __spark_entry__ as entry

    name = "op12_divergence_trees"
    assert differences(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


def test_equal_subtrees_are_one_node():
    counts = np.zeros((3, 1024), np.int64)
    counts[1, 5] = 3
    counts[2, :] = np.tile([1, 2, 3, 4], 256)
    leaves, levels, roots = D.consed(counts)
    assert leaves.tolist() == [0, 1, 2, 3, 4]
    assert max(len(a) for a, _ in levels) <= 5 and len(set(roots.tolist())) == 3
    (pair, u, v), summed = D.walk(levels, roots, np.array([0, 2]), np.array([1, 1]))
    assert len(pair) <= 2 + 5  # the repeated pattern against empty leaves is priced once
    price = np.abs(leaves[u] - leaves[v])
    assert summed(price).tolist() == [3, int(np.abs(counts[2] - counts[1]).sum())]


def test_shares_of_large_counts_are_exact():
    draw = random.Random(7)
    for _ in range(500):
        mass = draw.randrange(2, 9 * 10**15)
        count = draw.randrange(0, mass - 1)
        got = D.smoothed(np.array([count]), np.array([mass]))[0]
        assert int(got) == 1 + 10**9 * (count + 2) // mass
