import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import overlap
from reviewlens.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, TRICKY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_hand(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    out = []
    for k, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((doc, len(sets[k]), min(group, default=None) if sets[k] else doc))
    return sorted(out, key=repr)


def run(df, **more):
    names = ("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r[n] for n in names) for r in overlap.jaccard_groups(df, **more).collect()), key=repr)


def near_copies(seed, groups=12, most=25, words=120):
    """Chains and stars of copies around the threshold, a passage that many share, and singles."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(1, 3)))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(groups):
        text = [word() for _ in range(draw.randint(3, words))]
        for _ in range(draw.randint(1, most)):
            copy = list(text)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(len(copy))] = word()
            if draw.random() < 0.3:
                copy = copy[draw.randint(0, 9) :] or copy
            if draw.random() < 0.2:
                at = draw.randrange(len(copy))
                copy[at:at] = passage
            if draw.random() < 0.2:
                text = copy  # a chain
            rows.append((draw.randrange(10**6), " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, tricky, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert run(df) == by_hand(rows)


def test_many_frequent_shingles_and_other_thresholds(spark, tricky, monkeypatch):
    rows = near_copies(5, groups=6, most=40, words=40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(overlap, "FREQUENT", 40)
    monkeypatch.setattr(overlap, "BROADCAST_IDS", 0)
    assert run(df, percent=60) == by_hand(rows, 60)
    assert run(df, percent=90) == by_hand(rows, 90)


def test_edge_rows(tricky):
    assert run(tricky) == by_hand([r[:2] for r in TRICKY])


def test_no_links_and_empty_table(spark, tricky):
    rows = [(1, "a b c d e f"), (2, "g h i j k l"), (3, "")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == by_hand(rows)
    assert overlap.jaccard_groups(tricky.limit(0)).count() == 0


def test_query(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    names = ("doc_id", "n_shingles", "component_id")
    got = sorted((tuple(r[n] for n in names) for r in QUERIES["op6_ngram_jaccard_join"](spark, FOLDER).collect()), key=repr)
    assert got == by_hand(rows)


def test_components_of_chains_and_stars(spark):
    draw = random.Random(8)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(139, 200), (7, 7)]
    edges = [e if draw.random() < 0.5 else e[::-1] for e in edges]
    df = spark.createDataFrame(edges, "node long, other long")
    got = {r["node"]: r["group"] for r in overlap.components(df).collect()}
    want = {k: 0 for k in range(61)} | {k: 100 for k in (*range(100, 140), 200)}
    assert got == want
    assert overlap.components(df.where(F.lit(False))).count() == 0


def test_sets_do_not_depend_on_the_batch():
    texts = [t or "" for _, t, *_ in TRICKY]
    whole, starts = overlap.shingle_sets(pa.array(texts))
    for k, text in enumerate(texts):
        alone, _ = overlap.shingle_sets(pa.array([text]))
        assert alone.tolist() == whole[starts[k] : starts[k + 1]].tolist()
        assert len(alone) == len(shingles(text))
