import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewlens.llm import simhash
from reviewlens.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, TRICKY, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ("doc_id", "fingerprint", "component_id")


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(bits, most=3):
    """Smallest position reachable from each position, by all pairs."""
    bits = np.array(bits, np.uint64)
    label = list(range(len(bits)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(bits)):
        for b in np.flatnonzero(np.bitwise_count(bits[:a] ^ bits[a]) <= most).tolist():
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return [find(k) for k in range(len(bits))]


def by_hand(rows):
    bits = [fingerprint(t) for _, t in rows]
    group = reached(bits)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        out.append((doc, f"{bits[k]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def test_edge_rows(tricky):
    assert rows_of(simhash.simhash_groups(tricky), *NAMES) == by_hand([r[:2] for r in TRICKY])


def test_query(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert rows_of(QUERIES["op11_simhash_balls"](spark, FOLDER), *NAMES) == by_hand(rows)


def test_empty_table(tricky):
    assert simhash.simhash_groups(tricky.limit(0)).count() == 0


def test_a_component_without_ids(spark, tricky):
    df = spark.createDataFrame([(None, "only one here"), (None, "only one here"), (4, None), (3, "")], "doc_id long, text string")
    assert rows_of(simhash.simhash_groups(df), *NAMES) == by_hand([tuple(r) for r in df.collect()])


def fingerprints_near(seed, balls=6, each=40):
    """Fingerprints 0 to 6 flips from some centres, chains of 3 flips, and others."""
    draw = random.Random(seed)
    out = {0, 1, 7, 15, 2**64 - 1, 2**63}
    for _ in range(balls):
        at = draw.getrandbits(64)
        for _ in range(each):
            bits = draw.sample(range(64), draw.randint(0, 6))
            out.add(at ^ sum(1 << b for b in bits))
            if draw.random() < 0.2:
                at ^= sum(1 << b for b in draw.sample(range(64), 3))
                out.add(at)
    return sorted(out | {draw.getrandbits(64) for _ in range(100)})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_reach_what_all_pairs_reach(spark, tricky, seed, monkeypatch):
    monkeypatch.setattr(simhash, "PART_VARIANTS", 20_000)  # several parts of the shuffle
    bits = fingerprints_near(seed)
    signed = np.array(bits, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(b,) for b in signed], "bits long").repartition(3)
    found = [(r["node"], r["other"]) for r in simhash.links(nodes).collect()]
    place = {b: k for k, b in enumerate(signed)}
    for a, b in found:
        assert 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    label = list(range(len(bits)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in found:
        x, y = sorted((find(place[a]), find(place[b])))
        label[y] = x
    assert [find(k) for k in range(len(bits))] == reached(bits)


def test_one_parity_only(spark, tricky):
    even = [b for b in fingerprints_near(4) if b.bit_count() % 2 == 0]
    nodes = spark.createDataFrame([(int(np.uint64(b).view(np.int64)),) for b in even], "bits long")
    assert simhash.links(nodes).count() > 0
    assert simhash.links(nodes.where(F.lit(False))).count() == 0


def test_fingerprints_do_not_depend_on_the_batch():
    texts = [t or "" for _, t, *_ in TRICKY]
    whole = simhash.fingerprints(pa.array(texts))
    assert [int(x) for x in whole] == [fingerprint(t) for t in texts]
    assert [int(simhash.fingerprints(pa.array([t]))[0]) for t in texts] == [int(x) for x in whole]
    assert simhash.fingerprints(pa.array(["", " \t"])).tolist() == [0, 0]
    assert len(simhash.fingerprints(pa.array([], pa.string()))) == 0


def test_flips_cover_every_triple():
    pairs = {frozenset(p) for p in simhash._HALF}
    draw = random.Random(5)
    for _ in range(2000):
        a, b, c = draw.sample(range(64), 3)
        assert pairs & {frozenset((a, b)), frozenset((a, c)), frozenset((b, c))}
