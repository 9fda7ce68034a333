import math
import re

import numpy as np
import pytest

from reviewlens.llm import mixing
from reviewlens.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, TRICKY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Targets by bisection on the common unit, for sources in order."""
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    total = sum(sizes)
    low, high = 0.0, 10.0 * total + 1
    for _ in range(300):
        unit = (low + high) / 2
        given = sum(min(3 * s, w * unit) for s, w in zip(sizes, weights))
        low, high = (unit, high) if given < total else (low, unit)
    return [min(3 * s, w * high) for s, w in zip(sizes, weights)]


def check(rows, given, slack):
    sizes = {}
    for source, text in given:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, targets([sizes[n] for n in names])))
    taken = dict.fromkeys(names, 0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["copies"] <= 3 and len(r["shards"]) == r["copies"]
        taken[r["source"]] += r["copies"] * r["size"] * r["repeats"]
    for n in names:
        largest = max((r["size"] * r["repeats"] for r in rows if r["source"] == n), default=0)
        assert abs(taken[n] - want[n]) <= min(largest, max(slack * want[n], largest / 2 + 1))


def test_targets_are_met(documents):
    rows = mixing.plan(documents).collect()
    check(rows, [(r["source"], r["text"]) for r in documents.collect()], 0.02)


def test_edge_rows(tricky):
    rows = mixing.plan(tricky, block_docs=1, shard_blocks=2).collect()
    assert sum(r["repeats"] for r in rows) == len(TRICKY)
    check(rows, [(r[3], r[1]) for r in TRICKY], 1.0)


def test_same_plan_whatever_the_partitions(documents):
    names = ("doc_id", "copies", "shards")
    one = sorted(tuple(map(str, (r[n] for n in names))) for r in mixing.plan(documents).collect())
    two = sorted(tuple(map(str, (r[n] for n in names))) for r in mixing.plan(documents.repartition(5)).collect())
    assert one == two


def test_water_fill_stops_at_the_limit():
    assert mixing.water_fill([10, 100, 1000], [5, 2, 1], 1110) == pytest.approx([30, 300, 780])
    assert mixing.water_fill([0, 0], [5, 2], 0) == [0, 0]
    assert mixing.water_fill([], [], 0) == []


def laid_out(quotas, shards, seed=mixing.SEED):
    """Tickets of each source (row) in each shard (column)."""
    tree = mixing.SplittingTree(quotas, shards, seed)
    places = [tree.shards_of(k, np.arange(1, q + 1)) for k, q in enumerate(quotas)]
    return np.array([np.bincount(p, minlength=shards) for p in places]), places


def test_tree_keeps_quotas_and_shard_sizes():
    quotas = [100, 0, 37, 1, 512]
    for shards in (1, 2, 7, 650, 700):
        tree, places = laid_out(quotas, shards)
        assert tree.sum(axis=1).tolist() == quotas and (tree >= 0).all()
        assert np.ptp(tree.sum(axis=0)) <= 1
        assert all((np.diff(p) >= 0).all() for p in places)  # a shard owns a run
    assert (laid_out(quotas, 7)[0] == laid_out(quotas, 7)[0]).all()


def test_any_tickets_find_their_shards_alone():
    quotas, draw = [300, 41, 0, 77], np.random.default_rng(3)
    tree = mixing.SplittingTree(quotas, 23)
    whole = laid_out(quotas, 23)[1]
    for source in (0, 1, 3):
        ranks = draw.permutation(quotas[source])[:20] + 1
        assert tree.shards_of(source, ranks).tolist() == whole[source][ranks - 1].tolist()
        assert tree.shards_of(source, ranks[:0]).tolist() == []


def test_tree_is_hypergeometric():
    got = np.array([laid_out([30, 70], 4, seed)[0][0] for seed in range(2000)])
    assert np.allclose(got.mean(axis=0), 7.5, atol=0.15)
    variance = 25 * 0.3 * 0.7 * 75 / 99
    assert np.allclose(got.var(axis=0), variance, rtol=0.15)


@pytest.mark.parametrize("good, bad, picks", [(30, 70, 25), (5, 3, 6), (1, 9, 10), (0, 4, 2), (40, 2, 41)])
def test_inverted_draw_is_hypergeometric(good, bad, picks):
    u = (np.arange(4000) + 0.5) / 4000
    got = np.bincount([mixing.inverted_hypergeometric(x, good, bad, picks) for x in u], minlength=picks + 1) / 4000
    ways = [math.comb(good, k) * math.comb(bad, picks - k) / math.comb(good + bad, picks) for k in range(picks + 1)]
    assert np.allclose(got, ways, atol=1e-3)


def test_inverted_draw_of_very_many():
    good, bad, picks = 4 * 10**9, 6 * 10**9, 5 * 10**9
    draw = np.random.default_rng(1)
    got = np.array([mixing._hypergeometric(draw, good, bad, picks) for _ in range(60)], float)
    deviation = math.sqrt(picks * 0.4 * 0.6 * 0.5)
    assert abs(got.mean() - 2 * 10**9) < 5 * deviation / math.sqrt(60)
    assert 0.6 < got.std() / deviation < 1.5


def test_blocks_are_disjoint_and_shards_are_runs(documents):
    rows = mixing.plan(documents, block_docs=4, shard_blocks=5).collect()
    shards = {}
    for r in rows:
        for s in r["shards"]:
            shards[s] = shards.get(s, 0) + 1
    assert len(shards) > 3


def test_mix_repeats_documents_as_planned(tricky, documents):
    for df in (tricky, documents):
        planned = mixing.plan(df)
        out = mixing.mix(df, planned)
        assert out.schema == df.schema
        want = {}
        for r in planned.collect():
            if r["copies"]:
                want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"] * r["repeats"]
        got = {}
        for r in out.collect():
            got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert got == want


def test_empty_table(tricky):
    empty = tricky.limit(0)
    planned = mixing.plan(empty)
    assert planned.count() == 0 and mixing.mix(empty, planned).count() == 0


def test_stretches_give_the_same_plan(documents, monkeypatch):
    names = ("doc_id", "copies", "shards")
    get = lambda: sorted(
        tuple(map(str, (r[n] for n in names))) for r in mixing.plan(documents, block_docs=2, shard_blocks=3).collect()
    )
    one = get()
    monkeypatch.setattr(mixing, "STRETCH", 3)
    assert get() == one


def test_tickets_of_a_block_go_to_the_shards_of_the_tree(documents):
    """The plan by hand: ranks of all tickets in one sort, the whole tree laid out."""
    rows = mixing.plan(documents, block_docs=4, shard_blocks=5).collect()
    counts = {}
    for r in rows:
        for s in r["shards"]:
            counts[s] = counts.get(s, 0) + 1
    assert set(counts) <= set(range(max(counts) + 1))
    written, number = mixing.write_shards(documents, mixing.plan(documents, block_docs=4, shard_blocks=5))
    repeats = {}
    for r in rows:
        for s in r["shards"]:
            repeats[s] = repeats.get(s, 0) + r["repeats"]
    assert {r[number]: r["count"] for r in written.groupBy(number).count().collect()} == repeats


def test_query_reads_what_was_taken_from_the_shards(spark, documents):
    df = QUERIES["op9_mix_block_quotas"](spark, FOLDER)
    assert "mix-shards" in "".join(df.inputFiles())
    rows = df.collect()
    planned = {r["doc_id"]: r for r in mixing.plan(documents).collect()}
    assert len(rows) == documents.count() == len(planned)
    taken, targets_ = {}, {}
    for r in rows:
        p = planned[r["doc_id"]]
        assert r["taken"] == r["size"] * p["copies"] and r["shards"] == sorted(set(p["shards"]))
        taken[p["source"]] = taken.get(p["source"], 0) + r["taken"]
        targets_[p["source"]] = r["target"]
    for source, target in targets_.items():
        largest = max(r["size"] for r in rows if planned[r["doc_id"]]["source"] == source)
        assert abs(taken[source] - target) <= max(largest, 0.02 * target)
