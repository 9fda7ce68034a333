import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import negatives as N
from reviewlens.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.llm.conftest import FOLDER, rows_of

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
SHAPE = "vec_id long, embedding array<double>, label int, rank string, score double"


def by_hand(rows, is_anchor, percent=80):
    used = [
        (i, v, label) for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    # the exact floor of 256 times a double
    whole = [[math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v] for _, v, _ in used]
    low, high = -(1 << 63), (1 << 63) - 1
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out, seen = [], set()
    for a, (i, v, label) in enumerate(used):
        if i is None or not is_anchor(i) or (i, tuple(v), label) in seen:
            continue
        seen.add((i, tuple(v), label))
        score = [min(max(sum(x * y for x, y in zip(whole[a], w)), low), high) for w in whole]
        same = sorted(((j, s) for (j, _, other), s in zip(used, score) if other == label and j != i), key=order)[:5]
        for j, most in same:
            fits = [
                (k, s) for (k, _, other), s in zip(used, score)
                if other != label and 100 * s <= 100 * most and percent * most <= 100 * s
            ]
            for rank, (k, s) in enumerate(sorted(fits, key=order)[:5]):
                out.append((i, j, rank + 1, k, most, s))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "mine", 1.5) for r in rows], SHAPE).repartition(3)
    return rows_of(N.hard_negatives(df, anchor=F.col("vec_id") % 5 == 0, **more), *NAMES)


def random_rows(seed, n=300, dim=8, labels=4):
    draw = random.Random(seed)
    rows = [(k, [draw.gauss(0.2, 0.3) for _ in range(dim)], draw.randrange(labels)) for k in range(n)]
    rows += [(n + k, rows[7][1], 1) for k in range(80)]  # a frequent vector
    rows += [rows[10], rows[10], rows[12], rows[12]]  # repeated rows, an anchor among them
    return rows


EDGES = [
    (1000, None, 1), (1005, [0.5, None], 1), (1010, [float("nan"), 1.0], 1), (1015, [float("inf")], 2),
    (1020, [0.5, 0.5], None), (1025, [], 1), (1030, [1.0], 2), (1035, [-0.5, -0.25], 3), (None, [0.7, 0.1], 1),
    (None, [0.9, 0.9, 0.2], 2), (-5, [0.0, 0.0], 1), (-7, [0.3], -3), (1040, [0.5] * 20, 1),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_by_hand(spark, tricky, seed):
    rows = random_rows(seed)
    assert run(spark, rows) == by_hand(rows, lambda i: i % 5 == 0)


def test_edge_rows(spark, tricky):
    rows = random_rows(3, n=60) + EDGES
    assert run(spark, rows) == by_hand(rows, lambda i: i % 5 == 0)
    assert run(spark, EDGES) == by_hand(EDGES, lambda i: i % 5 == 0)


def test_very_large_components_are_exact(spark, tricky):
    draw = random.Random(4)
    rows = [(k, [draw.choice([1e5, -3e9, 2.0**60, 1e-9, 3e38, 0.5]) * draw.random() for _ in range(4)], k % 3) for k in range(60)]
    assert run(spark, rows) == by_hand(rows, lambda i: i % 5 == 0)


def test_large_anchor_sets_are_dealt_out(spark, tricky, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(N, "ROW_SLOT", 1)
    rows = random_rows(5)
    assert run(spark, rows) == by_hand(rows, lambda i: i % 5 == 0)


def test_no_rows_and_no_anchors(spark, tricky):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_query_equals_sql(spark, tricky):
    import __spark_entry__ as entry

    name = "op13_negatives_packed"
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("size", [1, 200, 2**20, 2**30, 2**45, 2**200])
def test_packed_scores_are_inner_products(size):
    draw = random.Random(size)
    make = lambda n, d: [[draw.randint(-size, size) for _ in range(d)] for _ in range(n)]
    kind = np.int64 if size < 2**31 else object
    a, b = make(5, 7), make(9, 6)
    got = N.scores(np.array(a, kind), np.array(b, kind))
    low, high = -(1 << 63), (1 << 63) - 1
    assert got.tolist() == [[min(max(sum(x * y for x, y in zip(r, s)), low), high) for s in b] for r in a]
    positive = np.abs(np.array(a, kind)) + 1
    assert N.scores(positive, positive)[0, 0] == min(sum(int(x) ** 2 for x in positive[0]), high)
