"""Hard negatives against brute force in exact integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslake.llm import op13_negatives as op13

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    use = []
    for i, x, label in sorted(set((i, None if x is None else tuple(x), label) for i, x, label in rows), key=repr):
        if label is not None and x and all(c is not None and math.isfinite(c) and abs(c) < op13.LARGEST for c in x):
            use.append((i, [math.floor(256 * float(np.float32(c))) for c in x], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for i, a, label in use:
        if i is None or i % 10:
            continue
        met = sorted((-score(a, x), math.inf if j is None else j, other) for j, x, other in use if j != i and len(x) == len(a))
        for s, j, _ in [m for m in met if m[2] == label][:5]:
            fits = [m for m in met if m[2] != label and 50 * -s <= 100 * -m[0] <= 95 * -s][:3]
            out += [(i, None if j == math.inf else j, rank, None if k == math.inf else k, -s, -t) for rank, (t, k, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, op13.mine(df, F.col("vec_id") % 10 == 0).collect()), key=repr)


def vectors(seed, n, dims=12, labels=4):
    r = random.Random(seed)
    base = [[r.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    return [(i, [c + r.gauss(0, 0.1) for c in r.choice(base)], r.randrange(labels)) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op13, "SHARD", 40)
    monkeypatch.setattr(op13, "ANCHORS", 9)
    monkeypatch.setattr(op13, "LEAF", 4)
    rows = vectors(1, 400)
    rows += [(1000 + i, rows[i % 3][1], i % 2) for i in range(60)]  # copies, also of other labels, and ties
    rows += [(10, rows[10][1], rows[10][2])] * 3 + [(20, rows[33][1], 3), (None, rows[10][1], 1), (None, rows[4][1], 0)]
    rows += [(2000, None, 1), (2001, [], 1), (2010, [float("nan")] * 12, 1), (2020, [float("inf")] * 12, 1), (2030, [None] * 12, 1), (2040, rows[0][1], None), (2050, [1e30] * 12, 0)]
    rows += [(3000 + i, [0.1 * i, 0.5], i % 2) for i in range(30)] + [(4000, [0.0] * 12, 0), (4010, [-1.0] * 12, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "a", "g", "b", "v", "kind", "score", "rank")}).repartition(3)
    got = found(df)
    assert got == brute(rows)
    assert len(got) > 200


def test_one_vector_for_a_third_of_all_rows(spark):
    rows = vectors(2, 120) + [(500 + i, [0.2] * 12, 1) for i in range(60)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_large_components_are_exact(spark):
    r = random.Random(3)
    rows = [(i, [float(np.float32(r.uniform(-260_000, 260_000))) for _ in range(8)], i % 2) for i in range(40)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(10, [1.0, 2.0], 1)], [(11, [1.0], 1), (12, [1.0], 2)]])
def test_nothing_to_mine(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == []


def test_boxes_bound_products_and_are_pruned():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (20, 6))
    x = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(0, 5, (3000, 6)))
    tree, anchor = op13.RTree(np.arange(3000), x), np.floor(rng.normal(0, 300, 6))
    bounds = [(low[0], high[0]) for low, high in tree.intervals(anchor[None])]
    scores = tree.x @ anchor
    for k in range(0, 3000, op13.LEAF):
        assert bounds[0][0][k // op13.LEAF] <= scores[k : k + op13.LEAF].min() <= scores[k : k + op13.LEAF].max() <= bounds[0][1][k // op13.LEAF]
    best = op13.Best(-math.inf, np.quantile(scores, 0.6), 3)
    read = op13.search(tree, anchor, bounds, [best])
    want = sorted((-s, i) for s, i in zip(scores.tolist(), tree.ids.tolist(), strict=True) if s <= best.high)[:3]
    assert [(float(s), i) for s, i in best.rows] == want
    assert read < 0.5 * len(tree.levels[0][0])
