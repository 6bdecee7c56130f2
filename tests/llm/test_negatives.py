import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagreef.llm import negatives
from tagreef.llm.negatives import Rows, mine_negatives, negatives_of, positives_of, spanning_tree

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, step):
    """The contract, every pair scored with whole numbers."""
    valid = []
    for vec_id, v, label in rows:
        if vec_id is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            valid.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, (anchor, label, v) in enumerate(valid):
        if anchor % step:
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w)), other, kind == label)
            for k, (other, kind, w) in enumerate(valid) if k != i and len(w) == len(v)
        ]
        for p, positive, _ in sorted(s for s in scores if s[2])[:5]:
            inside = sorted(s for s in scores if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p)
            out += [(anchor, positive, rank, other, -p, -s) for rank, (s, other, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def mined(spark, rows, step):
    table = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS row", "2 AS size", "'x' AS score", "3 AS chunk")
    found = mine_negatives(table, F.col("vec_id") % step == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(n, size, seed=0, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    v = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, size))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(k, v[k].tolist(), int(rng.integers(0, 4))) for k in range(n)]


@pytest.mark.parametrize("least", [512, 16])
def test_against_brute_force(spark, monkeypatch, least):
    """Also with several chunks and several trees."""
    monkeypatch.setattr(negatives, "LEAST_CHUNK", least)
    monkeypatch.setattr(negatives, "ANCHORS", 16 if least == 16 else 1024)
    rows = clustered(400, 12)
    expected = brute(rows, 5)
    assert len(expected) > 100
    assert mined(spark, rows, 5) == expected


def test_odd_rows(spark):
    one = [0.5, 0.25, -0.125]
    rows = [
        (0, one, 1), (1, one, 2), (2, one, 1), (2, one, 1), (3, [0.4, 0.25, -0.125], 2), (4, [0.3, 0.25, 0.0], 2),
        (5, None, 1), (6, [1.0, None, 0.0], 1), (7, [float("nan"), 0.0, 1.0], 2), (8, [float("inf"), 0.0, 1.0], 2),
        (9, [0.3, 0.2, -0.1], None), (None, one, 2), (10, [0.0, 0.0, 0.0], 1), (11, [0.0, 0.0, 0.0], 2), (12, [], 1),
        (14, [], 1), (15, [], 2), (16, [0.5, 0.5], 3), (17, [0.5, 0.4], 3), (18, [0.4, 0.4], 1), (20, [-0.5, -0.25, 0.0], 7),
        (20, [-0.5, -0.25, 0.0], 7), (0, one, 1), (21, [0.45, 0.25, -0.1], 2), (22, [0.45, 0.25, -0.1], 2),
    ]
    expected = brute(rows, 2)
    assert len(expected) > 20
    assert mined(spark, rows, 2) == expected
    assert mined(spark, [], 2) == []
    assert mined(spark, [(0, one, 1)], 2) == []


def test_vectors_too_long_for_doubles_take_no_part(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [3e38, 0.0], 1), (3, [0.9, 0.0], 2)]
    assert mined(spark, rows, 10) == brute([r for r in rows if r[0] != 2], 10)


def test_tree():
    v = np.random.default_rng(2).integers(-200, 200, (120, 5)).astype(float)
    v[40:60] = v[3]
    order, parent, edge = spanning_tree(v)
    assert sorted(order.tolist()) == list(range(120))
    assert parent[0] == -1 and all(p < k for k, p in enumerate(parent))
    v = v[order]
    assert edge[1:] == pytest.approx(np.linalg.norm(v[1:] - v[parent[1:]], axis=1))
    # As long as a tree that takes the shortest edges first.
    d = np.linalg.norm(v[:, None] - v[None], axis=2)
    root, total = list(range(120)), 0.0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in sorted(((a, b) for a in range(120) for b in range(a)), key=lambda p: d[p]):
        if find(a) != find(b):
            root[find(a)] = find(b)
            total += d[a, b]
    assert edge.sum() == pytest.approx(total)


def test_bounds_save_scores():
    """Near anchors score few rows outright, and find the same."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=24)
    near = np.floor(256 * (centre + 0.01 * rng.normal(size=(50, 24))) / np.linalg.norm(centre))
    v = np.floor(256 * rng.normal(size=(2000, 24)) / 5)
    label = rng.integers(0, 3, 2000)
    seen = 0

    class Counted(np.ndarray):
        def __matmul__(self, other):
            nonlocal seen
            seen += len(self)
            return np.asarray(self) @ other

    chunk = Rows(np.arange(2000), np.arange(2000), label, np.linalg.norm(v, axis=1), v.view(Counted))
    order, parent, edge = spanning_tree(near)
    anchors = Rows(np.arange(3000, 3050), np.arange(3000, 3050), np.zeros(50, int), np.linalg.norm(near, axis=1), near[order])
    found = list(positives_of(chunk, anchors, parent, edge, 5))
    scores = v @ near[order].T
    for k in range(50):
        best = sorted((-s, i) for i, s in enumerate(scores[:, k]) if label[i] == 0)[:5]
        assert [(i, -s) for r, i, s in found if r == 3000 + k] == [(i, s) for s, i in best]
    windows = [[(1, int(0.5 * s), int(0.9 * s))] for s in scores.max(0)]
    hard = list(negatives_of(chunk, anchors, parent, edge, windows, 3))
    for k in range(50):
        best = sorted((-s, i) for i, s in enumerate(scores[:, k]) if label[i] and windows[k][0][1] <= s <= windows[k][0][2])[:3]
        assert [(i, -s) for r, _, i, s in hard if r == 3000 + k] == [(i, s) for s, i in best]
    assert seen < 0.3 * 2 * 50 * 2000
