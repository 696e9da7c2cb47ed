"""op13 against all scores on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clanweave.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, score string, block string, key string"


@pytest.fixture
def rows():
    r = np.random.default_rng(6)
    centres = r.normal(size=(6, 12))
    out = [(k, k % 4, (centres[k % 6] + r.normal(size=12) * 0.7).tolist()) for k in range(400)]
    out += [(k, 1, out[3][2]) for k in range(400, 430)]  # copies: ties by id
    out += [(430, 9, out[8][2]), (440, 8, [0.0] * 12), (450, 2, []), (460, 2, [1.0, 2.0]), (470, 3, [-x for x in out[3][2]])]
    out += [(431, None, out[3][2]), (None, 1, out[3][2]), (432, 1, None), (433, 1, [math.nan] * 12), (434, 1, [math.inf] + [0.0] * 11), (435, 1, [None] + [0.0] * 11)]
    out += [out[10], out[10], (20, 3, out[7][2])]  # a repeated row, and another one of a known id that is an anchor
    return out


def brute(rows):
    usable = {(k, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for k, label, v in rows
              if k is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, label, v in usable:
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), k, other) for k, other, w in usable if k != a)
        for score, k, _ in [x for x in scored if x[2] == label][:5]:
            p = -score
            within = [x for x in scored if x[2] != label and 50 * p <= -100 * x[0] <= 95 * p][:3]
            out += [(a, k, n + 1, x[1], p, -x[0]) for n, x in enumerate(within)]
    return out


def test_mine(spark, rows):
    df = spark.createDataFrame([(*x, "clash", "clash", "clash") for x in rows], SCHEMA).repartition(3)
    want = sorted(brute(rows))
    for tree in (512, 7):
        got = sorted(tuple(x) for x in H.mine(df, F.col("vec_id") % 10 == 0, tree=tree).collect())
        assert got == want and len(got) > 300


def test_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 20)
    df = spark.createDataFrame([(*x, "", "", "") for x in rows], SCHEMA)
    assert sorted(tuple(x) for x in H.mine(df, F.col("vec_id") % 10 == 0).collect()) == sorted(brute(rows))


def test_few_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.mine(none, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0], "", "", ""), (1, 1, [1.0], "", "", "")], SCHEMA)
    assert H.mine(one, F.col("vec_id") % 10 == 0).count() == 0 == H.mine(one, F.col("vec_id") < 0).count()


def test_spanning_tree():
    points = np.random.default_rng(1).normal(size=(40, 3))
    order, parent, length = H.spanning_tree(points)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and (parent[1:] < np.arange(1, 40)).all()
    assert np.allclose(length[1:], np.linalg.norm(points[order][1:] - points[order][parent[1:]], axis=1))
    every = sorted((float(np.linalg.norm(points[a] - points[b])), a, b) for a in range(40) for b in range(a))
    group, total = list(range(40)), 0.0  # by merging the nearest
    for d, a, b in every:
        if group[a] != group[b]:
            group, total = [group[b] if g == group[a] else g for g in group], total + d
    assert math.isclose(length.sum(), total)


def test_bounds_spare_scores():
    """Near anchors: most rows that are out of the window are known to be so from the parent's scores."""
    r = np.random.default_rng(2)
    vectors = np.floor(256 * r.normal(size=(5000, 16)))
    points = np.floor(256 * (r.normal(size=16) * 3 + r.normal(size=(50, 16)) * 0.02))
    order, parent, length = H.spanning_tree(points)
    block = H.Block(np.arange(5000), np.zeros(5000), vectors)
    tree = {"points": points[order], "parent": parent, "edge": length}
    every = vectors @ points[order].T
    low, high = np.quantile(every, 0.95), np.quantile(every, 0.97)
    for k, near, scores in block.scores(tree, lambda k: (np.ones(5000, bool), low, high)):
        assert (scores == every[near, k]).all()
        wanted = np.flatnonzero((every[:, k] >= low) & (every[:, k] <= high))
        assert set(wanted) <= set(near)
    assert block.scored < 0.3 * 5000 * 50
