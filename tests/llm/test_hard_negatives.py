"""Hard negatives against a comparison of every anchor with every row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from histloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rid string, leaf int"


def clustered(n=700, dim=12, seed=4, clusters=9):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(clusters)] + 0.15 * rng.standard_normal(dim)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(3))))
    return rows


def odd_rows():
    one = [0.5] * 12
    return ([(i, one, i % 3) for i in range(1000, 1120)]                     # equal vectors: ties by vec_id
            + [(1000, one, 1), (1000, one, 1), (5, [], 0), (6, [0.3], 1), (7, None, 1), (8, [None] * 12, 1),
               (9, [float("nan")] * 12, 1), (10, [math.inf] + one[1:], 1), (11, one, None), (None, one, 1),
               (1200, [0.0] * 12, 2), (1250, [-0.5] * 12, 0), (1300, [40.0] * 12, 1), (1350, one, 5)])


def brute(rows, positives=5, negatives=3, low=50, high=95):
    part = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, x, lab) in enumerate(part):
        if a is None or a % 50:
            continue
        ranked = sorted(((-sum(p * q for p, q in zip(x, y)), b is None, b or 0, b, other)
                         for k, (b, y, other) in enumerate(part) if k != n), key=lambda r: r[:3])
        for p in [r for r in ranked if r[4] == lab][:positives]:
            hits = [r for r in ranked if r[4] != lab and low * -p[0] <= 100 * -r[0] <= high * -p[0]][:negatives]
            out += [(a, p[3], rank, r[3], -p[0], -r[0]) for rank, r in enumerate(hits, 1)]
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("leaf_rows,fanout,tile,block", [(10_000, 16, 4096, 4096), (25, 4, 16, 5), (60, 16, 4096, 3)])
def test_negatives_equal_a_full_comparison(spark, monkeypatch, leaf_rows, fanout, tile, block):
    monkeypatch.setattr(hn, "TILE", tile)
    monkeypatch.setattr(hn, "BLOCK", block)
    rows = clustered() + odd_rows()
    got = hn.mine_hard_negatives(table(spark, rows), F.col("vec_id") % 50 == 0, leaf_rows=leaf_rows, fanout=fanout)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert len(want) > 100 and result(got) == want


def test_other_parameters_and_small_fit(spark):
    rows = clustered(seed=8)
    got = hn.mine_hard_negatives(table(spark, rows), F.col("vec_id") % 50 == 0, positives=2, negatives=4, low=70, high=90,
                                 leaf_rows=20, fanout=3, fit_rows=64)
    assert result(got) == brute(rows, 2, 4, 70, 90)


def test_huge_components_and_doubles(spark):
    rows = [(i, [x * 3e30 for x in v], lab) for i, v, lab in clustered(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hn.mine_hard_negatives(df, F.col("vec_id") % 50 == 0, leaf_rows=30)
    assert {r.anchor_id for r in got.collect()} <= {0, 50, 100}
    small = [(i, [x * 5e6 for x in v], lab) for i, v, lab in clustered(120)]           # beyond exact floats
    df = spark.createDataFrame(small, "vec_id long, embedding array<double>, label int")
    got = hn.mine_hard_negatives(df, F.col("vec_id") % 50 == 0, leaf_rows=30)
    rows = [(i, v, lab) for i, v, lab in small]
    part = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    assert got.count() > 0
    for r in got.collect():
        assert r.positive_score == sum(p * q for p, q in zip(part[r.anchor_id], part[r.positive_id]))
        assert 50 * r.positive_score <= 100 * r.negative_score <= 95 * r.positive_score


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(7, None, 1), (11, [0.5], None)], [(50, [0.5], 1)], [(51, [0.5], 1), (52, [0.4], 1)]):
        assert hn.mine_hard_negatives(table(spark, rows) if rows else spark.createDataFrame([], SCHEMA),
                                      F.col("vec_id") % 50 == 0).collect() == []


def _tree(x, leaves, fanout=5):
    tree = hn.Tree(x.shape[1], float((x * x).sum(axis=1).max()))
    tree.grow(tree.lift(x[::2]), leaves, fanout)
    leaf = tree.leaf_of(x)
    found = {}
    tree.ranges(x[:100], leaf[:100], found)
    tree.ranges(x[100:], leaf[100:], found)
    for n, node in enumerate(tree.nodes):
        node.low, node.high = np.full((len(node.pivots),) * 2, np.inf), np.full((len(node.pivots),) * 2, -np.inf)
        for j in range(len(node.pivots)):
            if (n, j) in found:
                node.low[:, j], node.high[:, j] = found[n, j]
    return tree, leaf


@pytest.mark.parametrize("dim", [2, 3, 12])
def test_reach_keeps_every_leaf_with_a_score_in_a_window_and_leaves_others_out(dim):
    rng = np.random.default_rng(dim)
    x = np.floor(256 * (rng.standard_normal((8, dim))[rng.integers(8, size=2000)] + 0.1 * rng.standard_normal((2000, dim))))
    tree, leaf = _tree(x, 40)
    assert tree.n_leaves > 20 and len(tree.nodes) > 5
    scores = x[:60] @ x.T
    low = np.quantile(scores, [0.97, 0.2], axis=1).T
    high = np.quantile(scores, [0.99, 0.21], axis=1).T
    reached = tree.reach(x[:60], low, high)
    left_out = 0
    for a in range(60):
        inside = ((scores[a] >= low[a][:, None]) & (scores[a] <= high[a][:, None])).any(axis=0)
        assert set(leaf[inside].tolist()) <= set(reached[a])
        left_out += tree.n_leaves - len(reached[a])
    assert left_out > 0.1 * 60 * tree.n_leaves
    assert tree.reach(x[:3], np.full((3, 1), np.nan), np.full((3, 1), np.nan)) == [[], [], []]


def test_equal_points_make_one_leaf():
    tree, leaf = _tree(np.ones((200, 3)), 40)
    assert tree.n_leaves == 1 and not tree.nodes and set(leaf.tolist()) == {0}
