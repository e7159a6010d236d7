from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestide.llm import hard_negatives
from salestide.llm.hard_negatives import Search, Windows, built

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, windows=Windows()):
    """Every anchor against every row; rows of ``id, label, vector of whole numbers``."""
    rows = [r for r in rows if None not in r and None not in r[2]]
    rows = sorted({(i, l, tuple(v)) for i, l, v in rows})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        scored = sorted((-dot(a[2], b[2]), b[0], b[1]) for b in rows if b[0] != a[0])
        positives = [(i, -s) for s, i, label in scored if label == a[1]][: windows.positives]
        for positive, p in positives:
            inside = [
                (i, -s) for s, i, label in scored
                if label != a[1] and windows.least * p <= 100 * -s <= windows.most * p
            ]
            found += [(a[0], positive, k, i, p, s) for k, (i, s) in enumerate(inside[: windows.negatives], 1)]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<long>")


def mined(spark, rows, every, **options):
    made = hard_negatives.mine(frame(spark, rows), F.expr(f"vec_id % {every} = 0"), "vec_id", "label", "embedding", **options)
    assert made.columns == NAMES
    return sorted(map(tuple, made.collect()))


def clusters(count, width, seed, labels=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 60, (7, width))
    points = np.floor(centres[draw.integers(0, 7, count)] + draw.normal(0, 15, (count, width))).astype(int)
    return [(k, int(l), p.tolist()) for k, (l, p) in enumerate(zip(draw.integers(0, labels, count), points))]


@pytest.mark.parametrize("tree_rows", [16, 60, 10_000])
def test_against_all_rows(spark, tree_rows):
    rows = clusters(400, 6, 1)
    rows += [(1000 + k, k % 3, rows[5][2]) for k in range(40)]  # one vector many times: ties
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 300
    assert mined(spark, rows, 10, tree_rows=tree_rows, block_anchors=16) == want


def test_edge_rows(spark):
    rows = [
        (0, 1, [10, 0]), (1, 1, [9, 1]), (2, 2, [8, 0]), (3, 2, [4, 5]), (4, None, [9, 9]), (None, 1, [9, 9]), (5, 1, None),
        (6, 2, [7, None]), (7, 2, [8, 0]), (7, 2, [8, 0]), (0, 1, [10, 0]), (8, 3, []), (9, 3, [6]), (10, 5, [1, 1]), (20, 1, [-3, 1]),
        (30, 9, []), (40, 8, [1 << 40, -(1 << 40)]), (0, 2, [8, 0]), (50, 1, [0, 0]),
    ]
    bounded = [(i, l, v and [None if x is None else max(-(1 << 26), min(1 << 26, x)) for x in v]) for i, l, v in rows]
    want = brute(bounded, lambda i: i % 10 == 0)
    assert want and mined(spark, rows, 10) == want == mined(spark, rows, 10, tree_rows=2, block_anchors=1)
    assert mined(spark, rows[:0] or rows[4:5], 10) == []


def test_large_components_stay_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(k, k % 2, draw.integers(-(1 << 26), 1 << 26, 5).tolist()) for k in range(60)]
    assert mined(spark, rows, 5, tree_rows=20) == brute(rows, lambda i: i % 5 == 0)


def test_whole_numbers_and_unusable_vectors(spark):
    rows = [(1, [0.5, -0.001, 1.0]), (2, [float("nan")]), (3, [float("inf"), 1.0]), (4, None), (5, [None]), (6, []), (7, [float("-inf")])]
    given = spark.createDataFrame(rows, "k int, v array<float>")
    good = given.filter(hard_negatives.usable(F.col("v")))
    got = {r.k: r.w for r in good.select("k", hard_negatives.whole_numbers(F.col("v")).alias("w")).collect()}
    assert got == {1: [128, -1, 256], 6: []}


@pytest.mark.parametrize("seed", range(5))
def test_radii_cover_and_bounds_hold(seed):
    draw = np.random.default_rng(seed)
    points = draw.integers(-50, 50, (300, 3)) + 200 * draw.integers(0, 3, (300, 1))
    tree = built(np.arange(300), np.zeros(300, int), points.tolist())
    assert sorted(tree.ids) == list(range(300))
    assert len(tree.radii) > 10
    anchors = draw.integers(-100, 100, (20, 3))
    search = Search(tree, anchors)
    for k, anchor in enumerate(anchors):
        scores = tree.points @ anchor
        for node in range(len(tree.radii)):
            own = scores[tree.starts[node] : tree.starts[node + 1]]
            assert all((search.lower[k, node] <= own) & (own <= search.upper[k, node]))


def test_nodes_outside_the_windows_are_not_looked_into(monkeypatch):
    rows = clusters(3000, 4, 2)
    tree = built(np.arange(3000), np.array([r[1] for r in rows]), [r[2] for r in rows])
    looked = []
    plain = hard_negatives.products
    monkeypatch.setattr(hard_negatives, "products", lambda p, a: looked.append(len(p)) or plain(p, a))
    search = Search(tree, np.array([r[2] for r in rows[:20]]))
    for k in range(20):
        search.best(k, np.ones(3000, bool), [(-math.inf, math.inf)], 5)
    assert sum(looked) < 20 * 3000 / 2


def test_trees_of_equal_points_end():
    tree = built(np.arange(5000), np.zeros(5000, int), [[1, 2]] * 5000)
    assert len(tree.radii) == 1 and len(tree.ids) == 5000
