import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from custofold.llm import rtree

SCHEMA = "vec_id long, label int, v array<double>, rank string, score int"


def plain(rows, anchor, positives=5, negatives=10, low=30, high=90):
    """The definition, pair by pair, over (id, label, vector) rows."""
    rows = sorted({(i, y, tuple(int(x) for x in v)) for i, y, v in rows})

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for i, label, v in rows:
        if not anchor(i):
            continue
        others = sorted((-score(v, w), j, y) for j, y, w in rows if j != i)
        for p, j, _ in [o for o in others if o[2] == label][:positives]:
            p = -p
            inside = [(-n, k) for n, k, y in others if y != label and low * p <= -100 * n <= high * p][:negatives]
            out += [(i, j, r, k, p, n) for r, (n, k) in enumerate(inside, 1)]
    return sorted(out)


def got(spark, rows, anchor, tile_rows=rtree.TILE_ROWS, **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    made = rtree.hard_negatives(rtree.points(df, "vec_id", "label", F.col("v")), anchor, tile_rows=tile_rows, **sizes)
    return sorted(tuple(r) for r in made.collect())


def vectors(n, dims, seed, size=200):
    rnd = np.random.default_rng(seed)
    return [(i, int(rnd.integers(3)), rnd.integers(-size, size, dims).astype(float).tolist()) for i in range(n)]


@pytest.mark.parametrize("dims, tile_rows", [(2, 40), (5, 1000), (16, 60)])
def test_agrees_with_all_pairs(spark, dims, tile_rows):
    rows = vectors(400, dims, dims)
    want = plain(rows, lambda i: i % 20 == 0)
    assert want and got(spark, rows, F.col("vec_id") % 20 == 0, tile_rows) == want


def test_copies_ties_and_repeated_rows(spark):
    shared = [(i, i % 2, [3.0, 4.0, 0.0]) for i in range(0, 240)]  # one vector, two labels
    others = [(i, i % 3, [float(i % 5), 1.0, float(i % 4)]) for i in range(300, 500)]
    rows = shared + others + shared[:20]
    assert got(spark, rows, F.col("vec_id") % 50 == 0, 50) == plain(rows, lambda i: i % 50 == 0)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, y, v) for i, y, v in vectors(60, 3, 9)]
    bad = [
        (100, None, [1.0, 1.0, 1.0]), (200, 1, None), (300, 1, [1.0, None, 1.0]), (400, 1, [nan, 1.0, 1.0]),
        (500, 1, [inf, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (700, 1, [1e30, 1.0, 1.0]),
    ]
    assert got(spark, rows + bad, F.col("vec_id") % 10 == 0) == plain(rows, lambda i: i % 10 == 0)


def test_lengths_and_no_rows(spark):
    rows = [(0, 0, [5.0, 1.0]), (1, 0, [5.0]), (2, 1, [2.0, 3.0, 9.0]), (3, 1, []), (4, 1, [4.0, 0.0])]
    assert got(spark, rows, F.col("vec_id") == 0) == plain(rows, lambda i: i == 0) != []
    assert got(spark, [], F.col("vec_id") == 0) == []
    assert got(spark, rows, F.lit(False)) == []
    assert got(spark, [(1, 1, [])], F.lit(True)) == []


def test_large_components_are_exact(spark):
    rnd = random.Random(5)
    top = rtree.LIMIT
    rows = [(i, i % 2, [float(rnd.choice((top, top - 1, top - 2))) for _ in range(8)]) for i in range(80)]
    assert got(spark, rows, F.col("vec_id") % 8 == 0, window=(30, 100)) == plain(rows, lambda i: i % 8 == 0, high=100)


def tree_of(rows):
    order = rtree.str_order(rows)
    assert sorted(order.tolist()) == list(range(len(rows)))
    return rtree.Tree(order.astype("<i8"), np.zeros(len(rows), "<i4"), rows[order].astype(float))


def test_boxes_bound_every_row():
    rnd = np.random.default_rng(2)
    rows, anchors = rnd.integers(-50, 50, (1000, 4)).astype(float), rnd.integers(-50, 50, (7, 4)).astype(float)
    tree = tree_of(rows)
    for level, size in ((0, rtree.LEAF), (1, rtree.LEAF * rtree.FAN)):
        low, high = tree.bounds(anchors, level)
        scores = anchors @ tree.rows.T
        for node in range(low.shape[1]):
            own = scores[:, node * size : (node + 1) * size]
            assert (own >= low[:, node, None]).all() and (own <= high[:, node, None]).all()


def test_boxes_spare_most_rows_where_vectors_cluster():
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-1000, 1000, (64, 3))
    rows = (centres[rnd.integers(64, size=8000)] + rnd.integers(-5, 5, (8000, 3))).astype(float)
    tree, read = tree_of(rows), []
    for anchor in rows[:20]:
        seen = {}
        bounds = [tuple(x[0] for x in tree.bounds(anchor[None], level)) for level in (1, 0)]
        best = rtree.search(tree, anchor, np.ones(len(rows), bool), -np.inf, np.inf, 10, *bounds, seen)
        scores = tree.rows @ anchor
        first = np.lexsort((tree.ids, -scores))[:10]
        assert best.ids.tolist() == tree.ids[first].tolist()
        read.append(sum(len(at) for at, _ in seen.values()))
    assert np.mean(read) < 0.1 * len(rows)
