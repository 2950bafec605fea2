import random

import numpy as np

from ledgerline.llm import kdtree


def brute_force(rows, k, every, scale=256):
    ok = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i % every == 0:
            scores = sorted((-sum(p * q for p, q in zip(v, w)), j) for b, (j, w) in enumerate(ok) if b != a and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k, every):
    df = spark.createDataFrame([(i, v, "z", "z") for i, v in rows], "vec_id long, embedding array<double>, shard string, score string")
    return sorted(map(tuple, kdtree.top_k(df.repartition(3), k, every).collect()))


def test_equal_to_brute_force_with_ties_and_bad_rows(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.gauss(0, 0.3)]) for _ in range(6)]) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 430)]
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, [1.0] * 6),
             (10, [0.1, 0.2]), (510, [0.3, 0.4]), (520, []), (530, [1e6] * 6), (20, rows[20][1])]
    assert run(spark, rows, 5, 10) == brute_force(rows, 5, 10)
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 64)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 16)
    assert run(spark, rows, 5, 10) == brute_force(rows, 5, 10)
    assert run(spark, rows[:3], 5, 2) == brute_force(rows[:3], 5, 2)
    assert run(spark, [], 5, 10) == []


def test_tree_boxes_are_tight_and_cover_all_rows():
    x = np.random.default_rng(1).integers(-50, 50, (3000, 8)).astype(float)
    tree = kdtree.KdTree(x)
    leaves = [k for k, c in enumerate(tree.kids) if c is None]
    assert sum(tree.span[k][1] - tree.span[k][0] for k in leaves) == len(x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for k, (a, b) in enumerate(tree.span):
        assert (tree.sorted[a:b].min(axis=0) == tree.lo[k]).all() and (tree.sorted[a:b].max(axis=0) == tree.hi[k]).all()
    q = np.random.default_rng(2).integers(-50, 50, (5, 8)).astype(float)
    bounds = tree.bounds(q)
    for k, (a, b) in enumerate(tree.span):
        assert ((q @ tree.sorted[a:b].T).max(axis=1) <= bounds[:, k]).all()


def test_large_components_stay_exact():
    big = np.array([[2**30, 1], [2**30, 2]])
    assert kdtree.exact_type(big) is np.int64
    assert kdtree.exact_type(big * 2**20) is object
    assert kdtree.exact_type(np.array([[3, 4]])) is np.float64


def test_tied_scores_beyond_doubles_are_not_lost_between_shards(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 8)
    big = float(2**29 + 1)
    rows = [(i, [big / 256 * 2, 0.25]) for i in range(40)] + [(k, [big / 256 * 2 + 1 / 256, 0.25]) for k in (41, 42)]
    want = brute_force(rows, 5, 20)
    assert max(r[3] for r in want) > 2**53
    assert run(spark, rows, 5, 20) == want
