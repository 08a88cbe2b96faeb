"""Top-k search against all products."""

import numpy as np
import pytest
from conftest import DATA
from odd import clash

from wattline.llm.topk import Best, build_tree, dual_search, largest_product, top_k

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_force(rows, k, step):
    points = [(i, n, np.array([int(np.floor(256 * x)) for x in v], dtype=object)) for n, (i, v) in enumerate(rows)]
    found = []
    for i, n, point in points:
        if i is not None and i % step == 0:
            scores = sorted((-int((point * p).sum()), j if j is not None else 2**63) for j, m, p in points if m != n)
            found += [(i, r + 1, j if j < 2**63 else None, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(found, key=repr)


def answers(df):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()), key=repr)


def test_many_small_blocks(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(5, 8)) * 3
    rows = [(i, [float(x) for x in centers[i % 5] + rng.normal(size=8) * 0.2]) for i in range(400)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert answers(top_k(df, k=4, query_step=10, block_rows=40)) == by_force(rows, 4, 10)


def test_a_vector_that_most_rows_share(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i % 7), -1.0]) for i in range(300)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert answers(top_k(df, k=5, query_step=50, block_rows=32)) == by_force(rows, 5, 50)


def test_odd_vectors(spark):
    good = [(0, [0.1, 0.2]), (1, [0.3, -0.2]), (None, [0.3, -0.2]), (50, [9.0, 9.0]), (50, [0.1, 0.2])]
    bad = [(100, None), (150, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0])]
    df = clash(spark.createDataFrame([(i, v, 0) for i, v in good + bad], SCHEMA), "label")
    assert answers(top_k(df)) == by_force(good, 5, 50)
    assert top_k(clash(spark.createDataFrame([], SCHEMA), "label")).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0)], SCHEMA)
    assert top_k(one).count() == 0
    short = spark.createDataFrame([(0, [1.0, 1.0], 0), (1, [2.0], 0)], SCHEMA)
    assert answers(top_k(short)) == [(0, 1, 1, 131072)]


def test_values_beyond_exact_doubles(spark):
    rows = [(0, [2.0**21, 3.0]), (1, [2.0**21, 1.0]), (2, [2.0**21, 1.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert answers(top_k(df, k=2)) == by_force(rows, 2, 50)


@pytest.mark.parametrize("seed", range(3))
def test_trees_cover_their_points_and_prune(seed):
    rng = np.random.default_rng(seed)
    points = (rng.normal(size=(6, 4)) * 2000)[rng.integers(0, 6, 3000)] + rng.normal(size=(3000, 4)) * 30
    points = points.astype(np.int64)
    tree = build_tree(np.arange(3000), np.arange(3000), points)
    for low, high, center, radius, _, _ in tree.nodes:
        inside = tree.points[int(low) : int(high)]
        assert np.sqrt(((inside - tree.points[int(center)]) ** 2).sum(axis=1)).max() <= radius + 1e-6
    seen = []
    best = Best(3000, 3)
    offer = best.offer
    best.offer = lambda low, scores, *rest: (seen.append(scores.size), offer(low, scores, *rest))
    dual_search(tree, tree, best)
    assert sum(seen) < 0.7 * 3000 * 3000
    scores = tree.points @ tree.points.T
    np.fill_diagonal(scores, -(10**15))
    top = -np.sort(-scores, axis=1)[:, :3]
    assert [[-x[0] for x in found] for found in best.found] == top.tolist()
    assert largest_product(5.0, 1.0, 2.0, 3.0, 4.0) >= 5 + 6 + 4 + 3


def test_given_embeddings(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert answers(top_k(df)) == by_force(rows, 5, 50)
