"""Exact top-k search by inner product: dual-tree search over cover trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import materialize

TREE = (
    "block bigint, cell int, n int, dim int, ids array<bigint>, rows array<bigint>,"
    " points binary, nodes binary, center binary, radius double, norm double"
)
FOUND = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"
#: Stands for a null id, which comes after all others.
LAST_ID = 2**63 - 1
LEAF_POINTS, CHILDREN, SHRINK = 256, 8, 1.3


@dataclass
class Tree:
    """A cover tree over points in tree order: every node is a slice of them.

    ``nodes`` holds per node: first and last point, center, covering radius (the distance from the
    center to its farthest point), first child, number of children.
    """

    ids: np.ndarray
    rows: np.ndarray
    points: np.ndarray
    nodes: np.ndarray


def build_tree(ids: np.ndarray, rows: np.ndarray, points: np.ndarray) -> Tree:
    """Splits every node by farthest-first centers until they cover it with a smaller radius.

    The centers of a node's children lie further apart than the radius that covers their points,
    the two properties of a cover tree's level. A node of few points, or of equal ones, is a leaf.
    """
    exact = points
    points = points.astype(np.float64)
    order = np.arange(len(points))
    middle = points.mean(axis=0)
    first = int(((points - middle) ** 2).sum(axis=1).argmin())
    nodes: list[list[float]] = [[0, len(points), first, 0, 0, 0]]
    at = 0
    while at < len(nodes):
        low, high, center = (int(x) for x in nodes[at][:3])
        inside = order[low:high]
        distance = np.sqrt(((points[inside] - points[center]) ** 2).sum(axis=1))
        radius = float(distance.max())
        nodes[at][3] = radius
        if len(inside) > LEAF_POINTS and radius > 0:
            owner, centers = np.zeros(len(inside), dtype=int), [center]
            while len(centers) < CHILDREN and distance.max() > radius / SHRINK:
                centers.append(int(inside[distance.argmax()]))
                other = np.sqrt(((points[inside] - points[centers[-1]]) ** 2).sum(axis=1))
                closer = other < distance
                owner[closer] = len(centers) - 1
                distance = np.minimum(distance, other)
            nodes[at][4:] = [len(nodes), len(centers)]
            sizes = np.bincount(owner, minlength=len(centers))
            order[low:high] = inside[np.argsort(owner, kind="stable")]
            ends = low + np.cumsum(sizes)
            for end, size, child in zip(ends, sizes, centers, strict=True):
                nodes.append([end - size, end, child, 0, 0, 0])
        at += 1
    table = np.array(nodes)
    place = np.empty(len(order), dtype=int)
    place[order] = np.arange(len(order))
    table[:, 2] = place[table[:, 2].astype(int)]
    return Tree(ids[order], rows[order], exact[order], table)


class Best:
    """The best ``k`` candidates so far of each query of a group; ties to the smaller id."""

    def __init__(self, queries: int, k: int, bounds: np.ndarray | None = None):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in range(queries)]
        # What other blocks have shown to be reachable holds as well.
        self.worst = np.full(queries, -np.inf) if bounds is None else bounds.copy()

    def offer(self, low: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray) -> None:
        good = (scores >= self.worst[low : low + len(scores), None]) & (rows != own[:, None])
        for i in np.flatnonzero(good.any(axis=1)):
            query, line = low + int(i), scores[i]
            at = np.flatnonzero(good[i])
            if len(at) > 4 * self.k:
                edge = np.partition(line[at], len(at) - self.k)[len(at) - self.k]
                at = at[line[at] >= edge]
                # Of many equal scores only the smallest ids can count; points come by id.
                equal = at[line[at] == edge]
                equal = equal[np.lexsort((rows[equal], ids[equal]))][: self.k]
                at = np.concatenate((at[line[at] > edge], equal))
            new = [(-int(line[j]), int(ids[j]), int(rows[j])) for j in at]
            self.found[query] = sorted(self.found[query] + new)[: self.k]
            if len(self.found[query]) == self.k:
                self.worst[query] = max(self.worst[query], -self.found[query][-1][0])


def largest_product(dots, radius_a, norm_a, radius_b, norm_b):
    """No pair of points below two nodes has a larger inner product than this."""
    bound = dots + radius_b * norm_a + radius_a * norm_b + radius_a * radius_b
    return bound + 1e-9 * np.abs(bound) + 1e-6


def dual_search(queries: Tree, tree: Tree, best: Best) -> None:
    """Visits pairs of nodes, best bound first, and leaves out those that cannot matter.

    A pair is pruned when its bound is below the worst kth score among the node's queries.
    """
    largest = np.abs(queries.points).max(initial=0) * float(np.abs(tree.points).max(initial=0))
    exact = largest * queries.points.shape[1] < 2**52
    kind = np.float64 if exact else object  # Python's integers where a double could round
    q_points, t_points = queries.points.astype(kind), tree.points.astype(kind)
    q_real, t_real = queries.points.astype(np.float64), tree.points.astype(np.float64)
    q_nodes, t_nodes = queries.nodes, tree.nodes
    q_centers = q_real[q_nodes[:, 2].astype(int)]
    t_centers = t_real[t_nodes[:, 2].astype(int)]
    q_norms, t_norms = np.linalg.norm(q_centers, axis=1), np.linalg.norm(t_centers, axis=1)

    def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        dots = (q_centers[a] * t_centers[b]).sum(axis=1)
        return largest_product(dots, q_nodes[a, 3], q_norms[a], t_nodes[b, 3], t_norms[b])

    one = np.zeros(1, dtype=int)
    stack = [(0, 0, float(bounds(one, one)[0]))]
    while stack:
        a, b, bound = stack.pop()
        low, high = int(q_nodes[a, 0]), int(q_nodes[a, 1])
        if bound < best.worst[low:high].min():
            continue
        a_leaf, b_leaf = q_nodes[a, 5] == 0, t_nodes[b, 5] == 0
        if a_leaf and b_leaf:
            start, end = int(t_nodes[b, 0]), int(t_nodes[b, 1])
            scores = q_points[low:high] @ t_points[start:end].T
            best.offer(low, scores, tree.ids[start:end], tree.rows[start:end], queries.rows[low:high])
            continue
        if b_leaf or (not a_leaf and q_nodes[a, 3] > t_nodes[b, 3]):
            left = int(q_nodes[a, 4]) + np.arange(int(q_nodes[a, 5]))
            right = np.full(len(left), b)
        else:
            right = int(t_nodes[b, 4]) + np.arange(int(t_nodes[b, 5]))
            left = np.full(len(right), a)
        limits = bounds(left, right)
        # The most promising pair comes last, to be taken first.
        for i in np.argsort(limits):
            stack.append((int(left[i]), int(right[i]), float(limits[i])))


def _pack(block: int, cell: int, tree: Tree) -> dict:
    center = tree.points[int(tree.nodes[0, 2])].astype(np.float64)
    return {
        "block": block,
        "cell": cell,
        "n": len(tree.ids),
        "dim": tree.points.shape[1],
        "ids": tree.ids,
        "rows": tree.rows,
        "points": tree.points.astype("<i8").tobytes(),
        "nodes": tree.nodes.astype("<f8").tobytes(),
        "center": center.tobytes(),
        "radius": float(tree.nodes[0, 3]),
        "norm": float(np.linalg.norm(center)),
    }


def _unpack(ids, rows, points, nodes, n: int, dim: int) -> Tree:
    return Tree(
        np.asarray(ids),
        np.asarray(rows),
        np.frombuffer(points, "<i8").reshape(n, dim),
        np.frombuffer(nodes, "<f8").reshape(-1, 6),
    )


def whole_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """Rows whose vector has no null and only finite components, as floor(scale * x)."""
    components = F.col("embedding").cast("array<double>")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    usable = F.col("embedding").isNotNull() & F.forall(components, finite)
    whole = F.transform(components, lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))
    return vectors.where(usable).select(
        F.coalesce(F.col("vec_id").cast("bigint"), F.lit(LAST_ID)).alias("vec_id"), whole.alias("point"), F.monotonically_increasing_id().alias("row")
    )


def plant_trees(points: DataFrame, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """A cover tree for each block; blocks are parts of the cells around the pivots.

    A cell with more rows than a block holds is split by row number, so that a vector that many
    rows share makes many blocks, not a large one.
    """
    width = pivots.shape[1]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            real = _matrix(batch.point, width).astype(np.float64)
            near = ((pivots**2).sum(axis=1) - 2 * real @ pivots.T).argmin(axis=1)
            yield batch.assign(cell=near.astype("int32"))

    schema = "vec_id bigint, point array<bigint>, row bigint, cell int"
    placed = materialize(points.mapInPandas(assign, schema), "cells")
    # One row per cell, of which there are as many as pivots.
    parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    blocks = placed.join(F.broadcast(parts), "cell").withColumn(
        "block", F.col("cell") * F.lit(1 << 40) + F.pmod(F.xxhash64("row"), F.col("parts"))
    )

    def plant(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["vec_id", "row"])
        tree = build_tree(frame.vec_id.to_numpy(), frame.row.to_numpy(), _matrix(frame.point, width))
        return pd.DataFrame([_pack(key[0], int(frame.cell.iloc[0]), tree)])

    return blocks.select("block", "cell", "vec_id", "row", "point").groupBy("block").applyInPandas(plant, TREE)


def _matrix(points: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one is filled up with zeros."""
    rows = np.zeros((len(points), width), dtype=np.int64)
    for i, point in enumerate(points):
        rows[i, : len(point)] = point
    return rows


def _search(pairs: DataFrame, k: int, bounded: bool) -> DataFrame:
    """The best candidates of each pair of a query tree and a candidate tree."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                queries = _unpack(r.q_ids, r.q_rows, r.q_points, r.q_nodes, r.q_n, r.q_dim)
                tree = _unpack(r.ids, r.rows, r.points, r.nodes, r.n, r.dim)
                known = None
                if bounded:
                    held = dict(zip(r.bound_rows, r.bounds, strict=True))
                    known = np.array([held.get(x, -np.inf) for x in queries.rows])
                best = Best(len(queries.ids), k, known)
                dual_search(queries, tree, best)
                rows = [
                    (queries.rows[i], queries.ids[i], vec_id, row, -score)
                    for i, found in enumerate(best.found)
                    for score, vec_id, row in found
                ]
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND.split(", ")])

    return pairs.mapInPandas(search, FOUND)


def top_k(
    vectors: DataFrame,
    k: int = 5,
    query_step: int = 50,
    scale: float = 256.0,
    block_rows: int = 4096,
    max_cells: int = 256,
) -> DataFrame:
    """The ``k`` largest inner products of each query with every other row; exact.

    Queries are the rows whose vec_id is divisible by ``query_step``. Columns: query_id, rank
    (from 1), vec_id, score; ties go to the smaller vec_id. Queries and candidates are cut into
    blocks around at most ``max_cells`` pivots, each block gets a cover tree. A query block is
    first held against the blocks of its own cell, which gives every query a kth score to beat.
    Then pairs of blocks whose roots cannot beat the worst of these are dropped, and only the
    others are brought together, node pair by node pair.

    Null vectors, and those with null or non-finite components, take no part; neither does the
    query's own row, while other rows with its id do. A null vec_id is never a query and comes
    after all others in a tie. Shorter vectors count as filled up with zeros. Products must fit in
    64 bits. An empty table gives no rows. Other columns of ``vectors`` play no part.
    """
    spark = vectors.sparkSession
    points = materialize(whole_vectors(vectors, scale), "points")
    shape = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("point")).alias("width")).first()
    width = max(1, shape["width"] or 1)
    cells = max(1, min(max_cells, shape["n"] // block_rows))
    sample = points.select("point").distinct().orderBy(F.xxhash64("point")).limit(cells)
    picked = [r["point"] for r in sample.collect()] or [[0] * width]
    pivots = _matrix(pd.Series(picked), width).astype(np.float64)

    trees = materialize(plant_trees(points, pivots, block_rows), "trees")
    asked = points.where((F.col("vec_id") % query_step == 0) & (F.col("vec_id") != LAST_ID))
    query_rows = max(64, block_rows // 8)
    groups = materialize(plant_trees(asked, pivots, query_rows), "queries")
    groups = groups.select(*(F.col(c).alias(f"q_{c}") for c in groups.columns))

    home = _search(groups.join(trees, F.col("q_cell") == F.col("cell")), k, bounded=False)
    home = materialize(home, "home")
    by_query = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = home.withColumn("place", F.row_number().over(by_query)).where(F.col("place") == k)
    bounds = ranked.select("query_row", F.col("score").cast("double").alias("bound"))
    per_group = (
        groups.select("q_block", F.explode("q_rows").alias("query_row"))
        .join(bounds, "query_row", "left")
        .groupBy("q_block")
        .agg(
            F.collect_list(F.when(F.col("bound").isNotNull(), F.col("query_row"))).alias("bound_rows"),
            F.collect_list("bound").alias("bounds"),
            F.min(F.coalesce("bound", F.lit(-math.inf))).alias("worst"),
        )
        .withColumnRenamed("q_block", "bound_block")
    )
    groups = materialize(groups.join(per_group, F.col("q_block") == F.col("bound_block")), "bounds")

    # Each query block against each candidate block: only roots, some hundred bytes each.
    roots = trees.select("block", "cell", "center", "radius", "norm")
    heads = groups.select("q_block", "q_cell", "q_center", "q_radius", "q_norm", "worst")
    far = heads.join(roots, F.col("q_cell") != F.col("cell"))

    def promising(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a = np.stack([np.frombuffer(x, "<f8") for x in batch.q_center])
                b = np.stack([np.frombuffer(x, "<f8") for x in batch.center])
                limit = largest_product(
                    (a * b).sum(axis=1), batch.q_radius, batch.q_norm, batch.radius, batch.norm
                )
                yield batch.loc[limit >= batch.worst, ["q_block", "block"]]

    pairs = materialize(far.mapInPandas(promising, "q_block bigint, block bigint"), "pairs")
    others = _search(pairs.join(groups, "q_block").join(trees, "block"), k, bounded=True)
    place = F.row_number().over(by_query)
    return (
        home.unionByName(others)
        .withColumn("rank", place)
        .where(F.col("rank") <= k)
        .select(
            "query_id",
            F.col("rank").cast("int").alias("rank"),
            F.when(F.col("vec_id") != LAST_ID, F.col("vec_id")).alias("vec_id"),
            "score",
        )
    )


#: The same as SQL.
TOPK_SQL = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS point,
         row_number() OVER () AS place
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, place, unnest(point) AS x, generate_subscripts(point, 1) AS i FROM usable),
scores AS (
  SELECT q.vec_id AS query_id, q.place AS query_place, c.vec_id, c.place, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i
  WHERE q.vec_id % 50 = 0 AND q.place <> c.place
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_place ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
