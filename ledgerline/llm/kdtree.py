"""Exact top-k by inner product: a KD-tree per shard, best-first traversal, a threshold handed on between shards.

Rows are dealt to shards of bounded size.  A shard's tree splits at the median
of the widest dimension; every node has a tight bounding box.  A query visits
nodes in the order of the highest inner product that their box allows and
stops when that is below its kth score.  The first shard's kth scores are
handed to all others, which so begin with a bound.  Queries come in blocks of
bounded size, so one task never holds more than a shard and a block.
"""

from __future__ import annotations

import heapq
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF_ROWS = 256


class KdTree:
    """Median-split tree over the rows of ``x``; ``lo`` and ``hi`` are the boxes of its nodes."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.span: list[tuple[int, int]] = []
        self.kids: list[tuple[int, int] | None] = []
        lo, hi = [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            rows = x[self.order[a:b]]
            low, high = rows.min(axis=0), rows.max(axis=0)
            me = len(self.span)
            self.span.append((a, b))
            self.kids.append(None)
            lo.append(low)
            hi.append(high)
            if parent >= 0:
                left, right = self.kids[parent] or (-1, -1)
                self.kids[parent] = (me, right) if side == 0 else (left, me)
            width = high - low
            if b - a > LEAF_ROWS and len(width) and width.max() > 0:
                mid = (b - a) // 2
                part = np.argpartition(rows[:, int(np.argmax(width))], mid)
                self.order[a:b] = self.order[a:b][part]
                todo += [(a, a + mid, me, 0), (a + mid, b, me, 1)]
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.sorted = x[self.order]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Highest inner product of each query (row) with any point of each node's box (column)."""
        return np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T


def exact_type(*arrays: np.ndarray):
    """float64 where all inner products are exact in it, int64 where they fit, else Python's integers."""
    top = max([int(max(abs(int(a.min())), abs(int(a.max())))) for a in arrays if a.size] or [0])
    limit = top * top * max([a.shape[1] for a in arrays])
    return np.float64 if limit < 1 << 52 else np.int64 if limit < 1 << 62 else object


def search(tree: KdTree, ids: np.ndarray, places: np.ndarray, query: np.ndarray, bounds: np.ndarray, own: int, k: int,
           least: float) -> list[tuple[int, int]]:
    """The up to k best (score, id) of a query in one shard that reach ``least``; ties go to the smaller id."""
    best: list[tuple] = []
    kth = least
    queue = [(-bounds[0], 0)]
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < kth:
            break
        kids = tree.kids[node]
        if kids is not None:
            for c in kids:
                if bounds[c] >= kth:
                    heapq.heappush(queue, (-bounds[c], c))
            continue
        a, b = tree.span[node]
        scores = tree.sorted[a:b] @ query
        rows = tree.order[a:b]
        good = np.flatnonzero((scores >= kth) & (places[rows] != own))
        if len(good):
            best += [(-int(scores[g]), int(ids[rows[g]])) for g in good.tolist()]
            best = heapq.nsmallest(k, best)
            if len(best) == k:
                kth = max(kth, -best[-1][0])
    return [(-s, i) for s, i in best]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.values if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.values for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 0), np.int64)


def _best_of(k: int):
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "query_place", "vec_id", "score"]
        out: list[tuple] = []
        if shard.num_rows and queries.num_rows:
            x, q = _matrix(shard.column("v"), shard.num_rows), _matrix(queries.column("q_v"), queries.num_rows)
            kind = exact_type(x, q)
            tree, q = KdTree(x.astype(kind)), q.astype(kind)
            ids, places = shard.column("vec_id").to_numpy(), shard.column("place").to_numpy()
            bounds = tree.bounds(q)
            for i, (qid, place, least) in enumerate(zip(*(queries.column(c).to_pylist() for c in ("q_vec_id", "q_place", "q_least")))):
                found = search(tree, ids, places, q[i], bounds[i], place, k, -inf if least is None else least)
                out += [(qid, place, v, s) for s, v in found]
        return pa.Table.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], names=names)

    return run


def quantized(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v = floor(scale * x) of each component, dim; without null vectors and those with null or non-finite components."""
    x = F.col("e")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(inf)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(~bad & (F.size(x) > 0))
    return rows.select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"), F.size(x).alias("dim"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` highest inner products of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own.  Equal scores go to the smaller id.  Vectors that
    are null or empty or have null or non-finite components, and rows without
    an id, take no part; only vectors of equal length are compared.  Repeated rows
    are rows of their own.  Fewer candidates than ``k`` give fewer rows; an
    empty table gives an empty table.  Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = stored(quantized(vectors, scale, id_col, vec_col).withColumn("place", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.when(F.col("vec_id") % every == 0, 1).otherwise(0)).alias("q"))
    sizes = sizes.select("dim", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"),
                         F.greatest(F.lit(1), F.ceil(F.col("q") / BLOCK_QUERIES)).cast("int").alias("blocks"))
    sized = rows.join(stored(sizes, "vector-sizes"), "dim")
    shard = F.pmod(F.xxhash64(F.lit("shard"), "vec_id", "place"), F.col("shards")).cast("int")
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id", "place"), F.col("blocks")).cast("int")
    shards = sized.withColumn("shard", shard).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    queries = sized.where(F.col("vec_id") % every == 0).withColumn("block", block)
    schema = "query_id long, query_place long, vec_id long, score long"
    columns = ["vec_id", "place", "v", "dim", "shard", "block"]

    def join(some: DataFrame, asked: DataFrame) -> DataFrame:
        left = some.select(*columns).groupBy("dim", "shard", "block")
        right = asked.select(*[F.col(c).alias(f"q_{c}") for c in (*columns, "least")]).groupBy("q_dim", "q_shard", "q_block")
        return left.cogroup(right).applyInArrow(_best_of(k), schema)

    none = F.lit(None).cast("long")
    first = stored(join(shards.where("shard = 0"), queries.withColumn("shard", F.lit(0)).withColumn("least", none)), "top-first")
    reached = first.groupBy("query_place").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = reached.select(F.col("query_place").alias("p"), F.when(F.col("n") >= k, F.col("least")).alias("least"))
    others = queries.join(reached, F.col("place") == F.col("p"), "left").where("shards > 1")
    others = others.withColumn("shard", F.explode(F.expr("sequence(1, shards - 1)")))
    found = first.union(join(shards.where("shard > 0"), others))
    order = Window.partitionBy("query_id", "query_place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
