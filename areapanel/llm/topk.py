"""Exact top-k search by inner product with a KD-tree per shard."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import finite_vector, save

EXACT = float(2**52)


class KDTree:
    """Median splits on the widest side; every node keeps the tight box of its points."""

    def __init__(self, points: np.ndarray, leaf: int = 256):
        self.order = np.arange(len(points))
        self.children: list[tuple[int, int] | None] = []
        self.span: list[tuple[int, int]] = []
        lo, hi = [], []
        todo = [(0, len(points), None, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            at = self.order[start:end]
            box_lo, box_hi = points[at].min(axis=0), points[at].max(axis=0)
            node = len(self.span)
            self.span.append((start, end))
            self.children.append(None)
            lo.append(box_lo)
            hi.append(box_hi)
            if parent is not None:
                pair = list(self.children[parent] or (0, 0))
                pair[side] = node
                self.children[parent] = tuple(pair)
            wide = int(np.argmax(box_hi - box_lo))
            if end - start > leaf and box_hi[wide] > box_lo[wide]:
                middle = (end - start) // 2
                self.order[start:end] = at[np.argpartition(points[at, wide], middle)]
                todo += [(start, start + middle, node, 0), (start + middle, end, node, 1)]
        self.lo, self.hi = np.array(lo), np.array(hi)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Greatest inner product that a point in each node's box can have with each query."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T


def search(tree: KDTree, points: np.ndarray, ids: np.ndarray, query: np.ndarray, bounds: np.ndarray, own: int, k: int, least) -> list[tuple]:
    """The k best (score, -id) of a shard in any order; ``least``: kth score found elsewhere, or None."""
    best: list[tuple] = []
    queue = [(-bounds[0], 0)]
    while queue:
        bound, node = heapq.heappop(queue)
        floor = best[0][0] if len(best) == k else None
        floor = least if floor is None else floor if least is None else max(floor, least)
        if floor is not None and -bound < floor:
            break
        if tree.children[node]:
            for child in tree.children[node]:
                if floor is None or bounds[child] >= floor:
                    heapq.heappush(queue, (-bounds[child], child))
            continue
        start, end = tree.span[node]
        scores = points[start:end] @ query
        near = np.arange(len(scores)) if floor is None else np.flatnonzero(scores >= floor)
        for i in near.tolist():
            at = int(ids[start + i])
            if at != own:
                item = (int(scores[i]), -at)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
    return best


def _shard(k: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            matrix = lambda t: t["vec"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            points, queries = matrix(left), matrix(right)
            kind = np.float64
            if points.shape[1] * np.abs(points).max().astype(float) * np.abs(queries).max().astype(float) >= EXACT:
                kind = object  # Python's integers, for components that doubles can't multiply exactly
            points, queries = points.astype(kind), queries.astype(kind)
            tree = KDTree(points)
            points, ids = points[tree.order], left["id"].to_numpy()[tree.order]
            bounds = tree.bounds(queries)
            for q, query, row, least in zip(right["id"].to_pylist(), queries, bounds, right["least"].to_pylist(), strict=True):
                for score, at in search(tree, points, ids, query, row, q, k, least):
                    out["query_id"].append(q)
                    out["vec_id"].append(-at)
                    out["score"].append(max(-(2**63), min(2**63 - 1, score)))
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def exact_top_k(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0, shard_rows: int = 512, query_rows: int = 4096) -> DataFrame:
    """The ``k`` rows of ``df`` with the greatest integer inner product for each row of ``queries``.

    Components become floor(``scale`` * x).  Returns ``query_id``, ``rank`` from
    1, ``vec_id``, ``score``; fewer than k rows if there are fewer candidates;
    ties go to the smaller id; a query never finds its own id.

    Rows are hashed to about sqrt(n / ``shard_rows``) shards.  A task builds the
    KD-tree of one shard and searches it best-first for one block of queries.
    Every query first searches one shard; its kth score there goes along to all
    other shards, which visit only boxes that can still reach it.  The k best of
    the shards' lists are the answer.  A block of queries never holds more than
    about ``query_rows`` rows, so no task grows with the number of queries.

    Vectors that are null, empty, or hold null or non-finite components take no
    part, as query or candidate; nor do rows with a null id.  Only vectors of
    the same length are compared.  Of rows that repeat an id with the same
    vector one counts.  Scores beyond a long are clipped to it.
    """

    def whole(x: DataFrame) -> DataFrame:
        vec = F.col(vec_col).cast("array<double>")
        rows = x.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("id").isNotNull() & finite_vector(F.col("vec")))
        return rows.select("id", F.transform("vec", lambda v: F.floor(v * scale)).alias("vec")).distinct().withColumn("dim", F.size("vec"))

    points, wanted = save(whole(df), "topk-points"), save(whole(queries), "topk-queries")
    n, q = points.count(), wanted.count()
    shards = max(1, round((n / shard_rows) ** 0.5), -(-n // (shard_rows * 256)))
    blocks = max(1, -(-q // query_rows))
    point_rows = points.withColumns({"shard": F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    query_rows_ = wanted.withColumns({"home": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int"), "block": F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int")})

    def visit(asked: DataFrame) -> DataFrame:
        keys = ["dim", "shard", "block"]
        return point_rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_shard(k), "query_id long, vec_id long, score long")

    first = save(visit(query_rows_.withColumns({"shard": F.col("home"), "least": F.lit(None).cast("long")})), "topk-first")
    kth = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    rest = query_rows_.join(kth, "id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    both = first.unionByName(visit(rest))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
