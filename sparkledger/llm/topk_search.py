"""Exact top-k inner-product search by the threshold algorithm over sorted per-dimension lists.

Queries and candidates are dealt into blocks by a hash of their id; a cell is one query block against one candidate block,
so the work is a grid of cells of bounded size, whatever the skew of the vectors.  In a cell every dimension has its
candidates sorted by component.  A query reads these lists in parallel (from the top where its own component is positive,
from the bottom where it is negative, not at all where it is zero), each time to twice the depth, scores what it meets by
random access, and stops once the score to beat is above the threshold: the sum of its components times the components at
the present depth, which bounds every candidate not met yet.  At equality it reads on, since a tie may go to a smaller id.
It also stops when it has met all rows.

The score to beat is carried from cell to cell: each query first searches one candidate block, and its k-th score there is
its *floor* in all cells.  A cell whose largest components cannot reach the floor is left without reading, and no cell gives
back what is below it.  The cells' best k are merged.

Components are quantised to ``floor(scale * x)``, so scores are exact integers (computed in floating point only where that
is exact).

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null
id; rows of a repeated id are candidates of their own, and queries that are ranked together; a query's own id is no candidate
of it; a shorter vector counts as ending in zeros; fewer than k candidates give all; no queries or candidates give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_schema

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
DEPTH = 16


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): integer vectors that take part."""
    raw = F.col(vector_col).cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & raw.isNotNull() & (F.size(raw) > 0) & finite)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(raw, lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values = column.combine_chunks()
    lengths = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths]) if len(lengths) else []] = flat
    return out


class Lists:
    """The sorted lists of a block: ``down[t, i]`` is the row with the t-th largest component i."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, m = ids[order], m[order]
        self.down = np.argsort(-m, axis=0, kind="stable")
        self.values = np.take_along_axis(m, self.down, axis=0)
        self.most = int(np.abs(m).max(initial=0))
        self.m, self.exact = m, m.astype(np.float64)

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.most * int(np.abs(q).max(initial=0)) * len(q) < 1 << 53:  # every partial sum is a whole number of 53 bits
            return (self.exact[rows] @ q.astype(np.float64)).astype(np.int64)
        return self.m[rows] @ q

    def top(self, query_id: int, q: np.ndarray, k: int, floor: int | None = None, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the best k but rows of the query's own id, none under the floor, and the depth that was read."""
        n = len(self.ids)
        up, low = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        new = self.ids != query_id
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        t, beat = 0, floor
        while t < n and new.any():
            at = max(0, t - 1)  # before the first read, the largest components
            if beat is not None and beat > self.values[at, up] @ q[up] + self.values[n - 1 - at, low] @ q[low]:
                break
            to = min(n, 2 * t + depth) if len(up) or len(low) else n
            fresh = np.zeros(n, dtype=bool)
            if to == n:
                fresh[:] = True
            else:
                fresh[self.down[t:to, up].ravel()] = True
                fresh[self.down[n - to : n - t, low].ravel()] = True
            met = np.flatnonzero(fresh & new)
            new[met] = False
            rows, scores = np.concatenate([rows, met]), np.concatenate([scores, self.scores(met, q)])
            if len(rows) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                best = np.flatnonzero(scores >= least)
                best = best[np.lexsort([rows[best], -scores[best]])[:k]]  # rows are in the order of their ids
                rows, scores = rows[best], scores[best]
            if len(rows) >= k:
                beat = max(int(scores.min()), int(scores.min()) if floor is None else floor)
            t = to
        keep = np.lexsort([rows, -scores])[:k]
        keep = keep if floor is None else keep[scores[keep] >= floor]
        return self.ids[rows[keep]], scores[keep], t


_OUT = "query_id long, vec_id long, score long"


def search(candidates: DataFrame, queries: DataFrame, *, k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): both sides as ``quantised`` gives them."""
    across, down = max(1, math.ceil(candidates.count() / candidate_block)), max(1, math.ceil(queries.count() / query_block))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("vec_id", "v", block(down).alias("qb"))
    given = candidates.select(F.lit(False).alias("asks"), "vec_id", "v", F.lit(None).cast("long").alias("floor"), block(across).alias("cb"))
    schema = arrow_schema(_OUT)

    def cell(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").to_numpy()
        vectors = table.column("v")
        m = _matrix(vectors, int(np.diff(vectors.combine_chunks().offsets.to_numpy()).max()))
        out: tuple[list, list, list] = ([], [], [])
        if asks.any() and not asks.all():
            lists = Lists(ids[~asks], m[~asks])
            floors = table.column("floor").filter(pa.array(asks)).to_pylist()
            for query_id, q, floor in zip(ids[asks].tolist(), m[asks], floors, strict=True):
                found, scores, _ = lists.top(query_id, q, k, floor)
                for col, x in zip(out, (np.full(len(found), query_id), found, scores), strict=True):
                    col.append(x)
        joined = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out]
        return pa.table([pa.array(x, type=pa.int64()) for x in joined], schema=schema)

    cols = ["asks", "vec_id", "v", "floor", "qb", "cb"]
    first = asked.withColumn("cb", F.col("qb") % across).select(F.lit(True).alias("asks"), "vec_id", "v", F.lit(None).cast("long").alias("floor"), "qb", "cb")
    # a query block meets the candidate block of its own number, so a candidate block goes to the query blocks of that rest
    beside = given.withColumn("qb", F.explode(F.when(F.col("cb") < down, F.sequence(F.col("cb"), F.lit(down - 1).cast("long"), F.lit(across).cast("long"))))).select(*cols)
    seeds = first.select(*cols).unionByName(beside).groupBy("qb", "cb").applyInArrow(cell, _OUT)
    floors = seeds.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "floor")
    main = asked.join(floors, "vec_id", "left").withColumn("cb", each(across)).select(F.lit(True).alias("asks"), "vec_id", "v", "floor", "qb", F.col("cb").cast("long").alias("cb"))
    best = main.select(*cols).unionByName(given.withColumn("qb", each(down)).select("asks", "vec_id", "v", "floor", F.col("qb").cast("long").alias("qb"), "cb")).groupBy("qb", "cb").applyInArrow(cell, _OUT)
    return ranked(best, F.col("score").desc(), k)


def ranked(found: DataFrame, score: Column, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(score, "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
