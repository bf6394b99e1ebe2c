"""Exact top-k inner products by aggregation without random access.

Every block of candidate vectors is kept as one sorted list per dimension.  For a
query the lists are read in step, each from the end where its contribution is
largest.  A candidate's lower bound takes the least entry of the lists in which
it has not been seen, its upper bound the entry now being read.  Reading stops
when no vector outside the k best lower bounds can still reach the k-th; the
scores of those that can are then resolved, ties going to the smaller id.

All queries read a block's lists to the same depths, so what one has seen of a
vector in a list is the greater (for a negative weight the lesser) of the entry and
the frontier, and the bounds of many queries are one matrix product.  A query leaves
a block as soon as its reading stops: before the first entry if the heads of the
lists can't reach its k-th score so far, or when few candidates are left.

Candidates are read in blocks as they lie, so no vector is shuffled; each task
keeps the k best per query, and the queries are broadcast in segments of at most
``segment`` rows (with more queries, more passes are made).  Bounds are held in
doubles with a margin for rounding; scores are integers.

Defined results: vectors that are null or hold null or non-finite components take
no part; vectors of another length than the query are no candidates; a query's
own id is never a candidate; of repeated rows of a query id the least vector asks;
repeated candidate rows are ranked one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PART = "query_id long, vec_id long, score long"


@dataclass(frozen=True)
class TopKParams:
    k: int = 10
    scale: int = 1024
    every: int = 100  #: rows whose id it divides are queries
    segment: int = 20_000  #: queries in a broadcast
    block: int = 4096  #: candidates in a set of sorted lists
    tile: int = 256  #: queries whose bounds are held together


class SortedLists:
    """A block of vectors as sorted lists, one for each dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        self.values = np.sort(x, axis=0).astype(float)  # ascending, by dimension
        self.exact = float(np.abs(x).max(initial=0))

    def sides(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of all entries once ``depth`` of each list is read: dimensions read from above, and then from below."""
        n = len(self.ids)
        high, low = self.values[n - depth], self.values[depth - 1]
        above, below = self.x >= high, self.x <= low
        upper = np.concatenate([np.maximum(self.x, high), np.minimum(self.x, low)], axis=1)
        lower = np.concatenate([np.where(above, self.x, self.values[0]), np.where(below, self.x, self.values[-1])], axis=1)
        return upper, lower

    def heads(self) -> np.ndarray:
        return np.concatenate([self.values[-1], self.values[0]])

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Inner products as integers, by doubles where those hold them exactly."""
        x = self.x[rows]
        if self.exact * float(np.abs(q).max(initial=0)) * max(1, len(q)) < 2.0**53:
            return (x.astype(float) @ q.astype(float)).astype(np.int64)
        return x @ q

    def search(self, names: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """(scores, ids) of the best k and of what ties with the k-th, at least, by row of ``q``; ``floor`` has a score that k others have, or -inf."""
        n = len(self.ids)
        # positive weights meet the lists from above, negative ones from below
        w = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(float)
        margin = 1e-12 * self.exact * np.abs(w).sum(axis=1)
        active = np.flatnonzero(w @ self.heads() + margin >= floor)
        out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        depth = max(1, n // 8)
        while len(active):
            upper, lower = self.sides(depth)
            top = w[active] @ upper.T + margin[active, None]
            own = names[active, None] == self.ids[None, :]
            top[own] = -np.inf
            bound = floor[active]
            if n - 1 >= k:
                sure = w[active] @ lower.T - margin[active, None]
                sure[own] = -np.inf
                bound = np.maximum(bound, np.partition(sure, n - k, axis=1)[:, n - k])
            live = top >= bound[:, None]
            live &= ~own
            few = live.sum(axis=1) <= max(4 * k, n // 16)
            for r in np.flatnonzero(few | (depth >= n)):
                rows = np.flatnonzero(live[r])
                scores = self.scores(rows, q[active[r]])
                if len(rows) > k:
                    kth = np.partition(scores, len(rows) - k)[len(rows) - k]
                    rows, scores = rows[scores >= kth], scores[scores >= kth]
                out[int(active[r])] = (scores, self.ids[rows])
            active = active[~few] if depth < n else active[:0]
            depth = min(n, 2 * depth)
        return out


class Best:
    """The k best (score, id) so far of each query."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * queries
        self.floor = np.full(queries, -np.inf)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.rows[query][0], scores]), np.concatenate([self.rows[query][1], ids])
        order = np.lexsort((i, -s))[: self.k]
        self.rows[query] = (s[order], i[order])
        if len(order) == self.k:
            self.floor[query] = s[order[-1]]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each length of vector in the batch."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    lists = batch.column("v")
    off = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield ids[rows], flat[off[rows][:, None] + np.arange(n)].reshape(len(rows), n).astype(np.int64)


def _searcher(shared, p: TopKParams):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(np.array([k for k, v in shared.value if len(v) == n], dtype=np.int64), np.array([v for _, v in shared.value if len(v) == n], dtype=np.int64)) for n in sorted({len(v) for _, v in shared.value})]
        best = [Best(len(names), p.k) for names, _ in queries]
        for batch in batches:
            for ids, x in _vectors(batch):
                for (names, q), have in zip(queries, best, strict=True):
                    if q.shape[1] != x.shape[1]:
                        continue
                    for a in range(0, len(ids), p.block):
                        lists = SortedLists(ids[a : a + p.block], x[a : a + p.block])
                        for b in range(0, len(names), p.tile):
                            for r, found in lists.search(names[b : b + p.tile], q[b : b + p.tile], p.k, have.floor[b : b + p.tile]).items():
                                have.add(b + r, *found)
        cols = [[], [], []]
        for (names, _), have in zip(queries, best, strict=True):
            for name, (scores, ids) in zip(names, have.rows, strict=True):
                for col, part in zip(cols, (np.full(len(ids), name), ids, scores), strict=True):
                    col.append(part)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return search


def whole(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def top_k(vectors: DataFrame, p: TopKParams = TopKParams()) -> DataFrame:
    """(query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~odd).select("vec_id", whole(F.col("embedding"), p.scale).alias("v"))
    asking = v.filter(F.col("vec_id") % p.every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    segments = 1 + asking.count() // p.segment
    parts = []
    for s in range(segments):
        own = asking.filter(F.pmod(F.xxhash64("vec_id"), F.lit(segments)) == s)
        shared = spark.sparkContext.broadcast([(r.vec_id, np.array(r.v, dtype=np.int64)) for r in own.orderBy("vec_id").collect()])
        parts.append(v.mapInArrow(_searcher(shared, p), _PART))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return reduce(DataFrame.unionAll, parts).withColumn("rank", rank).filter(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")
