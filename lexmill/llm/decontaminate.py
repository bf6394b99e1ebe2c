"""Benchmark decontamination by spaced-seed hashing.

A seed hashes the tokens at fixed positions of a mask and ignores those between
them, so a substitution at an ignored position leaves the seed as it was.  The
masks are chosen so that every stretch that counts as an overlap holds at least
one seed free of substitutions; a test goes through all cases.  Seeds of the test
items are indexed in sorted arrays, document seeds are joined against them, and
each hit is verified on its diagonal (document position minus item position).

An overlap is a stretch of ``window`` aligned tokens with at most ``errors``
substitutions.  An item of ``least`` to ``window - 1`` tokens must be aligned
whole with at most one; shorter ones only match a document that is that very
sequence.  Overlapping stretches on a diagonal count as one; a pair reports its
best diagonal.

The index is broadcast in segments of at most ``segment_chars`` characters of
items; with more items, more passes are made over the documents.

Defined results: null and empty texts on either side match nothing; repeated
rows are reported once each; a null id is kept as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import _STEP, mix, words_of

#: Token positions of the seeds.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 2, 4, 5, 6, 7), (0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 5, 6))
SCHEMA = "doc_id long, item_id long, doc_start long, doc_end long, covered long, matched long"
_BLOCK = 1 << 18


@dataclass(frozen=True)
class OverlapParams:
    window: int = 13  #: tokens of an overlap
    errors: int = 2  #: substitutions in it
    least: int = 8  #: tokens of the shortest item that may match inside a document
    segment_chars: int = 32_000_000


@dataclass
class SeedIndex:
    seed: np.ndarray  #: sorted
    item: np.ndarray  #: row of the item, by seed
    at: np.ndarray  #: position in the item, by seed
    filter: np.ndarray  #: bit table over the seeds' low bits
    tokens: np.ndarray  #: token hashes of all items
    bounds: np.ndarray
    ids: list


def seeds_of(h: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """One hash for each position at which the mask fits."""
    n = len(h) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt + 1, dtype=np.uint64)
    for j, p in enumerate(mask):
        out += h[p : p + n] * _STEP[j]
    return mix(out)


def build_index(items: list[tuple[int | None, str | None]], p: OverlapParams) -> SeedIndex:
    """Items with one and the same text share their seeds by way of one row each."""
    tokens, seed, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sizes = np.zeros(len(items), dtype=np.int64)
    for w in words_of(pa.array([t for _, t in items], pa.string())):
        bounds = w.per_doc()
        for i in range(w.docs):
            h, row = w.hash[bounds[i] : bounds[i + 1]], w.first + i
            tokens.append(h)
            sizes[row] = len(h)
            for m, mask in enumerate(MASKS):
                s = seeds_of(h, mask, m) if len(h) >= p.least else h[:0]
                seed.append(s)
                item.append(np.full(len(s), row))
                at.append(np.arange(len(s)))
            if 0 < len(h) < p.least:  # the first token leads to it
                seed.append(mix(h[:1] + np.uint64(77)))
                item.append(np.array([row]))
                at.append(np.array([0]))
    seed, item, at = map(np.concatenate, (seed, item, at))
    order = np.argsort(seed, kind="stable")
    bits = max(16, int(np.ceil(np.log2(len(seed) + 1))) + 4)
    table = np.zeros(1 << bits, dtype=bool)
    table[seed & np.uint64(len(table) - 1)] = True
    return SeedIndex(seed[order], item[order], at[order], table, np.concatenate(tokens), np.concatenate([[0], np.cumsum(sizes)]), [k for k, _ in items])


def stretches(same: np.ndarray, p: OverlapParams, whole: int) -> np.ndarray:
    """Which aligned tokens lie in an overlap; ``whole`` is the item's length."""
    w, most = (p.window, p.errors) if whole >= p.window else (whole, 1)
    if len(same) < w:
        return np.zeros(len(same), dtype=bool)
    wrong = np.concatenate([[0], np.cumsum(~same)])
    good = wrong[w:] - wrong[:-w] <= most
    edge = np.zeros(len(same) + 1, dtype=np.int64)
    starts = np.flatnonzero(good)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + w, -1)
    return np.cumsum(edge[:-1]) > 0


def overlaps(h: np.ndarray, bounds: np.ndarray, index: SeedIndex, p: OverlapParams) -> list[tuple]:
    """(document row, item row, start, end, covered, matched) of each pair with an overlap."""
    found: set[tuple[int, int, int]] = set()
    low = np.uint64(len(index.filter) - 1)
    passes = [(seeds_of(h, mask, m), 0) for m, mask in enumerate(MASKS)]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    hits = [(np.flatnonzero(index.filter[s & low]), s) for s, _ in passes]
    hits.append((firsts, None))
    for where, s in hits:
        keys = s[where] if s is not None else mix(h[where] + np.uint64(77))
        lo, hi = np.searchsorted(index.seed, keys, "left"), np.searchsorted(index.seed, keys, "right")
        have = hi > lo
        where, lo, n = where[have], lo[have], (hi - lo)[have]
        a = 0
        while a < len(where):  # entries of a common seed are expanded in bounded blocks
            total = np.cumsum(n[a:])
            b = a + max(1, int(np.searchsorted(total, _BLOCK, "right")))
            reps = n[a:b]
            entry = np.repeat(lo[a:b] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
            pos = np.repeat(where[a:b], reps)
            doc = np.searchsorted(bounds, pos, "right") - 1
            key = np.unique(np.stack([doc, index.item[entry], pos - bounds[doc] - index.at[entry]], axis=1), axis=0)
            found.update(map(tuple, key.tolist()))
            a = b
    best: dict[tuple[int, int], tuple] = {}
    for doc, item, diagonal in sorted(found):
        d = h[bounds[doc] : bounds[doc + 1]]
        t = index.tokens[index.bounds[item] : index.bounds[item + 1]]
        if len(t) < p.least:
            if len(d) == len(t) and (d == t).all():
                best[doc, item] = (0, len(t), len(t), len(t))
            continue
        lo, hi = max(0, diagonal), min(len(d), diagonal + len(t))
        same = d[lo:hi] == t[lo - diagonal : hi - diagonal]
        inside = stretches(same, p, len(t))
        if inside.any():
            at = np.flatnonzero(inside)
            new = (int(lo + at[0]), int(lo + at[-1] + 1), len(at), int(same[inside].sum()))
            old = best.get((doc, item))
            if old is None or (new[2], new[3], -new[0]) > (old[2], old[3], -old[0]):
                best[doc, item] = new
    return [(doc, item, *v) for (doc, item), v in best.items()]


def _finder(shared, p: OverlapParams):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for w in words_of(batch.column("text")):
                rows = overlaps(w.hash, w.per_doc(), index, p)
                if rows:
                    cols = list(zip(*rows, strict=True))
                    doc = ids.take(pa.array(np.array(cols[0]) + w.first))
                    item = pa.array([index.ids[i] for i in cols[1]], pa.int64())
                    yield pa.RecordBatch.from_arrays([doc, item, *(pa.array(c, pa.int64()) for c in cols[2:])], names=["doc_id", "item_id", "doc_start", "doc_end", "covered", "matched"])

    return find


def _segments(items: DataFrame, p: OverlapParams) -> Iterator:
    """Broadcast indexes of bounded size that together hold all items."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.length("text") > 0)
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    segments = 1 + chars // p.segment_chars
    for k in range(segments):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(segments)) == k)
        rows = [(r.item_id, r.text) for r in own.orderBy("item_id").collect()]
        yield spark.sparkContext.broadcast(build_index(rows, p))


def contaminated(docs: DataFrame, items: DataFrame, p: OverlapParams = OverlapParams()) -> DataFrame:
    """A row for each document and benchmark item that overlap."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return reduce(DataFrame.unionAll, [docs.mapInArrow(_finder(shared, p), SCHEMA) for shared in _segments(items, p)])


def _keeper(shared, p: OverlapParams):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            for w in words_of(batch.column("text")):
                clean[[w.first + doc for doc, *_ in overlaps(w.hash, w.per_doc(), index, p)]] = False
            yield batch.filter(pa.array(clean))

    return keep


def drop_contaminated(docs: DataFrame, items: DataFrame, p: OverlapParams = OverlapParams()) -> DataFrame:
    """The rows, with all their columns, that overlap with no item; nothing is shuffled."""
    for shared in _segments(items, p):
        docs = docs.mapInArrow(_keeper(shared, p), docs.schema)
    return docs
