"""Scores of a class-based bigram model whose classes come from exchange clustering.

Counts cover every training text.  Words are told apart by their 64-bit hash.

* Vocabulary: every word that occurs ``least`` times has a class of its own, so what
  is learned grows with the corpus; rarer and unseen words have the class of one of
  ``suffix_units`` spelling units (a hash of the last three bytes).
* Codes: texts are taken apart once more and written as numbers, a word of the
  vocabulary by its place in it and another one by its spelling unit; all that follows
  reads those.  The vocabulary is broadcast for this in segments of at most
  ``segment`` words (20 bytes each), commonest words first; with more words, more
  passes are made over the codes.
* Exchange: the ``own_units`` commonest words and the spelling units come first.
  Starting from classes dealt by frequency, each in turn moves to the class that
  raises the likelihood of the class bigrams most, until nothing moves or ``sweeps``
  is reached.
* The other words of the vocabulary start from their spelling's class.  In each of
  ``rounds`` their bigrams with classes are counted over all texts as a sparse table
  (word and class, by side), and each word moves to its best class against the
  class bigrams as they stand.  Words of a round move together, so a round that
  doesn't raise the likelihood is taken back and is the last.  The driver gets the
  vocabulary's hashes and classes, and class bigrams; the executors get one byte for
  each of its words.  What the driver gets comes as Arrow columns and never as rows,
  and each broadcast but the last is destroyed as soon as its table has been written
  or fetched.  log10 p(w | v) = log10 p(class w | class v) +
  log10 p(w | class w); transitions are smoothed towards the class shares, and
  emissions by one count for each word of the class and one for unseen words.

Scoring needs each word's count.  Those of the vocabulary go with its codes; the other
words, none of which is frequent, are joined to the count table by hash.  The unigram
base is carried along.

Defined results: a null or empty text is one end token; a null doc_id counts as
training; repeated rows count and are scored one by one; without training texts
every count is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textbytes import Words, as_long, chunks, mix, words_of
from .workspace import Workspace

_FLUSH = 1 << 20


@dataclass(frozen=True)
class LmParams:
    own_units: int = 768  #: words that are exchanged one by one
    least: int = 8  #: occurrences from which a word has a class of its own
    rounds: int = 2  #: batches of moves of the other words of the vocabulary
    suffix_units: int = 256
    classes: int = 64
    sweeps: int = 8
    segment: int = 4_000_000  #: words of the vocabulary in a broadcast
    beta: float = 1.0  #: weight of the class shares in a transition
    folds: int = 7
    held: int = 2

    @property
    def units(self) -> int:
        return self.own_units + self.suffix_units


def held_out(doc_id: Column, p: LmParams) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % p.folds == p.held, F.lit(False))


def suffix_unit(w: Words, p: LmParams) -> np.ndarray:
    """Spelling unit of each word, counted from 0."""
    key = np.zeros(len(w.hash), dtype=np.uint64)
    for back in (1, 2, 3):
        at = w.end - back
        key = key * np.uint64(257) + np.where(at >= w.start, w.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return (mix(key) % np.uint64(p.suffix_units)).astype(np.int64)


def columns_of(df: DataFrame) -> dict[str, np.ndarray]:
    """All of a table without nulls, for the driver: a row as a Python object takes some hundreds of bytes."""
    got = df.toArrow()
    return {k: got.column(k).to_numpy() for k in got.column_names}


@contextmanager
def lent(spark: SparkSession, value) -> Iterator[Broadcast]:
    """A broadcast for tables that are written or fetched in the block; the driver and the executors keep nothing of it."""
    shared = spark.sparkContext.broadcast(value)
    try:
        yield shared
    finally:
        shared.destroy()


def _summed(h: np.ndarray, unit: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, unit, c = h[order], unit[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], unit[first], np.add.reduceat(c, first) if len(h) else c


def _counter(p: LmParams):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def out() -> pa.RecordBatch:
            h, unit, c = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(as_long(h)), pa.array(unit), pa.array(c)], names=["h", "unit", "c"])

        for batch in batches:
            for w in words_of(batch.column("text")):
                held.append(_summed(w.hash, suffix_unit(w, p), np.ones(len(w.hash), np.int64)))
                rows += len(held[-1][0])
                if rows >= _FLUSH:
                    yield out()
                    rows = 0
        if held:
            yield out()

    return count


_CODED = "rid long, doc_id long, train boolean, known long, logs double, codes binary, open array<long>"


def _resolved(codes: np.ndarray, doc: np.ndarray, h: np.ndarray, docs: int, segment) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the tokens, which of ``h`` (those of the negative codes) are still open, and by document the number and the summed logs of the others."""
    own, logs, places = segment
    at = np.flatnonzero(codes < 0)
    if not len(own) or not len(at):
        return codes, np.ones(len(at), bool), np.zeros(docs, np.int64), np.zeros(docs)
    place = np.minimum(np.searchsorted(own, h), len(own) - 1)
    hit = own[place] == h
    codes = codes.copy()
    codes[at[hit]] = places[place[hit]]
    of = doc[at[hit]]
    return codes, ~hit, np.bincount(of, minlength=docs), np.bincount(of, logs[place[hit]], docs)


def _coder(shared, p: LmParams):
    """Texts to codes: places in the first segment of the vocabulary, or -1 - the spelling unit."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = shared.value
        for batch in batches:
            for w in words_of(batch.column("text")):
                codes, left, known, logs = _resolved(-1 - suffix_unit(w, p), w.doc, w.hash, w.docs, segment)
                yield _coded(*(batch.column(k).slice(w.first, w.docs) for k in ("rid", "doc_id", "train")), known, logs, codes, w.per_doc(), w.hash[left], w.doc[left])

    return code


def _coded(rid, doc_id, train, known: np.ndarray, logs: np.ndarray, codes: np.ndarray, bounds: np.ndarray, h: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    data = codes.astype("<i4").tobytes()
    blobs = pa.array([data[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())
    open_ = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(bounds))).astype(np.int32)), pa.array(as_long(h)))
    return pa.RecordBatch.from_arrays([rid, doc_id, train, pa.array(known, pa.int64()), pa.array(logs, pa.float64()), blobs, open_], names=["rid", "doc_id", "train", "known", "logs", "codes", "open"])


def coded_texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets into the codes, document and code of each token), about a megabyte of codes at a time."""
    column = batch.column("codes")
    column = column.cast(pa.large_binary()) if pa.types.is_binary(column.type) else column
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    for a, b in chunks(offsets):
        part = np.frombuffer(raw[int(offsets[a]) : int(offsets[b])].tobytes(), dtype="<i4").astype(np.int64)
        bounds = (offsets[a : b + 1] - offsets[a]) // 4
        yield a, b, bounds, np.repeat(np.arange(b - a), np.diff(bounds)), part


def _recoder(shared):
    """The same for the words of a further segment."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = shared.value
        for batch in batches:
            lists = batch.column("open")
            off, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b, bounds, doc, codes in coded_texts(batch):
                h = flat[off[a] : off[b]]
                of = np.repeat(np.arange(b - a), np.diff(off[a : b + 1]))
                codes, left, known, logs = _resolved(codes, doc, h, b - a, segment)
                known = known + batch.column("known").to_numpy()[a:b]
                logs = logs + batch.column("logs").to_numpy()[a:b]
                yield _coded(*(batch.column(k).slice(a, b - a) for k in ("rid", "doc_id", "train")), known, logs, codes, bounds, h[left], of[left])

    return code


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, h, tf) of the words that are open, each once for its text."""
    for batch in batches:
        lists = batch.column("open")
        off, h = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        h, of = h[off[0] : off[-1]], np.repeat(np.arange(len(lists)), np.diff(off))
        order = np.lexsort((h, of))
        h, of = h[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])])) if len(h) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("rid").take(pa.array(of[first])), pa.array(h[first]), pa.array(np.diff(np.append(first, len(h))).astype(np.int64))], names=["rid", "h", "tf"])


def steps(bounds: np.ndarray, doc: np.ndarray, unit: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, unit before, unit) of all tokens, ends included; ``edge`` is the start before and the end after."""
    docs = len(bounds) - 1
    # one place more in each document, for its end
    after = np.full(len(unit) + docs, edge, dtype=np.int64)
    after[np.arange(len(unit)) + doc] = unit
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[bounds[:-1] + np.arange(docs)] = edge
    return np.repeat(np.arange(docs), np.diff(bounds) + 1), before, after


def _pairer(shared, k: int):
    """Bigrams of ``k`` kinds and the edge; the broadcast has the kind of each code, first those from -1 downwards and then those from 0."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, units = shared.value
        total = np.zeros((k + 1) ** 2, dtype=np.int64)
        for batch in batches:
            for _, _, bounds, doc, codes in coded_texts(batch):
                _, before, after = steps(bounds, doc, kind[_at(codes, units)], k)
                cell, c = np.unique(before * (k + 1) + after, return_counts=True)
                total[cell] += c
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "c"])

    return pair


def _at(codes: np.ndarray, units: int) -> np.ndarray:
    """Place of a code's kind: the spelling units stand before the words."""
    return np.where(codes < 0, -1 - codes, codes + units)


def _contexts(shared, core: int, p: LmParams):
    """Sparse counts of the words in batches: (word, place in its row, c); classes after it, classes before it, and itself after itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, units, _ = shared.value
        side = p.classes + 1
        width = 2 * side + 1
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        rows = 0

        def out() -> pa.RecordBatch:
            key, c = np.concatenate(held), np.concatenate(counts)
            order = np.argsort(key, kind="stable")
            key, c = key[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, c = key[first], np.add.reduceat(c, first)
            held.clear()
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(key // width), pa.array((key % width).astype(np.int16)), pa.array(c.astype(np.int32))], names=["word", "slot", "c"])

        for batch in batches:
            for _, _, bounds, doc, codes in coded_texts(batch):
                # the commonest words come first in the vocabulary, and have moved before
                _, before, after = steps(bounds, doc, cls[_at(codes, units)], p.classes)
                _, left, right = steps(bounds, doc, np.where(codes >= core, codes, -1), -1)
                a, b = left >= 0, right >= 0
                twice = a & (left == right)
                key = np.concatenate([left[a] * width + after[a], right[b] * width + side + before[b], left[twice] * width + 2 * side])
                if len(key):
                    key, c = np.unique(key, return_counts=True)
                    held.append(key)
                    counts.append(c)
                    rows += len(key)
                if rows >= 2 * _FLUSH:
                    yield out()
                    rows = 0
        if held:
            yield out()

    return count


def best_classes(word: np.ndarray, slot: np.ndarray, c: np.ndarray, cls: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, class) of the words that gain by leaving ``cls``; rows are sorted by word, ``g`` counts the bigrams of classes with the edge last."""
    side = len(g)
    k = side - 1
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words, at = word[first], np.cumsum(np.concatenate([[True], word[1:] != word[:-1]])) - 1
    n = len(words)
    rl = np.zeros((2, n, side))
    mine = np.zeros(n)
    right, left, self_ = slot < side, (slot >= side) & (slot < 2 * side), slot == 2 * side
    rl[0, at[right], slot[right]] = c[right]
    rl[1, at[left], slot[left] - side] = c[left]
    mine[at[self_]] = c[self_]
    own = cls[words].astype(np.int64)
    rows = np.arange(n)
    out_of, into = rl[0].sum(1), rl[1].sum(1)
    # its bigrams with itself move with it
    rl[0, rows, own] -= mine
    rl[1, rows, own] -= mine
    r, l = rl
    # cell (b, b) without the word: both of its parts leave, and its bigrams with itself
    diag = np.tile(np.diagonal(g)[:k], (n, 1))
    diag[rows, own] -= r[rows, own] + l[rows, own] + mine
    gain = _xlogx(diag + r[:, :k] + l[:, :k] + mine[:, None]) - _xlogx(diag + r[:, :k]) - _xlogx(diag + l[:, :k]) + _xlogx(diag)
    # only the cells of the classes around it change
    for near, far, cells in ((r, l, g), (l, r, g.T)):
        i, c = np.nonzero(near)
        if not len(i):
            continue
        v = near[i, c]
        now = cells[:k, c].T.copy()
        here = c == own[i]
        now[here] -= far[i[here], :k]
        now[np.arange(len(i)), own[i]] -= v
        inner = np.flatnonzero(c < k)
        now[inner, c[inner]] = diag[i[inner], c[inner]]
        heads = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
        gain[i[heads]] += np.add.reduceat(_xlogx(now + v[:, None]) - _xlogx(now), heads)
    for total, part in ((g.sum(1)[:k], out_of), (g.sum(0)[:k], into)):
        left_over = np.tile(total, (n, 1))
        left_over[rows, own] -= part
        gain -= _xlogx(left_over + part[:, None]) - _xlogx(left_over)
    best = gain.argmax(1)
    go = gain[rows, best] > gain[rows, own] + 1e-9
    return words[go], best[go]


def _mover(shared):
    """Rows come sorted by word; a word's rows are never parted."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, units, g = shared.value
        cls = cls[units:]
        rest = [np.zeros(0, np.int64)] * 3

        def out(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            # rows of one cell from several tasks
            first = np.flatnonzero(np.concatenate([[True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])]))
            cols = [cols[0][first], cols[1][first], np.add.reduceat(cols[2], first)]
            # a few thousand words at a time: the working set is dense
            starts = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]]))[::2048]
            for a, b in zip(starts, np.append(starts[1:], len(cols[0])), strict=True):
                words, to = best_classes(*(x[a:b] for x in cols), cls, g)
                yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(to.astype(np.int32))], names=["word", "cls"])

        for batch in batches:
            cols = [np.concatenate([x, batch.column(k).to_numpy().astype(np.int64)]) for x, k in zip(rest, ("word", "slot", "c"), strict=True)]
            if not len(cols[0]):
                continue
            whole = int(np.searchsorted(cols[0], cols[0][-1]))
            rest = [x[whole:] for x in cols]
            if whole:
                yield from out([x[:whole] for x in cols])
        if len(rest[0]):
            yield from out(rest)

    return move


def likelihood(g: np.ndarray) -> float:
    return float(_xlogx(g).sum() - _xlogx(g.sum(0)).sum() - _xlogx(g.sum(1)).sum())


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(n: np.ndarray, p: LmParams) -> np.ndarray:
    """Classes of the units, by exchange over their bigram counts ``n``."""
    u, k = len(n), p.classes
    weight = n.sum(0) + n.sum(1)
    order = np.argsort(-weight, kind="stable")
    cls = np.empty(u, dtype=np.int64)
    cls[order] = np.arange(u) % k
    hot = np.eye(k, dtype=np.int64)[cls]
    to, by = n @ hot, hot.T @ n  # unit -> class, class -> unit
    g = hot.T @ to
    for _ in range(p.sweeps):
        moved = 0
        for i in order:
            if not weight[i]:
                continue
            a, r, l, own = cls[i], to[i].copy(), by[:, i].copy(), n[i, i]
            # take it out of its class
            g[a, :] -= r
            g[:, a] -= l
            g[a, a] += own
            r[a] -= own
            l[a] -= own
            rows, cols = g.sum(1), g.sum(0)
            gain = (_xlogx(g + r[None, :]) - _xlogx(g)).sum(1) + (_xlogx(g + l[:, None]) - _xlogx(g)).sum(0)
            diag = np.diagonal(g)
            gain += _xlogx(diag + r + l + own) - _xlogx(diag + r) - _xlogx(diag + l) + _xlogx(diag)
            out, into = r.sum() + own, l.sum() + own
            gain -= _xlogx(rows + out) - _xlogx(rows) + _xlogx(cols + into) - _xlogx(cols)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            r[b] += own
            l[b] += own
            g[b, :] += r
            g[:, b] += l
            g[b, b] -= own
            if b != a:
                moved += 1
                cls[i] = b
                to[:, a] -= n[:, i]
                to[:, b] += n[:, i]
                by[a, :] -= n[i, :]
                by[b, :] += n[i, :]
        if not moved:
            break
    return cls


@dataclass
class Model:
    own: np.ndarray  #: hashes of the vocabulary, sorted within each segment
    cls: np.ndarray  #: its classes
    unit_cls: np.ndarray  #: classes of the spelling units
    move: np.ndarray  #: log10 of transitions
    room: np.ndarray  #: log10 of the emissions' denominators, by class; 0 for the end
    ends: int  #: training texts
    tokens: int
    kinds: int

    @property
    def base_room(self) -> float:
        return float(np.log10(self.tokens + self.kinds + 1))


def _scorer(shared, p: LmParams):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, units, move, room, ends, base_room = shared.value
        log_end = float(np.log10(ends + 1.0))
        for batch in batches:
            known, logs = batch.column("known").to_numpy(), batch.column("logs").to_numpy()
            for a, b, bounds, of, codes in coded_texts(batch):
                doc, before, cls = steps(bounds, of, kind[_at(codes, units)], p.classes)
                n = np.diff(bounds) + 1
                moves = np.bincount(doc, move[before, cls] - room[cls], b - a)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k).slice(a, b - a) for k in ("rid", "doc_id")), pa.array(n), pa.array(known[a:b] + (ends > 0)), pa.array(logs[a:b] + log_end - n * base_room),
                    # the end's emission is certain, so its count has no part in the model's score
                    pa.array(moves + logs[a:b]),
                ], names=["rid", "doc_id", "n", "known", "base", "score"])

    return score


@dataclass
class Vocabulary:
    hash: np.ndarray
    unit: np.ndarray
    count: np.ndarray
    segments: list[tuple[int, int]]  #: of places; hashes are sorted within each
    core: int  #: places of the words that are exchanged one by one


def vocabulary(counts: DataFrame, p: LmParams) -> Vocabulary:
    """The ``own_units`` commonest words and all that occur ``least`` times; the former come first, and all in segments by count."""
    cols = [F.col("h"), F.col("unit").cast("int").alias("unit"), F.col("c")]
    # those that occur less often are no part of the others
    common = counts.orderBy(F.desc("c"), "h").limit(p.own_units).filter(F.col("c") < p.least)
    got = columns_of(counts.filter(F.col("c") >= p.least).unionAll(common).select(*cols))
    h, c = got["h"], got["c"]
    core = min(p.own_units, len(h))
    edges = [0, *([core] if 0 < core < len(h) else []), *range(core + p.segment, len(h), p.segment), len(h)]
    segments = [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]
    order = np.lexsort((h, -c))
    h = h.view(np.uint64)
    for a, b in segments:
        order[a:b] = order[a:b][np.argsort(h[order[a:b]], kind="stable")]
    return Vocabulary(h[order], got["unit"][order], c[order], segments, core)


def coded(docs: DataFrame, v: Vocabulary, ws: Workspace, p: LmParams) -> DataFrame:
    """The table _CODED of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    # the first segment is the core, which is small, and goes with the next one
    parts = [(v.segments[0][0], v.segments[1][1]), *v.segments[2:]] if len(v.segments) > 1 else v.segments or [(0, 0)]
    now = None
    for k, (a, b) in enumerate(parts):
        order = np.argsort(v.hash[a:b], kind="stable")
        place = (a + order).astype(np.int32)
        with lent(spark, (v.hash[place], np.log10(v.count[place] + 1.0), place)) as shared:
            if now is None:
                rows = docs.withColumns({"rid": F.monotonically_increasing_id(), "train": ~held_out(F.col("doc_id"), p)}).select("rid", "doc_id", "train", "text")
                made = rows.mapInArrow(_coder(shared, p), _CODED)
            else:
                made = now.mapInArrow(_recoder(shared), _CODED)
            now = ws.save(made, f"coded-{k}", "zstd")
        if k:
            ws.drop(f"coded-{k - 1}")
    return now


def learn(docs: DataFrame, ws: Workspace, p: LmParams = LmParams()) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the coded texts, and the table (h, c) of the words beyond its vocabulary."""
    spark = docs.sparkSession
    training = docs.filter(~held_out(F.col("doc_id"), p)).select("text")
    counted = training.mapInArrow(_counter(p), "h long, unit long, c long").groupBy("h").agg(F.min("unit").alias("unit"), F.sum("c").alias("c"))
    counts = ws.save(counted, "counts")
    ends = training.count()
    sums = counts.agg(F.count("*").alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()
    v = vocabulary(counts, p)
    texts = coded(docs, v, ws, p)
    codes = texts.filter("train").select("codes")

    def bigrams(kind: np.ndarray, k: int) -> np.ndarray:
        with lent(spark, (kind, p.suffix_units)) as shared:
            cells = columns_of(codes.mapInArrow(_pairer(shared, k), "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")))
        out = np.zeros((k + 1) ** 2, dtype=np.int64)
        out[cells["cell"]] = cells["c"]
        return out.reshape(k + 1, k + 1)

    # the first exchange: the commonest words, and the spelling units for all others
    spelling = np.arange(p.suffix_units)
    n = bigrams(np.concatenate([p.own_units + spelling, np.arange(v.core), p.own_units + v.unit[v.core :]], dtype=np.int32, casting="same_kind"), p.units)
    first = exchange(n[:-1, :-1], p)
    unit_cls = first[p.own_units :].astype(np.uint8 if p.classes <= 256 else np.int32)
    own_cls = unit_cls[v.unit]
    own_cls[: v.core] = first[: v.core]
    cls = np.concatenate([unit_cls, own_cls])
    hot = np.eye(p.classes + 1, dtype=np.int64)[np.append(first, p.classes)]
    g = (hot.T @ n @ hot).astype(float)
    for _ in range(p.rounds if len(v.hash) > v.core else 0):
        with lent(spark, (cls, p.suffix_units, g)) as shared:
            table = codes.mapInArrow(_contexts(shared, v.core, p), "word long, slot short, c int")
            moves = columns_of(table.repartition("word").sortWithinPartitions("word", "slot").mapInArrow(_mover(shared), "word int, cls int"))
        if not len(moves["word"]):
            break
        new = cls.copy()
        new[p.suffix_units + moves["word"]] = moves["cls"]
        now = bigrams(new, p.classes).astype(float)
        if likelihood(now) <= likelihood(g):
            break
        cls, g = new, now

    share = (g.sum(0) + 1) / (g.sum() + p.classes + 1)
    move = np.log10((g + p.beta * share) / (g.sum(1, keepdims=True) + p.beta))
    kinds_rare = np.zeros(p.suffix_units, dtype=np.int64)
    for r in counts.groupBy("unit").agg(F.count("*").alias("n")).collect():
        kinds_rare[r.unit] = r.n
    kinds_rare -= np.bincount(v.unit, minlength=p.suffix_units)
    kinds = np.bincount(cls[: p.suffix_units], kinds_rare, p.classes) + np.bincount(cls[p.suffix_units :], minlength=p.classes)
    room = np.append(np.log10(g.sum(0)[:-1] + kinds + 1), 0.0)
    model = Model(v.hash, cls[p.suffix_units :], cls[: p.suffix_units], move, room, ends, sums.c + ends, sums.n + (ends > 0))
    # words of the vocabulary are no longer open, so the whole table may be joined
    return model, texts, counts.select("h", "c")


def score_texts(docs: DataFrame, p: LmParams = LmParams(), ws: Workspace | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each row."""
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "brown")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model, texts, counts = learn(docs, ws, p)
    shared = spark.sparkContext.broadcast((np.concatenate([model.unit_cls, model.cls]), p.suffix_units, model.move, model.room, model.ends, model.base_room))
    scored = texts.select("rid", "doc_id", "known", "logs", "codes").mapInArrow(_scorer(shared, p), "rid long, doc_id long, n long, known long, base double, score double")
    # rid and the words that go with it were written by one and the same task
    rest = texts.select("rid", "open").mapInArrow(_rare, "rid long, h long, tf long")
    found = rest.join(counts.filter(F.col("c") < p.least), "h").groupBy("rid").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("more"), F.sum("tf").alias("seen"))
    out = scored.join(found, "rid", "left")
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    score = F.col("score") + more
    return out.select(
        "doc_id", held_out(F.col("doc_id"), p).alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + seen).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n")).alias("perplexity"),
    )
