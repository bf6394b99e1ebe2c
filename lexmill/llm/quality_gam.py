"""A generalised additive model with pairwise interactions, for document quality.

Each feature has a lookup table over its bins, and each chosen pair of features a
table over pairs of coarser bins.  The tables are learned by cyclic boosting: in
every round each feature in turn gets one shallow tree (two cuts on its own bins)
fitted to the current residuals; then the pairs that explain most of what is left
get trees with one cut on either axis.  A score is the sum of one entry of each
table, looked up by vectorised bin additions, through the logistic function.

Features come from the bytes of the whole text and nothing else.  The model is
fitted on the driver from at most ``max_train`` labelled rows, those with the
smallest hash of their id; all other figures cover all rows.

Defined results: null and empty texts have all-zero features and a score as any
other; labels that are null count as missing; without labels of both classes the
score is the smoothed share of label 1 (0.5 without labels); a null doc_id is
scored and not held out; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textbytes import _SPACE, chunks, column_bytes, split_words

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "symbols", "pipes", "marks", "stops", "commas", "wide",
    "short_words", "inner_upper", "distinct_words", "top_word", "distinct_lines", "line_words", "log_lines", "space",
)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


_CLASSES = {
    "upper": range(65, 91), "letters": [*range(65, 91), *range(97, 123)], "digits": range(48, 58), "symbols": b"#$%&*@^~<>{}[]\\/=+_",
    "pipes": b"|", "marks": b"!?", "stops": b".", "commas": b",;:", "wide": range(192, 256), "tails": range(128, 192), "space": np.flatnonzero(_SPACE),
}


def _distinct(doc: np.ndarray, h: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document the number of distinct hashes, and the count of its commonest."""
    kinds, top = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    if len(h):
        order = np.lexsort((h, doc))
        d, s = doc[order], h[order]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] != s[:-1])]))
        kinds = np.bincount(d[new], minlength=docs)
        first = np.flatnonzero(np.concatenate([[True], np.diff(d[new]) != 0]))
        top[d[new][first]] = np.maximum.reduceat(np.diff(np.append(new, len(d))), first)
    return kinds, top


def features(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """documents x FEATURES, of a chunk."""
    w = split_words(raw, bounds)
    spectrum = np.zeros((w.docs, 256), dtype=np.int64)
    for i in range(w.docs):
        spectrum[i] = np.bincount(raw[bounds[i] : bounds[i + 1]], minlength=256)
    counts = {name: spectrum[:, list(own)].sum(axis=1).astype(float) for name, own in _CLASSES.items()}
    upper = np.concatenate([np.zeros(1, np.int32), np.cumsum((raw >= 65) & (raw <= 90), dtype=np.int32)])
    size = np.diff(bounds).astype(float)
    chars = np.maximum(size - counts["tails"], 1)
    words = np.diff(w.per_doc()).astype(float)
    per_word = np.maximum(words, 1)
    length = (w.end - w.start).astype(float)
    by_word = lambda x: np.bincount(w.doc, weights=x, minlength=w.docs) / per_word
    kinds, top = _distinct(w.doc, w.hash, w.docs)
    # lines end with a line feed or with the document
    ends = np.union1d(np.flatnonzero(raw == 10), bounds[1:][size > 0] - 1)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[: len(ends)]
    filled = ends + (raw[ends] != 10) > starts if len(ends) else np.zeros(0, bool)
    starts, stops = starts[filled], (ends + (raw[ends] != 10))[filled] if len(ends) else ends
    line_doc = np.searchsorted(bounds, starts, "right") - 1
    lines = np.bincount(line_doc, minlength=w.docs).astype(float)
    line_kinds, _ = _distinct(line_doc, w.span_hash(starts, stops), w.docs)
    out = np.stack([
        np.log1p(size), np.log1p(words), by_word(length), counts["upper"] / np.maximum(counts["letters"], 1), *(counts[k] / chars for k in ("digits", "symbols", "pipes", "marks", "stops", "commas", "wide")),
        by_word(length <= 3), by_word(upper[w.end] - upper[np.minimum(w.start + 1, w.end)] > 0), kinds / per_word, top / per_word, line_kinds / np.maximum(lines, 1), words / np.maximum(lines, 1), np.log1p(lines), counts["space"] / chars,
    ], axis=1)
    out[size == 0] = 0
    return out


def column_features(column: pa.Array) -> np.ndarray:
    raw, offsets = column_bytes(column)
    out = [features(raw[int(offsets[a]) : int(offsets[b])], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)]
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


@dataclass(frozen=True)
class GamParams:
    max_train: int = 20_000  #: labelled rows that the model is fitted on
    bins: int = 48
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 150
    pair_rounds: int = 60
    rate: float = 0.15
    least: float = 12.0  #: rows in a leaf
    smooth: float = 1.0
    threshold: float = 0.3


@dataclass
class Gam:
    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (cut, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += table[np.searchsorted(cut, x[:, f], "right")]
        for f, g, table in self.pairs:
            z += table[np.searchsorted(self.pair_cuts[f], x[:, f], "right"), np.searchsorted(self.pair_cuts[g], x[:, g], "right")]
        return 1 / (1 + np.exp(-z))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Bin edges halfway between distinct values at even ranks, so that rounding can't part equal values."""
    v = np.unique(x)
    if len(v) < 2:
        return np.zeros(0)
    q = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))
    at = np.clip(np.searchsorted(v, q, "left"), 1, len(v) - 1)
    return np.unique((v[at - 1] + v[at]) / 2)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: GamParams) -> np.ndarray:
    """Step of a tree with two cuts along an axis of bins, the second cut within the better half."""
    gain = lambda a, b: a * a / (b + p.smooth)

    def cut(a: int, b: int) -> tuple[float, int]:
        cg, ch, cn = np.cumsum(g[a:b]), np.cumsum(h[a:b]), np.cumsum(n[a:b])
        ok = (cn[:-1] >= p.least) & (cn[-1] - cn[:-1] >= p.least)
        if not ok.any():
            return 0.0, -1
        v = np.where(ok, gain(cg[:-1], ch[:-1]) + gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - gain(cg[-1], ch[-1]), -1.0)
        k = int(np.argmax(v))
        return float(v[k]), a + k + 1

    edges = [0, len(g)]
    for _ in range(2):
        best, at = max(cut(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True))
        if at < 0 or best <= 1e-9:
            break
        edges = sorted([*edges, at])
    out = np.zeros(len(g))
    if len(edges) > 2:
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + p.smooth)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: GamParams) -> tuple[float, np.ndarray]:
    """Gain and step of the best tree with one cut on each axis of a table."""
    out, best = np.zeros_like(g), 0.0
    if g.shape[0] < 2 or g.shape[1] < 2:
        return best, out
    sums = [np.cumsum(np.cumsum(x, 0), 1) for x in (g, h, n)]

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        ll = c[:-1, :-1]
        lh, hl = c[:-1, -1:] - ll, c[-1:, :-1] - ll
        return [ll, lh, hl, c[-1, -1] - ll - lh - hl]

    qg, qh, qn = map(quarters, sums)
    v = sum(a * a / (b + p.smooth) for a, b in zip(qg, qh, strict=True)) - sums[0][-1, -1] ** 2 / (sums[1][-1, -1] + p.smooth)
    i, j = np.unravel_index(int(np.argmax(v)), v.shape)
    for q, (rows, cols) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        if qn[q][i, j] >= p.least:
            out[rows, cols] = qg[q][i, j] / (qh[q][i, j] + p.smooth)
    return float(v[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, p: GamParams = GamParams()) -> Gam:
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    d = x.shape[1]
    model.cuts = [_cuts(x[:, f], p.bins) for f in range(d)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    at = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.cuts)]
    n_at = [np.bincount(b, minlength=len(t)) for b, t in zip(at, model.tables, strict=True)]
    z = np.full(len(y), model.intercept)
    for _ in range(p.rounds):
        for f in range(d):
            q = 1 / (1 + np.exp(-z))
            size = len(model.tables[f])
            step = p.rate * _tree(np.bincount(at[f], y - q, size), np.bincount(at[f], q * (1 - q), size), n_at[f], p)
            model.tables[f] += step
            z += step[at[f]]
    model.pair_cuts = [_cuts(x[:, f], p.pair_bins) for f in range(d)]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.pair_cuts)]
    size = [len(c) + 1 for c in model.pair_cuts]

    def tables(f: int, g: int, q: np.ndarray) -> list[np.ndarray]:
        cell, shape = coarse[f] * size[g] + coarse[g], (size[f], size[g])
        return [np.bincount(cell, weights, shape[0] * shape[1]).reshape(shape) for weights in (y - q, q * (1 - q), None)]

    q = 1 / (1 + np.exp(-z))
    ranked = sorted(((_pair_tree(*tables(f, g, q), p)[0], f, g) for f in range(d) for g in range(f)), reverse=True)
    model.pairs = [(f, g, np.zeros((size[f], size[g]))) for gain, f, g in ranked[: p.pairs] if gain > 0]
    for _ in range(p.pair_rounds):
        for f, g, table in model.pairs:
            step = p.rate * _pair_tree(*tables(f, g, 1 / (1 + np.exp(-z))), p)[1]
            table += step
            z += step[coarse[f], coarse[g]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = column_features(batch.column("text"))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("h"), flat], names=["y", "h", "x"])


def train(docs: DataFrame, labels: DataFrame, p: GamParams = GamParams()) -> Gam:
    """Fit on the labelled rows that are not held out, ``max_train`` at most: of documents and then of rows those with the smallest hash; every row of a document that has several labels counts once."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("y", F.xxhash64("doc_id", "text").alias("h"), "text")
    # an id may stand in any number of rows, so the bound holds before they are collected
    rows = texts.mapInArrow(_featurise, "y double, h long, x array<double>").orderBy("h", "y").limit(p.max_train).toPandas()
    # the order in which tasks end must not show in the sums
    x = np.array(rows["x"].tolist()).reshape(len(rows), len(FEATURES))
    y = rows["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order], p)


def _score_of(model: Gam, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.score(column_features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), pa.array(z)], names=[*names, "score"])

    return score


def score_quality(docs: DataFrame, labels: DataFrame, p: GamParams = GamParams()) -> DataFrame:
    """A row for each document; see SCHEMA."""
    model = train(docs, labels, p)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score_of(model, ["doc_id"]), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= p.threshold, 1).otherwise(0).cast("int").alias("predicted"))


def _keeper(model: Gam, threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(column_features(batch.column("text"))) >= threshold))

    return keep


def keep_quality(docs: DataFrame, labels: DataFrame, p: GamParams = GamParams()) -> DataFrame:
    """The rows, with all their columns, that are predicted to be of quality."""
    return docs.mapInArrow(_keeper(train(docs, labels, p), p.threshold), docs.schema)
