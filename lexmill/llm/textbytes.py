"""Vectorised tokenising and hashing of Arrow string columns, straight on their bytes.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased; every such byte is ASCII, so UTF-8 sequences stay whole.  A batch is
cut into chunks of whole documents near ``CHUNK`` bytes, so the working set of
the numpy passes is bounded by the longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Odd multipliers by word position inside a shingle.
_STEP = np.array([pow(0xD1342543DE82EF95, i + 1, 1 << 64) | 1 for i in range(64)], dtype=_U)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift multiply); returns a new array."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, dtype=_U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=_U))
        if size > 8 * CHUNK:  # one huge document: not kept for the worker's life
            return out[0], out[1]
        _powers[:] = out
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of a chunk of documents: byte spans, hashes and the document of each."""

    first: int  #: row of the chunk's first document in its batch
    docs: int  #: number of documents
    data: np.ndarray  #: lower-cased bytes
    bounds: np.ndarray  #: docs + 1 byte offsets into data
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray  #: row of the word's document, counted from ``first``
    total: np.ndarray  #: running polynomial sums, for hashes of other spans

    def per_doc(self) -> np.ndarray:
        """docs + 1 offsets into the words."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverse = powers(len(self.data) + 1)
        h = (self.total[end] - self.total[start]) * inverse[start]
        return mix(h + (end - start).astype(_U) * _U(0xA24BAED4963EE407))

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of documents of about ``limit`` bytes together, one document at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def words_of(column: pa.Array, limit: int = CHUNK) -> Iterator[Words]:
    raw, offsets = column_bytes(column)
    for a, b in chunks(offsets, limit):
        lo, hi = int(offsets[a]), int(offsets[b])
        yield split_words(raw[lo:hi], offsets[a : b + 1] - lo, a)


def split_words(raw: np.ndarray, bounds: np.ndarray, first: int = 0) -> Words:
    data = _LOWER[raw]
    n = len(data)
    solid = np.zeros(n + 2, dtype=np.int8)
    solid[1:-1] = ~_SPACE[data]
    step = np.diff(solid)
    inner = bounds[1:-1]
    # a document's end cuts a word even without white space
    cut = inner[(inner > 0) & (inner < n)]
    starts = step == 1
    ends = step == -1
    if len(cut):
        both = cut[(solid[cut] == 1) & (solid[cut + 1] == 1)]
        starts[both] = True
        ends[both] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum((data.astype(_U) + _U(1)) * power[:n], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    h = mix(h + (end - start).astype(_U) * _U(0xA24BAED4963EE407))
    doc = np.searchsorted(bounds, start, "right") - 1
    return Words(first, len(bounds) - 1, data, bounds, start, end, h, doc, total)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all runs of k words, in order; a document of 1 to k-1 words gives its whole sequence as one."""
    n = len(w.hash)
    at = w.per_doc()
    counts = np.diff(at)
    full = max(0, n - k + 1)
    if full:
        h = np.zeros(full, dtype=_U)
        for j in range(k):
            h += w.hash[j : j + full] * _STEP[j]
        inside = w.doc[:full] == w.doc[k - 1 :]
        h, doc = mix(h[inside]), w.doc[:full][inside]
    else:
        h, doc = np.zeros(0, _U), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array([short_hash(w.hash[at[i] : at[i + 1]]) for i in short], dtype=_U)
        h, doc = np.concatenate([h, extra]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return doc, h


def short_hash(h: np.ndarray) -> np.uint64:
    n = len(h)
    return mix((h * _STEP[:n]).sum(dtype=_U, keepdims=True) + np.array([n], dtype=_U) * _U(0x8CB92BA72F3D8DD7))[0]


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
