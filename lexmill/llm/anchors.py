"""Anchors of fixed-length byte strings: the content-chosen places by which equal strings are brought together.

Every string of ``length`` bytes has one anchor: of the ``gram``-byte pieces in it,
the one with the smallest hash (by its upper 32 bits, the leftmost of equals).
Equal strings have equal anchors at equal offsets, so a string can only occur twice
if its anchor's hash does.
"""

from __future__ import annotations

import numpy as np

from .textbytes import _U, mix, powers

GRAM = 32


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    n = len(raw)
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum((raw.astype(_U) + _U(1)) * power[:n], out=total[1:])
    return mix((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])


def sliding_least(key: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours, from least-so-far runs over blocks of w."""
    n = len(key)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=_U)
    padded[:n] = key
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def anchor_runs(raw: np.ndarray, bounds: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, anchor hash, first start, last start, anchors) of the runs of strings with one anchor hash, starts counted within their document."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, np.zeros(0, _U), none, none, none
    h = gram_hashes(raw, gram)
    at = np.arange(len(h), dtype=_U)
    best = sliding_least((h >> _U(32) << _U(32)) | at, length - gram + 1)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b - a >= length] or [none])
    if not len(starts):
        return none, np.zeros(0, _U), none, none, none
    place = (best[starts] & _U(0xFFFFFFFF)).astype(np.int64)
    value = h[place]
    doc = np.searchsorted(bounds, starts, "right") - 1
    # neighbours whose anchors are equal strings belong together, as in periodic texts
    new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.append(new[1:], len(starts)) - 1
    lo = bounds[doc[new]]
    moves = np.concatenate([[0], np.cumsum(place[1:] != place[:-1])])
    return doc[new], value[new], starts[new] - lo, starts[last] - lo, moves[last] - moves[new] + 1
