"""Suffix sorting by induction, with disk-backed queues, as deep as a given length.

The suffixes that begin a fall-and-rise (leftmost S-type) are sorted first: their
pieces are named in order, and the string of names is sorted by doubling ranks.
All others are induced: buckets are taken in order of their symbol, and every
sorted suffix hands the one before it to the queue of that one's symbol, first
the L-type ones upwards and then the S-type ones downwards.  The queues hold
(symbol, order, position) as position runs by symbol and spill to a file beyond
``limit`` bytes, and large arrays are mapped from files, so a text may exceed
memory.

Order is exact for the first ``depth`` symbols; suffixes equal so far come in any
order, which is enough to bring equal strings of that length side by side.
"""

from __future__ import annotations

import tempfile

import numpy as np

from .textbytes import _U, mix, powers

LIMIT = 256 << 20


def array(n: int, dtype, limit: int = LIMIT) -> np.ndarray:
    """Empty; in a nameless file if it is large."""
    if n * np.dtype(dtype).itemsize <= limit:
        return np.empty(n, dtype=dtype)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, dtype=dtype, mode="w+", shape=(n,))


class Queues:
    """A queue of positions for each symbol, in memory up to ``limit`` bytes and in a file beyond."""

    def __init__(self, symbols: int, limit: int = LIMIT) -> None:
        self.runs: list[list] = [[] for _ in range(symbols)]
        self.limit, self.held, self.file = limit, 0, None

    def push(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """Append the positions, in this order, each to its symbol's queue."""
        order = np.argsort(symbols, kind="stable")
        symbols, positions = symbols[order], positions[order]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if len(symbols) else []
        for a, b in zip(first, np.append(first[1:], len(symbols)).astype(int) if len(symbols) else [], strict=True):
            self.runs[symbols[a]].append(positions[a:b])
        self.held += positions.nbytes
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for queue in self.runs:
            for i, run in enumerate(queue):
                if isinstance(run, np.ndarray):
                    queue[i] = (self.file.seek(0, 2), len(run))
                    self.file.write(run.tobytes())
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        out = []
        for run in self.runs[symbol]:
            if isinstance(run, tuple):
                self.file.seek(run[0])
                run = np.frombuffer(self.file.read(run[1] * 8), dtype=np.int64)
            else:
                self.held -= run.nbytes
            out.append(run)
        self.runs[symbol] = []
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def s_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is."""
    n = len(t)
    turn = np.where(t[:-1] != t[1:], np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(turn[::-1])[::-1]
    out = np.ones(n, dtype=bool)
    inner = at < n - 1
    out[:-1][inner] = t[at[inner]] < t[at[inner] + 1]
    out[:-1][~inner] = False
    return out


def _inverse(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].reshape(-1)


def names(t: np.ndarray, s: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the pieces from one leftmost S-type position to the next; symbols are compared with their types."""
    size = np.append(np.diff(lms) + 1, 1)
    typed = np.concatenate([t.astype(np.int64) * 2 + s, np.zeros(6, np.int64)])

    def word(rows: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(rows), dtype=np.int64)
        for j in range(6 * k, 6 * k + 6):
            out = out * 1024 + np.where(size[rows] > j, typed[np.minimum(lms[rows] + j, len(typed) - 1)], 0)
        return out

    rank, k = _inverse(word(np.arange(len(lms)), 0)), 1
    while 6 * k <= depth + 6 and len(rows := np.flatnonzero(size > 6 * k)):
        more = _inverse(word(rows, k)) + 1
        key = rank * (int(more.max()) + 1)
        key[rows] += more
        rank, k = _inverse(key), k + 1
    return rank


def sort_names(rank: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, by doubling; only groups still tied are gone through again."""
    n = len(rank)
    count = np.bincount(rank)
    place = np.concatenate([[0], np.cumsum(count)[:-1]])[rank]  # first place of each group
    tied = np.flatnonzero(count[rank] > 1)
    h = 1
    while len(tied) and h < depth:
        nxt = np.where(tied + h < n, place[np.minimum(tied + h, n - 1)] + 1, 0)
        order = np.lexsort((nxt, place[tied]))
        rows, group, nxt = tied[order], place[tied][order], nxt[order]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new = new_group | np.concatenate([[True], nxt[1:] != nxt[:-1]])
        at = np.arange(len(rows))
        offset = at - np.maximum.accumulate(np.where(new_group, at, 0))
        head = np.maximum.accumulate(np.where(new, at, 0))
        place[rows] = group + offset[head]
        tied = np.sort(rows[~(new & np.append(new[1:], True))])
        h *= 2
    return np.argsort(place, kind="stable")


def suffix_order(t: np.ndarray, depth: int, limit: int = LIMIT) -> np.ndarray:
    """Positions of all suffixes of ``t`` in order; its last symbol must be 0 and the only one."""
    n = len(t)
    symbols = int(t.max()) + 1
    s = s_types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    order = lms[sort_names(names(t, s, lms, depth), depth)] if len(lms) else lms

    seeds, up = Queues(symbols, limit), Queues(symbols, limit)
    seeds.push(t[order], order)
    out = array(n, np.int64, limit)
    total = np.bincount(t, minlength=symbols)
    ends = np.cumsum(total)
    filled = ends - total  # L-type positions go to the front of each bucket
    for c in range(symbols):
        wave = up.pop(c)
        while True:
            if len(wave):
                out[filled[c] : filled[c] + len(wave)] = wave
                filled[c] += len(wave)
            else:
                wave = seeds.pop(c)
                if not len(wave):
                    break
            before = wave[wave > 0] - 1
            before = before[~s[before]]
            up.push(t[before], before)
            wave = up.pop(c)
    down = Queues(symbols, limit)
    down.push(t[-1:], np.array([n - 1]))
    back = ends.copy()  # S-type positions go to the back, from the end
    for c in range(symbols - 1, -1, -1):
        large = out[ends[c] - total[c] : filled[c]][::-1]
        wave = down.pop(c)
        while True:
            if len(wave):
                out[back[c] - len(wave) : back[c]] = wave[::-1]
                back[c] -= len(wave)
            elif len(large):
                wave, large = np.array(large), large[:0]
            else:
                break
            before = wave[wave > 0] - 1
            before = before[s[before]]
            down.push(t[before], before)
            wave = down.pop(c)
    return out


def repeated_starts(pieces: list[bytes], length: int, limit: int = LIMIT, starts: list[int] | None = None, passage: int | None = None, owners: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each piece, which of its strings of ``length`` bytes also start anywhere else in the pieces, and which of its first ``starts`` strings of ``passage`` bytes also start in a piece of another owner.

    A piece of owner -1 stands in several texts, so its strings are another owner's to all.
    """
    passage = passage or length
    sizes = np.array([len(x) for x in pieces], dtype=np.int64)
    most = np.maximum(sizes - passage + 1, 0)
    first = most if starts is None else np.minimum(np.array(starts, dtype=np.int64), most)
    owner = np.arange(len(pieces)) if owners is None else np.array(owners, dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    heads = ends - 1 - sizes
    raw = np.frombuffer(b"\0".join(pieces) + b"\0\0", dtype=np.uint8)
    n = len(raw)
    t = array(n, np.uint16, limit)
    t[:] = raw
    t += 2
    t[ends - 1] = 1
    t[n - 1] = 0
    starting = np.zeros(n, dtype=bool)
    long = np.zeros(n, dtype=bool)
    for a, k, m in zip(heads, sizes, first, strict=True):
        starting[a : a + m] = True
        long[a : a + max(0, k - length + 1)] = True
    long &= starting
    order = suffix_order(t, length, limit)
    order = order[starting[order]]
    again, shared = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if len(order):
        power, inverse = powers(n + 1)
        total = np.zeros(n + 1, dtype=_U)
        np.cumsum((raw.astype(_U) + _U(1)) * power[:n], out=total[1:])

        def alike(rows: np.ndarray, size: int) -> np.ndarray:
            """Whether each position's string is that of the position before it."""
            h = (total[rows + size] - total[rows]) * inverse[rows]
            near = np.flatnonzero(h[1:] == h[:-1])
            out = np.zeros(len(rows), dtype=bool)
            out[near[_equal(raw, rows[near], rows[near + 1], size)] + 1] = True
            return out

        rows = order[long[order]]
        if len(rows) > 1:
            same = alike(rows, length)
            again[rows[same]] = True
            again[rows[np.flatnonzero(same) - 1]] = True
        group = np.flatnonzero(~alike(order, passage))
        own = owner[np.searchsorted(ends, order, "right")]
        low, high = np.minimum.reduceat(own, group), np.maximum.reduceat(own, group)
        shared[order] = np.repeat((low != high) | (low < 0), np.diff(np.append(group, len(order))))
    return [(again[a : a + max(0, k - length + 1)], shared[a : a + m]) for a, k, m in zip(heads, sizes, first, strict=True)]


def _equal(raw: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at a and b are equal.  The common prefix of a pair is that of the pair one place before, less one, so only its last byte is read anew."""
    if not len(a):
        return np.zeros(0, dtype=bool)
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    head = np.concatenate([[True], (b[1:] != b[:-1] + 1) | (a[1:] != a[:-1] + 1)])
    good = raw[a + length - 1] == raw[b + length - 1]
    for i in np.flatnonzero(head):
        good[i] = raw[a[i] : a[i] + length].tobytes() == raw[b[i] : b[i] + length].tobytes()
    # a chain breaks where a byte differs; what follows there is compared in full
    broken = np.flatnonzero(~good)
    for i in broken:
        j = i + 1
        while j < len(a) and not head[j] and j - i < length:
            good[j] = raw[a[j] : a[j] + length].tobytes() == raw[b[j] : b[j] + length].tobytes()
            j += 1
    out = np.empty(len(a), dtype=bool)
    out[order] = good
    return out
