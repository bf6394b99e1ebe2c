"""Exact removal of long repeated strings by external induced suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere else,
in the same document or another, is removed.  Passages that documents share are
reported beside that, from the same sort: strings of ``passage`` bytes that also start
in another row's text, merged into runs, of which those of ``passage_words`` words
count.  Nothing is removed for being one.

1. Each distinct text is cut into runs of strings of ``passage`` bytes that share an
   anchor (see ``anchors``).  A string can only repeat if its anchor's hash occurs
   twice, so only the pieces around such anchors go on, each with ``length`` bytes
   from its last string on; the runs of a piece and its strings never part.
2. Pieces are dealt by anchor, and each task sorts the suffixes of its pieces in
   shards (see ``suffix_sort``).  Strings that are neighbours in suffix order with a
   common prefix of ``length`` or of ``passage`` bytes repeat.  An anchor whose different pieces are
   more than a shard is parted: strings with nearly the same offset to their anchor
   go by a hash of the bytes that all such strings share, in narrowing steps down to
   the whole string.  Equal strings stay together at each step, and a shard is at
   most about twice ``shard_bytes``, or one piece of a text if that is more.  Strings
   that are still too many then have their passage in common; they are settled by
   aggregation, as there is nothing left to sort.
3. Their spans are merged per text and cut out.

Copies of a text are not compared with each other: a text that stands in several
rows repeats as a whole if it has ``length`` bytes, and takes part once.

Defined results: null and empty texts have no bytes and the digest of nothing;
texts shorter than ``length`` bytes stay whole; repeated rows, also of one doc_id,
are copies, and share their whole text; a null doc_id is carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, anchor_runs, gram_hashes, sliding_least
from .suffix_sort import repeated_starts
from .textbytes import _U, as_long, chunks, column_bytes
from .workspace import Workspace

NOTHING = hashlib.sha256(b"").hexdigest()
_BASE = "rid long, doc_id long, n_bytes long, n_words long, key string, runs array<struct<a:long,s0:long,s1:long,n:long>>"
_PIECE = "a long, key string, s0 long, n long, piece binary"  # n strings start in a piece
_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
_NAMES = ("a", "key", "s0", "n", "piece")
_SPAN = "key string, b long, e long, shared boolean"


@dataclass(frozen=True)
class SubstringParams:
    length: int = 400
    passage: int = 256  #: bytes of a string that is reported if documents share it, ``length`` at most
    passage_words: int = 50  #: words of the shortest run of such strings that counts
    shard_bytes: int = 2_000_000  #: pieces sorted together, and the most that one group of them may have
    sort_bytes: int = 128_000_000  #: memory of a sort's queues and of each of its arrays


def _runs_array(offsets: np.ndarray, a: np.ndarray, s0: np.ndarray, s1: np.ndarray, n: np.ndarray) -> pa.Array:
    fields = [pa.array(as_long(a)), pa.array(s0), pa.array(s1), pa.array(n)]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(fields, ["a", "s0", "s1", "n"]))


def _surveyor(p: SubstringParams):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                lo = int(offsets[a])
                part, bounds = raw[lo : int(offsets[b])], offsets[a : b + 1] - lo
                doc, *runs = anchor_runs(part, bounds, p.passage)
                keys = [hashlib.sha256(part[x:y]).hexdigest() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                words = [len(part[x:y].tobytes().split()) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("rid").slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array(np.diff(bounds)), pa.array(words, pa.int64()), pa.array(keys),
                    _runs_array(np.searchsorted(doc, np.arange(b - a + 1)), *runs),
                ], names=["rid", "doc_id", "n_bytes", "n_words", "key", "runs"])

    return survey


def _cutter(p: SubstringParams):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column("text"))
            for i, (key, runs) in enumerate(zip(batch.column("key").to_pylist(), batch.column("runs").to_pylist(), strict=True)):
                text = raw[int(offsets[i]) : int(offsets[i + 1])]
                rows = [(r["a"], key, r["s0"], r["s1"] - r["s0"] + 1, text[r["s0"] : r["s1"] + p.length].tobytes()) for r in runs]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=_NAMES)

    return cut


def split_piece(a: int, piece: bytes, n: int, w: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(group, first start, last start) of the ``n`` strings of a piece, by anchor and offset to it in steps of ``w``."""
    raw = np.frombuffer(piece, dtype=np.uint8)[: n + length - 1]
    h = gram_hashes(raw, GRAM)
    best = sliding_least((h >> _U(32) << _U(32)) | np.arange(len(h), dtype=_U), length - GRAM + 1)
    place = (best & _U(0xFFFFFFFF)).astype(np.int64)
    step = (place - np.arange(len(place))) // w
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (step[1:] != step[:-1])]))
    for x, y in zip(first.tolist(), [*(first[1:] - 1).tolist(), len(place) - 1], strict=True):
        at, b = int(place[x]), int(step[x])
        core = piece[at - b * w : at - (b + 1) * w + 1 + length]
        yield int.from_bytes(hashlib.blake2b(core, digest_size=8, key=b"%d %d %d" % (a, w, b)).digest(), "little", signed=True), x, y


def _splitter(w: int, p: SubstringParams):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (g, key, s0 + x, y - x + 1, piece[x : y + p.length])
                for a, key, s0, n, piece in zip(*(batch.column(k).to_pylist() for k in _NAMES), strict=True)
                for g, x, y in split_piece(a, piece, n, w, p.passage)
            ]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=_NAMES)

    return split


def settled(strings: DataFrame, p: SubstringParams) -> DataFrame:
    """Spans of pieces that hold one string each: equal ones meet by aggregation, so a group of any size is in no one task."""
    once = strings.dropDuplicates(["key", "s0"]).withColumn("head", F.substring("piece", 1, p.passage))
    heads = once.groupBy("head").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo < hi").select("head")
    again = once.filter(F.length("piece") >= p.length).groupBy("piece").agg(F.count("*").alias("c")).filter("c > 1").select("piece")
    span = lambda df, size, kind: df.select("key", F.col("s0").alias("b"), (F.col("s0") + size).alias("e"), F.lit(kind).alias("shared"))
    return span(once.join(again, "piece", "left_semi"), p.length, False).unionAll(span(once.join(heads, "head", "left_semi"), p.passage, True))


def parted(pieces: DataFrame, p: SubstringParams, ws: Workspace) -> tuple[DataFrame, DataFrame | None]:
    """The pieces with groups as their anchors, so that no group's different pieces are more than a shard; and the spans of the strings of the groups that can't be parted so."""
    done, now = None, ws.save(pieces, "hot-0")
    for k, w in enumerate(sorted({max(1, p.passage // 8), max(1, p.passage // 64), 1}, reverse=True)):
        kinds = now.groupBy("a", F.xxhash64("piece").alias("x")).agg(F.max(F.length("piece")).cast("long").alias("n"))
        big = ws.save(kinds.groupBy("a").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).filter((F.col("n") > p.shard_bytes) & (F.col("kinds") > 1)).select("a"), f"big-{k}")
        small = now.join(big, "a", "left_anti")
        done = small if done is None else done.unionByName(small)
        if big.isEmpty():
            return done, None
        split = ws.save(now.join(big, "a", "left_semi").select(*_NAMES).mapInArrow(_splitter(w, p), _PIECE), f"split-{k}")
        now = split.join(split.groupBy("a").agg(F.count("*").alias("c")).filter("c > 1").select("a"), "a", "left_semi")
        now = ws.save(now.select(*_NAMES), f"hot-{k + 1}")
        ws.drop(f"split-{k}")
    return done, settled(now, p)


def _sorter(p: SubstringParams):
    """Rows come sorted by anchor, so an anchor's pieces follow each other."""

    def runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
        edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
        yield from zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)

    def whole(key: str, s0: int, n: int, size: int, shared: bool) -> Iterator[tuple[str, int, int, bool]]:
        """Spans of a piece that stands in several places."""
        if size >= p.length:
            yield key, s0, s0 + size, False
        if shared:
            yield key, s0, s0 + n - 1 + p.passage, True

    def shard(own: dict[tuple[int, bytes], list]) -> Iterator[tuple[str, int, int, bool]]:
        pieces = [x for _, x in own]
        codes: dict[str, int] = {}
        # a piece that stands in several texts is of none
        owners = [-1 if shared else codes.setdefault(key, len(codes)) for key, _, _, shared, _ in own.values()]
        flagged = repeated_starts(pieces, p.length, p.sort_bytes, [n for _, _, n, _, _ in own.values()], p.passage, owners)
        for piece, (again, shared), (key, s0, n, common, places) in zip(pieces, flagged, own.values(), strict=True):
            if common or places:
                again = np.ones(max(0, len(piece) - p.length + 1), dtype=bool)
            if common:
                shared = np.ones(n, dtype=bool)
            for a, b in runs(again):
                yield key, s0 + a, s0 + b - 1 + p.length, False
            for a, b in runs(shared):
                for s in (s0, *places):
                    yield key, s + a, s + b - 1 + p.passage, True

    def rows(spans: list[tuple[str, int, int, bool]]) -> pa.RecordBatch:
        cols = list(zip(*spans, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["key", "b", "e", "shared"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[int, bytes], list] = {}
        size, last = 0, (None, None, None)
        for batch in batches:
            known_spans: list[tuple[str, int, int, bool]] = []
            for a, key, s0, n, piece in zip(*(batch.column(k).to_pylist() for k in _NAMES), strict=True):
                if a != last[0] and size >= p.shard_bytes:
                    yield rows(list(shard(own)))
                    own, size = {}, 0
                if (a, key, s0) == last:  # a row that is there twice is one place
                    continue
                last = (a, key, s0)
                # one and the same piece in several places repeats whole, and is sorted once
                known = own.get((a, piece))
                if known is None:
                    own[a, piece] = [key, s0, n, False, []]
                    size += len(piece)
                    continue
                known_spans += whole(key, s0, n, len(piece), key != known[0])
                if key == known[0]:  # texts come one after another, so those beyond the first one are seen later
                    known[4].append(s0)
                else:
                    known[3] = True
            if known_spans:
                yield rows(known_spans)
        if own:
            yield rows(list(shard(own)))

    return sort


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _remover(p: SubstringParams):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column("text"))
            rows = []
            for i, (key, own) in enumerate(zip(batch.column("key").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
                text = raw[int(offsets[i]) : int(offsets[i + 1])].tobytes()
                runs = merged([(s["b"], s["e"]) for s in own if not s["shared"]])
                passages = [(a, b) for a, b in merged([(s["b"], s["e"]) for s in own if s["shared"]]) if len(text[a:b].split()) >= p.passage_words]
                digest, done = hashlib.sha256(), 0
                for a, b in runs:
                    digest.update(text[done:a])
                    done = b
                digest.update(text[done:])
                rows.append((key, sum(b - a for a, b in runs), len(runs), digest.hexdigest(), sum(b - a for a, b in passages), len(passages)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["key", "removed", "spans", "kept", "shared", "passages"])

    return remove


def removed_spans(docs: DataFrame, p: SubstringParams, ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables: of all rows (rid, doc_id, n_bytes, key); of the distinct texts with a candidate (key, text); of spans (key, b, e, shared)."""
    base = ws.save(docs.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(_surveyor(p), _BASE), "base")
    one = base.groupBy("key").agg(F.min("rid").alias("rid"))
    runs = base.join(one.select("rid"), "rid", "left_semi").select("rid", F.explode("runs").alias("r"))
    seen = runs.groupBy(F.col("r.a").alias("a")).agg(F.sum("r.n").alias("c"), F.sum(F.col("r.s1") - F.col("r.s0") + p.length).alias("size")).filter("c > 1")
    hot = ws.save(seen.filter(F.col("size") > p.shard_bytes).select("a"), "hot")
    twice = seen.select("a")
    mine = runs.select("rid", "r", F.col("r.a").alias("a")).join(twice, "a", "left_semi").groupBy("rid").agg(F.collect_list("r").alias("runs"))
    wanted = mine.join(base.select("rid", F.col("doc_id").alias("id"), "key"), "rid")
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["id"])).filter(F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("key"))
    texts = ws.save(found.select("key", "text", "runs"), "texts")
    pieces = texts.mapInArrow(_cutter(p), _PIECE)
    more = None
    if not hot.isEmpty():
        few, more = parted(pieces.join(hot, "a", "left_semi").select(*_NAMES), p, ws)
        pieces = pieces.join(hot, "a", "left_anti").unionByName(few)
    pieces = pieces.repartition("a").sortWithinPartitions("a", "key", "s0")
    spans = pieces.mapInArrow(_sorter(p), _SPAN)
    spans = ws.save(spans if more is None else spans.unionByName(more), "spans")
    return base, texts, spans


def repeated_bytes(docs: DataFrame, p: SubstringParams = SubstringParams(), ws: Workspace | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared, n_passages) of each row: the last two are bytes and number of the passages that another row has too."""
    ws = ws or Workspace(docs.sparkSession, "substrings")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base, texts, spans = removed_spans(docs, p, ws)
    grouped = spans.groupBy("key").agg(F.collect_set(F.struct("b", "e", "shared")).alias("spans"))
    made = "key string, removed long, spans long, kept string, shared long, passages long"
    cut = texts.select("key", "text").join(grouped, "key").mapInArrow(_remover(p), made).dropDuplicates(["key"])
    # what holds for a text holds for its rows
    known = base.groupBy("key").agg(F.count("*").alias("copies")).join(cut, "key", "left").filter("copies > 1 or removed is not null")
    out = base.select("doc_id", "n_bytes", "n_words", "key").join(known, "key", "left")
    copied = F.col("copies") > 1
    pick = lambda hit, whole, name, none: F.when(hit, whole).otherwise(F.coalesce(name, none))
    copy = copied & (F.col("n_bytes") >= p.length)
    common = copied & (F.col("n_bytes") >= p.passage) & (F.col("n_words") >= p.passage_words)
    zero = F.lit(0)
    return out.select(
        "doc_id", "n_bytes", pick(copy, F.col("n_bytes"), "removed", zero).cast("long").alias("n_removed"), pick(copy, F.lit(1), "spans", zero).cast("long").alias("n_spans"),
        pick(copy, F.lit(NOTHING), "kept", F.col("key")).alias("kept_sha256"),
        pick(common, F.col("n_bytes"), "shared", zero).cast("long").alias("n_shared"), pick(common, F.lit(1), "passages", zero).cast("long").alias("n_passages"),
    )
