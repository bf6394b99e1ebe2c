"""URL rules in a sorted array of 64-bit xxhash digests.

A rule is a host and a path prefix with an action.  It fits its host and all
subdomains where the url's path starts with the rule's, and the longest fitting
rule decides (of equally long ones, that with the longer host).  The rules' keys
``host/path`` are hashed; digests are sorted and memory-mapped, and the keys that
a url could match (its host suffixes with its path cut to each length that some
rule has) are probed together by vectorised binary search.  The full key stored
beside a digest must be equal, so a collision never decides.

The array is broadcast in segments of at most ``segment_rules`` rules and mapped
from a nameless temporary file, so workers page in what they probe; with more
rules, more passes are made.

Defined results: a null url, or one without ``://``, has empty host and path and
gets the default verdict, as does a url that no rule fits; repeated rows give
repeated results.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id long, host string, path string, rule string, verdict string"
_UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    action: str  #: block or allow
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass
class Packed:
    """Arrays as bytes, for a broadcast."""

    digests: bytes
    ends: bytes  #: end of each key in keys
    hosts: bytes  #: length of each key's host
    keys: bytes
    allow: bytes
    lengths: list[int]  #: path lengths that rules have


def pack(rules: Sequence[Rule]) -> Packed:
    """Of rules with one and the same key the first one holds."""
    by_key: dict[tuple[str, str], Rule] = {}
    for r in rules:
        by_key.setdefault((r.host, r.path), r)
    rows = sorted((xxhash.xxh64_intdigest(r.key.encode()), r.key.encode(), r) for r in by_key.values())
    ends = np.cumsum([0] + [len(k) for _, k, _ in rows], dtype=np.int64)
    return Packed(
        np.array([d for d, _, _ in rows], dtype=np.uint64).tobytes(), ends.tobytes(), np.array([len(r.host.encode()) for *_, r in rows], dtype=np.int32).tobytes(),
        b"".join(k for _, k, _ in rows), bytes(r.action == "allow" for *_, r in rows), sorted({len(r.path) for *_, r in rows}),
    )


def _mapped(data: bytes, dtype: str) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=dtype)
    with tempfile.TemporaryFile() as f:
        f.write(data)
        f.flush()
        return np.memmap(f, dtype=dtype, mode="r")


class RuleArray:
    def __init__(self, packed: Packed) -> None:
        self.digests = _mapped(packed.digests, "<u8")
        self.ends = _mapped(packed.ends, "<i8")
        self.hosts = _mapped(packed.hosts, "<i4")
        self.keys = _mapped(packed.keys, "u1")
        self.allow = _mapped(packed.allow, "u1")
        self.lengths = packed.lengths

    def find(self, owners: list[int], keys: list[bytes], hosts: list[int]) -> list[tuple[int, bytes, int, bool]]:
        """(owner, key, host length, allow) of the keys that are stored."""
        if not keys or not len(self.digests):
            return []
        probe = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))
        at = np.searchsorted(self.digests, probe, "left")
        out = []
        for i in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == probe):
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == probe[i]:  # collisions stand side by side
                if self.hosts[j] == hosts[i] and self.keys[self.ends[j] : self.ends[j + 1]].tobytes() == keys[i]:
                    out.append((owners[i], keys[i], hosts[i], bool(self.allow[j])))
                    break
                j += 1
        return out


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lower-cased, and path."""
    if url is None or (k := url.find("://")) < 0:
        return "", ""
    rest = url[k + 3 :]
    end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for c in "?#" if (i := tail.find(c)) >= 0), default=len(tail))
    return rest[:end].translate(_UPPER_TO_LOWER), tail[:stop]


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[tuple[bytes, int]]:
    """Keys that a rule which fits would have, with the length of their hosts."""
    at = 0
    while True:
        suffix = host[at:]
        size = len(suffix.encode())
        for n in lengths:
            if n > len(path):
                break
            yield (suffix + path[:n]).encode(), size
        dot = host.find(".", at)
        if dot < 0:
            return
        at = dot + 1


def _matcher(shared, default: str):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = RuleArray(shared.value)
        for batch in batches:
            names = batch.schema.names
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            best: list[tuple[int, int, bytes | None, str]] = [(-1, -1, None, default)] * len(parts)
            if "rule" in names:
                for i, (rule, verdict, size) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("rule", "verdict", "size")), strict=True)):
                    if rule is not None:
                        best[i] = (len(rule), size, rule.encode(), verdict)
            owners, keys, hosts = [], [], []
            for i, (host, path) in enumerate(parts):
                for key, size in candidates(host, path, rules.lengths):
                    owners.append(i)
                    keys.append(key)
                    hosts.append(size)
            for i, key, size, allow in rules.find(owners, keys, hosts):
                new = (len(key.decode()), size, key, "allow" if allow else "block")
                if new[:2] > best[i][:2]:
                    best[i] = new
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                pa.array([k and k.decode() for _, _, k, _ in best], pa.string()), pa.array([v for *_, v in best], pa.string()), pa.array([s for _, s, *_ in best], pa.int64()),
            ], names=["page_id", "url", "host", "path", "rule", "verdict", "size"])

    return match


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", segment_rules: int = 2_000_000) -> DataFrame:
    """A row for each page; see SCHEMA."""
    spark = pages.sparkSession
    now = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    for k in range(0, max(1, len(rules)), segment_rules):
        shared = spark.sparkContext.broadcast(pack(rules[k : k + segment_rules]))
        now = now.mapInArrow(_matcher(shared, default), "page_id long, url string, host string, path string, rule string, verdict string, size long")
    return now.select("page_id", "host", "path", "rule", "verdict")
