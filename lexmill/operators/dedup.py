"""Exact and order-greedy near-duplicate removal.

Near duplicates: a document goes if one of its signature's bands is that of an
earlier document that stays.  Documents that go never shadow others, so the result
is the first maximal independent set over the given order; it is found by rounds
over the bands' minima, each of which settles whatever its earlier neighbours allow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MinHashParams
from ..functions.metrics import quality_of
from ..functions.text import normalized_hash, window_text
from ..sources.sinks import staged

MERSENNE = (1 << 61) - 1
EMPTY = 0xFFFFFFFF
#: Characters of texts that are signed together, and the distinct shingles whose values are held at once.
CHUNK, TABLE = 1 << 20, 1 << 18


def shingles(text: Column, k: int = 5) -> Column:
    """Distinct k-character shingles, in the order in which they come; none of a shorter text."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    grams = chars
    # characters are shifted against each other, so the text is taken apart k times and not once for each shingle
    for j in range(1, k):
        grams = F.zip_with(grams, F.slice(chars, F.lit(j + 1), F.lit(1 << 30)), lambda a, b: F.when(b.isNotNull(), F.concat(a, b)))
    return F.array_distinct(F.filter(grams, lambda g: g.isNotNull()))


def dedup_stats(docs: DataFrame, kept: DataFrame, low: Column) -> DataFrame:
    """(source, read, kept, dup, low_quality) of ``docs`` (id, source) with ``kept`` (id, keep): a document that ``low`` holds for counts as weak, and of the others those that go are copies."""
    met = docs.join(kept, "id")
    weak = F.coalesce(low, F.lit(False))
    return met.groupBy("source").agg(F.count("*").alias("read"), F.count_if(F.col("keep") & ~weak).alias("kept"), F.count_if(~F.col("keep")).alias("dup"), F.count_if(F.col("keep") & weak).alias("low_quality"))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def exact_dedup(df: DataFrame, text: str, order: Sequence[Column | str]) -> DataFrame:
    """The first of the rows whose text is the same but for case and white space."""
    return first_by(df.withColumn("_h", normalized_hash(F.col(text))), ["_h"], order).drop("_h")


def permutations(p: MinHashParams) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(p.seed)
    a = rng.randint(1, MERSENNE, p.permutations, dtype=np.uint64)
    b = rng.randint(0, MERSENNE, p.permutations, dtype=np.uint64)
    return a, b


def values(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """((a * x + b) mod (2**61 - 1)) mod 2**32 of 32-bit hashes x, a row for each; in steps that stay in the processor's cache."""
    u, m = np.uint64, np.uint64(MERSENNE)
    hi, lo = a >> u(32), a & u(0xFFFFFFFF)
    out = np.empty((len(x), len(a)), dtype=np.uint32)
    step = max(1, (1 << 17) // max(1, len(a)))
    held = np.empty((3, min(step, len(x)), len(a)), dtype=u)
    for at in range(0, len(x), step):
        c = x[at : at + step, None]
        s, t, v = held[:, : len(c)]
        # a * x = hi * x * 2**32 + lo * x, the first product below 2**61 and the second below 2**64; 2**61 is 1
        np.multiply(c, hi, out=s)
        np.right_shift(s, u(29), out=t)
        s &= u((1 << 29) - 1)
        s <<= u(32)
        s += t
        np.multiply(c, lo, out=t)
        np.right_shift(t, u(61), out=v)
        t &= m
        s += t
        s += v
        s += b  # below 2**63
        np.right_shift(s, u(61), out=t)
        s &= m
        s += t
        # at most 3 above the modulus, whose lower 32 bits are -1
        s += s >= m
        out[at : at + step] = s
    return out


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of ((a * x + b) mod (2**61 - 1)) mod 2**32 over 32-bit hashes x."""
    out = np.full(len(a), EMPTY, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        out = np.minimum(out, values(hashes[at : at + 4096], a, b).min(axis=0))
    return out


def _hashed(own: Iterable[str], n: int, kind: str) -> np.ndarray:
    """Of strings the lower 32 bits of XXH3-64, or the first 32 of an md5."""
    import hashlib

    import xxhash

    if kind == "md5":
        return np.fromiter((int(hashlib.md5(s.encode()).hexdigest()[:8], 16) for s in own), dtype=np.uint64, count=n)
    return np.fromiter((xxhash.xxh3_64_intdigest(s) & 0xFFFFFFFF for s in own), dtype=np.uint64, count=n)


def base_hashes(text: str, k: int, kind: str = "xxh3") -> np.ndarray:
    """Hashes of the distinct k-character shingles."""
    own = {text[i : i + k] for i in range(len(text) - k + 1)}
    return _hashed(own, len(own), kind)


def signatures(texts: Sequence[str], p: MinHashParams, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A row of the signature for each text; a shingle that several of them have is hashed and permuted once."""
    k = p.shingle
    sizes = np.array([max(0, len(t) - k + 1) for t in texts], dtype=np.int64)
    out = np.full((len(texts), len(a)), EMPTY, dtype=np.int64)
    if not sizes.sum():
        return out
    if len(texts) == 1:
        out[0] = signature(base_hashes(texts[0], k, p.hash), a, b)
        return out
    whole = "".join(texts)
    kinds, code = np.unique(np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32), return_inverse=True)
    key, most = code[: len(code) - k + 1], len(kinds)
    for j in range(1, k):
        if most * len(kinds) >= 1 << 62:
            found, key = np.unique(key, return_inverse=True)
            most = len(found)
        key, most = key * len(kinds) + code[j : len(code) - k + 1 + j], most * len(kinds)
    starts = np.cumsum([0, *(len(t) for t in texts[:-1])])
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)  # no shingle lies in two texts
    found, first, place = np.unique(key[at], return_index=True, return_inverse=True)
    if len(found) > TABLE:
        half = len(texts) // 2
        return np.concatenate([signatures(texts[:half], p, a, b), signatures(texts[half:], p, a, b)])
    table = values(_hashed((whole[i : i + k] for i in at[first].tolist()), len(found), p.hash), a, b)
    for i in np.flatnonzero(sizes):
        out[i] = table[place[ends[i] - sizes[i] : ends[i]]].min(axis=0)
    return out


def _signer(p: MinHashParams):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        a, b = permutations(p)
        for batch in batches:
            # rows in chunks of about CHUNK characters of what signatures look at
            seen = np.minimum(pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False), 3 * p.window + 2).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(seen) // CHUNK)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                texts = part.column("_text").to_pylist()
                made = {k: part.column(k) for k in part.schema.names if k not in ("_text", "_scored")}
                if "_scored" in part.schema.names:
                    scored = part.column("_scored").to_pylist()
                    made["score"] = pa.array([quality_of(t) if s and t is not None else None for t, s in zip(texts, scored, strict=True)], pa.float64())
                rows = signatures([window_text(t or "", p.window, p.max_chars) for t in texts], p, a, b)
                made["signature"] = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * p.permutations), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return sign


def with_signature(docs: DataFrame, p: MinHashParams = MinHashParams(), scored: Column | None = None) -> DataFrame:
    """(id, ord, signature) of ``docs`` (id, ord, text), and the quality score of rows that ``scored`` holds for; one Arrow pass."""
    extra = [] if scored is None else [F.coalesce(scored, F.lit(False)).alias("_scored")]
    view = docs.select("id", "ord", *extra, F.make_valid_utf8("text").alias("_text"))
    kinds = dict(docs.dtypes)
    return view.mapInArrow(_signer(p), f"id {kinds['id']}, ord {kinds['ord']}, {'score double, ' if extra else ''}signature array<long>")


def similarity(a: Column, b: Column) -> Column:
    """Share of equal places."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def band_keys(signed: DataFrame, p: MinHashParams = MinHashParams()) -> DataFrame:
    """(id, ord, band, key): a row for each band of a signature."""
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), lambda i: F.struct(i.alias("band"), F.slice("signature", i * p.rows + 1, F.lit(p.rows)).alias("key"))))
    return signed.select("id", "ord", band.alias("k")).select("id", "ord", "k.band", F.sha2(F.array_join("k.key", ","), 256).alias("key"))


def band_matches(keyed: DataFrame) -> DataFrame:
    """(id, first, bands): the first document of all that share a band with this one, itself left out, and in how many bands a document stands before it."""
    first = keyed.groupBy("band", "key").agg(F.min_by("id", "ord").alias("first"), F.min("ord").alias("first_ord"))
    met = keyed.join(first, ["band", "key"]).filter("first_ord < ord")
    return met.groupBy("id").agg(F.min_by("first", "first_ord").alias("first"), F.count("*").alias("bands"))


def settle(keyed: DataFrame) -> DataFrame:
    """(id, keep) for every id of ``keyed`` (id, ord, band, key): keep if no earlier document that stays shares a band.

    Rounds over the least order of each band: a document that comes first among those
    still standing in all of its bands stays, and one that has a staying one before it
    in any goes.  No pairs are formed, however many share a band.
    """
    alone = keyed.groupBy("band", "key").agg(F.count("*").alias("c"))
    # a band of one document decides nothing
    state = staged(keyed.join(alone.filter("c > 1").select("band", "key"), ["band", "key"], "left_semi").withColumn("keep", F.lit(None).cast("boolean")))
    done = keyed.select("id").distinct().join(state.select("id").distinct(), "id", "left_anti").withColumn("keep", F.lit(True))
    parts = [staged(done)]
    while not state.isEmpty():
        least = state.groupBy("band", "key").agg(F.min("ord").alias("least"), F.min(F.when(F.col("keep"), F.col("ord"))).alias("kept"))
        met = state.join(least, ["band", "key"])
        verdict = met.filter("keep is null").groupBy("id").agg(F.bool_or(F.coalesce(F.col("kept") < F.col("ord"), F.lit(False))).alias("hit"), F.bool_and(F.col("least") == F.col("ord")).alias("clear"))
        decided = staged(verdict.filter("hit or clear").select("id", (~F.col("hit")).alias("keep")))
        parts.append(decided)
        # those that go leave their bands; those that stay remain as long as a band has someone undecided
        left = state.join(decided.withColumnRenamed("keep", "now"), "id", "left").filter(F.coalesce("now", F.lit(True))).withColumn("keep", F.coalesce("keep", "now")).drop("now")
        open_ = left.groupBy("band", "key").agg(F.bool_or(F.col("keep").isNull()).alias("open")).filter("open").select("band", "key")
        state = staged(left.join(open_, ["band", "key"], "left_semi").select(*keyed.columns, "keep"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def near_dedup(docs: DataFrame, p: MinHashParams = MinHashParams()) -> DataFrame:
    """(id, keep) of ``docs`` (id, ord, text)."""
    return near_dedup_signed(staged(with_folded(with_signature(docs, p))), p)


def with_folded(signed: DataFrame) -> DataFrame:
    """With sig, which equal signatures share."""
    return signed.withColumn("sig", F.sha2(F.array_join("signature", ","), 256))


def near_dedup_signed(signed: DataFrame, p: MinHashParams = MinHashParams()) -> DataFrame:
    """(id, keep) of ``signed`` (id, ord, signature, sig), a written table; documents with one signature are folded before pairs are formed.

    Of equal signatures the first stands for all: each later one has it as an earlier
    neighbour with the very same neighbours, so it goes whether or not that one stays.
    """
    first = staged(signed.groupBy("sig").agg(F.min_by(F.struct("id", "ord", "signature"), "ord").alias("r")).select("sig", "r.*"))
    kept = settle(band_keys(first, p)).filter("keep").select("id", "keep")
    return signed.select("id").join(kept, "id", "left").select("id", F.coalesce("keep", F.lit(False)).alias("keep"))
