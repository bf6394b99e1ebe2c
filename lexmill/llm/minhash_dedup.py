"""MinHash near-duplicates with tensored banding.

A signature is two collections, A and B, of ``side`` sub-keys of ``rows``
minimum hashes each.  Table (i, j) is keyed by the pair (A_i, B_j), so
``side ** 2`` tables of ``2 * rows`` hashes cost ``2 * side * rows`` minhashes
rather than ``2 * side ** 2 * rows``.  A pair of similarity s meets in a table
with probability (1 - (1 - s**rows)**side)**2; at the defaults that is 0.99998
for s = 0.8.

A table key can only be shared if both of its halves are, so sub-keys that occur
once are removed before pairs are formed; unique documents form no table keys.
Candidates are confirmed on the full shingle sets.  Documents with one and the
same set are one class and enter the search as one row.

Within a bucket every member is first compared with the bucket's smallest id, its
pivot.  Pivots whose members then are in one component are settled.  For the
others, members of different components are found by what sets them apart from
their pivot (see ``_across``), so no link between components that share a bucket
is lost, and neither copies nor the dissimilar are expanded into pairs.

Defined results: null or wordless texts have an empty set, n_shingles 0 and stay
on their own; repeated rows of one doc_id count as one row each in the result and
share their component; a null doc_id never links or becomes a component's id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .textbytes import as_long, mix, shingles, words_of
from .workspace import Workspace


@dataclass(frozen=True)
class MinHashParams:
    words: int = 4  #: words in a shingle
    percent: int = 80  #: least 100 * intersection / union
    side: int = 16  #: sub-keys in each of the two collections
    rows: int = 3  #: minimum hashes in a sub-key
    seed: int = 20_240_601
    piece: int = 1024  #: about as many of a pivot's members go through one task together


def _multipliers(p: MinHashParams) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(p.seed))
    return rng.integers(0, 1 << 63, size=(2 * p.side * p.rows, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distinct_shingles(w, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(docs + 1 offsets, hashes sorted and distinct within each document)."""
    doc, h = shingles(w, k)
    at = np.searchsorted(doc, np.arange(w.docs + 1))
    parts = [np.unique(h[at[i] : at[i + 1]]) for i in range(w.docs)]
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _signer(p: MinHashParams):
    mult = _multipliers(p)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words_of(batch.column("text")):
                at, h = distinct_shingles(w, p.words)
                n = np.diff(at)
                have = np.flatnonzero(n)
                keys = np.zeros((w.docs, 2 * p.side), dtype=np.uint64)
                set_a = np.zeros(w.docs, dtype=np.uint64)
                set_b = np.zeros(w.docs, dtype=np.uint64)
                if len(have):
                    first = at[have]
                    set_a[have] = mix(np.add.reduceat(h, first))
                    set_b[have] = mix(np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), first))
                    for s in range(2 * p.side):
                        key = np.full(len(have), s + 1, dtype=np.uint64)
                        for r in range(s * p.rows, (s + 1) * p.rows):
                            least = np.minimum.reduceat((h ^ mult[r, 0]) * mult[r, 1], first)
                            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
                        keys[have, s] = key
                ids = batch.column("doc_id").slice(w.first, w.docs)
                flat = pa.array(as_long(keys.reshape(-1)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(w.docs + 1, dtype=np.int32) * (2 * p.side)), flat)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(as_long(set_a)), pa.array(as_long(set_b)), lists], names=["doc_id", "n", "sa", "sb", "subkeys"])

    return sign


def _setter(p: MinHashParams):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words_of(batch.column("text")):
                at, h = distinct_shingles(w, p.words)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(as_long(h)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(w.first, w.docs), lists], names=["id", "hs"])

    return sets


def _fits(p: MinHashParams, a: str, b: str) -> Column:
    """Sizes that allow the similarity."""
    return (F.lit(100) * F.least(a, b) >= F.lit(p.percent) * F.greatest(a, b))


def _verified(pairs: DataFrame, sets: DataFrame, p: MinHashParams) -> DataFrame:
    """The pairs (a, b) that have the similarity on their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("hs").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hs").alias("hb"))
    met = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ha", "hb"))
    return met.filter(F.lit(100) * common >= F.lit(p.percent) * (F.size("ha") + F.size("hb") - common)).select("a", "b")


def _deltas(tables: DataFrame, roots: DataFrame, sets: DataFrame, p: MinHashParams, ws: Workspace) -> DataFrame:
    """(a, b, size, piece, na, nb, ra, rb, d, linked): members of the buckets that aren't settled, with what sets them apart from their pivot b.

    A bucket is settled if all its members are in one component.  The pivot of
    another is the smallest root of those of its members that are linked to
    anything, or else its smallest id.  A pivot of many members meets them in
    pieces of about ``p.piece``, and so does all that is known of it, so that no
    task has all of them.
    """
    placed = tables.join(roots, tables["rep"] == roots["node"], "left").select("t", F.col("rep").alias("a"), "root", F.coalesce("root", "rep").alias("ra"))
    open_ = placed.groupBy("t").agg(F.min("ra").alias("lo"), F.max("ra").alias("hi"), F.coalesce(F.min("root"), F.min("a")).alias("b")).filter("lo < hi").select("t", "b")
    pairs = ws.save(placed.join(open_, "t").filter("a != b").select("a", "b", "ra").distinct(), "pairs")
    # members are counted by salts first: their number is needed to cut them, and they must not come together for it
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a", F.lit(1)), F.lit(1 + pairs.count() // p.piece)))
    parts = salted.groupBy("b", "salt").agg(F.count("*").alias("c"))
    sizes = parts.groupBy("b").agg(F.sum("c").alias("size"))
    pieces = F.ceil(F.col("size") / p.piece)
    members = salted.join(parts.join(sizes, "b").select("b", "salt", "size"), ["b", "salt"]).withColumn("piece", F.pmod(F.xxhash64("a"), pieces)).drop("salt")
    known = sizes.join(sets.select(F.col("id").alias("b"), F.col("hs").alias("hb")), "b").join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    pivots = known.select("b", "hb", F.coalesce("rb", "b").alias("rb"), F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
    met = members.join(sets.select(F.col("id").alias("a"), F.col("hs").alias("ha")), "a").join(pivots, ["b", "piece"])
    delta = F.array_union(F.array_except("ha", "hb"), F.array_except("hb", "ha"))
    out = met.select("a", "b", "size", "piece", F.size("ha").alias("na"), F.size("hb").alias("nb"), "ra", "rb", delta.alias("d"))
    linked = F.lit(100 + p.percent) * F.size("d") <= F.lit(100 - p.percent) * (F.col("na") + F.col("nb"))
    return ws.save(out.withColumn("linked", linked), "deltas")


def _across(deltas: DataFrame, p: MinHashParams, ws: Workspace) -> DataFrame:
    """Pairs (a, b) of different components that shared a bucket and can still be linked.

    With pivot c, let D be a member's symmetric difference to c and f = (1 - s) / (1 + s),
    so that a and b are linked if and only if their own difference is at most
    T = f * (na + nb).  It is |Da| + |Db| - 2 * |Da and Db|.  Two members that are
    both linked to c are of one component through it; of any other two one at least
    isn't linked to c, and from that follows that

    * the sizes |Da| and |Db| differ by T at most,
    * Da and Db share more than (|D| + f * (nc - n)) / 2 elements, D and n being those
      of a member whose partner isn't linked to c,
    * and at least |D| - T of a member that isn't linked to c.

    So in any order of the elements both have a common one among their first
    |D| - least + 1: an equi-join on (pivot, element) finds every such pair without
    going through the pairs of a bucket.  Elements come the later in the order the
    more of a pivot's members differ from it in them, as far as some 64 members show; the
    order decides how many pairs are met in vain, never which are found.
    """
    f = (100 - p.percent) / (100 + p.percent)
    # every so manieth member by hash, so that no pivot's members are gathered in one task
    some = deltas.filter(F.pmod(F.xxhash64("a"), F.ceil(F.col("size") / 64)) == 0).select("a", "b", "d")
    votes = some.select("b", F.explode("d").alias("e")).groupBy("b", "e").agg(F.count("*").alias("c")).filter("c > 1")
    tier = F.when(F.col("c") * 2 > F.col("m"), 2).when(F.col("c") * 8 > F.col("m"), 1).otherwise(0)
    votes = votes.join(some.groupBy("b").agg(F.count("*").alias("m")), "b").withColumn("tier", tier)
    tiers = votes.groupBy("b").agg(*(F.collect_list(F.when(F.col("tier") == k, F.col("e"))).alias(f"t{k}") for k in range(3)))
    tiers = tiers.join(deltas.select("b", "piece").distinct(), "b")
    ranked = deltas.join(tiers, ["b", "piece"], "left").withColumns({f"t{k}": F.coalesce(f"t{k}", F.array().cast("array<long>")) for k in range(3)})
    rare = F.array_except("d", F.concat("t0", "t1", "t2"))
    order = F.concat(F.array_sort(rare), *(F.array_sort(F.array_intersect("d", f"t{k}")) for k in range(3)))
    x = F.size("d")
    # members that aren't linked to the pivot are looked up under both bounds
    among = x - F.floor((x + f * (F.col("nb") - F.col("na"))) / 2)
    over = x - F.ceil(x - f * (1 + 100 / p.percent) * F.col("na")) + 1
    taken = F.when(F.col("linked"), among).otherwise(F.greatest(among, over))
    taken = F.greatest(F.lit(0), F.least(x, taken)).cast("int")
    heads = ws.save(ranked.select("b", "a", "na", "ra", "linked", x.alias("x"), among.alias("among"), F.posexplode(F.slice(order, F.lit(1), taken)).alias("at", "e")), "prefixes")
    side = lambda q: heads.select("b", "e", *(F.col(k).alias(k + q) for k in ("a", "na", "ra", "x", "linked", "at", "among")))
    # what two have in common from their first common element on must suffice
    rest = F.least(F.col("x1") - F.col("at1"), F.col("x2") - F.col("at2"))
    near = F.lit(100 - p.percent) * (F.col("na1") + F.col("na2")) >= F.lit(100 + p.percent) * (F.col("x1") + F.col("x2") - 2 * rest)
    # two that aren't linked meet once, below the first bound on either side
    twice = F.col("linked1") | ((F.col("a1") < F.col("a2")) & (F.col("at1") < F.col("among1")) & (F.col("at2") < F.col("among2")))
    met = side("1").join(side("2").filter("not linked2"), ["b", "e"]).filter((F.col("ra1") != F.col("ra2")) & _fits(p, "na1", "na2") & near & twice)
    return met.select(F.least("a1", "a2").alias("a"), F.greatest("a1", "a2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, p: MinHashParams = MinHashParams(), ws: Workspace | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text)."""
    ws = ws or Workspace(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = ws.save(docs.mapInArrow(_signer(p), "doc_id long, n long, sa long, sb long, subkeys array<long>"), "signed")

    # one row per distinct set
    reps = ws.save(signed.filter("n > 0 and doc_id is not null").groupBy("sa", "sb", "n").agg(F.min("doc_id").alias("rep"), F.min_by("subkeys", "doc_id").alias("subkeys")), "reps")
    halves = reps.select("rep", "n", F.posexplode("subkeys").alias("i", "k"))
    shared = halves.groupBy("i", "k").agg(F.count("*").alias("c")).filter("c > 1").select("i", "k")
    met = halves.join(shared, ["i", "k"], "left_semi").groupBy("rep", "n").agg(F.collect_list(F.struct("i", "k")).alias("ks"))
    a, b = F.expr(f"filter(ks, x -> x.i < {p.side})"), F.expr(f"filter(ks, x -> x.i >= {p.side})")
    tabled = met.select("rep", "n", F.explode(a).alias("x"), b.alias("ys")).select("rep", "n", "x", F.explode("ys").alias("y")).select("rep", "n", F.xxhash64("x.i", "x.k", "y.i", "y.k").alias("t"))
    tables = ws.save(tabled, "tables")

    # round 1: each member of a bucket against the bucket's smallest id
    heads = tables.groupBy("t").agg(F.min(F.struct("rep", "n")).alias("h"), F.count("*").alias("c")).filter("c > 1").select("t", F.col("h.rep").alias("b"), F.col("h.n").alias("nb"))
    starred = ws.save(tables.withColumnRenamed("rep", "a").withColumnRenamed("n", "na").join(heads, "t").filter(F.col("a") != F.col("b")).select("a", "b", "na", "nb").distinct(), "starred")
    ids = starred.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # both searches draw on these sets; texts are joined by merging whatever the size, so the plan is one
    sets = ws.save(docs.hint("merge").join(ids, "doc_id", "left_semi").mapInArrow(_setter(p), "id long, hs array<long>").dropDuplicates(["id"]), "sets")
    good = ws.save(_verified(starred.filter(_fits(p, "na", "nb")), sets, p), "edges1")
    roots = components(good, ws, "cc1")

    deltas = _deltas(tables, roots, sets, p, ws)
    pivots = deltas.filter("linked and ra != rb").select("a", "b")
    more = ws.save(_verified(_across(deltas, p, ws), sets, p).union(pivots), "edges2")
    ws.drop("starred", "tables", "sets", "pairs", "deltas", "prefixes")
    roots = components(good.union(more), ws, "cc2")

    named = reps.select("sa", "sb", "n", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("sa", "sb", "n", F.coalesce("root", "rep").alias("root"))
    out = signed.drop("subkeys").join(named, ["sa", "sb", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("root")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, p: MinHashParams = MinHashParams(), ws: Workspace | None = None) -> DataFrame:
    """The rows, with all their columns, of one document of each group.

    Rows that share a doc_id are one document: it stays if any of them is kept, as
    one row.  Rows without a doc_id stay.
    """
    ws = ws or Workspace(docs.sparkSession, "minhash")
    found = ws.save(near_duplicates(docs, p, ws).groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).filter("doc_id is not null"), "found")
    key = docs["doc_id"].cast("long")
    once, more = found.filter("kept and rows = 1"), found.filter("kept and rows > 1")
    out = docs.hint("merge").join(once, key == once["doc_id"], "left_semi").unionAll(docs.filter(key.isNull()))
    if not more.isEmpty():
        out = out.unionAll(docs.hint("merge").join(more, key == more["doc_id"], "left_semi").dropDuplicates(["doc_id"]))
    return out
