"""Connected components over an edge table, by alternating large and small stars.

Every round is two shuffles with map-side minima; hot hubs are joined under the
adaptive skew join, and nothing is gathered on the driver but two counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


def _fingerprint(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b") % F.lit(1 << 40)), F.lit(0))).first()
    return row[0], row[1]


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(node, root) for every node of an edge, root the smallest id reachable.

    ``edges`` has long columns a and b; direction, repeats and self loops are of
    no account.  The result is a table of ``ws`` called ``name``.
    """
    now = ws.save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), f"{name}-0")
    seen, k = _fingerprint(now), 0
    while seen[0]:
        k += 1
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a != b").distinct()
        nxt = ws.save(small, f"{name}-{k}")
        ws.drop(f"{name}-{k - 1}")
        found = _fingerprint(nxt)
        now = nxt
        if found == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
