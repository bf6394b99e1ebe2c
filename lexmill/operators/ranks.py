"""Places and running sums over a whole table without a window over all of it.

Rows are range-partitioned by the order; each partition counts (or sums) its own,
the few totals are added up, and every partition starts from what lies before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Row numbers from 1; the order should be total, or ties fall either way."""
    return with_running(df.withColumn("_one", F.lit(1)), order, F.col("_one"), name).drop("_one")


def with_running(df: DataFrame, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Running sum of ``value`` up to and with each row.

    The sorted table is written to the shared folder, so that the totals and the rows
    come from one and the same range partitioning.
    """
    from ..sources.sinks import staged

    keyed = df.withColumn("_v", value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    held = staged(keyed)
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = held.groupBy("_part").agg(F.sum("_v").alias("_t"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_t").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return held.withColumn(name, F.sum("_v").over(own)).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before", "_v")


def with_running_in(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], value: Column, name: str) -> DataFrame:
    """Running sum of ``value`` within each group, up to and with each row.

    Rows are range-partitioned by group and order together, so a group that holds most
    of them goes over many tasks; each starts from what the ones before have of its group.
    """
    from ..sources.sinks import staged

    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    held = staged(df.withColumn("_v", value).repartitionByRange(*(F.col(g) for g in group), *keys).withColumn("_part", F.spark_partition_id()))
    own = Window.partitionBy("_part", *group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    totals = held.groupBy("_part", *group).agg(F.sum("_v").alias("_t"))
    # a row for each partition and group in it
    before = totals.withColumn("_before", F.coalesce(F.sum("_t").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = held.withColumn(name, F.sum("_v").over(own)).alias("h").join(before.alias("b"), (F.col("h._part") == F.col("b._part")) & reduce(and_, (F.col(f"h.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group)))
    return met.select("h.*", "b._before").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before", "_v")
