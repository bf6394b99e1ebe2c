"""Event windows: sliding counts and rates, latches, idle runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sliding_count(events: DataFrame, key: str, ts: str = "ts", seconds: int = 1800, least: int = 3) -> DataFrame:
    """Events of the key within the last ``seconds``, this one included, and whether that is an alert."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(key).orderBy(at).rangeBetween(-(seconds * 1_000_000 - 1), 0)
    return events.withColumn("recent", F.count("*").over(w)).withColumn("alert", F.col("recent") >= least)


def rising_edges(df: DataFrame, key: str, order: list[str], condition: Column) -> DataFrame:
    """Rows at which the condition begins to hold."""
    before = F.lag(condition, 1, False).over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("edge", condition & ~before)


def idle_runs(df: DataFrame, key: str, order: list[str], idle: Column) -> DataFrame:
    """With idle_run: how many rows on end have been idle, 0 at one that isn't."""
    w = Window.partitionBy(key).orderBy(*order)
    block = F.sum((~idle).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = df.withColumn("_b", block).withColumn("_i", idle.cast("int"))
    return out.withColumn("idle_run", F.sum("_i").over(Window.partitionBy(key, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("_b", "_i")


def sliding_rate(df: DataFrame, key: str, order: list[str], done: str, seconds: str, rows: int = 10) -> DataFrame:
    """Progress per second over the last ``rows`` samples."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-(rows - 1), 0)
    span = F.col(seconds) - F.first(seconds).over(w)
    return df.withColumn("rate", F.when(span > 0, (F.col(done) - F.first(done).over(w)) / span))
