"""Structured Streaming: incremental ingest with exact deduplication, and alerts on event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import normalized_hash
from ..operators.gates import clean_documents


def ingest(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    """Clean and gate Parquet files as they come; what has been read is in the checkpoint, so a restart goes on where it was."""
    docs = spark.readStream.schema(schema).parquet(folder)

    def keep(batch: DataFrame, epoch: int) -> None:
        good = clean_documents(batch).filter("reason is null").drop("reason").withColumn("_h", normalized_hash(F.col("text"))).dropDuplicates(["_h"])
        try:
            good = good.join(spark.read.parquet(out).filter(F.col("epoch") != epoch).select("_h"), "_h", "left_anti")
        except Exception as e:  # the first batch has nothing to compare with
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        # a batch that is run again replaces its own partition
        good.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out)

    return docs.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", key: str = "event_type", width: str = "30 minutes", slide: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Events and values by sliding window; works on a stream and on a table."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width, slide).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A user's events with no gap between them."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def first_seen(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def alerts(counts: DataFrame, least: int | Column = 3) -> DataFrame:
    return counts.filter(F.col("n") >= least)
