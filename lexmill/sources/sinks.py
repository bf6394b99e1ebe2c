"""Sinks, staged tables and the state of interrupted runs."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def staging_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; intermediate tables need a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """The table as written to the shared folder and read again: cuts lineage, outlives executors."""
    path = f"{staging_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_jsonl(df: DataFrame, path: str, ascii_only: bool = False, rows_per_file: int | None = None, by_source: bool = False, overwrite: bool = False) -> bool:
    """One object a line.  A finished output is left as it is unless ``overwrite``; returns whether anything was written."""
    if exists(df.sparkSession, f"{path}/_SUCCESS") and not overwrite:
        return False
    w = df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", "true").option("writeNonAsciiCharacterAsCodePoint", str(ascii_only).lower())
    w = w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w
    (w.partitionBy("source") if by_source else w).json(path)
    return True


def write_stats(df: DataFrame, path: str) -> None:
    """A small table of figures as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that an earlier run has not finished."""
    return files.join(done.select("path").distinct(), "path", "left_anti")


def progress_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, lines_done, kept): the new row of a source replaces the old one."""
    both = old.alias("o").join(new.alias("n"), "source", "full_outer")
    return both.select("source", *(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in ("lines_done", "kept")))


def latest(df: DataFrame, order: str, keep: int) -> DataFrame:
    """The newest ``keep`` checkpoints."""
    return df.orderBy(F.desc(order)).limit(keep)


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, eos: int = 3) -> int:
    """Token arrays, in the order of ``pos``, as Parquet rows of little-endian uint16 bytes (pos, bytes, n), a part file for each range of ``pos``; returns the number of tokens.

    The bytes in the order of ``pos`` are the flat stream; a token beyond 65535 or a row without an end token is an error.
    """
    import numpy as np

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            for x in batch.column("tokens").to_pylist():
                if not x or min(x) < 0 or max(x) > 65535 or x[-1] != eos:
                    raise ValueError("a document's tokens are of 16 bits and end on the end token")
            data = [np.asarray(x, dtype="<u2").tobytes() for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("pos"), pa.array(data, pa.binary()), pa.array([len(x) // 2 for x in data], pa.int64())], names=["pos", "bytes", "n"])

    packed = docs.orderBy("pos").select("pos", "tokens").mapInArrow(pack, "pos long, bytes binary, n long")
    packed.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def manifest(tokens: int, files: list[tuple[str, int]]) -> str:
    return json.dumps({"total_tokens": tokens, "shards": [{"file": f, "tokens": n} for f, n in files]})
