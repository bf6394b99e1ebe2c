"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it
again: the files outlive lost executors, keep column pruning and can be removed
as soon as the next table has been written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder in local mode and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset; intermediate tables need a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Workspace:
    """Named tables of one operator run, below a folder of its own."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        """Write ``df`` and return the table as read back."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
