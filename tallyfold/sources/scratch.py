"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows of a task, about, where a table is dealt by its size.
ROWS_PER_TASK = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df hashed by keys to as many partitions as that number of rows needs, or as the session has if those are more, where it needs several: what a task sorts doesn't grow with the table. The number is given even where the session's number of shuffle
    partitions would do, as Spark would join those to partitions of 64 MB compressed."""
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys) if parts > 1 else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: spark.checkpoint.dir, or a local one on a local master where that is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-tallyfold-")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: later steps don't plan or compute it anew, and a lost executor loses none of it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
