"""Loading that skips what is loaded already, as batch and as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

PARTS = 64


def _part(keys: list[str]) -> F.Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")


def loaded_keys(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows loaded so far with their load and part; none if nothing was."""
    whole = StructType([*schema.fields, StructField("load", LongType()), StructField("part", IntegerType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], whole)


def load_new(new: DataFrame, path: str, keys: list[str], load: int) -> None:
    """Append to path the rows of new whose keys no other load has brought, one row per key (the least by its columns' order), under the number of this load.

    Runs again with the same number, a load replaces itself and no other, so a retry after a loss neither doubles nor drops rows. The loaded keys alone are read back, and they are joined
    part by part of their hash, by which the table is partitioned.
    """
    spark = new.sparkSession
    named = new.withColumn("part", _part(keys))
    first = named.groupBy("part", *keys).agg(F.min(F.struct(*[c for c in new.columns if c not in keys])).alias("_rest")) if set(new.columns) - set(keys) else named.distinct()
    there = loaded_keys(spark, path, new.schema).filter(F.col("load") != load).select("part", *keys)
    fresh = first.join(there, ["part", *keys], "left_anti")
    rest = [F.col("_rest")[c].alias(c) for c in new.columns if c not in keys]
    fresh.select(*keys, *rest, F.lit(load).cast("long").alias("load"), "part").select(*new.columns, "load", "part").write.option("partitionOverwriteMode", "dynamic").partitionBy("load", "part").mode("overwrite").parquet(path)


def load_stream(spark: SparkSession, source: str, schema: str, shape, path: str, keys: list[str], checkpoint: str, event_time: str, lateness: str = "30 days", files: int = 100) -> None:
    """Load all new files of a folder. What comes again within ``lateness`` of event time is left out by the stream's own state, what other loads or a stream before have brought by the join
    with the loaded keys; a micro-batch that is run again replaces what it wrote. A row that is later than ``lateness`` is left out even if it is new, as the state can't tell any more: choose it to cover
    the source's delays, or load such rows with load_new."""
    rows = shape(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source))
    once = rows.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)
    started = once.writeStream.foreachBatch(lambda batch, number: load_new(batch, path, keys, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
