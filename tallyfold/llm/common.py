"""Shared folder, materialised intermediates and Arrow batch sizes for the corpus operators."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of a text table in one Arrow batch; a batch of long documents must fit a Python worker.
TEXT_ROWS_PER_BATCH = 2_000
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where that is unset on a local master (tests) a local one."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.tallyfold.scratch", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-tallyfold-")
        spark.conf.set("spark.tallyfold.scratch", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of its own in the shared folder."""
    return f"{shared_dir(spark)}/tallyfold/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends here and lost executors lose nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def batches(spark: SparkSession, rows: int = TEXT_ROWS_PER_BATCH, size: int = BATCH_BYTES) -> contextlib.AbstractContextManager[None]:
    """Bound the rows and bytes that Spark sends to a Python worker at once, for the actions within the block."""
    return _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)})


def early_filters(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """For the actions within the block, a shuffled join with filtered rows puts Spark's Bloom filter (1 MB) of their keys before the shuffle of the other side, whatever the sizes: few of the texts that no key
    wants are moved. The join itself stays exact."""
    sizes = "spark.sql.optimizer.runtime.bloomFilter."
    return _settings(spark, {f"{sizes}applicationSideScanSizeThreshold": "0", f"{sizes}creationSideThreshold": "1000g"})


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that a slice holds about ``size`` bytes of that string column, or one row: for results that are computed
    later, under whatever setting the session has then."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            so_far = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, so_far + size, side="right")))
            yield batch.slice(at, end - at)
            at = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unsigned_hex(col) -> F.Column:
    """16 lowercase hex digits of a bigint taken as unsigned."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
