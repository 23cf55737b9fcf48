"""Stored statistics of the cube, rebuilt for the years that changed; per-row divisors and lags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallyfold.functions import scalars as S


def rebuild(rows: DataFrame, path: str, measure: Callable[[DataFrame], DataFrame], since_year: int | None = None) -> None:
    """Keep measure(rows) under path, a folder per year; with since_year only rows of that year and later are read and only those years' folders are written, so a filter on the year reaches the
    scan and older files stay as they are, byte for byte. Years from since_year on that have no rows any more lose their folder.

    measure must give each year's results from that year's rows alone and keep the column year.
    """
    spark = rows.sparkSession
    found = measure(rows if since_year is None else rows.filter(F.col("year") >= since_year))
    writer = found.repartition("year").write.partitionBy("year").mode("overwrite")
    if since_year is None:
        writer.option("partitionOverwriteMode", "static").parquet(path)
        return
    kept = _years(spark, path, since_year)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    there = {r["year"] for r in rows.filter(F.col("year") >= since_year).select("year").distinct().toLocalIterator()}
    jvm = spark.sparkContext._jvm
    for year in kept - there:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/year={year}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _years(spark: SparkSession, path: str, since_year: int) -> set[int]:
    try:
        return {r["year"] for r in spark.read.parquet(path).filter(F.col("year") >= since_year).select("year").distinct().toLocalIterator()}
    except AnalysisException:
        return set()


def stored(spark: SparkSession, path: str, dataset: str | None = None, year: int | None = None) -> DataFrame:
    """The kept results; a year reads its folder alone."""
    out = spark.read.parquet(path)
    out = out.filter(F.col("dataset") == dataset) if dataset else out
    return out.filter(F.col("year") == year) if year is not None else out


def per_divisor(observations: DataFrame, divisors: DataFrame, keys: tuple[str, ...] = ("geo", "year"), scale: float = 1.0) -> DataFrame:
    """Each observation over its own divisor, the one row (the least value, if several) of divisors with its keys; NULL without one or where it is 0. One aggregate and one outer join stand for a
    subquery per row; an observation is never doubled."""
    one = divisors.filter("value IS NOT NULL").groupBy(*keys).agg(F.min("value").alias("divisor"))
    joined = observations.join(one, list(keys), "left")
    return joined.withColumn("ratio", F.when(F.col("divisor") != 0, F.col("value") * scale / F.col("divisor")))


def lags(streams: DataFrame, offsets: DataFrame, key: str = "stream", by: str = "seq") -> DataFrame:
    """streams(stream, seq), offsets(reader, stream, seq): per reader and stream how far behind the newest event it is; one that has read nothing is behind by all, a stream without events by 0."""
    newest = streams.groupBy(key).agg(F.max(by).alias("newest"))
    read = offsets.groupBy("reader", key).agg(F.max(by).alias("read"))
    return read.join(newest, key, "left").select("reader", key, F.greatest(F.coalesce("newest", F.lit(0)) - F.coalesce("read", F.lit(0)), F.lit(0)).alias("lag"))


def panel(rows: DataFrame, *sets: tuple[str, ...], top: int | None = None, within: str | None = None, **measures) -> DataFrame:
    """Counts (and measures) of several groupings in one pass: a row per group of each set, with level, the set's number, and NULL in columns that the set hasn't. With ``top`` only the most
    frequent groups of each set, within each value of ``within`` where the set has it, by falling n and then by the columns."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    named = {c: f"_{c}_absent" for c in columns}
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.count("*").alias("n"), *(m.alias(k) for k, m in measures.items()), *(F.grouping(c).alias(named[c]) for c in columns))
    level = F.lit(None).cast("int")
    for i, s in enumerate(sets):
        level = F.when(F.lit(True) if not columns else _all(F.col(named[c]) == int(c not in s) for c in columns), i).otherwise(level)
    out = grouped.withColumn("level", level).drop(*named.values())
    if top is None:
        return out
    from pyspark.sql import Window

    order = Window.partitionBy("level", *([within] if within else [])).orderBy(F.desc("n"), *(c for c in columns if c != within))
    return out.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top).drop("place")


def _all(conditions) -> F.Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def rates(rows: DataFrame, *, by: str | None = None, **conditions: F.Column) -> DataFrame:
    """Per group (or of all rows): n, and for each condition the rows that meet it and their share in per cent to one digit; one pass. A missing condition isn't met."""
    counts = [F.count("*").alias("n"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items())]
    got = rows.groupBy(by).agg(*counts) if by else rows.agg(*counts)
    return got.withColumns({f"{k}_pct": S.rounded(F.col(k) / F.greatest("n", F.lit(1)) * 100, 1) for k in conditions})
