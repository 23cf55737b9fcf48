"""Statistics cube: slice and dataset statistics, level universe, yearly availability, series, bivariate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.functions.scalars import safe_div


def _spread(df: DataFrame, *keys: str, **more) -> DataFrame:
    """n, low, high and exact percentiles of value per group. Equal values are counted before, over all tasks, so a group's buffer holds its distinct values once."""
    counted = df.groupBy(*keys, "value").agg(F.count("*").alias("_n"), *(f.alias(name) for name, (f, _) in more.items()))
    out = counted.groupBy(*keys).agg(F.sum("_n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.percentile("value", [0.02, 0.5, 0.98], F.col("_n")).alias("_p"), *(f.alias(name) for name, (_, f) in more.items()))
    return out.withColumns({"p02": F.col("_p")[0], "p50": F.col("_p")[1], "p98": F.col("_p")[2]}).drop("_p")


def _described(df: DataFrame, *keys: str) -> DataFrame:
    low = F.col("p50") - F.col("p02")
    kind = F.when((F.col("low") < 0) & (F.col("high") > 0), "diverging").otherwise("sequential")
    skew = F.when(low > 0, (F.col("p98") - F.col("p50")) / low)
    return df.withColumns({"kind": kind, "skew": skew}).select(*keys, "n", *(S.rounded(c, 4).alias(c) for c in ("low", "high", "p02", "p50", "p98", "skew")), "kind")


def slice_stats(observations: DataFrame) -> DataFrame:
    """Per dataset and slice; missing values take no part."""
    return _described(_spread(observations.filter("value IS NOT NULL"), "dataset", "slice_key"), "dataset", "slice_key")


def dataset_stats(observations: DataFrame) -> DataFrame:
    """Per dataset; the count includes missing values."""
    years = {"y0": (F.min("year"), F.min("y0")), "y1": (F.max("year"), F.max("y1"))}
    return _described(_spread(observations, "dataset", **years), "dataset", "y0", "y1")


def level_universe(observations: DataFrame, regions: DataFrame, levels: int = 4) -> DataFrame:
    """Regions per level: of the region table, else of the observations, else 0."""
    known = regions.withColumn("level", F.length("code") - 2).groupBy("level").agg(F.count_distinct("code").alias("known"))
    seen = observations.withColumn("level", F.length("geo") - 2).groupBy("level").agg(F.count_distinct("geo").alias("seen"))
    spine = observations.sparkSession.range(levels).select(F.col("id").cast("int").alias("level"))
    return spine.join(known, "level", "left").join(seen, "level", "left").select("level", F.coalesce("known", "seen", F.lit(0)).cast("long").alias("universe"))


def year_availability(observations: DataFrame, universe: DataFrame) -> DataFrame:
    rows = observations.withColumn("level", F.length("geo") - 2).groupBy("dataset", "level", "slice_key", "year").agg(F.count_distinct(F.when(F.col("value").isNotNull(), F.col("geo"))).alias("present"))
    return rows.join(universe, "level", "left").select("dataset", "level", "slice_key", "year", "present", S.rounded(safe_div(F.col("present") * 100.0, F.col("universe").cast("double")), 4).alias("pct"))


def series(observations: DataFrame, dataset: str, level: int | None = None, geo: list[str] | None = None, start: int | None = None, end: int | None = None, dims: dict[str, str] | None = None, limit: int = 100_000) -> DataFrame:
    """Filtered observations in (geo, year, slice) order, at most limit rows; a level or region list is required."""
    if level is None and not geo:
        raise ValueError("a level or a region list is required")
    out = observations.filter(F.col("dataset") == dataset)
    if geo:
        out = out.filter(F.col("geo").isin(*geo))
    if level is not None:
        out = out.filter(F.length("geo") == level + 2)
    if start is not None:
        out = out.filter(F.col("year") >= start)
    if end is not None:
        out = out.filter(F.col("year") <= end)
    for k, v in (dims or {}).items():
        out = out.filter(F.col("dims")[k] == v)
    return out.orderBy("geo", "year", "slice_key").limit(limit)


def bounded_series(observations: DataFrame, dataset: str, limit: int = 100_000, **filters) -> tuple[DataFrame, bool]:
    """series(...) with whether there are more rows than limit: one row more is asked for."""
    got = series(observations, dataset, limit=limit + 1, **filters)
    return got.limit(limit), got.count() > limit


def bivariate(x: DataFrame, y: DataFrame, limit: int = 20) -> DataFrame:
    """Two measures of the same regions."""
    return x.select("geo", S.rounded("value", 4).alias("x")).join(y.select("geo", S.rounded("value", 4).alias("y")), "geo").orderBy(F.desc("x"), "geo").limit(limit)
