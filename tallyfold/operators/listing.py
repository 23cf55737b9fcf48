"""Lists as a page shows them: filters that may be unset, a stable order, pages, counts of what is shown, samples."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def optional(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality with each value that is set; a list means any of its values."""
    for name, value in wanted.items():
        if isinstance(value, (list, tuple)):
            df = df.filter(F.col(name).isin(*value))
        elif value is not None:
            df = df.filter(F.col(name) == value)
    return df


def starting_with(df: DataFrame, **prefixes: str | None) -> DataFrame:
    """Rows whose columns, as text, start with the prefixes that are set (a code's branch, a date's year)."""
    for name, prefix in prefixes.items():
        if prefix:
            df = df.filter(F.col(name).cast("string").startswith(prefix))
    return df


def in_region(df: DataFrame, prefix: str | None, region: str = "nuts", country: str = "country", country_of: dict[str, str] | None = None) -> DataFrame:
    """Rows of a region and its parts; a prefix of two letters is a country, whose rows without a region count by their country code."""
    if not prefix:
        return df
    hit = F.col(region).startswith(prefix)
    if len(prefix) == 2:
        hit = hit | (F.col(country) == (country_of or {}).get(prefix, prefix))
    return df.filter(F.coalesce(hit, F.lit(False)))


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0, most: int = 200) -> DataFrame:
    """Rows offset + 1 to offset + limit in an order that the caller makes total, with has_more: one row more is read to tell. A page has at most ``most`` rows, as with pages of a
    service: a larger limit is that limit, and has_more then says that there are more. A top-k per task, no global sort."""
    limit = min(limit, most)
    place = "_place"
    top = df.orderBy(*order).limit(offset + limit + 1).withColumn(place, F.row_number().over(Window.orderBy(*order)))
    more = F.max(place).over(Window.partitionBy(F.lit(1))) > offset + limit
    return top.withColumn("has_more", more).filter((F.col(place) > offset) & (F.col(place) <= offset + limit)).drop(place)


def shown_counts(shown: DataFrame, by: str) -> DataFrame:
    """Counts over the rows of a page only."""
    return shown.groupBy(by).agg(F.count("*").alias("n"))


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by the hash of their key and a seed: random to the eye, the same for every run and engine with that hash."""
    return df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))).orderBy("_h", key).limit(n).drop("_h")


def label(*parts: str) -> Column:
    """Parts with a dash between; missing ones leave none."""
    return F.concat_ws(" - ", *parts)


def in_language(df: DataFrame, name: str, lang: str | None, known: list[str]) -> Column:
    """The name in a language of the list (its first two letters), else the name itself."""
    short = (lang or "")[:2].lower()
    own = f"{name}_{short}"
    return F.coalesce(F.col(own), F.col(name)) if short in known and own in df.columns else F.col(name)


def union_of_keys(*frames: DataFrame) -> DataFrame:
    """Distinct rows of frames with the same columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def with_latest(df: DataFrame, details: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """df with the greatest value of its details, missing where there are none."""
    return df.join(details.groupBy(key).agg(F.max(value).alias(out)), key, "left")


def first_of(df: DataFrame, key: str, exact: DataFrame, fallback: DataFrame, fallback_key: str, out: str) -> DataFrame:
    """out from exact(key, out) where it has the row's key, else from fallback(fallback_key, out); via tells which."""
    a = exact.select(F.col(key).alias("_k"), F.col(out).alias("_a")).distinct()
    b = fallback.select(F.col(fallback_key).alias("_f"), F.col(out).alias("_b")).distinct()
    both = df.join(a, F.col(key).eqNullSafe(F.col("_k")), "left").join(b, F.col(fallback_key) == F.col("_f"), "left")
    return both.withColumns({out: F.coalesce("_a", "_b"), "via": F.when(F.col("_a").isNotNull(), "key").when(F.col("_b").isNotNull(), "fallback")}).drop("_k", "_a", "_f", "_b")


#: How a version 5 or any other UUID begins.
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-"


def by_identity(wanted: DataFrame, listings: DataFrame, rows: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """wanted(id): rows of the company that each id names, with id and source. An id that begins like a UUID is the company's own, any other one a ticker, looked up in listings(ticker, company); tickers
    whose company has no rows take those of fallback(ticker, ...), whose other columns are those of rows(company, ...) without company."""
    own = wanted.filter(F.col("id").rlike(UUID)).select("id", F.col("id").alias("company"))
    listed = wanted.filter(~F.col("id").rlike(UUID)).join(listings.select(F.col("ticker").alias("id"), "company").distinct(), "id")
    found = own.unionByName(listed.select("id", "company")).join(rows, "company").withColumn("source", F.lit("store"))
    if fallback is None:
        return found
    missing = wanted.filter(~F.col("id").rlike(UUID)).join(found.select("id").distinct(), "id", "left_anti")
    return found.unionByName(missing.join(fallback.withColumnRenamed("ticker", "id"), "id").withColumn("source", F.lit("filings")), allowMissingColumns=True)
