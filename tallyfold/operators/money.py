"""Amounts as published, to euro: currency resolution, sentinels, and an as-of join with the rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: First day of the euro per country (ISO alpha-3); before it a country's default is its own currency. Fixed values.
EURO_SINCE = {
    "AUT": "1999-01-01", "BEL": "1999-01-01", "DEU": "1999-01-01", "ESP": "1999-01-01", "FIN": "1999-01-01", "FRA": "1999-01-01", "IRL": "1999-01-01", "ITA": "1999-01-01", "LUX": "1999-01-01",
    "NLD": "1999-01-01", "PRT": "1999-01-01", "GRC": "2001-01-01", "SVN": "2007-01-01", "CYP": "2008-01-01", "MLT": "2008-01-01", "SVK": "2009-01-01", "EST": "2011-01-01", "LVA": "2014-01-01",
    "LTU": "2015-01-01", "HRV": "2023-01-01",
}
#: National currencies, for countries outside the euro and for days before it. Fixed values.
NATIONAL = {
    "AUT": "ATS", "BEL": "BEF", "DEU": "DEM", "ESP": "ESP", "FIN": "FIM", "FRA": "FRF", "IRL": "IEP", "ITA": "ITL", "LUX": "LUF", "NLD": "NLG", "PRT": "PTE", "GRC": "GRD", "SVN": "SIT", "CYP": "CYP",
    "MLT": "MTL", "SVK": "SKK", "EST": "EEK", "LVA": "LVL", "LTU": "LTL", "HRV": "HRK", "BGR": "BGN", "CZE": "CZK", "DNK": "DKK", "HUN": "HUF", "POL": "PLN", "ROU": "RON", "SWE": "SEK", "GBR": "GBP",
    "NOR": "NOK", "CHE": "CHF", "ISL": "ISK",
}


def resolved_currency(declared: Column, country: Column, day: Column) -> Column:
    """The declared code where it is three letters; else the country's currency on that day; else NULL."""
    code = F.upper(F.trim(declared))
    since, own = (F.create_map(*(F.lit(x) for kv in d.items() for x in kv)) for d in (EURO_SINCE, NATIONAL))
    default = F.when(F.try_element_at(since, country).cast("date") <= day, "EUR").otherwise(F.try_element_at(own, country))
    return F.when(code.rlike("^[A-Z]{3}$"), code).otherwise(default)


def published_amount(text: Column) -> Column:
    """A published amount as a number; NULL for text that is no number, and for the sentinels of undisclosed values: below zero, 0, 1, and runs of nines from six digits on."""
    value = F.regexp_replace(F.trim(text), "[  ']", "").try_cast("double")
    nines = F.regexp_replace(F.trim(text), "[  ']", "").rlike(r"^9{6,}(\.9+|\.0+)?$")
    return F.when((value > 1) & ~nines & ~F.isnan(value) & (value < float("inf")), value)


def as_of(rows: DataFrame, facts: DataFrame, key: str, day: str, value: str, out: str, span_days: int = 32) -> DataFrame:
    """rows with the value of the newest fact of their key at or before their day, whatever the distance; NULL without one. All columns of rows stay.

    Days are cut into spans of fixed length. What is newest within a span is found by a window over (key, span), so a key with a third of the rows is spread over its spans; what was newest before a
    span is carried over the few (key, span) pairs alone. Of several facts of one day the least counts. Distinct days, not rows, go through the window.
    """
    span = lambda d: F.floor(F.unix_date(d) / span_days)
    once = facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(day).cast("date").alias("_d")).agg(F.min(value).alias("_v"))
    asked = rows.select(F.col(key).alias("_k"), F.col(day).cast("date").alias("_d")).filter("_k IS NOT NULL AND _d IS NOT NULL").distinct()
    both = asked.select("_k", "_d", F.lit(None).cast(once.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_asks")).unionByName(once.withColumn("_asks", F.lit(0))).withColumn("_s", span("_d"))
    here = Window.partitionBy("_k", "_s").orderBy("_d", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = both.withColumn("_own", F.last("_v", ignorenulls=True).over(here)).filter("_asks = 1").select("_k", "_d", "_s", "_own")
    spans = both.groupBy("_k", "_s").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_d"))).alias("_last"))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    opened = spans.withColumn("_open", F.last("_last", ignorenulls=True).over(before)).select("_k", "_s", "_open")
    known = within.join(opened, ["_k", "_s"]).select("_k", "_d", F.coalesce("_own", "_open").alias(out))
    joined = rows.join(known, (rows[key] == known["_k"]) & (rows[day].cast("date") == known["_d"]), "left")
    return joined.drop("_k", "_d")


def published_to_euro(amounts: DataFrame, rates: DataFrame) -> DataFrame:
    """amounts(declared, country, day, published), rates(currency, day, per_euro): adds currency, amount and eur. Without a currency, an amount or a rate eur is NULL."""
    rows = amounts.withColumns({"currency": resolved_currency(F.col("declared"), F.col("country"), F.col("day").cast("date")), "amount": published_amount(F.col("published"))})
    got = as_of(rows, rates.filter("per_euro > 0"), "currency", "day", "per_euro", "_rate")
    return got.withColumn("eur", F.when(F.col("currency") == "EUR", F.col("amount")).otherwise(F.col("amount") / F.col("_rate"))).drop("_rate")
