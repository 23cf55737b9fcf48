"""Country codes, identifiers of things, keys by hash, venues, comparable values and text segments as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalars import uuid5

#: The statistics office's country codes that differ from the two-letter standard, and the code of a territory outside it.
OVERRIDES = {"EL": "GRC", "UK": "GBR", "XK": "XKX"}
#: Fixed value: namespace of the version 5 ids.
NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
#: Exchange codes and the symbol suffixes that they stand for.
EXCHANGE_SUFFIX = {"GY": "DE", "GF": "DE", "SM": "MC", "SQ": "MC", "IM": "MI", "NA": "AS", "FP": "PA", "LN": "L", "NO": "OL", "SS": "ST", "DC": "CO", "FH": "HE", "ID": "IR", "PW": "WA", "PL": "LS"}


def clean_code(code: Column) -> Column:
    """Stripped upper case; empty is missing."""
    return F.nullif(F.upper(F.trim(code)), F.lit(""))


def with_alpha3(df: DataFrame, code: str, countries: DataFrame, out: str = "alpha3") -> DataFrame:
    """countries(alpha2, alpha3), a few hundred rows: a two- or three-letter code in three letters; unknown ones are missing."""
    extra = df.sparkSession.createDataFrame(list(OVERRIDES.items()), "alpha2 string, alpha3 string")
    known = countries.select("alpha2", "alpha3").unionByName(extra)
    both = known.select(F.col("alpha2").alias("_code"), F.col("alpha3").alias("_to")).unionByName(known.select(F.col("alpha3").alias("_code"), F.col("alpha3").alias("_to"))).groupBy("_code").agg(F.max("_to").alias(out))
    return df.withColumn("_given", clean_code(F.col(code))).join(F.broadcast(both), F.col("_given") == F.col("_code"), "left").drop("_given", "_code")


def id_of(kind: str, *parts: Column) -> Column:
    """Version 5 id of an entity by the kind of its key: lei, cik, national, name, vat, or any other label (taxonomy codes)."""
    first = parts[0]
    name = {
        "lei": lambda: F.concat(F.lit("lei:"), first),
        "cik": lambda: F.concat(F.lit("edgar:"), F.when(F.length(first) >= 10, first).otherwise(F.lpad(first, 10, "0"))),
        "national": lambda: F.concat(F.upper(first), F.lit(":"), parts[1]),
        "name": lambda: F.concat(F.upper(first), F.lit(":"), F.upper(F.trim(parts[1]))),
        "vat": lambda: F.concat(F.upper(first), F.lit(":"), F.trim(parts[1])),
    }.get(kind, lambda: F.concat(F.lit(f"{kind}:"), *parts))()
    return uuid5(NAMESPACE, name)


def iri(base: str, kind: Column, key: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/id/"), kind, F.lit("/"), key)


def iri_kind(value: Column) -> Column:
    """The class in .../id/<Class>/<uuid>, missing for anything else."""
    return F.nullif(F.regexp_extract(value, r"/id/([A-Za-z]+)/[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", 1), F.lit(""))


def iri_tail(value: Column) -> Column:
    return F.substring_index(value, "/", -1)


def slice_key(dims: Column) -> Column:
    """MD5 of the dimensions in the order of their names."""
    pairs = F.transform(F.array_sort(F.map_entries(dims)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.md5(F.array_join(pairs, "|"))


def segments(text: Column) -> Column:
    """title, subtitle and context of a text whose parts stand between long dashes; empty parts don't count."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), " — "), lambda p: F.trim(p)), lambda p: p != "")
    part = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    context = F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), " · ")).otherwise("")
    return F.struct(part(1).alias("title"), part(2).alias("subtitle"), context.alias("context"))


def symbol(ticker: Column, exchange: Column) -> Column:
    """Ticker with the suffix of its exchange; home symbols (exchange US) have none and a dash for the dot; unknown exchanges have no symbol."""
    suffix = F.create_map(*(F.lit(x) for kv in EXCHANGE_SUFFIX.items() for x in kv))[clean_code(exchange)]
    return F.when(clean_code(exchange) == "US", F.replace(ticker, F.lit("."), F.lit("-"))).when(suffix.isNotNull(), F.concat(ticker, F.lit("."), suffix))


def instrument_class(kind: Column, company: list[str], fund: list[str]) -> Column:
    """company, fund, or missing."""
    return F.when(F.trim(kind).isin(company), "company").when(F.trim(kind).isin(fund), "fund")


def comparable(value: Column) -> Column:
    """Form in which values of two stores are compared: a number with at most four digits behind the point, else the trimmed text."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    shown = F.regexp_replace(F.regexp_replace(F.format_string("%.4f", number), "0+$", ""), r"\.$", "")
    return F.when(text.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), shown).otherwise(text)


def longest(names: Column) -> Column:
    """The longest of an array of names; of equally long ones the greatest."""
    return F.array_max(F.transform(F.filter(names, lambda n: n.isNotNull()), lambda n: F.struct(F.length(n).alias("l"), n.alias("n"))))["n"]


def unless_zero(x: Column) -> Column:
    """Missing where it is zero but for rounding."""
    return F.when(F.abs(x) > 1e-9, x)


def json_amount(payload: Column, field: str) -> Column:
    """A number in a JSON text; missing and empty count as 0."""
    return F.coalesce(F.nullif(F.get_json_object(payload, f"$.{field}"), F.lit("")), F.lit("0")).try_cast("double")
