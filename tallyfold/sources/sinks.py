"""Writers: appended event batches, partitions that a run replaces, spreadsheets, request lines, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import identifiers as I


def append_events(rows: DataFrame, path: str, producer: str, kind: str, key: str, batch: str | None = None) -> str:
    """One event (batch, producer, kind, key, payload) per row, appended as one batch; a batch id that is there already is not written again."""
    batch = batch or uuid.uuid4().hex
    spark = rows.sparkSession
    payload = F.to_json(F.struct(*rows.columns))
    events = rows.select(F.lit(producer).alias("producer"), F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), payload.alias("payload"), F.lit(batch).alias("batch"))
    if not _has_batch(spark, path, batch):
        events.write.mode("append").partitionBy("batch").parquet(path)
    return batch


def _has_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether the folder holds the batch, asked of the store itself, so that remote ones work as well."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch}")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def replace_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Writes the partitions that rows has and leaves all others, so a repeated run of a day or dataset changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def spreadsheet(rows: DataFrame, path: str, key: str, fields: list[str]) -> None:
    """Annual rows as CSV text, one folder per key, newest year first within a file; whole numbers without decimals, others with two, missing ones empty."""
    shown = rows.select(key, F.col("year").cast("string").alias("year"), *(I.shown_number(F.col(f).cast("double")).alias(f) for f in fields))
    shown.repartition(key).sortWithinPartitions(key, F.desc("year")).write.mode("overwrite").option("header", True).option("emptyValue", "").partitionBy(key).csv(path)


#: The language that names of a country are in, by ISO alpha-2; fixed values.
COUNTRY_LANGUAGE = {
    "AT": "de", "BE": "nl", "BG": "bg", "CY": "el", "CZ": "cs", "DE": "de", "DK": "da", "EE": "et", "ES": "es", "FI": "fi", "FR": "fr", "GR": "el", "HR": "hr", "HU": "hu", "IE": "en", "IT": "it",
    "LT": "lt", "LU": "fr", "LV": "lv", "MT": "mt", "NL": "nl", "PL": "pl", "PT": "pt", "RO": "ro", "SE": "sv", "SI": "sl", "SK": "sk", "GB": "en",
}


def source_language(lang: F.Column, country: F.Column) -> F.Column:
    """The language that is stated, else the country's, else English."""
    known = F.create_map(*(F.lit(x) for kv in COUNTRY_LANGUAGE.items() for x in kv))
    return F.coalesce(F.nullif(F.lower(F.trim(lang)), F.lit("")), F.try_element_at(known, F.upper(country)), F.lit("en"))


def translation_requests(names: DataFrame, path: str, languages: list[str]) -> None:
    """names(id, name, lang) as JSON lines (id, name, source, targets): all languages but the name's own; no language counts as English."""
    source = F.coalesce("lang", F.lit("en"))
    names.select("id", "name", source.alias("source"), F.array_except(F.array(*map(F.lit, languages)), F.array(source)).alias("targets")).write.mode("overwrite").json(path)


def translations(spark: SparkSession, path: str, names: DataFrame, languages: list[str]) -> DataFrame:
    """Answers (id, names: language to text) as (id, lang, name), known languages other than the name's own only; empty ones go."""
    answers = spark.read.schema("id string, names map<string, string>").json(path).select("id", F.explode("names").alias("lang", "name"))
    own = names.select(F.col("id").cast("string").alias("_id"), F.coalesce("lang", F.lit("en")).alias("_own"))
    out = answers.join(own, F.col("id") == F.col("_id")).filter(F.col("lang").isin(*languages) & (F.col("lang") != F.col("_own")) & (F.trim("name") != ""))
    return out.groupBy("id", "lang").agg(F.min(F.trim("name")).alias("name"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of a folder's files, hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def erase(persons: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Takes persons(id) out of tables (name: frame and its person column): the remaining tables, and (table, erased) counts."""
    gone = persons.select(F.col("id").alias("_gone")).distinct()
    left, counts = {}, None
    for name, (rows, column) in tables.items():
        left[name] = rows.join(gone, rows[column] == F.col("_gone"), "left_anti")
        n = rows.join(gone, rows[column] == F.col("_gone"), "left_semi").agg(F.count("*").alias("erased")).select(F.lit(name).alias("table"), "erased")
        counts = n if counts is None else counts.unionByName(n)
    return left, counts


def export_universe(listings: DataFrame, path: str) -> None:
    """listings(ticker, listing): a JSON line per ticker with the number of its distinct listings and the first of them; tickers without a name are left out."""
    named = listings.filter("ticker IS NOT NULL AND ticker <> ''")
    named.groupBy("ticker").agg(F.count_distinct("listing").alias("listings"), F.min("listing").alias("first")).write.mode("overwrite").json(path)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("ticker string, listings long, first long").json(path)


def headed_sheets(snapshot: DataFrame, annual: DataFrame, path: str, fields: dict[str, str]) -> None:
    """A text file per ticker, as the spreadsheet lays it out: three rows of metadata (market, last quarter, dividend and split), the columns' names, and the years, newest first.

    snapshot(ticker, price, avg_volume, current_assets, inventory, prepaid, current_liabilities, debt, equity, shares, dividend_day, dividend, split_year, split_ratio), annual(ticker, year, ...), fields:
    shown name to column of annual. Missing figures are empty, a missing split ratio is No; a ticker without a snapshot has no file.
    """
    shown = lambda c: F.coalesce(I.shown_number(F.col(c).cast("double")), F.lit(""))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = lambda *parts: F.concat_ws(",", *(F.lit(p) if isinstance(p, str) else p for p in parts))
    quarter = [x for name, c in (("Cur Assets", "current_assets"), ("Inv.", "inventory"), ("PrePaidEx.", "prepaid"), ("Cur Liabi.", "current_liabilities"), ("debt", "debt"), ("equity", "equity"), ("shares", "shares")) for x in (name, shown(c))]
    head = [
        row("Ticker", F.col("ticker"), "Price", shown("price"), "Avg. Volume", shown("avg_volume")), row(*quarter),
        row("Last Div", text("dividend_day"), "Amount", shown("dividend"), "Last Split", text("split_year"), "Split Ratio", F.when(F.col("split_ratio").isNull(), "No").otherwise(shown("split_ratio"))),
        row("Year", *fields),
    ]
    heads = snapshot.select("ticker", F.posexplode(F.array(*head)).alias("place", "line"))
    years = annual.join(snapshot.select("ticker").distinct(), "ticker", "left_semi").select("ticker", (F.lit(100_000) - F.col("year")).cast("int").alias("place"), row(F.col("year").cast("string"), *(shown(c) for c in fields.values())).alias("line"))
    lines = heads.unionByName(years)
    lines.repartition("ticker").sortWithinPartitions("ticker", "place", "line").select("ticker", "line").write.mode("overwrite").partitionBy("ticker").text(path)
