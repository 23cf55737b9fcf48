"""Lexical and vector search with reciprocal-rank fusion; tiered name search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.functions.scalars import cosine

FUSION = 60


def tokens(text: str) -> F.Column:
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _count(array: str, word: str) -> F.Column:
    return F.size(F.filter(array, lambda t: t == word))


def lexical(docs: DataFrame, words: list[str], limit: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, rank): rows with every word; the score is the words' share of all tokens. The top-k needs no global sort."""
    counted = docs.select(key, tokens(text).alias("t")).select(key, F.size("t").alias("n"), *(_count("t", w).alias(f"w{i}") for i, w in enumerate(words)))
    for i in range(len(words)):
        counted = counted.filter(F.col(f"w{i}") > 0)
    hits = sum((F.col(f"w{i}") for i in range(len(words))), F.lit(0))
    return _ranked(counted.select(key, S.rounded(hits / F.col("n"), 8).alias("score")), key, F.desc("score"), limit)


def vector(rows: DataFrame, query: list[float], limit: int = 100, embedding: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, score, rank) by cosine similarity, exact over all rows."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return _ranked(rows.select(key, S.rounded(cosine(F.col(embedding), q), 8).alias("score")), key, F.desc("score"), limit)


def _ranked(scored: DataFrame, key: str, order, limit: int) -> DataFrame:
    # The limit comes first (a top-k per task), so the rank's window sees at most ``limit`` rows.
    return scored.orderBy(order, key).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(order, F.col(key))))


def fuse(a: DataFrame | None, b: DataFrame | None, key: str, limit: int = 20) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists; a list that is None leaves the other's ranks (degraded mode)."""
    if a is None and b is None:
        raise ValueError("no list to fuse")
    ranks = lambda d, name: d.select(key, F.col("rank").alias(name))
    if a is None or b is None:
        both = ranks(b, "rb").withColumn("ra", F.lit(None).cast("int")) if a is None else ranks(a, "ra").withColumn("rb", F.lit(None).cast("int"))
    else:
        both = ranks(a, "ra").join(ranks(b, "rb"), key, "full")
    part = lambda r: F.coalesce(F.lit(1.0) / (FUSION + F.col(r)), F.lit(0.0))
    return both.select(key, "ra", "rb", S.rounded(part("ra") + part("rb"), 8).alias("score")).orderBy(F.desc("score"), key).limit(limit)


def tiered(names: DataFrame, query: str, limit: int = 50) -> DataFrame:
    """names(kind, key, name): exact name 4, prefix 2, contained 0; sources fill in the order of kind, then by tier, shorter name, name."""
    q, n = F.lit(query.lower()), F.lower("name")
    hit = names.filter(F.contains(n, q)).withColumn("tier", F.when(n == q, 4).when(n.startswith(q), 2).otherwise(0))
    return hit.select("kind", "key", "name", "tier").orderBy("kind", F.desc("tier"), F.length("name"), "name", "key").limit(limit)


def companies(names: DataFrame, listings: DataFrame, awarded: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """names(company, name), listings(company, ticker), awarded(company): companies by a text in their name or at the start of a ticker: company, name, ticker, source, tier.

    Listed ones come first, then those with contracts, then the others; in each by tier (name equal 4, ticker equal 3, name begins 2, ticker begins 1, name contains 0), shorter name, name. A company is
    there once, by the first of these that it belongs to, with the least of its tickers. Tickers count for listed companies alone. A top-k per task, no global sort.
    """
    q, name, ticker = F.lit(query.lower()), F.lower("name"), F.lower("ticker")
    contained, begun = F.contains(name, q), F.coalesce(ticker.startswith(q), F.lit(False))
    tier = F.when(name == q, 4).when(F.coalesce(ticker == q, F.lit(False)), 3).when(name.startswith(q), 2).when(begun, 1).otherwise(0)
    listed = names.join(listings.filter("ticker IS NOT NULL"), "company").filter(contained | begun)
    listed = listed.groupBy("company", "name").agg(F.max(tier).alias("tier"), F.min("ticker").alias("ticker")).withColumn("source", F.lit(1))
    rest = names.filter(contained).join(listed.select("company"), "company", "left_anti").withColumn("ticker", F.lit(None).cast("string")).withColumn("tier", tier)
    known = awarded.select("company").distinct().withColumn("_won", F.lit(True))
    rest = rest.join(known, "company", "left").withColumn("source", F.when(F.col("_won"), 2).otherwise(3))
    both = listed.select("company", "name", "ticker", "source", "tier").unionByName(rest.select("company", "name", "ticker", "source", "tier"))
    return both.orderBy("source", F.desc("tier"), F.length("name"), "name", "company").limit(limit)
