"""Values by region: companies, contracts and money on any level, in a scope, with empty regions; an entity's partners by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S

DEEPEST = 3
METRICS = ("companies", "contracts", "contracts_eur")


def _checked(level: int, metric: str, scope: str | None, metrics: tuple[str, ...]) -> None:
    if level not in range(DEEPEST + 1):
        raise ValueError(f"a level is 0 to {DEEPEST}")
    if metric not in metrics:
        raise ValueError(f"a metric is one of {metrics}")
    if level == DEEPEST and not scope:
        raise ValueError(f"level {DEEPEST} needs a scope")


def _value(metric: str) -> F.Column:
    if metric == "companies":
        return F.count_distinct("company").cast("double")
    if metric == "contracts":
        return F.count_distinct(F.when(F.col("is_current"), F.col("contract"))).cast("double")
    return S.rounded(F.sum(F.when(F.col("is_current") & ~F.coalesce(F.col("low_confidence"), F.lit(False)), F.coalesce("value", F.lit(0.0))).otherwise(0.0)), 2)


def by_region(located: DataFrame, contracts: DataFrame, regions: DataFrame, metric: str, level: int, scope: str | None = None, connected: DataFrame | None = None) -> DataFrame:
    """located(company, code), contracts(contract, company, value, is_current, low_confidence), regions(code): (code, value) of every region of the level, of those under the scope if one is given;
    0 where nothing is. A region's level is its code's length less two, its ancestors are its code's beginnings. connected(company) lets only these count. A company in several places counts
    in each, its money too; in one region of the level a company or contract counts once, but money once for each place."""
    _checked(level, metric, scope, METRICS)
    wanted = regions.filter(F.length("code") == level + 2).select("code").distinct()
    rows = located.filter(F.length("code") >= level + 2)
    if scope:
        wanted, rows = wanted.filter(F.col("code").startswith(scope)), rows.filter(F.col("code").startswith(scope))
    if connected is not None:
        rows = rows.join(connected.select("company").distinct(), "company", "left_semi")
    rows = rows.select("company", F.substring("code", 1, level + 2).alias("code"))
    if metric != "companies":
        # Each company's contracts are folded before they meet its places, where the metric lets them.
        rows = rows.join(contracts.select("contract", "company", "value", "is_current", "low_confidence"), "company")
    values = rows.groupBy("code").agg(_value(metric).alias("value"))
    return wanted.join(values, "code", "left").select("code", F.coalesce("value", F.lit(0.0)).alias("value"))


def of_entity(contracts: DataFrame, located: DataFrame, countries: DataFrame, regions: DataFrame, metric: str, level: int, company: int | None = None, authority: int | None = None, scope: str | None = None) -> DataFrame:
    """An entity's contracts by where its partners are, (code, value): a company's by its authorities' country, which is known on level 0 alone (deeper levels have no row); an authority's by the
    places of the companies that it awarded to. contracts(contract, company, authority, value, is_current, low_confidence), countries(authority, code), located(company, code)."""
    _checked(level, metric, scope, METRICS[1:])
    if (company is None) == (authority is None):
        raise ValueError("either a company or an authority")
    if company is not None:
        own = contracts.filter(F.col("company") == company).join(countries, "authority").withColumn("code", F.when(F.lit(level) == 0, F.col("code")))
        own = own.filter("code IS NOT NULL")
    else:
        own = contracts.filter(F.col("authority") == authority).join(located, "company").filter(F.length("code") >= level + 2).withColumn("code", F.substring("code", 1, level + 2))
    if scope:
        own = own.filter(F.col("code").startswith(scope) | F.lit(scope).startswith(F.col("code")))
    known = regions.filter(F.length("code") == level + 2).select("code").distinct()
    return own.groupBy("code").agg(_value(metric).alias("value")).join(known, "code", "left_semi")
