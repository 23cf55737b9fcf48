"""The driver's tables in the roles of notices, companies, filings, prices and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.sources.scratch import dealt
from tallyfold.sources.scratch import scratch as scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> int:
    """The number of line items, and so of notices."""
    return table(spark, sf_dir, "lineitem").count()


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as notices of contracts (orders); every 97th order is published a thousandfold. Contracts are joined last, so their rows lie together when they are collapsed."""
    li, o, c, p = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "part"))
    n = lines(spark, sf_dir)
    leak = F.when(F.col("l_orderkey") % 97 == 0, F.lit(1000.0)).otherwise(F.lit(1.0))
    items = dealt(li, n, "l_partkey").join(dealt(p, n, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    placed = dealt(o, n, "o_custkey").join(dealt(c, n, "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = dealt(items, n, "l_orderkey").join(dealt(placed, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    bidders = F.col("l_linenumber") % 4
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("notice_id"), F.col("l_orderkey").alias("contract_key"),
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("company"), F.col("o_custkey").alias("authority"),
        F.col("c_nationkey").alias("nation"), F.when(F.col("l_returnflag") == "R", "can-modif").otherwise("can-standard").alias("notice_type"),
        F.to_date("l_shipdate").alias("pub_date"), F.col("p_type").alias("division"), F.col("o_orderpriority").alias("priority"),
        F.col("l_extendedprice").alias("estimate"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) * leak).alias("total"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("payable"), F.when(bidders > 0, bidders).alias("bidders"),
        (F.col("l_orderkey") % 97 == 0).alias("low_confidence"),
        F.when(F.col("c_nationkey") % 5 == 0, "PRT").otherwise("POL").alias("country"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and year as annual filings."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    yearly = o.groupBy(F.col("o_custkey").alias("company"), F.year("o_orderdate").alias("year")).agg(S.rounded(F.sum("o_totalprice"), 2).alias("revenue"), F.count("*").alias("orders"))
    r, n = F.col("revenue"), F.col("orders")
    return yearly.join(c, F.col("company") == F.col("c_custkey")).select(
        "company", "year", "revenue", (r * 0.18).alias("net_income"), (r * 0.25).alias("operating_income"), (r * 0.22).alias("pretax"), (r * 0.04).alias("tax"),
        (r * 0.03).alias("depreciation"), (n * 1000.0).alias("shares"), (F.col("c_acctbal") * 20).alias("equity"), (n * 9000.0).alias("liabilities"),
        (n * 4000.0).alias("debt"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("cash"), (r / 20000.0).alias("price"), (n * 0.5).alias("dividend"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit prices of a brand's line items on a day as that day's prices."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return li.join(p, li.l_partkey == p.p_partkey).groupBy(F.col("p_brand").alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(
        F.max(unit).alias("high"), F.min(unit).alias("low"), F.avg(unit).alias("close"), F.sum("l_quantity").alias("volume"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean prices per priority (dataset), year, nation (region code R<region><nation>) and slice; means under 20000 count as missing."""
    li, o, c, n = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation"))
    rows = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    geo = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    mean = S.rounded(F.avg("l_extendedprice"), 4)
    out = rows.groupBy(F.col("o_orderpriority").alias("dataset"), F.year("l_shipdate").alias("year"), geo.alias("geo"), "l_returnflag", "l_linestatus").agg(mean.alias("m"))
    return out.select("dataset", "year", "geo", F.create_map(F.lit("flag"), F.col("l_returnflag"), F.lit("status"), F.col("l_linestatus")).alias("dims"),
                      F.concat(F.lit("flag="), "l_returnflag", F.lit("|status="), "l_linestatus").alias("slice_key"), F.when(F.col("m") >= 20000, F.col("m")).alias("value"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region codes of two levels: R<region> and R<region><nation>."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    top = r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"), F.lit(None).cast("string").alias("parent"))
    low = n.select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"))
    return top.unionByName(low)


def filings_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """filings with the figures that only some sources report."""
    c = F.col
    return filings(spark, sf_dir).withColumns({
        "gross_profit": c("revenue") * 0.4, "assets": c("equity") + c("liabilities"), "current_assets": c("shares") * 5, "current_liabilities": c("shares") * 3, "inventory": c("shares") * 0.4,
        "prepaid": F.when(c("company") % 2 == 1, c("shares") * 0.1), "operating_cashflow": c("revenue") * 0.2, "capex": F.when(c("company") % 4 > 0, c("revenue") * 0.05),
        "interest_expense": F.when(c("company") % 3 > 0, c("revenue") * 0.01), "long_term_debt": F.when(c("company") % 5 > 0, c("debt") * 0.8)})

