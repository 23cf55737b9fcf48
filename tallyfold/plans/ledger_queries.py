"""Named queries on filings, values, resolution, quality, loads, readers and writers; each with its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import codes
from tallyfold.functions import scalars as S
from tallyfold.operators import etl, finance, matching, procurement, quality, search
from tallyfold.plans import oracles as O
from tallyfold.plans.views import filings, filings_full, notices, observations, scratch, table
from tallyfold.sources import readers, registers, sinks
from tallyfold.sources.scratch import kept

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = O._half_up(sql)
        return f

    return add


# Filings -----------------------------------------------------------------------------------------------------------

_FULL = O.FILINGS + """, full_ AS (SELECT *, revenue * 0.4::DOUBLE AS gross_profit, equity + liabilities AS assets, shares * 5 AS current_assets, shares * 3 AS current_liabilities, shares * 0.4::DOUBLE AS inventory,
  CASE WHEN company % 2 = 1 THEN shares * 0.1::DOUBLE END AS prepaid, revenue * 0.2::DOUBLE AS operating_cashflow, CASE WHEN company % 4 > 0 THEN revenue * 0.05::DOUBLE END AS capex,
  CASE WHEN company % 3 > 0 THEN revenue * 0.01::DOUBLE END AS interest_expense, CASE WHEN company % 5 > 0 THEN debt * 0.8::DOUBLE END AS long_term_debt,
  dense_rank() OVER w AS n, lead(revenue) OVER w AS rev0, lead(net_income) OVER w AS net0 FROM filings WINDOW w AS (PARTITION BY company ORDER BY year DESC))"""
_PER_YEAR = _FULL + """, q AS (SELECT *, operating_cashflow - abs(capex) AS fcf, net_income / shares AS eps, equity / shares AS bvps, revenue / shares AS rps FROM full_ WHERE n <= 5),
  ratios AS (SELECT company, year, round(price, 4) AS avg_price, round(revenue, 4) AS revenue, round(gross_profit, 4) AS gross_profit, round(operating_income, 4) AS operating_income, round(net_income, 4) AS net_income, round(eps, 4) AS eps,
    round(assets, 4) AS total_assets, round(liabilities, 4) AS total_liabilities, round(equity, 4) AS equity, round(shares, 4) AS shares, round(current_assets, 4) AS current_assets, round(current_liabilities, 4) AS current_liabilities,
    round(operating_cashflow, 4) AS operating_cashflow, round(capex, 4) AS capex, round(fcf, 4) AS free_cashflow, round(nullif(bvps, 0), 4) AS book_value_per_share, round(rps, 4) AS revenue_per_share, round(fcf / shares, 4) AS fcf_per_share,
    round(dividend, 4) AS dividend_per_share, round(CASE WHEN eps > 0 THEN price / eps END, 4) AS pe, round(CASE WHEN bvps > 0 THEN price / bvps END, 4) AS pb, round(CASE WHEN rps > 0 THEN price / rps END, 4) AS ps,
    round(net_income / nullif(equity, 0) * 100, 4) AS roe, round(net_income / nullif(assets, 0) * 100, 4) AS roa, round(net_income / revenue * 100, 4) AS npm, round(gross_profit / revenue * 100, 4) AS gross_margin,
    round(operating_income / revenue * 100, 4) AS operating_margin, round(current_assets / current_liabilities, 4) AS current_ratio, round((current_assets - coalesce(inventory, 0) - coalesce(prepaid, 0)) / current_liabilities, 4) AS quick_ratio,
    round(liabilities / nullif(equity, 0), 4) AS debt_to_equity, round(liabilities / nullif(assets, 0), 4) AS debt_to_assets, round(fcf / shares / price * 100, 4) AS fcf_yield, round(dividend / price * 100, 4) AS dividend_yield,
    round((revenue - rev0) / abs(rev0) * 100, 4) AS revenue_growth, round((net_income - net0) / abs(net0) * 100, 4) AS earnings_growth FROM q)"""
_VALUED = _FULL + """, v AS (SELECT *, coalesce(long_term_debt, 0) AS ltd, coalesce(cash, 0) AS c, operating_income + depreciation AS e, CASE WHEN net_income + tax <> 0 THEN greatest(0, least(0.5, tax / (net_income + tax))) ELSE 0.21 END AS t FROM full_ WHERE n <= 5),
  valued AS (SELECT company, year, round(depreciation, 4) AS da, round(cash, 4) AS cash, round(long_term_debt, 4) AS long_term_debt, round(e, 4) AS ebitda, round(e / revenue * 100, 4) AS ebitda_margin, round(ltd - c, 4) AS net_debt,
    round(nullif(ltd - c, 0) / nullif(e, 0), 4) AS net_debt_to_ebitda, round(operating_income / interest_expense, 4) AS interest_coverage, round(t * 100, 4) AS effective_tax_rate, round(operating_income * (1 - t), 4) AS nopat,
    round(equity + ltd - c, 4) AS invested_capital, round(operating_income * (1 - t) / nullif(equity + ltd - c, 0) * 100, 4) AS roic FROM v)"""


@query(f"WITH {_PER_YEAR} SELECT * FROM ratios")
def fundamentals_full(spark: SparkSession, sf: str) -> DataFrame:
    return finance.fundamentals_full(filings_full(spark, sf))


@query(f"WITH {_VALUED} SELECT * FROM valued")
def valuation_years(spark: SparkSession, sf: str) -> DataFrame:
    return finance.valuation_per_year(filings_full(spark, sf))


@query(f"WITH {_VALUED} SELECT company, round(avg(ebitda_margin), 4) AS avg_ebitda_margin, round(avg(net_debt_to_ebitda), 4) AS avg_net_debt_to_ebitda, round(avg(interest_coverage), 4) AS avg_interest_coverage, round(avg(roic), 4) AS avg_roic FROM valued GROUP BY 1")
def valuation_averages(spark: SparkSession, sf: str) -> DataFrame:
    return finance.valuation_averages(finance.valuation_per_year(filings_full(spark, sf)))


@query(f"WITH {_PER_YEAR} SELECT company, year, revenue, -abs(capex) AS capex, round(c_acctbal, 2) AS balance FROM ratios LEFT JOIN customer ON c_custkey = company AND c_acctbal > 0")
def raw_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Annual rows beside the customer's balance as the market snapshot."""
    snapshot = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("company"), S.rounded("c_acctbal", 2).alias("balance"))
    return finance.raw_dataset(finance.fundamentals_full(filings_full(spark, sf)), snapshot).select("company", "year", "revenue", "capex", "balance")


@query("""SELECT CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) WHEN c_nationkey = 24 THEN 'edgar' ELSE 'esef' END AS source, count(*) AS n FROM customer GROUP BY 1""")
def filing_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Where customers' filings are from: a segment as reported source for a quarter, else by nation 24 standing for the home country."""
    c = table(spark, sf, "customer")
    reported, country = F.when(F.col("c_custkey") % 4 == 0, F.col("c_mktsegment")), F.when(F.col("c_nationkey") == 24, "US").otherwise("XX")
    return c.groupBy(finance.filing_source(reported, country).alias("source")).agg(F.count("*").alias("n"))


@query(f"WITH {O.FILINGS} SELECT company, year, cash AS cash_and_equivalents, revenue FROM filings")
def filings_series(spark: SparkSession, sf: str) -> DataFrame:
    return finance.as_series(filings(spark, sf), {"cash": "cash_and_equivalents"}).select("company", "year", "cash_and_equivalents", "revenue")


@query(f"""WITH {O.FILINGS} SELECT company, year, CASE WHEN abs(cash - 1000) > 500 THEN cash END AS cash, CASE WHEN abs(equity) > 1e-9 THEN equity END AS equity FROM filings""")
def shown_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts that are zero but for rounding aren't shown."""
    near = F.when(F.abs(F.col("cash") - 1000) <= 500, F.lit(1e-12)).otherwise(F.col("cash"))
    return filings(spark, sf).select("company", "year", codes.unless_zero(near).alias("cash"), codes.unless_zero(F.col("equity")).alias("equity"))


# Values ------------------------------------------------------------------------------------------------------------

@query(f"""WITH {O.NOTICES} SELECT CASE line WHEN 7 THEN 'auto' WHEN 6 THEN 'review' END AS quarantine, count(*) AS n, count(CASE WHEN line < 6 THEN 1 END) AS totals, count(CASE WHEN line <> 6 THEN 1 END) AS estimates, count(CASE WHEN line < 6 THEN 1 END) AS payables FROM notices GROUP BY 1""")
def withheld_values(spark: SparkSession, sf: str) -> DataFrame:
    """Notices whose seventh lines report zero and sixth ones a negative value: what is left of their fields."""
    n = notices(spark, sf).withColumns({"total": F.when(F.col("line") == 7, 0.0).when(F.col("line") == 6, -F.col("total")).otherwise(F.col("total")), "payable": F.when(F.col("line") < 6, F.col("payable"))})
    w = procurement.withhold(procurement.value_confidence(n.drop("low_confidence")))
    return w.groupBy("quarantine").agg(F.count("*").alias("n"), F.count("total").alias("totals"), F.count("estimate").alias("estimates"), F.count("payable").alias("payables"))


@query(f"""WITH {O.NOTICES} SELECT notice_id, contract_key FROM notices WHERE low_confidence AND notice_id > '5' ORDER BY notice_id LIMIT 50""")
def backfill_page(spark: SparkSession, sf: str) -> DataFrame:
    """The next fifty flagged notices that still have a value, by id from 5 on."""
    return procurement.still_carrying(notices(spark, sf), "notice_id", "total", "5", 50).select("notice_id", "contract_key")


@query(f"""WITH {O.NOTICES}, r AS (SELECT * REPLACE (round(total, 2) AS total) FROM notices QUALIFY row_number() OVER (PARTITION BY contract_key ORDER BY pub_date DESC, line DESC, part DESC, company DESC) = 1),
  m AS (SELECT *, total / estimate BETWEEN 900 AND 1100 AND (country = 'PRT' OR (abs(total - round_even(total, 0)) < 1e-6 AND round_even(total, 0) % 10 = 0 AND round_even(total, 0) % 1000 <> 0)) AS leak FROM r WHERE total >= 1e6)
  SELECT contract_key, round(total / 1000, 4) AS total, 'ratio' AS scale_tier FROM m WHERE leak""")
def corrected_scales(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts whose newest notice, of a million or more, was published a thousandfold."""
    n = notices(spark, sf).withColumn("total", S.rounded("total", 2))
    got = procurement.correct_scale(n, "contract_key", ["pub_date", "line", "part", "company"], 1e6)
    return got.select("contract_key", S.rounded("total", 4).alias("total"), "scale_tier")


# Resolution and search ---------------------------------------------------------------------------------------------

@query("""WITH k AS (SELECT s_nationkey AS nation, floor(s_acctbal / 500)::BIGINT AS band, count(*) AS n, min(s_suppkey) AS e FROM supplier GROUP BY ALL)
  SELECT CASE WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'no_match' END AS hint, count(*) AS n, count(CASE WHEN n = 1 THEN e END) AS entities FROM customer LEFT JOIN k ON nation = c_nationkey AND band = floor(c_acctbal / 500)::BIGINT GROUP BY 1""")
def lobby_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Customers matched to suppliers of their nation with a balance in the same band."""
    band = lambda x: F.floor(F.col(x) / 500).cast("long").alias("band")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), band("c_acctbal"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("nation"), band("s_acctbal"))
    return matching.match_counts(c, s, ["nation", "band"], "c_custkey").groupBy("hint").agg(F.count("*").alias("n"), F.count("entity").alias("entities"))


@query("""WITH k AS (SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS lei, s_suppkey % 40 AS vat, substr(s_name, 10) AS name, s_nationkey AS country FROM supplier),
  w AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN c_custkey END AS lei, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 400 END AS vat, substr(c_name, 10) AS name, c_nationkey AS country FROM customer),
  f AS (SELECT id, 0 AS t, entity FROM w JOIN k USING (lei) UNION ALL SELECT id, 1, entity FROM w JOIN k USING (vat) UNION ALL SELECT id, 2, entity FROM w JOIN k USING (name, country)),
  b AS (SELECT * FROM (SELECT id, t, count(DISTINCT entity) AS n, min(entity) AS entity FROM f GROUP BY id, t) QUALIFY t = min(t) OVER (PARTITION BY id))
  SELECT id, CASE WHEN n IS NULL THEN 'no_match' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS hint, ['lei', 'vat', 'name_country'][t + 1] AS tier, [1.0::DOUBLE, 0.99::DOUBLE, 0.95::DOUBLE][t + 1] AS score, CASE WHEN n = 1 THEN entity END AS entity FROM w LEFT JOIN b USING (id)""")
def resolver_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers to suppliers by LEI, VAT number, then name and country, all made from their numbers."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    w = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 7 == 0, F.col("c_custkey")).alias("lei"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 400).alias("vat"), F.substring("c_name", 10, 30).alias("name"), F.col("c_nationkey").alias("country"))
    k = s.select(F.col("s_suppkey").alias("entity"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).alias("lei"), (F.col("s_suppkey") % 40).alias("vat"), F.substring("s_name", 10, 30).alias("name"), F.col("s_nationkey").alias("country"))
    return matching.resolve_tiers(w, k)


@query("""WITH l AS (SELECT p_brand AS ticker, p_size % 3 AS exchange, CASE WHEN p_size < 40 THEN 'equity' ELSE 'debt' END AS sector, p_partkey % 100 AS lei, CASE WHEN p_partkey % 4 = 0 THEN 'W' || p_partkey END AS isin, p_partkey AS place FROM part),
  r AS (SELECT ticker, exchange, lei, coalesce(isin, 'B' || s_suppkey) AS isin, place FROM l LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 > 0) ON s_suppkey = lei WHERE sector = 'equity')
  SELECT ticker, exchange, lei, isin FROM r WHERE isin IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker, exchange ORDER BY place) = 1""")
def isin_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as listings of brands: a quarter bring their own ISIN, suppliers are the bulk map."""
    k = F.col("p_partkey")
    listings = table(spark, sf, "part").select(F.col("p_brand").alias("ticker"), (F.col("p_size") % 3).alias("exchange"), F.when(F.col("p_size") < 40, "equity").otherwise("debt").alias("sector"), (k % 100).alias("lei"), F.when(k % 4 == 0, F.concat(F.lit("W"), k)).alias("isin"), k.alias("place"))
    bulk = table(spark, sf, "supplier").filter("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("lei"), F.concat(F.lit("B"), "s_suppkey").alias("isin"))
    return matching.enrich_isins(listings, bulk)


_PAIRS = "c AS (SELECT a.c_custkey AS a, b.c_custkey AS b, floor((1 - abs(a.c_acctbal - b.c_acctbal) / 12000) * 10000 + 0.5) / 10000 AS confidence FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 AND a.c_mktsegment = b.c_mktsegment), d AS (SELECT a, b, a % 4 = 0 AS approve FROM c WHERE a % 2 = 0)"


def _pairs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    x, y = c.select(F.col("c_custkey").alias("a"), F.col("c_acctbal").alias("u"), F.col("c_mktsegment").alias("s")), c.select(F.col("c_custkey").alias("b"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("t"))
    pairs = x.join(y, (F.col("a") + 1 == F.col("b")) & (F.col("s") == F.col("t"))).select("a", "b", S.rounded(1 - F.abs(F.col("u") - F.col("v")) / 12000, 4).alias("confidence"))
    return pairs, pairs.filter("a % 2 = 0").select("a", "b", (F.col("a") % 4 == 0).alias("approve"))


@query(f"WITH {_PAIRS} SELECT a, b, confidence FROM c WHERE a % 2 <> 0 ORDER BY confidence DESC, a, b LIMIT 30")
def pairs_to_review(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring customers of a segment as candidate pairs; those with an even first number are decided."""
    return matching.review_list(*_pairs(spark, sf), limit=30)


@query(f"WITH {_PAIRS} SELECT CASE WHEN approve IS NULL THEN 'pending' WHEN approve THEN 'merged' ELSE 'rejected' END AS state, count(*) AS n FROM c LEFT JOIN d USING (a, b) GROUP BY 1")
def decided_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return matching.apply_decisions(*_pairs(spark, sf))[1].groupBy("state").agg(F.count("*").alias("n"))


@query(f"WITH {O.LEXICAL} SELECT doc_id, rank AS ra, round(1.0::DOUBLE / (60 + rank), 8) AS score FROM lexical ORDER BY score DESC, doc_id LIMIT 20")
def lexical_only(spark: SparkSession, sf: str) -> DataFrame:
    """Fused search without a vector list: the words' ranks alone."""
    return search.fuse(search.lexical(table(spark, sf, "documents"), ["the", "of", "and"]), None, "doc_id").select("doc_id", "ra", "score")


@query("""SELECT symbol, name, tier, source FROM (SELECT replace(p_brand, '#', '') || p_partkey AS symbol, p_name AS name, CASE WHEN p_size % 2 = 0 THEN 'edgar' ELSE 'esef' END AS source, CASE WHEN lower(replace(p_brand, '#', '') || p_partkey) LIKE 'blue%' THEN 1 ELSE 0 END AS tier FROM part WHERE contains(lower(p_name), 'blue')) ORDER BY tier DESC, symbol, name LIMIT 50""")
def ticker_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as listed companies whose name has blue in it."""
    known = table(spark, sf, "part").select(F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), "p_partkey").alias("symbol"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, "USD").otherwise("EUR").alias("currency"))
    return matching.find_tickers(known, "Blue").select("symbol", "name", "tier", "source")


# Quality -----------------------------------------------------------------------------------------------------------

@query("""SELECT 'orders_have_customers' AS assertion, 'block' AS severity, count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) AS value, count(*) AS total, 'pass' AS status, false AS failed FROM orders
  UNION ALL SELECT 'no_negative_balance', 'warn', count(*) FILTER (c_acctbal < 0), count(*), CASE WHEN count(*) FILTER (c_acctbal < 0) = 0 THEN 'pass' ELSE 'warn' END, false FROM customer
  UNION ALL SELECT 'missing_column', 'block', NULL, NULL, 'error', true UNION ALL SELECT 'missing_column_warns', 'warn', NULL, NULL, 'warn', true""")
def assertions_isolated(spark: SparkSession, sf: str) -> DataFrame:
    """Two checks that can be measured and two that can't; none stops the others."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    A = quality.Assertion
    got = quality.run(spark, [
        A("orders_have_customers", "block", lambda: quality.orphans(o, c, "o_custkey", "c_custkey"), quality.zero()),
        A("no_negative_balance", "warn", lambda: quality.violations(c, F.col("c_acctbal") < 0), quality.zero()),
        A("missing_column", "block", lambda: quality.violations(c, F.col("nothing") < 0), quality.zero()),
        A("missing_column_warns", "warn", lambda: quality.violations(c, F.col("nothing") < 0), quality.zero()),
    ])
    return got.select("assertion", "severity", "value", "total", "status", F.col("error").isNotNull().alias("failed"))


@query(f"""WITH {O.SCORED}, v AS (SELECT *, CASE WHEN line = 3 THEN confidence + 0.02 ELSE confidence END AS kept FROM scored) SELECT count(*) FILTER (abs(kept - consistency * plausibility) > 0.011) AS value, count(*) AS total FROM v""")
def confidence_formula(spark: SparkSession, sf: str) -> DataFrame:
    """Scores whose stored value, raised on third lines, isn't the product of its parts."""
    v = procurement.value_confidence(notices(spark, sf).drop("low_confidence"))
    kept = F.when(F.col("line") == 3, F.col("confidence") + 0.02).otherwise(F.col("confidence"))
    return quality.broken_product(v.withColumn("kept", kept), "kept", "consistency", "plausibility", spared=F.col("flag") == "concession_negative")


@query(f"""WITH {_FULL}, a AS (SELECT *, CASE WHEN year % 3 = 0 THEN assets * 1.05::DOUBLE ELSE assets END AS stated FROM full_) SELECT count(*) FILTER (stated > 0 AND abs(stated - (equity + liabilities)) / stated > 0.02) AS value, count(*) AS total FROM a""")
def accounting_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Balance sheets that don't add up within two hundredths; every third year's assets are overstated."""
    f = filings_full(spark, sf).withColumn("stated", F.when(F.col("year") % 3 == 0, F.col("assets") * 1.05).otherwise(F.col("assets")))
    return quality.broken_identity(f, "stated", "liabilities", "equity")


@query("""WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN upper(c_name) ELSE ' ' || c_name END AS c_name, CASE WHEN c_custkey % 15 = 0 THEN c_acctbal + 1 ELSE c_acctbal + 1e-7::DOUBLE END AS c_acctbal FROM customer WHERE c_custkey % 7 > 0)
  SELECT a.c_custkey, CASE WHEN b.c_custkey IS NULL THEN 'missing_right' WHEN trim(a.c_name) IS DISTINCT FROM trim(b.c_name) THEN 'c_name' WHEN a.c_acctbal::VARCHAR::DECIMAL(38, 4) IS DISTINCT FROM b.c_acctbal::VARCHAR::DECIMAL(38, 4) THEN 'c_acctbal' END AS difference FROM customer a LEFT JOIN b USING (c_custkey) WHERE difference IS NOT NULL""")
def store_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Customers against a mirror with missing rows, changed names and balances, padded names and balances a ten millionth off: the first field whose trimmed text, or number to four digits, differs."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    b = c.filter("c_custkey % 7 > 0").withColumns({"c_name": F.when(F.col("c_custkey") % 10 == 0, F.upper("c_name")).otherwise(F.concat(F.lit(" "), "c_name")), "c_acctbal": F.when(F.col("c_custkey") % 15 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal") + 1e-7)})
    return quality.first_difference(c, b, "c_custkey", ["c_name", "c_acctbal"])


@query("""SELECT *, excess = 0 AND missing <= 0.05 * stored AS ok FROM (SELECT (SELECT count(*) FROM orders) AS stored, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS mirrored, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS missing,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS excess)""")
def order_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that have lines, as a mirror of all orders."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return quality.shortfall(o, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


_SUPPLIER_TRIPLES = """t AS (SELECT 's' || s_suppkey AS subject, unnest(['name', 'balance', 'nation', 'name']) AS predicate, unnest([CASE WHEN s_suppkey % 9 > 0 THEN s_name END, CASE WHEN s_suppkey % 5 = 0 THEN 'much' ELSE s_suppkey::VARCHAR END, s_nationkey::VARCHAR, CASE WHEN s_suppkey % 11 = 0 THEN 'again' END]) AS object FROM supplier),
  triples AS (SELECT * FROM t WHERE object IS NOT NULL)"""


def _supplier_triples(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier")
    fields = {"name": F.when(k % 9 > 0, F.col("s_name")), "balance": F.when(k % 5 == 0, "much").otherwise(k.cast("string")), "nation": F.col("s_nationkey")}
    subject = F.concat(F.lit("s"), k)
    return etl.triples(s, subject, fields).unionByName(etl.triples(s, subject, {"name": F.when(k % 11 == 0, "again")}))


@query(f"WITH {_SUPPLIER_TRIPLES} SELECT predicate, count(*) AS n, min(object) AS least FROM triples GROUP BY 1")
def supplier_triples(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as triples; missing fields have none."""
    return _supplier_triples(spark, sf).groupBy("predicate").agg(F.count("*").alias("n"), F.min("object").alias("least"))


@query("""SELECT 's' || s_suppkey AS subject, unnest(list_filter([CASE WHEN (s_suppkey % 9 > 0)::INT + (s_suppkey % 11 = 0)::INT = 0 THEN 'name missing' WHEN s_suppkey % 9 > 0 AND s_suppkey % 11 = 0 THEN 'name repeated' END, CASE WHEN s_suppkey % 5 = 0 THEN 'balance type' END, CASE WHEN s_nationkey >= 20 THEN 'nation value' END], lambda x: x IS NOT NULL)) AS violation FROM supplier""")
def shape_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' triples that lack or repeat a name, have a balance that is no number, or an unknown nation."""
    got = quality.shape_violations(_supplier_triples(spark, sf), ["name"], {"balance": "double"}, {"nation": [str(i) for i in range(20)]})
    return got.select("subject", F.concat_ws(" ", "predicate", "reason").alias("violation"))


# Loads -------------------------------------------------------------------------------------------------------------

@query(f"""WITH {_SUPPLIER_TRIPLES}, g AS (SELECT 's' || s_suppkey AS subject FROM supplier WHERE s_nationkey = 1), i AS (SELECT 's' || s_suppkey AS subject, 'name' AS predicate, 'new' AS object FROM supplier WHERE s_nationkey IN (1, 2))
  SELECT predicate, count(*) AS n, count(*) FILTER (object = 'new') AS new FROM (SELECT * FROM triples WHERE subject NOT IN (SELECT subject FROM i) AND subject NOT IN (SELECT subject FROM g) UNION ALL SELECT * FROM i WHERE subject NOT IN (SELECT subject FROM g)) GROUP BY 1""")
def replaced_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of nation 2 come in anew, those of nation 1 are deleted: the triples after it."""
    subject = lambda d: d.select(F.concat(F.lit("s"), "s_suppkey").alias("subject"))
    s = table(spark, sf, "supplier")
    new = subject(s.filter("s_nationkey IN (1, 2)")).withColumns({"predicate": F.lit("name"), "object": F.lit("new")})
    got = etl.replace_entities(_supplier_triples(spark, sf), new, subject(s.filter("s_nationkey = 1")))
    return got.groupBy("predicate").agg(F.count("*").alias("n"), F.count_if(F.col("object") == "new").alias("new"))


@query("""SELECT user_id, event_type, count(*) AS n FROM events WHERE coalesce(nullif(['de', 'fr', 'xx', ''][event_id % 4 + 1], ''), 'de') IN ('de', 'fr') AND NOT (event_id % 5 = 0 AND event_id % 3 = 0) AND event_id % 7 > 0 GROUP BY ALL""")
def entity_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Events as statements about users in languages: those about others, in other languages and about places on another globe go; an address that is no place stays."""
    e = table(spark, sf, "events")
    k = F.col("event_id")
    user = F.concat(F.lit("Q"), "user_id")
    lang = F.nullif(F.element_at(F.array(*map(F.lit, ["De", "FR", "xx", ""])), (k % 4 + 1).cast("int")), F.lit(""))
    rows = e.select("user_id", F.when(k % 7 == 0, "Q0other").otherwise(user).alias("subject"), F.col("event_type").alias("predicate"), F.when(k % 5 == 0, "<http://globe/Q405> Point(1 2)").otherwise("x").alias("object"), lang.alias("language"),
                    F.when(k % 3 == 0, etl.WKT).alias("datatype"))
    return etl.entity_triples(rows, user, ["de", "fr"]).groupBy("user_id", F.col("predicate").alias("event_type")).agg(F.count("*").alias("n"))


_MARKS = "m AS (SELECT event_type AS source, max(ts) FILTER (event_id % 3 = 0) AS mark FROM events WHERE event_type <> 'error' GROUP BY 1)"


@query(f"WITH {_MARKS} SELECT event_type AS source, count(*) AS n FROM events LEFT JOIN m ON source = event_type WHERE mark IS NULL OR ts > mark GROUP BY 1")
def rows_past_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Events newer than what their type's load has reached; errors have no watermark yet."""
    e = table(spark, sf, "events").withColumnRenamed("event_type", "source")
    marks = e.filter("source <> 'error'").groupBy("source").agg(F.max(F.when(F.col("event_id") % 3 == 0, F.col("ts"))).alias("mark"))
    return etl.with_watermark(e, marks).groupBy("source").agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT event_type AS source, ts::DATE AS day, count(*) FILTER (value > 3) AS ok, count(*) FILTER (value <= 3 OR value IS NULL) AS failed FROM events GROUP BY ALL), b AS (SELECT source, min(day) AS bad FROM d WHERE ok = 0 AND failed > 0 GROUP BY 1),
  r AS (SELECT source, max(day) AS reached FROM d LEFT JOIN b USING (source) WHERE bad IS NULL OR day < bad GROUP BY 1), m AS (SELECT event_type AS source, min(ts)::DATE AS mark FROM events WHERE event_type <> 'view' GROUP BY 1)
  SELECT source, greatest(mark, reached)::VARCHAR AS mark FROM m FULL JOIN r USING (source)""")
def advanced_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarks of event types after loading day by day, where events of a low value fail."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    good = F.coalesce(F.col("value") > 3, F.lit(False))
    days = e.groupBy(F.col("event_type").alias("source"), "day").agg(F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"))
    marks = e.filter("event_type <> 'view'").groupBy(F.col("event_type").alias("source")).agg(F.min("day").alias("mark"))
    return etl.advance(marks, days).select("source", F.col("mark").cast("string").alias("mark"))


@query("""WITH h AS (SELECT o_orderpriority AS dataset, max(o_orderdate)::DATE AS updated, max(year(o_orderdate)) AS max_year FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1), u AS (SELECT o_orderpriority AS dataset, max(o_orderdate)::DATE - CASE WHEN o_orderpriority < '3' THEN 9 ELSE 0 END AS updated FROM orders GROUP BY 1)
  SELECT u.dataset, CASE WHEN u.updated < h.updated THEN 'skip' WHEN max_year IS NULL THEN 'full' ELSE 'from' END AS action, CASE WHEN u.updated < h.updated THEN NULL ELSE max_year - 1 END AS start_year FROM u LEFT JOIN h USING (dataset)""")
def change_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Priorities as datasets: two are older upstream, one isn't held yet, the others are read from the year before their newest."""
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    held = o.filter("o_orderpriority <> '5-LOW'").groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.max("day").alias("updated"), F.max(F.year("day")).alias("max_year"))
    up = o.groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.max("day").alias("d")).select("dataset", F.date_sub("d", F.when(F.col("dataset") < "3", 9).otherwise(0)).alias("updated"))
    return etl.change_gate(held, up)


@query("""SELECT t AS job, 'success' AS status, n::VARCHAR AS message FROM (SELECT 'customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'supplier', count(*) FROM supplier) UNION ALL SELECT 'broken', 'failed', 'no such table'""")
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs that count tables, and one that fails, as the run log has them."""
    path = scratch(spark, "runs")

    def broken() -> str:
        raise RuntimeError("no such table")

    for name in ("customer", "orders", "supplier"):
        etl.record_run(spark, path, name, lambda: str(table(spark, sf, name).count()))
    try:
        etl.record_run(spark, path, "broken", broken)
    except RuntimeError:
        pass
    return etl.runs(spark.read.schema(etl.RUN_SCHEMA).parquet(path)).select("job", "status", "message")


@query("""SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ('nation', 'supplier', 'orders', 'events', 'documents')""")
def schema_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Tables and their columns, as a client that writes queries is shown them."""
    names = ("nation", "supplier", "orders", "events", "documents")
    for n in names:
        table(spark, sf, n).createOrReplaceTempView(f"known_{n}")
    rows = [(t.removeprefix("known_"), c) for t, c, _ in etl.introspect(spark, [f"known_{n}" for n in names])]
    return spark.createDataFrame(rows, "table_name string, column_name string")


@query("""SELECT assertion, run, status FROM (SELECT 'orders_exist' AS assertion, 'pass' AS status UNION ALL SELECT 'balances', CASE WHEN (SELECT min(c_acctbal) FROM customer) < 0 THEN 'fail' ELSE 'pass' END), (SELECT unnest([1, 2]) AS run)""")
def kept_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results of two runs of the checks, kept and read again."""
    from datetime import datetime

    path, A = scratch(spark, "results"), quality.Assertion
    checks = [A("orders_exist", "block", lambda: quality.violations(table(spark, sf, "orders"), F.lit(True)), quality.at_least(1)), A("balances", "block", lambda: quality.violations(table(spark, sf, "customer"), F.col("c_acctbal") < 0), quality.zero())]
    for run in (1, 2):
        quality.keep_results(quality.run(spark, checks, datetime(2020, 1, run)), path)
    return spark.read.parquet(path).select("assertion", F.dayofmonth("run_at").alias("run"), "status")


# Readers and writers -----------------------------------------------------------------------------------------------

#: Records of an XML file at most: some tens of MB.
RECORDS_PER_FILE = 50_000


def _csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


def _xml(df: DataFrame, path: str, row: str) -> str:
    """An XML file is read by one task, whatever its size, so the records are dealt to files that don't grow with the table."""
    df.write.format("xml").option("rootTag", "data").option("rowTag", row).option("maxRecordsPerFile", RECORDS_PER_FILE).save(path)
    return path


@query(f"""WITH {O.OBSERVATIONS} SELECT dataset, geo, year::INT AS year, slice_key, value FROM observations WHERE value IS NOT NULL""")
def read_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Each dataset's observations written as a wide statistics file (periods as columns, ``:`` for what is missing) and read back, whatever the number of periods."""
    every, out = kept(observations(spark, sf), "observations"), None  # a mean per cell: the lines are joined once, not once for each dataset
    years = [r[0] for r in every.select("year").distinct().orderBy("year").collect()]  # a file's header: it is one line
    for (dataset,) in every.select("dataset").distinct().orderBy("dataset").collect():
        o = every.filter(F.col("dataset") == dataset)
        wide = o.groupBy(F.concat_ws(",", F.col("dims")["flag"], F.col("dims")["status"], "geo").alias("key")).pivot("year", years).agg(F.first("value"))
        head = "flag,status,geo\\TIME_PERIOD"
        cells = wide.select(F.col("key").alias(head), *(F.when(F.col(f"`{y}`").isNotNull(), F.format_string("%.4f p", F.col(f"`{y}`"))).otherwise(":").alias(str(y)) for y in years))
        got = readers.cube_tsv(spark, _csv(cells, scratch(spark, "cube"), "\t"), dataset)
        part = got.select(F.lit(dataset).alias("dataset"), "geo", F.year("time").alias("year"), "slice_key", "value")
        out = part if out is None else out.unionByName(part)
    return out


@query("""WITH g AS (SELECT 'AA' AS code, 'top' AS name UNION ALL SELECT 'AA' || chr((65 + n_nationkey)::INT), n_name FROM nation) SELECT code, name, length(code) - 2 AS level, CASE WHEN length(code) > 2 THEN substr(code, 1, length(code) - 1) END AS parent FROM g""")
def read_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as region codes under one country, through the CSV reader."""
    n = table(spark, sf, "nation").select(F.concat(F.lit("AA"), F.chr(F.col("n_nationkey") + 65)).alias("CODE"), F.col("n_name").alias("NAME"))
    top = table(spark, sf, "region").filter("r_regionkey = 0").select(F.lit("AA").alias("CODE"), F.lit("top").alias("NAME"))
    return readers.regions_csv(spark, _csv(n.unionByName(top), scratch(spark, "regions")))


@query("""SELECT 'X' || c_nationkey AS country, (c_custkey % 700)::VARCHAR AS postcode, min('N' || (c_custkey % 90)) AS nuts3 FROM customer GROUP BY ALL""")
def read_postcodes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as rows of the postcode file, quoted as it is; the smallest region of a postcode counts."""
    q = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    c = table(spark, sf, "customer").select(F.lower(F.concat(F.lit("X"), "c_nationkey")).alias("COUNTRY"), q((F.col("c_custkey") % 700).cast("string")).alias("CODE"), q(F.concat(F.lit("N"), F.col("c_custkey") % 90)).alias("NUTS3"))
    path = scratch(spark, "postcodes")
    c.write.option("header", True).option("sep", ";").option("quote", "").csv(path)
    return readers.postcodes_csv(spark, path)


@query("""SELECT lpad(c_custkey::VARCHAR, 20, 'A') AS lei, c_name AS name, 'X' || c_nationkey AS country, (c_custkey % 700)::VARCHAR AS postcode FROM customer""")
def read_legal_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as records of the LEI file and read back."""
    c = table(spark, sf, "customer")
    address = F.struct(F.concat(F.lit("X"), "c_nationkey").alias("Country"), (F.col("c_custkey") % 700).cast("string").alias("PostalCode"))
    rows = c.select(F.lpad(F.col("c_custkey").cast("string"), 20, "A").alias("LEI"), F.struct(F.col("c_name").alias("LegalName"), address.alias("LegalAddress")).alias("Entity"))
    return readers.legal_entities_xml(spark, _xml(rows, scratch(spark, "lei"), "LEIRecord")).select("lei", "name", "country", "postcode")


@query("""SELECT 'E' || c_custkey AS child, 'E' || (c_custkey // 2) AS parent, CASE WHEN c_custkey % 3 = 0 THEN 'direct' ELSE 'ultimate' END AS kind FROM customer WHERE c_custkey % 3 < 2 AND c_custkey % 5 > 0 AND c_custkey > 0""")
def read_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the one of half their number as parent; a fifth are inactive, a third have another kind of tie."""
    k = F.col("c_custkey")
    node = lambda x: F.struct(F.concat(F.lit("E"), x).alias("NodeID"))
    kind = F.when(k % 3 == 0, "IS_DIRECTLY_CONSOLIDATED_BY").when(k % 3 == 1, "IS_ULTIMATELY_CONSOLIDATED_BY").otherwise("IS_FEEDER_TO")
    r = F.struct(node(k).alias("StartNode"), node(F.expr("c_custkey div 2")).alias("EndNode"), kind.alias("RelationshipType"), F.when(k % 5 == 0, "INACTIVE").otherwise("ACTIVE").alias("RelationshipStatus"))
    return registers.relationships_xml(spark, _xml(table(spark, sf, "customer").select(r.alias("Relationship")), scratch(spark, "rr"), "RelationshipRecord"))


@query("""SELECT 'XX' || lpad(p_partkey::VARCHAR, 10, '0') AS isin, p_name AS name, CASE WHEN p_size % 3 = 0 THEN 'equity' ELSE 'fund' END AS kind, p_size % 2 = 0 AS active, CASE WHEN p_partkey % 4 > 0 THEN lpad(p_partkey::VARCHAR, 20, 'L') END AS lei FROM part WHERE p_size % 3 < 2""")
def read_instruments(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as new and terminated instruments; a third are neither equities nor funds, a quarter of the issuers are no LEI."""
    k, size = F.col("p_partkey"), F.col("p_size")
    general = F.struct(F.concat(F.lit("XX"), F.lpad(k.cast("string"), 10, "0")).alias("Id"), F.col("p_name").alias("FullNm"), F.when(size % 3 == 0, "ESVUFR").when(size % 3 == 1, "CIOGES").otherwise("DBFTFB").alias("ClssfctnTp"), F.lit("EUR").alias("NtnlCcy"))
    rows = table(spark, sf, "part").select(general.alias("FinInstrmGnlAttrbts"), F.when(k % 4 > 0, F.lpad(k.cast("string"), 20, "L")).otherwise("short").alias("Issr"), F.struct(F.lit("XETR").alias("Id")).alias("TradgVnRltdAttrbts"), size.alias("s"))
    path = scratch(spark, "firds")
    _xml(rows.filter("s % 2 = 0").drop("s"), f"{path}/new", "NewRcrd")
    _xml(rows.filter("s % 2 = 1").drop("s"), f"{path}/gone", "TermntdRcrd")
    return registers.instruments_xml(spark, f"{path}/*").select("isin", "name", "kind", "active", "lei")


@query("""SELECT 'EU.' || s_suppkey AS reference, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'person' ELSE 'entity' END AS kind, CASE WHEN s_nationkey > 0 THEN 'N' || s_nationkey END AS country, 2 AS names FROM supplier""")
def read_sanctions(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as sanctioned ones with two names, one of them repeated, and a citizenship."""
    k = F.col("s_suppkey")
    alias = lambda whole, first, last: F.struct(whole.alias("_wholeName"), first.alias("_firstName"), last.alias("_lastName"))
    none = F.lit(None).cast("string")
    names = F.array(alias(F.col("s_name"), none, none), alias(none, F.lit("No"), F.concat(F.lit("N"), k)), alias(F.col("s_name"), none, none))
    place = F.array(F.struct(F.when(F.col("s_nationkey") > 0, F.concat(F.lit("N"), "s_nationkey")).otherwise("00").alias("_countryIso2Code"), F.lit("UNKNOWN").alias("_countryDescription")))
    rows = table(spark, sf, "supplier").select(F.concat(F.lit("EU."), k).alias("_euReferenceNumber"), F.struct(F.when(k % 2 == 0, "person").otherwise("enterprise").alias("_code")).alias("subjectType"), names.alias("nameAlias"), place.alias("citizenship"))
    got = registers.sanctions_xml(spark, _xml(rows, scratch(spark, "sanctions"), "sanctionEntity"))
    return got.select("reference", "name", "kind", "country", F.size("names").alias("names"))


@query("""SELECT s_suppkey::VARCHAR AS id, s_name AS name, least(1000 * (s_suppkey % 9 + 1), 5000) AS cost_low, greatest(1000 * (s_suppkey % 9 + 1), 5000) AS cost_high, '2020-01-0' || (s_suppkey % 9 + 1) AS registered FROM supplier""")
def read_lobbyists(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as interest representatives; half of the cost bands are the wrong way round."""
    k = F.col("s_suppkey")
    band = F.struct((F.lit(1000) * (k % 9 + 1)).cast("string").alias("min"), F.lit("5000").alias("max"))
    rows = table(spark, sf, "supplier").select(k.cast("string").alias("identificationCode"), F.struct(F.col("s_name").alias("originalName")).alias("name"), F.concat(F.lit("2020-01-0"), k % 9 + 1, F.lit("T00:00")).alias("registrationDate"), F.struct(F.struct(F.struct(band.alias("range")).alias("costs")).alias("closedYear")).alias("financialData"))
    return registers.lobbyists_xml(spark, _xml(rows, scratch(spark, "lobby"), "interestRepresentative")).select("id", "name", "cost_low", "cost_high", "registered")


@query("""SELECT lpad(p_partkey::VARCHAR, 5, '1') || '000' AS code, CASE WHEN p_partkey % 2 = 0 THEN '10000000' END AS parent, l AS language, CASE l WHEN 'en' THEN p_name ELSE p_brand END AS label, greatest(length(regexp_replace(lpad(p_partkey::VARCHAR, 5, '1') || '000', '0+$', '')), 1) AS level FROM part, (SELECT unnest(['en', 'de']) AS l)""")
def read_product_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as rows of a code list with labels in two languages; a third language isn't wanted."""
    k = F.col("p_partkey")
    cell = lambda name, v: F.struct(F.lit(name).alias("_ColumnRef"), v.alias("SimpleValue"))
    cells = F.array(cell("code", F.concat(F.lpad(k.cast("string"), 5, "1"), F.lit("000"))), cell("parentCode", F.when(k % 2 == 0, "10000000")), cell("eng_label", F.col("p_name")), cell("deu_label", F.col("p_brand")), cell("fra_label", F.col("p_type")))
    return registers.codes_xml(spark, _xml(table(spark, sf, "part").select(cells.alias("Value")), scratch(spark, "cpv"), "Row"), {"eng": "en", "deu": "de"})


@query("""SELECT DISTINCT lpad((c_custkey % 500)::VARCHAR, 20, 'A') AS lei, 'I' || (c_custkey % 900) AS isin FROM customer WHERE c_custkey % 500 IN (SELECT s_suppkey FROM supplier)""")
def read_isins(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as rows of the daily mapping, for the suppliers' identifiers only."""
    lei = lambda x: F.lpad(x.cast("string"), 20, "A")
    rows = table(spark, sf, "customer").select(lei(F.col("c_custkey") % 500).alias("LEI"), F.concat(F.lit("I"), F.col("c_custkey") % 900).alias("ISIN"))
    return registers.isins_csv(spark, _csv(rows, scratch(spark, "isins")), table(spark, sf, "supplier").select(lei(F.col("s_suppkey")).alias("lei")))


@query("""SELECT 'd' || (o_custkey % 40) AS code, max(o_orderdate::DATE)::VARCHAR AS updated FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def read_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as entries of a table of contents; pending ones have no date."""
    day = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(" ")
    rows = table(spark, sf, "orders").select(F.lit("t").alias("title"), F.concat(F.lit(" d"), F.col("o_custkey") % 40).alias("code"), day.alias("last update of data"))
    return registers.catalogue_tsv(spark, _csv(rows, scratch(spark, "toc"), "\t")).select("code", F.col("updated").cast("string").alias("updated"))


@query("""SELECT 'Q' || p_partkey AS qid, p_name AS title, 1000.5::DOUBLE + p_size AS budget, coalesce(CASE WHEN p_size % 2 = 0 THEN 'FR10' END, 'FR1') AS region, 'Q9' || p_partkey AS beneficiary_qid, CASE WHEN p_size % 3 = 0 THEN 'F' || p_size ELSE 'code' END AS fund, p_type AS programme
  FROM part WHERE p_partkey % 10 > 0 AND p_partkey % 7 > 1""")
def read_projects(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as funded projects since 2020; a tenth have no item, a seventh no date, sums are written with a comma, the finest region counts."""
    k, none = F.col("p_partkey"), F.lit(None).cast("string")
    rows = table(spark, sf, "part").select(
        F.when(k % 10 > 0, F.concat(F.lit("http://x/Q"), k)).otherwise("none").alias("Operation_Unique_Identifier"), none.alias("Operation_Name_English"), F.col("p_name").alias("Operation_Name_Programme_Language"),
        F.concat(F.lit("1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(".5")).alias("Total_Eligible_Expenditure_amount"), F.lit("7").alias("Project_EU_Budget"), F.when(k % 7 == 0, "03/04/2019").when(k % 7 > 1, "03/04/2020").alias("Operation_Start_Date"), none.alias("Operation_End_Date"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("F"), "p_size")).alias("Fund_Name"), F.lit("code").alias("Fund_Code"), F.col("p_type").alias("Programme_Name"),
        none.alias("NUTS3_Code"), F.when(F.col("p_size") % 2 == 0, "FR10").alias("NUTS2_Code"), F.lit("FR1").alias("NUTS1_Code"), F.lit("FR").alias("CountryCode"), F.col("p_brand").alias("Beneficiary_Name"), F.concat(F.lit("http://x/Q9"), k).alias("Beneficiary_Unique_Identifier"))
    return registers.projects_csv(spark, _csv(rows, scratch(spark, "projects")), "2020-01-01").select("qid", "title", "budget", "region", "beneficiary_qid", "fund", "programme")


@query("""SELECT 'customer' AS producer, c_custkey::VARCHAR AS key, c_name AS name FROM customer""")
def written_events(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as a batch of events twice under one id: they are there once."""
    path, c = scratch(spark, "events"), table(spark, sf, "customer").select("c_custkey", "c_name")
    for _ in range(2):
        sinks.append_events(c, path, "customer", "upsert", "c_custkey", batch="b1")
    return spark.read.parquet(path).select("producer", "key", F.get_json_object("payload", "$.c_name").alias("name"))


@query("""SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1 UNION ALL SELECT 'F', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%'""")
def replaced_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by state, of which one state is then replaced by its urgent orders."""
    path, o = scratch(spark, "parts"), table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sinks.replace_partitions(o, path, "o_orderstatus")
    sinks.replace_partitions(o.filter("o_orderstatus = 'F' AND o_orderpriority LIKE '1%'"), path, "o_orderstatus")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(f"""WITH {O.FILINGS} SELECT c_nationkey AS nation, year::VARCHAR AS year, company::VARCHAR AS company, CASE WHEN shares = floor(shares) THEN shares::BIGINT::VARCHAR END AS shares FROM filings JOIN customer ON company = c_custkey""")
def written_spreadsheets(spark: SparkSession, sf: str) -> DataFrame:
    """All companies' filings as a spreadsheet for each nation, read back as text."""
    path = scratch(spark, "sheets")
    nations = table(spark, sf, "customer").select(F.col("c_custkey").alias("company"), F.col("c_nationkey").alias("nation"))
    sinks.spreadsheet(filings(spark, sf).join(nations, "company"), path, "nation", ["company", "shares"])
    return spark.read.option("header", True).schema("year string, company string, shares string, nation int").csv(path).select("nation", "year", "company", "shares")


@query("""SELECT s_suppkey::VARCHAR AS id, ['de', 'en', 'fr'][(s_suppkey % 3 + 1)::INT] AS source, array_to_string(list_filter(['de', 'en', 'fr'], lambda l: l <> ['de', 'en', 'fr'][(s_suppkey % 3 + 1)::INT]), ',') AS targets FROM supplier""")
def translation_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' names to be translated; those in English don't say so."""
    path, lang = scratch(spark, "requests"), F.element_at(F.array(F.lit("de"), F.lit(None).cast("string"), F.lit("fr")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    sinks.translation_requests(table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), lang.alias("lang")), path, ["de", "en", "fr"])
    return spark.read.schema("id string, source string, targets array<string>").json(path).select("id", "source", F.array_join("targets", ",").alias("targets"))


@query("""SELECT 'customer' AS "table", count(*) AS erased FROM customer WHERE c_custkey % 10 = 3 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey % 10 = 3""")
def erased_persons(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth customer asks to be erased: rows that go, per table."""
    c = table(spark, sf, "customer")
    return sinks.erase(c.filter("c_custkey % 10 = 3").select(F.col("c_custkey").alias("id")), {"customer": (c, "c_custkey"), "orders": (table(spark, sf, "orders"), "o_custkey")})[1]


@query("""SELECT n_regionkey::VARCHAR AS part, count(*) AS n, true AS whole FROM nation GROUP BY 1""")
def verified_files(spark: SparkSession, sf: str) -> DataFrame:
    """Nations dealt by region: how many rows are read from each region's file, and whether its bytes still have the hash in the manifest."""
    path = scratch(spark, "artifacts")
    table(spark, sf, "nation").repartition("n_regionkey").write.json(path)
    held = sinks.manifest(spark, path)
    again = sinks.manifest(spark, path).select("file", F.col("sha256").alias("again"))
    rows = spark.read.schema("n_name string, n_regionkey int").json(path).select(F.col("n_regionkey").cast("string").alias("part"), F.col("_metadata.file_name").alias("file"))
    return rows.join(held.join(again, "file"), "file").groupBy("part").agg(F.count("*").alias("n"), F.bool_and(F.col("sha256") == F.col("again")).alias("whole"))


@query("""SELECT 's' || l_suppkey AS ticker, count(DISTINCT l_partkey) AS listings, min(l_partkey) AS first FROM lineitem GROUP BY l_suppkey""")
def price_universe(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with their parts as listings, exported as JSON lines and read back."""
    path = scratch(spark, "universe")
    sinks.export_universe(table(spark, sf, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("ticker"), F.col("l_partkey").alias("listing")), path)
    return sinks.read_universe(spark, path)
