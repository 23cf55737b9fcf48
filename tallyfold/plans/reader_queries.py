"""Named queries that write given tables as reports, metadata, petitions, triples, indices and shapes and read them back; each with its SQL beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.plans import oracles as O
from tallyfold.plans.views import scratch, table
from tallyfold.sources import reports

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = O._half_up(sql)
        return f

    return add


def _json(df: DataFrame, path: str) -> str:
    df.write.json(path)
    return path


def _text(df: DataFrame, path: str) -> str:
    df.write.text(path)
    return path


def _map(rows: Column) -> Column:
    return F.map_from_entries(F.collect_list(rows))


# Filed facts -------------------------------------------------------------------------------------------------------

_FACTS = """facts AS (SELECT 'S' || l_suppkey AS entity, 'L' || l_linenumber AS concept, l_extendedprice AS value, CASE l_returnflag WHEN 'A' THEN '10-K' WHEN 'R' THEN '20-F' ELSE '10-Q' END AS form,
  l_shipdate::DATE AS e, l_shipdate::DATE + (l_partkey % 90)::INT AS filed FROM lineitem WHERE l_linenumber <= 4 AND (l_linestatus = 'O' OR (l_quantity::INT * 10) >= 340))"""


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of orders as filed facts: line number as concept, ten days of span for each unit, open ones as instants."""
    li = table(spark, sf, "lineitem")
    end = F.to_date("l_shipdate")
    form = F.when(F.col("l_returnflag") == "A", "10-K").when(F.col("l_returnflag") == "R", "20-F").otherwise("10-Q")
    rows = li.select(F.concat(F.lit("S"), "l_suppkey").alias("entity"), F.concat(F.lit("L"), "l_linenumber").alias("concept"), F.col("l_extendedprice").alias("value"), form.alias("form"), F.when(F.col("l_linenumber") <= 4, "FY").otherwise("Q1").alias("fiscal_period"),
                     F.when(F.col("l_linestatus") == "O", "instant").otherwise("duration").alias("period_type"), F.date_sub(end, F.col("l_quantity").cast("int") * 10).alias("start"), end.alias("end"), F.date_add(end, (F.col("l_partkey") % 90).cast("int")).alias("filed"))
    return reports.filed_facts_json(spark, _json(rows, scratch(spark, "facts")))


@query(f"WITH {_FACTS} SELECT entity, concept, year(e)::INT AS year, arg_max(value, (filed, value)) AS value FROM facts GROUP BY ALL")
def read_filed_facts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.concept_years(_facts(spark, sf))


@query(f"""WITH {_FACTS}, n AS (SELECT entity, form, count(*) AS n FROM facts WHERE form <> '10-Q' GROUP BY ALL), best AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY entity ORDER BY n DESC, form) = 1)
  SELECT entity, coalesce(form, '10-K') AS form FROM (SELECT DISTINCT entity FROM facts) LEFT JOIN best USING (entity)""")
def annual_forms(spark: SparkSession, sf: str) -> DataFrame:
    return reports.common_form(_facts(spark, sf))


@query("""WITH y AS (SELECT o_custkey AS entity, year(o_orderdate)::INT AS year, max(o_totalprice) AS assets, min(o_totalprice) AS liabilities, max(CASE WHEN o_custkey % 3 = 0 AND o_orderstatus = 'F' THEN o_totalprice END) AS equity,
  max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS ocf, min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS capex FROM orders GROUP BY ALL)
  SELECT entity, year, round(CASE WHEN max(equity) OVER (PARTITION BY entity) IS NULL THEN assets - liabilities ELSE equity END, 4) AS equity, round(ocf - capex, 4) AS free_cashflow FROM y""")
def derived_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' years by their orders; a third of them report equity in some year."""
    o, price = table(spark, sf, "orders"), F.col("o_totalprice")
    rows = o.groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year")).agg(
        F.max(price).alias("assets"), F.min(price).alias("liabilities"), F.max(F.when((F.col("o_custkey") % 3 == 0) & (F.col("o_orderstatus") == "F"), price)).alias("equity"),
        F.max(F.when(F.col("o_orderstatus") == "F", price)).alias("operating_cashflow"), F.min(F.when(F.col("o_orderpriority") == "1-URGENT", price)).alias("capex"))
    return reports.derived_fields(rows).select("entity", "year", S.rounded("equity", 4).alias("equity"), S.rounded("free_cashflow", 4).alias("free_cashflow"))


@query("""SELECT lpad(c_custkey::VARCHAR, 20, 'L') AS lei, c_name AS name, 'N' || c_nationkey AS country, CASE c_nationkey WHEN 3 THEN 'SEK' WHEN 7 THEN 'PLN' ELSE 'EUR' END AS currency, year(o_orderdate)::INT AS year, o_totalprice AS revenue
  FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 5 > 0 AND year(o_orderdate) BETWEEN 1990 AND 2030""")
def read_annual_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of a customer, its orders as filings, by 100,000 order keys so that none grows with the customer; every fifth has a bad LEI, a filing of the year 1900 is implausible."""
    filing = F.struct(F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("revenue"))
    filings = table(spark, sf, "orders").groupBy("o_custkey", F.floor(F.col("o_orderkey") / 100_000)).agg(F.collect_list(filing).alias("f"))
    c = table(spark, sf, "customer").join(filings, F.col("o_custkey") == F.col("c_custkey"))
    wrong = F.array(F.struct(F.lit(1900).alias("year"), F.lit(1.0).alias("revenue")))
    docs = c.select(F.lpad(F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 5 > 0, 20).otherwise(19), F.lit("L")).alias("lei"), F.col("c_name").alias("name"), F.concat(F.lit("N"), "c_nationkey").alias("country"), F.concat("f", wrong).alias("filings"))
    path = _json(docs, scratch(spark, "summaries"))
    return reports.annual_reports_json(spark, path, ["revenue"], {"N3": "SEK", "N7": "PLN"}, last_year=2030, lines=True)


# Metadata and registers --------------------------------------------------------------------------------------------

@query("""SELECT 'cube ' || s_suppkey // 500 AS label, DATE '2024-01-01' + (s_suppkey // 500 % 28)::INT AS updated, 'freq|geo|time' AS dims, count(*)::INT AS geos, min(s_suppkey::VARCHAR) AS first_code, max(s_name) AS last_label FROM supplier GROUP BY s_suppkey // 500""")
def read_cube_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of 500 suppliers as the places of a cube, with labels."""
    s = table(spark, sf, "supplier").groupBy(F.floor(F.col("s_suppkey") / 500).alias("block")).agg(_map(F.struct(F.col("s_suppkey").cast("string"), "s_name")).alias("m"))
    dim = lambda m: F.struct(F.struct(m.alias("label")).alias("category"))
    one = F.create_map(F.lit("A"), F.lit("annual"))
    docs = s.select(F.concat(F.lit("cube "), "block").alias("label"), F.concat(F.date_add(F.lit("2024-01-01"), (F.col("block") % 28).cast("int")), F.lit("T23:00:00")).alias("updated"), F.array(*map(F.lit, ("freq", "geo", "time"))).alias("id"),
                    F.array(F.lit(1), F.size("m"), F.lit(1)).alias("size"), F.create_map(F.lit("freq"), dim(one), F.lit("geo"), dim(F.col("m"))).alias("dimension"))
    got = reports.cube_metadata_json(spark, _json(docs, scratch(spark, "metadata")), lines=True)
    named = F.element_at("labels", "geo")
    return got.filter(F.size("labels") == 1).select("label", F.to_date("updated").alias("updated"), F.array_join("dims", "|").alias("dims"), F.get("sizes", F.lit(1)).alias("geos"), F.array_min(F.map_keys(named)).alias("first_code"), F.array_max(F.map_values(named)).alias("last_label"))


@query("""SELECT c_name AS petition, CASE WHEN c_custkey % 2 = 0 THEN 'en ' || c_custkey ELSE 'xx ' || c_custkey END AS title, c_mktsegment AS status, count(*) FILTER (o_orderpriority <> '1-URGENT')::INT AS organizers,
  sum(o_orderkey % 1000)::DOUBLE AS funding, count(*)::INT AS sponsors, min(o_orderdate::DATE) AS registered, NULL::DATE AS closed FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_mktsegment""")
def read_petitions(spark: SparkSession, sf: str) -> DataFrame:
    """A customer's orders as organizers and sponsors of a petition; urgent ones asked for privacy; every document comes twice."""
    member = F.struct(F.concat(F.lit("order "), "o_orderkey").alias("fullName"), F.lit("MEMBER").alias("type"), F.lit("FR").alias("residenceCountry"), (F.col("o_orderpriority") == "1-URGENT").alias("privacyApplied"))
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(member).alias("members"), F.collect_list(F.struct((F.col("o_orderkey") % 1000).cast("double").alias("amount"))).alias("sponsors"), F.min(F.to_date("o_orderdate")).alias("day"))
    version = lambda code, text: F.struct(F.lit(code).alias("languageCode"), F.concat(F.lit(text), "c_custkey").alias("title"))
    step = lambda name, day: F.struct(F.lit(name).alias("name"), day.alias("date"))
    docs = table(spark, sf, "customer").join(o, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("comRegNum"), F.col("c_mktsegment").alias("status"), F.when(F.col("c_custkey") % 2 == 0, F.array(version("DE", "de "), version("EN", "en "))).otherwise(F.array(version("SV", "xx "), version("DE", "de "))).alias("linguisticVersions"),
        F.array(step("REGISTERED", F.col("day").cast("string")), step("CLOSED", F.lit("soon"))).alias("progress"), "members", F.struct("sponsors").alias("funding"))
    path = _json(docs.unionByName(docs), scratch(spark, "petitions"))
    got = reports.petitions_json(spark, path, {"REGISTERED": "registered", "CLOSED": "closed"})
    return got.select("petition", "title", "status", F.size("organizers").alias("organizers"), "funding", "sponsors", "registered", "closed")


@query("""SELECT s_name AS company, 'N' || s_nationkey AS country, CASE WHEN s_suppkey % 4 = 0 THEN 'B' ELSE 'A' END AS score, CASE WHEN s_suppkey % 7 > 0 THEN s_acctbal END AS scope1, NULL::DOUBLE AS scope2, 2023 AS year FROM supplier WHERE s_suppkey % 2 = 0""")
def read_emissions(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with an even key as companies of the reporting year; every seventh figure is no number."""
    s, key = table(spark, sf, "supplier"), F.col("s_suppkey")
    rows = s.select(F.concat(F.lit(" "), "s_name").alias("organization"), F.concat(F.lit("N"), "s_nationkey").alias("country"), F.when(key % 4 == 0, "B").alias("score"), F.lit("A").alias("cdp_score"),
                    F.when(key % 7 > 0, F.col("s_acctbal").cast("string")).otherwise("n/a").alias("scope_1_emissions"), F.lit("").alias("scope2"), F.when(key % 2 == 0, "2023").otherwise("2022").alias("reporting_year"))
    return reports.emissions_json(spark, _json(rows, scratch(spark, "emissions")), 2023)


@query("""SELECT 'urn:c:' || c_custkey AS subject, 'urn:name' AS predicate, c_name || ' "' || c_mktsegment || '"' AS object, 'en' AS language, NULL::VARCHAR AS datatype FROM customer
  UNION ALL SELECT 'urn:c:' || c_custkey, 'urn:nation', 'urn:n:' || c_nationkey, NULL, NULL FROM customer UNION ALL SELECT 'urn:c:' || c_custkey, 'urn:key', c_custkey::VARCHAR, NULL, 'urn:int' FROM customer""")
def read_ntriples(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as lines of triples between comments."""
    lines = F.format_string('<urn:c:%1$s> <urn:name> "%2$s \\"%3$s\\""@en .\n# %1$s\n<urn:c:%1$s> <urn:nation> <urn:n:%4$s> .\n<urn:c:%1$s> <urn:key> "%1$s"^^<urn:int> .', "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return reports.ntriples(spark, _text(table(spark, sf, "customer").select(lines), scratch(spark, "triples")))


@query("""SELECT 'P' || p_partkey AS ticker, p_brand AS brand, CASE WHEN p_partkey % 3 > 0 THEN p_size::VARCHAR END AS last FROM part""")
def read_price_index(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as entries of the index, some with a quoted name and without a last date."""
    quote = F.when(F.col("p_partkey") % 2 == 0, "'").otherwise("")
    entry = F.concat(quote, F.lit("P"), "p_partkey", quote, F.lit(":\n  brand: '"), "p_brand", F.lit("'\n  stray\n# note\n  last: "), F.when(F.col("p_partkey") % 3 > 0, F.col("p_size").cast("string")).otherwise("null"))
    got = reports.price_index(spark, _text(table(spark, sf, "part").select(entry), scratch(spark, "index")))
    return got.select("ticker", *(F.element_at("fields", k).alias(k) for k in ("brand", "last")))


_SHAPES = """shapes AS (SELECT 'AA' || s_suppkey AS code, length('AA' || s_suppkey) - 2 AS level, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name, 'AA' || left(s_suppkey::VARCHAR, length(s_suppkey::VARCHAR) - 1) AS parent,
  CASE WHEN s_suppkey % 2 = 0 THEN 'MULTIPOLYGON(((0 0.5, ' || s_suppkey || ' 0, 0 0.5)))' ELSE 'MULTIPOLYGON(((0 0, 1 ' || s_suppkey || ', 0 0)), ((5 5, 6 6, 5 5)))' END AS wkt FROM supplier WHERE s_suppkey % 11 > 0)"""


def _shapes(spark: SparkSession, sf: str) -> DataFrame:
    """A collection per 500 suppliers; their shapes are polygons or pairs of them, every eleventh is a point."""
    key, text = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    shape = (F.when(key % 11 == 0, '"type":"Point","coordinates":[1,2]').when(key % 2 == 0, F.format_string('"type":"Polygon","coordinates":[[[0,0.5],[%s,0],[0,0.5]]]', text))
             .otherwise(F.format_string('"type":"MultiPolygon","coordinates":[[[[0,0],[1,%s],[0,0]]],[[[5,5,9],[6,6,9],[5,5,9]]]]', text)))
    name = F.when(key % 3 > 0, F.concat(F.lit(',"NAME_LATN":"'), "s_name", F.lit('"'))).otherwise("")
    feature = F.concat(F.lit('{"properties":{"NUTS_ID":"AA'), text, F.lit('"'), name, F.lit('},"geometry":{'), shape, F.lit("}}"))
    docs = table(spark, sf, "supplier").groupBy(F.floor(F.col("s_suppkey") / 500).alias("block")).agg(F.collect_list(feature).alias("f")).select(F.concat(F.lit('{"features":['), F.array_join("f", ","), F.lit("]}")))
    return reports.region_shapes(spark, _text(docs, scratch(spark, "shapes")), lines=True)


@query(f"WITH {_SHAPES} SELECT * FROM shapes")
def read_region_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return _shapes(spark, sf).drop("native")


@query(f"WITH {_SHAPES} SELECT code, coalesce(name, code) AS name, level FROM shapes")
def region_list(spark: SparkSession, sf: str) -> DataFrame:
    return reports.region_list(_shapes(spark, sf))
