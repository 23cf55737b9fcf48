"""Named queries on lists, codes, joins, the trade graph and places; each with its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import codes, identifiers
from tallyfold.functions import scalars as S
from tallyfold.operators import etl, graph, listing, matching, panels, procurement
from tallyfold.plans import oracles as O
from tallyfold.plans.queries import _trade_edges
from tallyfold.plans.views import notices, observations, prices, regions, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def R(x: str, n: int) -> str:
    """SQL of S.rounded."""
    return f"floor(({x}) * {10**n}.0::DOUBLE + 0.5) / {10**n}.0::DOUBLE"


# Lists -------------------------------------------------------------------------------------------------------------

@query("""SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, o_orderpriority || ' - ' || o_orderstatus AS label, (SELECT count(*) FROM orders) > 150 AS has_more
  FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100""")
def contracts_page(spark: SparkSession, sf: str) -> DataFrame:
    """The third page of fifty orders, newest first."""
    got = listing.page(table(spark, sf, "orders"), [F.desc("o_orderdate"), F.col("o_orderkey")], 50, 100)
    return got.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"), listing.label("o_orderpriority", "o_orderstatus").alias("label"), "has_more")


@query("""SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS supporters FROM customer ORDER BY coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, -1) DESC, c_custkey LIMIT 40""")
def supporters_page(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by balance as petitions by supporters; those in debt have no count and come last."""
    c = table(spark, sf, "customer").withColumn("supporters", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    return listing.page(c, [F.coalesce("supporters", F.lit(-1.0)).desc(), F.col("c_custkey")], 40).select("c_custkey", "c_mktsegment", "supporters")


@query("""SELECT c_mktsegment, count(*) AS n FROM (SELECT c_mktsegment FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 60) GROUP BY 1""")
def shown_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments among the sixty richest customers, as facets of the page that is shown."""
    return listing.shown_counts(listing.page(table(spark, sf, "customer"), [F.desc("c_acctbal"), F.col("c_custkey")], 60), "c_mktsegment")


@query("""SELECT s_suppkey, s_name FROM supplier ORDER BY md5('7:' || s_suppkey), s_suppkey LIMIT 25""")
def sampled_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return listing.sample(table(spark, sf, "supplier"), "s_suppkey", 25, seed=7).select("s_suppkey", "s_name")


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey % 3 > 0 THEN 'R' || (c_nationkey % 5) || lpad(c_nationkey::VARCHAR, 2, '0') END AS nuts, 'X' || (c_nationkey % 5) AS country, c_acctbal FROM customer)
  SELECT nuts, country, count(*) AS n FROM c WHERE nuts LIKE 'R1%' OR country = 'X1' GROUP BY ALL""")
def customers_in_region(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of region R1 (two letters, so its country X1 counts for those without a region)."""
    n = F.col("c_nationkey")
    region = F.when(n % 3 > 0, F.concat(F.lit("R"), (n % 5).cast("string"), F.lpad(n.cast("string"), 2, "0")))
    c = table(spark, sf, "customer").select("c_custkey", region.alias("nuts"), F.concat(F.lit("X"), (n % 5).cast("string")).alias("country"))
    return listing.in_region(c, "R1", country_of={"R1": "X1"}).groupBy("nuts", "country").agg(F.count("*").alias("n"))


@query(f"""SELECT o_orderstatus, count(*) AS n, {R('sum(o_totalprice)', 0)} AS value FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderdate::DATE::VARCHAR LIKE '1997%' AND o_orderstatus IN ('F', 'O') GROUP BY 1""")
def prefix_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a priority's branch and of a year, of two states."""
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    got = listing.optional(listing.starting_with(o, o_orderpriority="1", day="1997", o_orderstatus=None), o_orderstatus=["F", "O"], o_custkey=None)
    return got.groupBy("o_orderstatus").agg(F.count("*").alias("n"), S.rounded(F.sum("o_totalprice"), 0).alias("value"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'fr ' || n_name ELSE n_name END AS name FROM nation""")
def names_in_language(spark: SparkSession, sf: str) -> DataFrame:
    """Nations' names in French where there is one."""
    n = table(spark, sf, "nation").withColumn("n_name_fr", F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("fr "), "n_name")))
    return n.select("n_nationkey", listing.in_language(n, "n_name", "fr-BE", ["de", "en", "fr"]).alias("name"))


@query(f"""SELECT event_type, count(*) AS n, {R("sum(coalesce(nullif(props->>'$.k', ''), '0')::DOUBLE)", 4)} AS k FROM events WHERE coalesce(nullif(props->>'$.k', ''), '0')::DOUBLE >= 5 GROUP BY 1""")
def json_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose key in the payload is five or more."""
    e = table(spark, sf, "events").withColumn("k", codes.json_amount(F.col("props"), "k")).filter("k >= 5")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), S.rounded(F.sum("k"), 4).alias("k"))


@query("""WITH k AS (SELECT o_orderkey, count(*) AS lines, count(DISTINCT l_suppkey) AS parties, min_by(l_partkey, (l_linenumber, l_partkey, l_suppkey)) AS first_part FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
  SELECT o_orderkey, c_name AS authority, n_name AS country, coalesce(lines, 0) AS lines, coalesce(parties, 0) AS parties, first_part FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN k USING (o_orderkey)""")
def contract_details(spark: SparkSession, sf: str) -> DataFrame:
    """An order with its authority, country and parties, as a detail page nests them."""
    o, c, n, li = (table(spark, sf, t) for t in ("orders", "customer", "nation", "lineitem"))
    authorities = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("authority"), F.col("c_name").alias("name"), F.col("n_name").alias("country"))
    awards = li.select(F.col("l_orderkey").alias("contract"), F.col("l_linenumber").alias("place"), F.col("l_suppkey").alias("party"), F.col("l_partkey").alias("part"))
    detail = procurement.contract_details(o.select(F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("authority")), authorities, awards)
    return detail.select(F.col("contract").alias("o_orderkey"), F.col("authority.name").alias("authority"), "authority.country", F.coalesce("award.lines", F.lit(0)).alias("lines"), F.coalesce("award.parties", F.lit(0)).alias("parties"), "award.first_part")


# Joins and unions --------------------------------------------------------------------------------------------------

@query(f"""WITH {O.OBSERVATIONS} SELECT dataset, max(year) AS newest FROM observations WHERE value IS NOT NULL GROUP BY 1""")
def newest_years(spark: SparkSession, sf: str) -> DataFrame:
    """Each dataset with the newest year that it has values for."""
    o = observations(spark, sf)
    return listing.with_latest(o.select("dataset").distinct(), o.filter("value IS NOT NULL"), "dataset", "year", "newest")


@query("""WITH c AS (SELECT c_custkey, c_custkey % 50 AS postcode, c_nationkey AS country FROM customer), e AS (SELECT DISTINCT s_suppkey AS postcode, 'R' || s_nationkey AS region FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey < 50), f AS (SELECT n_nationkey AS country, 'N' || n_regionkey AS region FROM nation WHERE n_nationkey < 20)
  SELECT region, via, count(*) AS n FROM (SELECT coalesce(e.region, f.region) AS region, CASE WHEN e.region IS NOT NULL THEN 'key' WHEN f.region IS NOT NULL THEN 'fallback' END AS via FROM c LEFT JOIN e USING (postcode) LEFT JOIN f USING (country)) GROUP BY ALL""")
def region_links(spark: SparkSession, sf: str) -> DataFrame:
    """Customers to regions by a postcode, else by their country."""
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 50).alias("postcode"), F.col("c_nationkey").alias("country"))
    e = table(spark, sf, "supplier").filter("s_suppkey % 3 = 0 AND s_suppkey < 50").select(F.col("s_suppkey").alias("postcode"), F.concat(F.lit("R"), "s_nationkey").alias("region"))
    f = table(spark, sf, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("country"), F.concat(F.lit("N"), "n_regionkey").alias("region"))
    return listing.first_of(c, "postcode", e, f, "country", "region").groupBy("region", "via").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, event_type FROM events WHERE event_type <> 'error'), d AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error') SELECT event_type, count(*) AS dead FROM d JOIN e USING (user_id) GROUP BY 1""")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Users with an error as dead letters: how many events of each type they stem from."""
    e = table(spark, sf, "events")
    return etl.by_producer(e.filter("event_type = 'error'").select("user_id").distinct(), e.filter("event_type <> 'error'"), "user_id", "event_type")


@query("""WITH r AS (SELECT DISTINCT c_mktsegment AS producer, c_nationkey AS job FROM customer WHERE c_nationkey < 8), m AS (SELECT c_mktsegment AS producer, count(*) AS events FROM customer WHERE c_acctbal < 0 AND c_nationkey > 10 GROUP BY 1), j AS (SELECT s_nationkey AS job, count(*) AS runs FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
  SELECT producer, job, coalesce(events, 0) AS events, coalesce(runs, 0) AS runs FROM r LEFT JOIN m USING (producer) LEFT JOIN j USING (job)""")
def registry_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Segments as producers with nations as jobs: figures of both, 0 where there are none."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    registry = c.filter("c_nationkey < 8").select(F.col("c_mktsegment").alias("producer"), F.col("c_nationkey").alias("job")).distinct()
    metrics = c.filter("c_acctbal < 0 AND c_nationkey > 10").groupBy(F.col("c_mktsegment").alias("producer")).agg(F.count("*").alias("events"))
    runs = s.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("job")).agg(F.count("*").alias("runs"))
    return etl.registry_metrics(registry, metrics, runs)


@query("""SELECT DISTINCT c.c_custkey, s.s_suppkey FROM customer c JOIN supplier s ON substr(c.c_name, 10) = substr(s.s_name, 10)""")
def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Customers to suppliers by the number in their names, each distinct key looked up once."""
    c = table(spark, sf, "customer").select("c_custkey", F.substring("c_name", 10, 20).alias("lei"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.substring("s_name", 10, 20).alias("lei"))
    return matching.lookup_keys(c, s, "lei", "s_suppkey").select("c_custkey", "s_suppkey")


@query(f"""SELECT o_orderpriority, count(*) AS n, {R('sum(coalesce(CASE WHEN o_orderstatus <> %s THEN o_totalprice END, 0))' % "'P'", 0)} AS granted FROM orders GROUP BY 1""")
def grants_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as grants; pending ones have no amount yet and count with 0."""
    amount = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return panels.granted(table(spark, sf, "orders"), "o_orderpriority", amount)


@query("""WITH w AS (SELECT DISTINCT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'), e AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber + 1000000000 AS id, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT id FROM w))
  SELECT id FROM w UNION SELECT id FROM e UNION SELECT l_partkey + 100000000000 FROM e""")
def work_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders as works with their expressions (lines) and manifestations (parts)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 1_000_000_000).alias("line"), (F.col("l_partkey") + 100_000_000_000).alias("part"))
    works = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    return etl.closure(works, (li, "l_orderkey", "line"), (li, "line", "part"))


@query("""SELECT year(o_orderdate)::INT AS year FROM orders UNION SELECT year(l_shipdate)::INT FROM lineitem""")
def known_years(spark: SparkSession, sf: str) -> DataFrame:
    return listing.union_of_keys(table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")), table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")))


# Codes -------------------------------------------------------------------------------------------------------------

@query("""WITH k AS (SELECT upper(substr(n_name, 1, 1)) || chr((65 + n_nationkey)::INT) AS a2, upper(substr(n_name, 1, 2)) || chr((65 + n_nationkey)::INT) AS a3, n_nationkey FROM nation),
  c AS (SELECT CASE c_custkey % 4 WHEN 0 THEN ' ' || lower(a2) WHEN 1 THEN a3 WHEN 2 THEN 'EL' ELSE '' END AS code, a3 FROM customer JOIN k ON c_nationkey = n_nationkey)
  SELECT code, CASE code WHEN 'EL' THEN 'GRC' WHEN '' THEN NULL ELSE a3 END AS alpha3, count(*) AS n FROM c GROUP BY ALL""")
def country_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of two and three letters made from the nations, written in several ways, in three letters."""
    sign = F.chr(F.col("n_nationkey") + 65)
    k = table(spark, sf, "nation").select("n_nationkey", F.concat(F.upper(F.substring("n_name", 1, 1)), sign).alias("alpha2"), F.concat(F.upper(F.substring("n_name", 1, 2)), sign).alias("alpha3"))
    way = F.col("c_custkey") % 4
    code = F.when(way == 0, F.concat(F.lit(" "), F.lower("alpha2"))).when(way == 1, F.col("alpha3")).when(way == 2, "EL").otherwise("")
    c = table(spark, sf, "customer").join(F.broadcast(k), F.col("c_nationkey") == F.col("n_nationkey")).select(code.alias("code"))
    return codes.with_alpha3(c, "code", k).groupBy("code", "alpha3").agg(F.count("*").alias("n"))


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INT % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(f"""WITH k AS (SELECT c_custkey, unnest(['lei', 'cik', 'national', 'name', 'vat', 'fund']) AS kind, unnest(['lei:' || c_name, 'edgar:' || lpad(c_custkey::VARCHAR, 10, '0'), upper(c_mktsegment) || ':' || c_custkey, upper(c_mktsegment) || ':' || upper(trim(c_name)), upper(c_mktsegment) || ':' || trim(c_name), 'fund:' || c_mktsegment]) AS name FROM customer),
  h AS (SELECT c_custkey, kind, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || name::BLOB) AS h FROM k)
  SELECT c_custkey, kind, {_UUID} AS id FROM h""")
def entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Version 5 ids of customers by each form of key."""
    c = table(spark, sf, "customer")
    key, name, segment = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
    ids = {"lei": (name,), "cik": (key,), "national": (segment, key), "name": (segment, name), "vat": (segment, name), "fund": (segment,)}
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), codes.id_of(k, *parts).alias("id")) for k, parts in ids.items())))
    return c.select("c_custkey", each.alias("e")).select("c_custkey", "e.kind", "e.id")


@query("""WITH i AS (SELECT s_suppkey, 'https://data.example.org/id/' || CASE WHEN s_suppkey % 3 = 0 THEN 'Company' WHEN s_suppkey % 3 = 1 THEN 'Person' ELSE 'x9' END || '/' || md5(s_suppkey::VARCHAR)[1:8] || '-0000-0000-0000-' || md5(s_suppkey::VARCHAR)[1:12] AS iri FROM supplier)
  SELECT s_suppkey, iri, CASE WHEN s_suppkey % 3 = 0 THEN 'Company' WHEN s_suppkey % 3 = 1 THEN 'Person' END AS kind, md5(s_suppkey::VARCHAR)[1:8] || '-0000-0000-0000-' || md5(s_suppkey::VARCHAR)[1:12] AS tail FROM i""")
def entity_iris(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of suppliers built and parsed again; the class of a third isn't made of letters."""
    s = table(spark, sf, "supplier")
    h, way = F.md5(F.col("s_suppkey").cast("string")), F.col("s_suppkey") % 3
    key = F.concat(F.substring(h, 1, 8), F.lit("-0000-0000-0000-"), F.substring(h, 1, 12))
    made = s.select("s_suppkey", codes.iri("https://data.example.org/", F.when(way == 0, "Company").when(way == 1, "Person").otherwise("x9"), key).alias("iri"))
    return made.select("s_suppkey", "iri", codes.iri_kind(F.col("iri")).alias("kind"), codes.iri_tail(F.col("iri")).alias("tail"))


@query("""WITH s AS (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) SELECT l_returnflag, l_linestatus, md5('flag=' || l_returnflag || '|status=' || l_linestatus) AS slice_key, sha256(l_returnflag || l_linestatus) AS artifact, sha1(l_returnflag) AS id FROM s""")
def hash_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of slices by the hash of their dimensions, whatever the order of the map."""
    s = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    dims = F.create_map(F.lit("status"), F.col("l_linestatus"), F.lit("flag"), F.col("l_returnflag"))
    return s.select("l_returnflag", "l_linestatus", codes.slice_key(dims).alias("slice_key"), F.sha2(F.concat("l_returnflag", "l_linestatus"), 256).alias("artifact"), F.sha1("l_returnflag").alias("id"))


@query("""SELECT p_partkey, p_name AS title, CASE WHEN p_partkey % 3 > 0 THEN p_brand ELSE '' END AS subtitle, CASE WHEN p_partkey % 3 = 2 THEN p_type || ' · ' || p_size ELSE '' END AS context FROM part""")
def text_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Parts' texts put together with long dashes and taken apart again."""
    way = F.col("p_partkey") % 3
    text = F.concat_ws(" — ", "p_name", F.when(way > 0, F.col("p_brand")), F.when(way == 2, F.col("p_type")), F.when(way == 2, F.col("p_size").cast("string")))
    return table(spark, sf, "part").select("p_partkey", codes.segments(text).alias("s")).select("p_partkey", "s.title", "s.subtitle", "s.context")


@query("""SELECT p_brand, exchange, count(*) AS n, min(CASE exchange WHEN ' us' THEN replace(t, '.', '-') WHEN 'LN' THEN t || '.L' WHEN 'GY' THEN t || '.DE' WHEN 'FP' THEN t || '.PA' END) AS symbol, min(CASE WHEN p_size < 15 THEN 'company' WHEN p_size < 30 THEN 'fund' END) AS least_class
  FROM (SELECT p_brand, p_size, [' us', 'LN', 'GY', 'FP', 'ZZ'][p_partkey % 5 + 1] AS exchange, replace(p_brand, '#', '.') AS t FROM part) GROUP BY ALL""")
def symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as tickers at five exchanges, one of them unknown; sizes tell companies from funds."""
    exchange = F.element_at(F.array(*map(F.lit, [" us", "LN", "GY", "FP", "ZZ"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    kind = F.when(F.col("p_size") < 15, " Common Stock ").when(F.col("p_size") < 30, "Mutual Fund").otherwise("Note")
    p = table(spark, sf, "part").select("p_brand", exchange.alias("exchange"), F.replace("p_brand", F.lit("#"), F.lit(".")).alias("t"), codes.instrument_class(kind, ["Common Stock"], ["Mutual Fund"]).alias("class"))
    return p.groupBy("p_brand", "exchange").agg(F.count("*").alias("n"), F.min(codes.symbol(F.col("t"), F.col("exchange"))).alias("symbol"), F.min("class").alias("least_class"))


@query("""SELECT n_nationkey, CASE WHEN length(n_name) > length(r_name) OR length(n_name) = length(r_name) AND n_name > r_name THEN n_name ELSE r_name END AS name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def longest_names(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", codes.longest(F.array("n_name", F.lit(None).cast("string"), "r_name")).alias("name"))


@query("""WITH g AS (SELECT 'R' || chr((65 + n_regionkey)::INT) || lpad(n_nationkey::VARCHAR, 2, '0') AS code FROM nation) SELECT code, length(code) - 2 AS level, substr(code, 1, length(code) - 1) AS parent FROM g""")
def geo_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Level and parent of the nations' region codes."""
    code = F.concat(F.lit("R"), F.chr(F.col("n_regionkey") + 65), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return table(spark, sf, "nation").select(code.alias("code")).select("code", identifiers.region_level(F.col("code")).alias("level"), identifiers.region_parent(F.col("code")).alias("parent"))


@query("""SELECT c_custkey, lpad(c_custkey::VARCHAR, 20, 'A') AS lei, c_custkey::VARCHAR AS cik, lpad(c_custkey::VARCHAR, 14, '1') AS siret, 'Regulation' AS act, CASE WHEN c_custkey % 2 = 0 THEN '1998-0' || (c_custkey % 9 + 1) || '-15' END AS day FROM customer""")
def identifier_canon(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers written from customers' numbers with blanks, zeros and small letters, in canonical form."""
    key = F.col("c_custkey").cast("string")
    day = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("15/0"), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit("/1998"))).otherwise("soon")
    spaced = F.concat_ws(" ", F.substring(F.lpad(key, 14, "1"), 1, 3), F.substring(F.lpad(key, 14, "1"), 4, 11))
    return table(spark, sf, "customer").select("c_custkey", identifiers.lei(F.concat(F.lit(" "), F.lower(F.lpad(key, 20, "A")))).alias("lei"), identifiers.cik(F.lpad(key, 10, "0")).alias("cik"),
                                               identifiers.siret(spaced).alias("siret"), identifiers.act_kind(F.concat(F.lit("3"), F.lit("2016"), F.lit("R"), F.lpad(key, 4, "0"))).alias("act"), identifiers.date_of(day).cast("string").alias("day"))


# Graph and places --------------------------------------------------------------------------------------------------

_TYPED = "typed AS (SELECT DISTINCT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'sold' END AS kind, l_shipdate::DATE AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _typed_edges(spark: SparkSession, sf: str) -> DataFrame:
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.when(F.col("l_returnflag") == "R", "returned").otherwise("sold").alias("kind"), F.to_date("l_shipdate").alias("day")).distinct()


_AROUND = f"""{_TYPED}, used AS (SELECT * FROM typed WHERE kind <> 'returned' AND day >= DATE '1997-01-01'), b AS (SELECT src AS near, dst AS far FROM used UNION SELECT dst, src FROM used),
  h1 AS (SELECT DISTINCT far AS node FROM b WHERE near = 's1'), h2 AS (SELECT DISTINCT far AS node FROM b JOIN h1 ON near = node WHERE far <> 's1' AND far NOT IN (SELECT node FROM h1)),
  kept AS (SELECT * FROM (SELECT 's1' AS node, 0 AS hops UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2) ORDER BY hops, node LIMIT 120)"""


@query(f"WITH {_AROUND} SELECT node, hops FROM kept")
def neighbourhood(spark: SparkSession, sf: str) -> DataFrame:
    """Up to 120 nodes within two hops of a supplier, by sales since 1997 that weren't returned."""
    seed = table(spark, sf, "supplier").filter("s_suppkey = 1").select(F.concat(F.lit("s"), "s_suppkey").alias("node"))
    return graph.typed_neighbourhood(_typed_edges(spark, sf), seed, 2, excluded=("returned",), since="1997-01-01", most=120)[0]


@query(f"WITH {_AROUND} SELECT src, dst, kind, day::VARCHAR AS day FROM used SEMI JOIN (SELECT node AS src FROM kept) USING (src) SEMI JOIN (SELECT node AS dst FROM kept) USING (dst)")
def neighbourhood_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The edges between the nodes of neighbourhood."""
    seed = table(spark, sf, "supplier").filter("s_suppkey = 1").select(F.concat(F.lit("s"), "s_suppkey").alias("node"))
    edges = graph.typed_neighbourhood(_typed_edges(spark, sf), seed, 2, excluded=("returned",), since="1997-01-01", most=120)[1]
    return edges.withColumn("day", F.col("day").cast("string"))


@query(f"""WITH {O.EDGES}, t AS (SELECT 's' || s_suppkey AS node FROM supplier WHERE s_nationkey = 3), a AS (SELECT DISTINCT dst AS node FROM both_ways JOIN t ON src = node), b AS (SELECT DISTINCT dst AS node FROM both_ways JOIN a ON src = node)
  SELECT node FROM a UNION SELECT node FROM b""")
def reaching_nation(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes with a path of one or two edges to a supplier of nation 3."""
    targets = table(spark, sf, "supplier").filter("s_nationkey = 3").select(F.concat(F.lit("s"), "s_suppkey").alias("node"))
    return graph.reaching(_trade_edges(spark, sf), targets, 2)


@query("""SELECT kind, count(*) AS n, min(id) AS least FROM (SELECT p_partkey AS id, CASE WHEN p_partkey IN (SELECT s_suppkey FROM supplier) THEN 'supplier' WHEN p_partkey IN (SELECT c_custkey FROM customer) THEN 'customer' END AS kind FROM part) GROUP BY 1""")
def kinds_of_keys(spark: SparkSession, sf: str) -> DataFrame:
    """What part numbers would be the keys of: a supplier, else a customer, else nothing."""
    wanted = table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    return graph.kind_of(wanted, [("supplier", table(spark, sf, "supplier").select("s_suppkey")), ("customer", table(spark, sf, "customer").select("c_custkey"))]).groupBy("kind").agg(F.count("*").alias("n"), F.min("id").alias("least"))


@query("""SELECT c_custkey AS id, coalesce(CASE WHEN c_acctbal > 5000 THEN c_name END, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END, c_custkey::VARCHAR) AS label, (c_acctbal > 5000)::INT + (c_nationkey % 2 = 0)::INT AS props FROM customer""")
def node_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as nodes: the label shown for each and how many properties are left."""
    props = F.create_map(F.lit("name"), F.when(F.col("c_acctbal") > 5000, F.col("c_name")), F.lit("segment"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise(""), F.lit("embedding"), F.lit("x"))
    shown = graph.shown_nodes(table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), props.alias("props")), ["name", "segment"])
    return shown.select("id", "label", F.size("props").alias("props"))


@query("""WITH h AS (SELECT DISTINCT o_custkey AS person, l_suppkey AS company, l_returnflag AS role, o_orderstatus <> 'F' AS current, o_orderdate::DATE AS start FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey <= 5)
  SELECT company, person, c_name AS name, role, current, start::VARCHAR AS start, row_number() OVER (PARTITION BY company ORDER BY current DESC, start DESC NULLS LAST, person, role) AS place FROM h JOIN customer ON c_custkey = person""")
def company_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in roles (return flags) at the first suppliers; open orders are current roles."""
    li, o, c = table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "customer")
    held = li.filter("l_suppkey <= 5").join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("person"), F.col("l_suppkey").alias("company"), F.col("l_returnflag").alias("role"), (F.col("o_orderstatus") != "F").alias("current"), F.to_date("o_orderdate").alias("start")).distinct()
    return graph.roles(c.select(F.col("c_custkey").alias("person"), F.col("c_name").alias("name")), held, include_former=True).withColumn("start", F.col("start").cast("string"))


@query("""WITH i AS (SELECT c_custkey AS id, ['R0', 'R1', 'R' || c_nationkey] AS refs FROM customer), l AS (SELECT DISTINCT o_custkey AS id, o_orderstatus AS kind, 'R' || (o_orderkey % 4) AS ref FROM orders)
  SELECT i.id, array_to_string(list_sort(list_distinct(list_filter(refs, lambda r: NOT list_contains(coalesce(a, []), r)))), ',') AS unresolved, coalesce(f, '') AS fulfilled
  FROM i LEFT JOIN (SELECT id, list(DISTINCT ref) AS a, string_agg(DISTINCT ref, ',' ORDER BY ref) FILTER (kind = 'F') AS f FROM l GROUP BY 1) x ON x.id = i.id""")
def petition_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with references, their orders as links by state: the references that nothing links to."""
    items = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.array(F.lit("R0"), F.lit("R1"), F.concat(F.lit("R"), "c_nationkey")).alias("refs"))
    links = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("kind"), F.concat(F.lit("R"), F.col("o_orderkey") % 4).alias("ref")).distinct()
    got = graph.linked_refs(items, links)
    return got.select("id", F.array_join("unresolved", ",").alias("unresolved"), F.coalesce(F.array_join(F.col("linked")["F"], ","), F.lit("")).alias("fulfilled"))


@query(f"""WITH {O.CONTRACTS}, g AS (SELECT n_nationkey, 'R' || n_regionkey AS up, 'R' || n_regionkey || lpad(n_nationkey::VARCHAR, 2, '0') AS code FROM nation),
  k AS (SELECT code, up, count(*) FILTER (is_current) AS contracts, {R("sum(CASE WHEN is_current AND NOT low_confidence THEN current_value ELSE 0 END)", 0)} AS contracts_eur, count(DISTINCT authority) AS authorities FROM contracts JOIN g ON nation = n_nationkey WHERE up = 'R1' GROUP BY ALL)
  SELECT code, contracts, contracts_eur, authorities FROM k""")
def region_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts, trusted money and authorities per region within the scope R1."""
    n = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("R"), "n_regionkey", F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"))
    c = procurement.collapse_modifications(notices(spark, sf)).join(F.broadcast(n.filter(F.col("code").startswith("R1"))), F.col("nation") == F.col("n_nationkey"))
    trusted = F.when(F.col("is_current") & ~F.col("low_confidence"), F.col("current_value")).otherwise(0.0)
    return c.groupBy("code").agg(F.count_if("is_current").alias("contracts"), S.rounded(F.sum(trusted), 0).alias("contracts_eur"), F.count_distinct("authority").alias("authorities"))


@query("""WITH c AS (SELECT 'R' || n_regionkey || lpad(n_nationkey::VARCHAR, 2, '0') AS child FROM nation UNION SELECT 'R' || r_regionkey || '0' FROM region UNION SELECT 'R' || r_regionkey FROM region)
  SELECT a.child, b.child AS parent, length(a.child) - 2 AS level FROM c a JOIN c b ON substr(a.child, 1, length(a.child) - 1) = b.child WHERE length(a.child) > 2""")
def region_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Parent edges of the region codes, as the places of the statistics go into the graph."""
    got = regions(spark, sf).select("code").unionByName(table(spark, sf, "region").select(F.concat(F.lit("R"), "r_regionkey", F.lit("0")).alias("code")))
    return etl.hierarchy_edges(got)


@query(f"""WITH {O.RECENT}, c AS (SELECT ticker, date, coalesce((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0), 0) AS change FROM recent WINDOW w AS (PARTITION BY ticker ORDER BY date))
  SELECT ticker, date::VARCHAR AS date, {R('row_number() OVER (PARTITION BY ticker ORDER BY change DESC, date) / (count(*) OVER (PARTITION BY ticker))::DOUBLE', 6)} AS probability FROM c""")
def change_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Each day's rank by its rise, ties in order of the days, as a share of the days."""
    from tallyfold.operators import finance

    got = finance.change_ranks(finance.recent(prices(spark, sf)))
    return got.select("ticker", F.col("date").cast("string").alias("date"), "probability")
