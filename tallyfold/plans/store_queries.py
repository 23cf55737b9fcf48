"""Named queries on stores: keyed state, loads, routes, the word index, the check catalogue, kept statistics, panels, money and artifacts; each with its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.operators import catalogue, cube_store, listing, money, procurement, quality, regional, routes, stats, text_index
from tallyfold.plans import oracles as O
from tallyfold.plans.ledger_queries import ORACLE_SQL as LEDGER_SQL
from tallyfold.plans.ledger_queries import QUERIES as LEDGER
from tallyfold.plans.ledger_queries import _xml
from tallyfold.plans.views import lines, notices, observations, regions, scratch, table
from tallyfold.sources import artifacts
from tallyfold.sources.scratch import dealt
from tallyfold.streaming import ingest

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = O._half_up(sql)
        return f

    return add


# Loads -------------------------------------------------------------------------------------------------------------

@query("""SELECT CASE WHEN o_orderkey % 3 > 0 THEN 0 ELSE 1 END AS load, o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY ALL""")
def loaded_once(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in two batches that overlap; the second one runs twice, as after a loss."""
    path = scratch(spark, "loaded")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    ingest.load_new(o.filter("o_orderkey % 3 > 0"), path, ["o_orderkey"], 0)
    for _ in range(2):
        ingest.load_new(o.filter("o_orderkey % 3 <> 1"), path, ["o_orderkey"], 1)
    return ingest.loaded_keys(spark, path, o.schema).groupBy("load", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""SELECT event_type, event_id % 4 = 0 AS before, count(*) AS n FROM events GROUP BY ALL""")
def loaded_by_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events of which a batch has brought every fourth before; the stream then delivers all of them twice."""
    path = scratch(spark, "loaded")
    shaped = lambda d: d.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e = table(spark, sf, "events")
    ingest.load_new(shaped(e.filter("event_id % 4 = 0")), path, ["event_id"], -1)
    ingest.load_stream(spark, f"{sf}/events.parque[t]", e.schema, lambda d: shaped(d).unionByName(shaped(d)), path, ["event_id"], scratch(spark, "cursor"), "ts")
    return ingest.loaded_keys(spark, path, shaped(e).schema).groupBy("event_type", (F.col("load") < 0).alias("before")).agg(F.count("*").alias("n"))


# Routes ------------------------------------------------------------------------------------------------------------

@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, l_returnflag AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity >= 49 AND l_returnflag <> 'R'),
  b AS (SELECT near, far, min(kind) AS kind FROM (SELECT src AS near, dst AS far, kind FROM e UNION ALL SELECT dst, src, kind FROM e) GROUP BY ALL),
  pairs AS (SELECT 's' || s_suppkey AS src, 's' || (s_suppkey + 1) AS dst FROM supplier WHERE s_suppkey % 5 = 0),
  w AS (SELECT src, dst, src AS node, [src] AS nodes, []::VARCHAR[] AS kinds FROM pairs
    UNION ALL SELECT w.src, w.dst, b.far, list_append(nodes, b.far), list_append(kinds, b.kind) FROM w JOIN b ON w.node = b.near WHERE len(nodes) <= 4 AND w.node <> w.dst AND NOT list_contains(nodes, b.far)),
  r AS (SELECT src, dst, len(nodes) - 1 AS hops, nodes, kinds FROM w WHERE node = dst)
  SELECT src, dst, hops::INT AS hops, array_to_string(nodes, ' ') AS nodes, array_to_string(kinds, ' ') AS kinds FROM r QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY hops, nodes) = 1""")
def shortest_routes(spark: SparkSession, sf: str) -> DataFrame:
    """The way between suppliers next to each other in number through customers who bought much; returned goods don't count."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    e = li.filter("l_quantity >= 49").join(o, li.l_orderkey == o.o_orderkey).select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.col("l_returnflag").alias("kind"))
    pairs = table(spark, sf, "supplier").filter("s_suppkey % 5 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("src"), F.concat(F.lit("s"), F.col("s_suppkey") + 1).alias("dst"))
    got = routes.shortest_routes(e, pairs, 4, excluded=("R",))
    return got.select("src", "dst", "hops", F.array_join("nodes", " ").alias("nodes"), F.array_join("kinds", " ").alias("kinds"))


# Words -------------------------------------------------------------------------------------------------------------

def _titled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their first line as title and the rest as body."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", "lang", "source", F.substring_index("text", "\n", 1).alias("title"), F.expr("CASE WHEN instr(text, '\n') > 0 THEN substr(text, instr(text, '\n') + 1) ELSE '' END").alias("body"))


@query(r"""WITH d AS (SELECT doc_id, lang, CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title, CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body FROM documents),
  f AS (SELECT doc_id, lang, list_filter(string_split_regex(lower(title), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS t, 2.0::DOUBLE AS w FROM d UNION ALL SELECT doc_id, lang, list_filter(string_split_regex(lower(body), '[^\p{L}\p{N}]+'), lambda t: t <> ''), 1.0::DOUBLE FROM d),
  s AS (SELECT doc_id, w * (len(list_filter(t, lambda x: x = 'the')) + len(list_filter(t, lambda x: x = 'and')))::DOUBLE / len(t) AS score FROM f WHERE lang = 'en' AND list_contains(t, 'the') AND list_contains(t, 'and')),
  m AS (SELECT doc_id AS key, round(max(score), 8) AS score FROM s GROUP BY 1)
  SELECT key, score, row_number() OVER (ORDER BY score DESC, key)::INT AS rank FROM m ORDER BY score DESC, key LIMIT 50""")
def indexed_search(spark: SparkSession, sf: str) -> DataFrame:
    """English documents with both words in the title or in the body, titles counting twice; from an index over all words of both fields."""
    path = scratch(spark, "words")
    text_index.write_index(_titled(spark, sf), path, ["title", "body"], "doc_id", ("lang",))
    return text_index.find(spark, path, ["The", "and"], 2, [2.0, 1.0], F.col("lang") == "en", 50)


# Checks ------------------------------------------------------------------------------------------------------------

C = catalogue.Check
CHECKS = [
    # Orders
    C("orders", "order_key_present", "completeness", "o_orderkey IS NULL", label="o_orderkey"),
    C("orders", "order_customer_present", "completeness", "o_custkey IS NULL"),
    C("orders", "order_date_present", "completeness", "o_orderdate IS NOT NULL", rule=("coverage", 0.99)),
    C("orders", "order_status_known", "vocabulary", "o_orderstatus NOT IN ('F', 'O', 'P')", label="o_orderkey"),
    C("orders", "order_priority_known", "vocabulary", "o_orderpriority NOT LIKE '_-%'"),
    C("orders", "order_total_positive", "range", "o_totalprice <= 0"),
    C("orders", "order_total_plausible", "range", "o_totalprice > 400000", "warn", rule=("within", 0.2), label="o_orderkey"),
    C("orders", "order_total_small", "range", "o_totalprice < 2000", "warn", rule=("at_most", 10)),
    C("orders", "order_year_plausible", "era", "year(o_orderdate) NOT BETWEEN 1990 AND 2030"),
    C("orders", "finished_share", "band", "o_orderstatus = 'F'", "warn", rule=("band", 0.1, 0.9, 100)),
    C("orders", "open_share", "band", "o_orderstatus = 'O'", "warn", rule=("band", 0.1, 0.9, 100)),
    C("orders", "urgent_share", "band", "o_orderpriority = '1-URGENT'", "warn", rule=("band", 0.15, 0.25, 100)),
    C("orders", "orders_enough", "volume", "true", rule=("at_least", 100)),
    C("orders", "urgent_orders_dated", "completeness", "o_orderdate IS NULL", among="o_orderpriority = '1-URGENT'"),
    # Lines with what they refer to
    C("lines", "line_order_known", "reference", "o_orderkey IS NULL"),
    C("lines", "line_part_known", "reference", "p_partkey IS NULL"),
    C("lines", "line_supplier_known", "reference", "s_suppkey IS NULL"),
    C("lines", "line_quantity_positive", "range", "l_quantity <= 0"),
    C("lines", "line_quantity_bounded", "range", "l_quantity > 50"),
    C("lines", "line_price_positive", "range", "l_extendedprice <= 0"),
    C("lines", "line_discount_bounded", "range", "l_discount < 0 OR l_discount > 0.11"),
    C("lines", "line_tax_bounded", "range", "l_tax < 0 OR l_tax > 0.09"),
    C("lines", "line_flag_known", "vocabulary", "l_returnflag NOT IN ('A', 'N', 'R')"),
    C("lines", "line_status_known", "vocabulary", "l_linestatus NOT IN ('F', 'O')"),
    C("lines", "line_number_bounded", "range", "l_linenumber NOT BETWEEN 1 AND 7"),
    C("lines", "shipped_after_order", "order", "l_shipdate < o_orderdate", "warn", rule=("within", 0.5)),
    C("lines", "shipped_soon", "order", "l_shipdate <= o_orderdate + INTERVAL 400 DAY", "warn", rule=("coverage", 0.9)),
    C("lines", "returned_share", "band", "l_returnflag = 'R'", "warn", rule=("band", 0.1, 0.5, 1000)),
    C("lines", "deep_discount_share", "band", "l_discount >= 0.09", "warn", rule=("band", 0.05, 0.4, 1000)),
    C("lines", "open_lines_not_returned", "rule", "l_returnflag = 'R'", "warn", among="l_linestatus = 'O'", rule=("within", 0.4)),
    C("lines", "line_ship_year", "era", "year(l_shipdate) NOT BETWEEN 1990 AND 2030"),
    C("lines", "line_price_unit", "formula", "l_extendedprice / l_quantity > 3000", "warn", rule=("at_most", 100)),
    # Customers
    C("customers", "customer_name_present", "completeness", "c_name IS NOT NULL AND c_name <> ''", rule=("coverage", 0.99)),
    C("customers", "customer_nation_known", "reference", "n_nationkey IS NULL", label="c_custkey"),
    C("customers", "customer_balance_floor", "range", "c_acctbal < -1000", label="c_custkey"),
    C("customers", "customer_balance_negative", "range", "c_acctbal < 0", "warn", rule=("within", 0.05), label="c_custkey"),
    C("customers", "customer_balance_ceiling", "range", "c_acctbal > 10000"),
    C("customers", "customer_segment_present", "completeness", "c_mktsegment IS NULL"),
    C("customers", "building_share", "band", "c_mktsegment = 'BUILDING'", "warn", rule=("band", 0.1, 0.3, 100)),
    C("customers", "customer_name_form", "format", "c_name NOT LIKE 'Customer#%'"),
    # Suppliers
    C("suppliers", "supplier_name_present", "completeness", "s_name IS NOT NULL AND s_name <> ''", rule=("coverage", 0.99)),
    C("suppliers", "supplier_nation_known", "reference", "n_nationkey IS NULL"),
    C("suppliers", "supplier_name_form", "format", "s_name NOT LIKE 'Supplier#%'"),
    C("suppliers", "supplier_balance_floor", "range", "s_acctbal < -1000"),
    C("suppliers", "suppliers_enough", "volume", "true", "warn", rule=("at_least", 50)),
    # Parts
    C("parts", "part_name_present", "completeness", "p_name IS NULL OR p_name = ''"),
    C("parts", "part_size_bounded", "range", "p_size NOT BETWEEN 1 AND 50", label="p_partkey"),
    C("parts", "part_price_positive", "range", "p_retailprice <= 0"),
    C("parts", "part_brand_form", "format", "p_brand NOT LIKE 'Brand#%'"),
    C("parts", "part_type_present", "completeness", "p_type IS NOT NULL", rule=("coverage", 0.99)),
    C("parts", "large_share", "band", "p_size > 25", "warn", rule=("band", 0.3, 0.7, 100)),
    # Keys
    C("order_keys", "order_keys_unique", "uniqueness", "n > 1", label="k"),
    C("line_keys", "line_keys_repeated", "uniqueness", "n > 1", "warn", rule=("within", 0.9)),
    # Events
    C("events", "event_type_present", "completeness", "event_type IS NULL"),
    C("events", "event_user_present", "completeness", "user_id IS NOT NULL", rule=("coverage", 0.99)),
    C("events", "event_error_share", "band", "event_type = 'error'", "warn", rule=("band", 0.0, 0.5, 100)),
    C("events", "event_value_present", "completeness", "value IS NOT NULL", "warn", rule=("coverage", 0.5)),
    C("events", "event_value_bounded", "range", "value < 0", "warn", rule=("within", 0.01)),
    C("events", "event_year", "era", "year(ts) NOT BETWEEN 2000 AND 2040"),
    C("events", "purchases_valued", "completeness", "value IS NULL", among="event_type = 'purchase'", rule=("within", 0.5)),
    # Documents and pages
    C("documents", "document_text_present", "completeness", "text IS NOT NULL AND text <> ''", rule=("coverage", 0.95)),
    C("documents", "document_lang_present", "completeness", "lang IS NOT NULL", "warn", rule=("coverage", 0.5)),
    C("documents", "document_length_kept", "formula", "n_chars <> length(text)", "warn", rule=("within", 0.05)),
    C("documents", "document_long", "range", "n_chars > 100000", "warn", rule=("within", 0.01)),
    C("pages", "page_url_form", "format", "url NOT LIKE 'http%://%'", "warn", rule=("within", 0.05)),
    C("pages", "page_html_present", "completeness", "html IS NOT NULL AND html <> ''", rule=("coverage", 0.9)),
]
VIEWS = {
    "orders": "SELECT * FROM orders",
    "lines": "SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey",
    "customers": "SELECT * FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "suppliers": "SELECT * FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
    "parts": "SELECT * FROM part", "events": "SELECT * FROM events", "documents": "SELECT * FROM documents", "pages": "SELECT * FROM pages",
    "order_keys": "SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1",
    "line_keys": "SELECT l_orderkey AS k, l_linenumber AS l, count(*) AS n FROM lineitem GROUP BY 1, 2",
}


def frames(spark: SparkSession, sf: str) -> dict:
    t = lambda name: table(spark, sf, name)
    return {
        "orders": lambda: t("orders"),
        "lines": lambda: (li := t("lineitem")).join(o := t("orders"), li.l_orderkey == o.o_orderkey, "left").join(p := t("part"), li.l_partkey == p.p_partkey, "left").join(s := t("supplier"), li.l_suppkey == s.s_suppkey, "left"),
        "customers": lambda: (c := t("customer")).join(n := t("nation"), c.c_nationkey == n.n_nationkey, "left"),
        "suppliers": lambda: (s := t("supplier")).join(n := t("nation"), s.s_nationkey == n.n_nationkey, "left"),
        "parts": lambda: t("part"), "events": lambda: t("events"), "documents": lambda: t("documents"), "pages": lambda: t("pages"),
        "order_keys": lambda: t("orders").groupBy(F.col("o_orderkey").alias("k")).agg(F.count("*").alias("n")),
        "line_keys": lambda: t("lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("l")).agg(F.count("*").alias("n")),
    }


@query(catalogue.as_sql(CHECKS, VIEWS))
def check_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """All checks on the tables, one pass for each frame."""
    return catalogue.run(spark, frames(spark, sf), CHECKS).drop("error")


@query("WITH " + ", ".join(f"{k}_ AS ({v})" for k, v in VIEWS.items()) + " " + " UNION ALL ".join(f"SELECT '{c.name}' AS assertion, ({c.label})::VARCHAR AS label FROM {c.frame}_ WHERE ({c.among}) AND coalesce({c.violates}, false)" for c in CHECKS if c.label))
def catalogue_offenders(spark: SparkSession, sf: str) -> DataFrame:
    """Every row that breaks a check with a label."""
    return catalogue.offenders(frames(spark, sf), CHECKS)


_RESOLVED = LEDGER_SQL["resolver_tiers"].replace("WITH k AS", "k AS", 1)
_RESOLVED = _RESOLVED[: _RESOLVED.rindex("SELECT id, CASE WHEN n IS NULL")], _RESOLVED[_RESOLVED.rindex("SELECT id, CASE WHEN n IS NULL") :]


@query(f"""WITH {_RESOLVED[0].rstrip()}, r AS ({_RESOLVED[1]}),
  c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 'tier' WHEN c_custkey % 3 = 0 THEN 'confident' WHEN c_custkey % 5 = 0 THEN 'entity' ELSE 'refused' END AS expect FROM customer)
  SELECT expect, ok, count(*) AS n FROM (SELECT expect, coalesce(CASE expect WHEN 'tier' THEN hint = 'matched' AND tier = 'lei' AND score >= 0.99 WHEN 'confident' THEN hint IN ('matched', 'ambiguous') AND coalesce(score, 0) >= 0.9
    WHEN 'refused' THEN hint <> 'matched' AND (hint = 'no_match' OR coalesce(score, 0) < 0.99) ELSE hint = 'matched' AND CASE WHEN entity = 2 THEN 1 ELSE entity END = CASE WHEN id = 2 THEN 1 ELSE id END END, false) AS ok FROM c JOIN r USING (id)) GROUP BY ALL""")
def resolver_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """What customers with an LEI, a VAT number, a name or nothing are expected to resolve to, against the tiers' answers; suppliers 1 and 2 are known to be one."""
    k = F.col("c_custkey")
    expect = F.when(k % 7 == 0, "tier").when(k % 3 == 0, "confident").when(k % 5 == 0, "entity").otherwise("refused")
    least = F.when(expect == "tier", 0.99).when(expect == "confident", 0.9).otherwise(0.99)
    cases = table(spark, sf, "customer").select(F.concat(F.lit("case "), k).alias("case"), expect.alias("expect"), k.alias("id"), F.lit("lei").alias("tier"), least.alias("least"), k.alias("entity"))
    same = spark.createDataFrame([(2, 1)], "node long, canonical long")
    return quality.resolver_checks(cases, LEDGER["resolver_tiers"](spark, sf), same).groupBy("expect", "ok").agg(F.count("*").alias("n"))


# Kept statistics ---------------------------------------------------------------------------------------------------

@query(f"""WITH {O.OBSERVATIONS}, {O.UNIVERSE}, changed AS (SELECT dataset, year, geo, slice_key, CASE WHEN year < 1996 OR value < 40000 THEN value END AS value FROM observations WHERE year < 1998),
  a AS (SELECT dataset, length(geo) - 2 AS level, slice_key, year, count(DISTINCT geo) FILTER (value IS NOT NULL) AS present FROM changed GROUP BY ALL)
  SELECT dataset, level, slice_key, year, present, round(CASE WHEN present > 0 AND universe > 0 THEN present * 100.0::DOUBLE / universe END, 4) AS pct FROM a LEFT JOIN universe USING (level)""")
def rebuilt_availability(spark: SparkSession, sf: str) -> DataFrame:
    """Availability kept per year, then rebuilt from 1996 on after large values went and the years from 1998 on were withdrawn; older years come from the first run."""
    path = scratch(spark, "availability")
    o = observations(spark, sf)
    universe = stats.level_universe(o, regions(spark, sf))
    cube_store.rebuild(o, path, lambda d: stats.year_availability(d, universe))
    changed = o.withColumn("value", F.when((F.col("year") < 1996) | (F.col("value") < 40000), F.col("value"))).filter("year < 1998")
    cube_store.rebuild(changed, path, lambda d: stats.year_availability(d, universe), since_year=1996)
    return cube_store.stored(spark, path).select("dataset", "level", "slice_key", "year", "present", "pct")


@query(f"""WITH {O.OBSERVATIONS} SELECT o.geo, o.year, o.slice_key, round(o.value * 100 / nullif((SELECT min(d.value) FROM observations d WHERE d.dataset = '2-HIGH' AND d.geo = o.geo AND d.year = o.year), 0), 4) AS ratio
  FROM observations o WHERE o.dataset = '1-URGENT'""")
def per_divisor(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent observations in per cent of the least high one of their region and year."""
    o = observations(spark, sf)
    got = cube_store.per_divisor(o.filter("dataset = '1-URGENT'"), o.filter("dataset = '2-HIGH'"), scale=100.0)
    return got.select("geo", "year", "slice_key", S.rounded("ratio", 4).alias("ratio"))


@query("""WITH r AS (SELECT 'r' || (user_id % 10) AS reader, event_type AS stream, max(event_id) AS read FROM events GROUP BY ALL)
  SELECT reader, stream, greatest((SELECT max(s.event_id) FROM events s WHERE s.event_type = r.stream) - read, 0) AS lag FROM r""")
def reader_lags(spark: SparkSession, sf: str) -> DataFrame:
    """Event types as streams, users by last digit as readers: how far each is behind."""
    e = table(spark, sf, "events")
    return cube_store.lags(e.select(F.col("event_type").alias("stream"), F.col("event_id").alias("seq")), e.select(F.concat(F.lit("r"), F.col("user_id") % 10).alias("reader"), F.col("event_type").alias("stream"), F.col("event_id").alias("seq")))


# Panels ------------------------------------------------------------------------------------------------------------

@query("""WITH t AS (SELECT event_type AS graph, props->>'$.k' AS predicate, 'class' || (user_id % 7) AS class FROM events),
  g AS (SELECT graph, predicate, class, count(*) AS n, CASE WHEN grouping(graph) = 1 THEN 0 WHEN grouping(predicate) = 0 THEN 2 WHEN grouping(class) = 0 THEN 3 ELSE 1 END AS level FROM t GROUP BY GROUPING SETS ((), (graph), (graph, predicate), (graph, class)))
  SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY level, graph ORDER BY n DESC, predicate, class) <= 5""")
def triple_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Events as triples: in all, per graph, and the five most frequent predicates and classes of each graph, from one pass."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("graph"), F.get_json_object("props", "$.k").alias("predicate"), F.concat(F.lit("class"), F.col("user_id") % 7).alias("class"))
    return cube_store.panel(e, (), ("graph",), ("graph", "predicate"), ("graph", "class"), top=5, within="graph").select("graph", "predicate", "class", "n", "level")


@query("""WITH p AS (SELECT p_brand AS venue, p_type AS kind, 'c' || (p_partkey % 12) AS country, CASE WHEN p_size % 4 = 0 THEN p_partkey END AS lei FROM part),
  g AS (SELECT venue, kind, country, count(*) AS n, count(lei) AS linked, CASE WHEN grouping(venue) = 0 THEN 1 WHEN grouping(kind) = 0 THEN 2 WHEN grouping(country) = 0 THEN 3 ELSE 0 END AS level FROM p GROUP BY GROUPING SETS ((), (venue), (kind), (country)))
  SELECT venue, kind, country, n, level, linked, round(linked / greatest(n, 1)::DOUBLE * 100, 1) AS linked_pct FROM g QUALIFY row_number() OVER (PARTITION BY level ORDER BY n DESC, venue, kind, country) <= 10""")
def register_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as instruments: count and linked rate in all, by venue, kind and country, the ten largest of each, from one pass."""
    p = table(spark, sf, "part").select(F.col("p_brand").alias("venue"), F.col("p_type").alias("kind"), F.concat(F.lit("c"), F.col("p_partkey") % 12).alias("country"), F.when(F.col("p_size") % 4 == 0, F.col("p_partkey")).alias("lei"))
    got = cube_store.panel(p, (), ("venue",), ("kind",), ("country",), top=10, linked=F.count("lei"))
    return got.withColumn("linked_pct", S.rounded(F.col("linked") / F.greatest("n", F.lit(1)) * 100, 1)).select("venue", "kind", "country", "n", "level", "linked", "linked_pct")


@query("""WITH l AS (SELECT c_mktsegment AS category, strftime(o_orderdate, '%Y-%m') || '-01' AS month, CASE WHEN o_totalprice < 50000 THEN 'a' WHEN o_totalprice < 150000 THEN 'b' ELSE 'c' END AS spend, CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS matched FROM orders JOIN customer ON o_custkey = c_custkey)
  SELECT category, month, spend, count(*) AS n, count(matched) AS matched, CASE WHEN grouping(category) = 0 THEN 1 WHEN grouping(month) = 0 THEN 2 WHEN grouping(spend) = 0 THEN 3 ELSE 0 END AS level FROM l GROUP BY GROUPING SETS ((), (category), (month), (spend))""")
def lobby_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as registrations: category mix, registrations by month, spending classes, and how many are matched, from one pass."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    v = F.col("o_totalprice")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("category"), F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-01")).alias("month"), F.when(v < 50000, "a").when(v < 150000, "b").otherwise("c").alias("spend"),
                                                        F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("m"))
    return cube_store.panel(rows, (), ("category",), ("month",), ("spend",), matched=F.count("m")).select("category", "month", "spend", "n", "matched", "level")


@query(f"""WITH {O.NOTICES} SELECT nation, count(*) AS n, count(*) FILTER (bidders IS NOT NULL) AS bidders, count(*) FILTER (total > 0) AS valued, count(*) FILTER (coalesce(bidders = 1, false)) AS single, count(*) FILTER (notice_type = 'can-modif') AS modified,
  round(count(*) FILTER (bidders IS NOT NULL) / greatest(count(*), 1)::DOUBLE * 100, 1) AS bidders_pct, round(count(*) FILTER (total > 0) / greatest(count(*), 1)::DOUBLE * 100, 1) AS valued_pct,
  round(count(*) FILTER (coalesce(bidders = 1, false)) / greatest(count(*), 1)::DOUBLE * 100, 1) AS single_pct, round(count(*) FILTER (notice_type = 'can-modif') / greatest(count(*), 1)::DOUBLE * 100, 1) AS modified_pct FROM notices GROUP BY nation""")
def integrity_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation how many notices disclose bidders and a value, have a single bidder, or are modifications."""
    c = F.col
    return cube_store.rates(notices(spark, sf), by="nation", bidders=c("bidders").isNotNull(), valued=c("total") > 0, single=c("bidders") == 1, modified=c("notice_type") == "can-modif")


# Money -------------------------------------------------------------------------------------------------------------

_MONEY = """a AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'PLN' WHEN 1 THEN ' huf' WHEN 2 THEN 'n/a' END AS declared, ['POL', 'SWE', 'ITA', 'SVK', 'XXX'][c_nationkey % 5 + 1] AS country, o_orderdate::DATE AS day,
    CASE WHEN o_orderkey % 11 = 0 THEN '1' WHEN o_orderkey % 13 = 0 THEN '999999999' WHEN o_orderkey % 17 = 0 THEN 'secret' ELSE o_totalprice::DECIMAL(18, 2)::VARCHAR END AS published FROM orders JOIN customer ON o_custkey = c_custkey),
  c AS (SELECT *, CASE WHEN regexp_matches(upper(trim(declared)), '^[A-Z]{3}$') THEN upper(trim(declared)) ELSE CASE country WHEN 'POL' THEN 'PLN' WHEN 'SWE' THEN 'SEK' WHEN 'ITA' THEN CASE WHEN day >= DATE '1999-01-01' THEN 'EUR' ELSE 'ITL' END WHEN 'SVK' THEN CASE WHEN day >= DATE '2009-01-01' THEN 'EUR' ELSE 'SKK' END END END AS currency,
    CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE published::DOUBLE END AS amount FROM a),
  r AS (SELECT ['PLN', 'HUF', 'SEK', 'ITL'][l_linenumber % 4 + 1] AS currency, l_shipdate::DATE AS day, min(1 + l_tax * 10) AS per_euro FROM lineitem WHERE l_discount >= 0.09 GROUP BY ALL),
  e AS (SELECT c.currency, c.amount, CASE WHEN c.currency = 'EUR' THEN amount ELSE amount / per_euro END AS eur FROM c ASOF LEFT JOIN r ON c.currency = r.currency AND c.day >= r.day)"""


@query(f"WITH {_MONEY} SELECT currency, count(*) AS n, count(amount) AS disclosed, count(eur) AS converted, round(sum(eur), 0) AS eur FROM e GROUP BY 1")
def published_values(spark: SparkSession, sf: str) -> DataFrame:
    """Order values as published: currencies declared, sloppily written, missing or before the euro; amounts undisclosed or no numbers."""
    o, c, li = table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "lineitem")
    k = F.col("o_orderkey")
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    text = F.when(k % 11 == 0, "1").when(k % 13 == 0, "999999999").when(k % 17 == 0, "secret").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.when(k % 4 == 0, "PLN").when(k % 4 == 1, " huf").when(k % 4 == 2, "n/a").alias("declared"), pick(["POL", "SWE", "ITA", "SVK", "XXX"], F.col("c_nationkey") % 5).alias("country"), F.to_date("o_orderdate").alias("day"), text.alias("published"))
    rates = li.filter("l_discount >= 0.09").select(pick(["PLN", "HUF", "SEK", "ITL"], F.col("l_linenumber") % 4).alias("currency"), F.to_date("l_shipdate").alias("day"), (1 + F.col("l_tax") * 10).alias("per_euro"))
    return money.published_to_euro(rows, rates).groupBy("currency").agg(F.count("*").alias("n"), F.count("amount").alias("disclosed"), F.count("eur").alias("converted"), S.rounded(F.sum("eur"), 0).alias("eur"))


@query(f"WITH {_MONEY}, t AS (SELECT currency, count(*) AS n FROM e WHERE currency IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 25) SELECT (SELECT count(*) FROM e) AS total, (SELECT count(*) FROM e WHERE amount IS NULL) AS undisclosed, (SELECT count(*) FROM e WHERE eur IS NOT NULL) AS converted, (SELECT count(*) FROM e WHERE currency IS NOT NULL) AS with_currency, currency, n FROM t")
def currency_panel(spark: SparkSession, sf: str) -> DataFrame:
    """In all, undisclosed, converted and with a currency, and the 25 most frequent currencies."""
    per = QUERIES["published_values"](spark, sf)
    whole = per.agg(F.sum("n").alias("total"), F.sum(F.col("n") - F.col("disclosed")).alias("undisclosed"), F.sum("converted").alias("converted"), F.sum(F.when(F.col("currency").isNotNull(), F.col("n")).otherwise(0)).alias("with_currency"))
    return whole.crossJoin(per.filter("currency IS NOT NULL").orderBy(F.desc("n"), "currency").limit(25).select("currency", "n"))  # one row beside 25


# Artifacts ---------------------------------------------------------------------------------------------------------

@query("""SELECT c_nationkey::VARCHAR AS part, count(*) AS n, c_nationkey IN (3, 5) AS written FROM customer GROUP BY ALL""")
def resumed_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as artifacts by nation. The files of nations 3 and 5 get other rows behind the manifest's back; a second run writes these two alone, and all rows are read back."""
    path = scratch(spark, "artifacts")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    artifacts.write_artifacts(c, path, F.col("c_nationkey"), rows_per_file=500)
    harmed = c.filter("c_nationkey IN (3, 5)").withColumns({"part": F.col("c_nationkey").cast("string"), "c_name": F.lit("harmed")})
    harmed.write.partitionBy("part").option("compression", "gzip").option("partitionOverwriteMode", "dynamic").mode("overwrite").json(f"{path}/data")
    again = artifacts.write_artifacts(c, path, F.col("c_nationkey"), rows_per_file=500)
    rows = artifacts.read_artifacts(spark, path, "c_custkey long, c_name string").groupBy("part").agg(F.count("*").alias("n"))
    return rows.join(again.withColumn("written", F.lit(True)), "part", "left").select("part", "n", F.coalesce("written", F.lit(False)).alias("written"))


@query("""WITH s AS (SELECT 's' || s_suppkey AS subject, s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier),
  t AS (SELECT s_nationkey, s_suppkey % 9 = 0 AS person FROM s WHERE s_nationkey % 2 = 0)
  SELECT 'even' AS graph, 'name' AS predicate, count(*) AS n FROM t WHERE NOT person HAVING count(*) > 0 UNION ALL SELECT 'even', 'type', count(*) FROM t WHERE NOT person HAVING count(*) > 0
  UNION ALL SELECT 'refused', 'missing', count(*) FROM s WHERE s_nationkey % 2 = 1 AND s_suppkey % 10 = 1""")
def gated_graphs(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of even nations replace a graph; those of odd ones, of which some have no name, are refused for the same graph, which stays. Every ninth of the first is a person and left out."""
    path = scratch(spark, "graphs")
    s = table(spark, sf, "supplier")
    subject = F.concat(F.lit("s"), "s_suppkey").alias("subject")

    def triples(rows: DataFrame, broken: F.Column) -> DataFrame:
        names = rows.filter(~broken).select(subject, F.lit("name").alias("predicate"), F.col("s_name").alias("object"))
        kind = F.when((F.col("s_suppkey") % 9 == 0) & (F.col("s_nationkey") % 2 == 0), "person").otherwise("company")
        return names.unionByName(rows.select(subject, F.lit("type").alias("predicate"), kind.alias("object")))

    rule = ["name", "type"], {}, {"type": ["company"]}
    artifacts.replace_graph(triples(s.filter("s_nationkey % 2 = 0"), F.lit(False)), path, "even", *rule)
    refused = artifacts.replace_graph(triples(s.filter("s_nationkey % 2 = 1"), F.col("s_suppkey") % 10 == 1), path, "even", *rule)
    kept = spark.read.schema("subject string, predicate string, object string, graph string").parquet(path).groupBy("graph", "predicate").agg(F.count("*").alias("n"))
    return kept.unionByName(refused.groupBy(F.lit("refused").alias("graph"), F.col("reason").alias("predicate")).agg(F.count("*").alias("n")))


# Regions, identities and periods -----------------------------------------------------------------------------------

_PLACED = O.CONTRACTS + """, located AS (SELECT s_suppkey AS company, 'R' || n_regionkey || lpad(n_nationkey::VARCHAR, 2, '0') AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT s_suppkey, 'R0' || lpad((s_suppkey % 5)::VARCHAR, 2, '0') FROM supplier WHERE s_suppkey % 10 = 0),
  codes AS (SELECT 'R' || r_regionkey AS code FROM region UNION SELECT 'R' || n_regionkey || lpad(n_nationkey::VARCHAR, 2, '0') FROM nation UNION SELECT 'R9')"""


def _placed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Suppliers at their nations, every tenth in a second place; contracts; the regions with one that nobody is in."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    code = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    second = s.filter("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("company"), F.concat(F.lit("R0"), F.lpad((F.col("s_suppkey") % 5).cast("string"), 2, "0")).alias("code"))
    located = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("company"), code.alias("code")).unionByName(second)
    c = procurement.collapse_modifications(notices(spark, sf)).select(F.col("contract_key").alias("contract"), "company", "authority", F.col("current_value").alias("value"), "is_current", "low_confidence", "nation")
    return located, c, regions(spark, sf).select("code").unionByName(spark.createDataFrame([("R9",)], "code string"))


def _region_sql(name: str, level: int, value: str, scope: str = "", joined: bool = True) -> str:
    source = "located l JOIN contracts c ON l.company = c.company" if joined else "located l"
    return f"""SELECT '{name}' AS metric, w.code, coalesce(v.value, 0)::DOUBLE AS value FROM (SELECT code FROM codes WHERE length(code) = {level + 2} AND starts_with(code, '{scope}')) w
      LEFT JOIN (SELECT substr(l.code, 1, {level + 2}) AS code, {value} AS value FROM {source} WHERE length(l.code) >= {level + 2} AND starts_with(l.code, '{scope}') GROUP BY 1) v ON v.code = w.code"""


_MONEY_SUM = "round(sum(CASE WHEN is_current AND NOT low_confidence THEN current_value ELSE 0 END), 0)"


@query(f"WITH {_PLACED} " + " UNION ALL ".join([
    _region_sql("companies 0", 0, "count(DISTINCT l.company)", joined=False), _region_sql("companies 2 in R1", 2, "count(DISTINCT l.company)", "R1", joined=False),
    _region_sql("contracts 2", 2, "count(DISTINCT CASE WHEN is_current THEN contract_key END)"), _region_sql("contracts_eur 0", 0, _MONEY_SUM), _region_sql("contracts_eur 2 in R0", 2, _MONEY_SUM, "R0")]))
def region_values(spark: SparkSession, sf: str) -> DataFrame:
    """Three metrics on two levels, with and without a scope; regions without anything stay with 0."""
    located, c, codes = _placed(spark, sf)
    out = None
    for metric, level, scope in (("companies", 0, None), ("companies", 2, "R1"), ("contracts", 2, None), ("contracts_eur", 0, None), ("contracts_eur", 2, "R0")):
        name = f"{metric} {level}" + (f" in {scope}" if scope else "")
        part = regional.by_region(located, c, codes, metric, level, scope).select(F.lit(name).alias("metric"), "code", S.rounded("value", 0).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {_PLACED}, k AS (SELECT 'R' || n_regionkey AS code, n_nationkey FROM nation), f AS (SELECT min(company) AS company, min(authority) AS authority FROM contracts)
  SELECT 'company' AS kind, k.code, round(sum(CASE WHEN is_current AND NOT low_confidence THEN current_value ELSE 0 END), 0)::DOUBLE AS value FROM contracts c JOIN k ON c.nation = k.n_nationkey WHERE c.company = (SELECT company FROM f) GROUP BY ALL
  UNION ALL SELECT 'authority', l.code, count(DISTINCT CASE WHEN is_current THEN contract_key END)::DOUBLE FROM contracts c JOIN located l ON c.company = l.company WHERE c.authority = (SELECT authority FROM f) GROUP BY ALL""")
def entity_regions(spark: SparkSession, sf: str) -> DataFrame:
    """The first supplier's money by its customers' region, and the first customer's contracts by where its suppliers are."""
    located, c, codes = _placed(spark, sf)
    n = table(spark, sf, "nation")
    countries = c.select("authority", "nation").distinct().join(n, F.col("nation") == n.n_nationkey).select("authority", F.concat(F.lit("R"), "n_regionkey").alias("code")).distinct()
    first = c.agg(F.min("company").alias("company"), F.min("authority").alias("authority")).first()
    own = regional.of_entity(c, located, countries, codes, "contracts_eur", 0, company=first["company"]).select(F.lit("company").alias("kind"), "code", S.rounded("value", 0).alias("value"))
    return own.unionByName(regional.of_entity(c, located, countries, codes, "contracts", 2, authority=first["authority"]).select(F.lit("authority").alias("kind"), "code", "value"))


@query(f"""WITH {O.FILINGS}, w AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN lpad(c_custkey::VARCHAR, 8, '0') || '-0000-5' ELSE 'T' || (c_custkey // 4) END AS id, c_custkey FROM customer WHERE c_custkey % 5 < 3),
  i AS (SELECT DISTINCT id FROM w), r AS (SELECT id, CASE WHEN id LIKE 'T%' THEN substr(id, 2)::BIGINT ELSE substr(id, 1, 8)::BIGINT END AS company FROM i)
  SELECT id, f.year::INT AS year, round(revenue, 2) AS revenue, 'store' AS source FROM r JOIN filings f USING (company) UNION ALL SELECT id, 0, 1.0::DOUBLE, 'filings' FROM r WHERE id LIKE 'T%' AND company NOT IN (SELECT company FROM filings)""")
def filings_by_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Filings of companies asked for by UUID or by ticker; tickers of companies without any take a fallback's."""
    from tallyfold.plans.views import filings

    uuid = lambda c: F.concat(F.lpad(c.cast("string"), 8, "0"), F.lit("-0000-5"))
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    wanted = c.filter("c_custkey % 5 < 3").select(F.when(k % 2 == 0, uuid(k)).otherwise(F.concat(F.lit("T"), F.expr("c_custkey div 4"))).alias("id")).distinct()
    listings = c.select(F.concat(F.lit("T"), k).alias("ticker"), uuid(k).alias("company")).unionByName(spark.createDataFrame([("T0", "00000000-0000-5")], "ticker string, company string")).distinct()
    rows = filings(spark, sf).select(uuid(F.col("company")).alias("company"), F.col("year").cast("int").alias("year"), S.rounded("revenue", 2).alias("revenue"))
    fallback = listings.select("ticker", F.lit(0).alias("year"), F.lit(1.0).alias("revenue"))
    return listing.by_identity(wanted, listings, rows, fallback).select("id", "year", "revenue", "source")


@query("""WITH p AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN year(o_orderdate)::VARCHAR WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN year(o_orderdate) || '-Q' || quarter(o_orderdate) ELSE 'x' END AS period, year(o_orderdate) AS y, o_orderkey % 4 < 3 AS readable, o_orderdate::DATE AS day FROM orders), l AS (SELECT max(day) AS last FROM p)
  SELECT period, count(*) AS n, count(*) FILTER (day >= last - 180) AS half, count(*) FILTER (day >= last - 730) AS two_years, count(*) FILTER (day >= last - 365) AS odd FROM p, l WHERE readable AND y >= 1995 GROUP BY 1""")
def windowed_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by period from 1995 on, unreadable periods aside, and how many are in named windows before the last day."""
    o = table(spark, sf, "orders")
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 4
    y = F.year("o_orderdate").cast("string")
    p = F.when(k == 0, y).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).when(k == 2, F.concat(y, F.lit("-Q"), F.quarter("o_orderdate").cast("string"))).otherwise("x")
    last = F.lit(o.agg(F.max(d)).first()[0])
    rows = o.select(p.alias("period"), d.alias("day")).filter(S.kept_period(F.col("period"), 1995))
    within = lambda name: F.count_if(F.col("day") >= S.window_start(name, last))
    return rows.groupBy("period").agg(F.count("*").alias("n"), within("6mo").alias("half"), within("2y").alias("two_years"), within("soon").alias("odd"))


# Companies ---------------------------------------------------------------------------------------------------------

@query(f"""WITH {O.FILINGS}, l AS (SELECT company, year, revenue, operating_income, operating_income + depreciation AS ebitda, CASE WHEN company % 5 > 0 THEN debt * 0.8::DOUBLE ELSE 0 END - coalesce(cash, 0) AS net_debt, revenue * 0.2::DOUBLE - abs(CASE WHEN company % 4 > 0 THEN revenue * 0.05::DOUBLE END) AS fcf FROM filings QUALIFY year = max(year) OVER (PARTITION BY company)),
  s AS (SELECT c_custkey AS company, CASE WHEN c_custkey % 6 > 0 THEN c_acctbal END AS price, c_nationkey * 10 AS shares FROM customer WHERE c_custkey % 7 > 0),
  e AS (SELECT c_custkey AS company, CASE WHEN shares > 0 AND price > 0 THEN price * shares END AS market_cap, net_debt, revenue, fcf, ebitda, operating_income FROM customer LEFT JOIN s ON s.company = c_custkey LEFT JOIN l ON l.company = c_custkey),
  v AS (SELECT *, market_cap + net_debt AS ev FROM e)
  SELECT company, round(market_cap, 4) AS market_cap, round(net_debt, 4) AS net_debt, round(ev, 4) AS ev, round(nullif(ev, 0) / nullif(ebitda, 0), 4) AS ev_ebitda, round(nullif(ev, 0) / nullif(revenue, 0), 4) AS ev_revenue, round(nullif(ev, 0) / nullif(fcf, 0), 4) AS ev_fcf, round(nullif(ev, 0) / nullif(operating_income, 0), 4) AS ev_ebit FROM v""")
def enterprise_multiples(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a company with a market of its own: some without a price, without shares, without filings or without anything."""
    from tallyfold.operators import finance
    from tallyfold.plans.views import filings_full

    c = table(spark, sf, "customer")
    market = c.filter("c_custkey % 7 > 0").select(F.col("c_custkey").alias("company"), F.when(F.col("c_custkey") % 6 > 0, F.col("c_acctbal")).alias("price"), (F.col("c_nationkey") * 10).alias("shares"))
    return finance.enterprise_multiples(filings_full(spark, sf), market, c.select(F.col("c_custkey").alias("company")))


@query(f"""WITH {O.CONTRACTS}, {O.FILINGS.strip()}, w AS (SELECT company, count(*) FILTER (is_current) AS contracts, round(sum(CASE WHEN is_current AND NOT low_confidence THEN current_value ELSE 0 END), 0) AS value, count(DISTINCT authority) AS authorities FROM contracts GROUP BY 1),
  y AS (SELECT company, count(*) AS years, max(year)::INT AS newest, max_by(revenue, year) AS revenue FROM filings GROUP BY 1)
  SELECT s_suppkey AS company, s_name AS name, n_name AS country, coalesce(contracts, 0) AS contracts, coalesce(authorities, 0) AS authorities, coalesce(years, 0) AS years, coalesce(value, 0)::DOUBLE AS value, newest, round(revenue, 2) AS revenue
  FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN w ON w.company = s_suppkey LEFT JOIN y ON y.company = s_suppkey""")
def company_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with what they won and, as the customers of the same number, what they filed."""
    from tallyfold.plans.views import filings

    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    companies = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("company"), F.col("s_name").alias("name"), F.col("n_name").alias("country"))
    got = procurement.company_profile(companies, dealt(procurement.collapse_modifications(notices(spark, sf)), lines(spark, sf), "company"), filings(spark, sf))
    return got.select("company", "name", "country", "contracts", "authorities", "years", S.rounded("value", 0).alias("value"), F.col("newest").cast("int").alias("newest"), S.rounded("revenue", 2).alias("revenue"))


# More panels --------------------------------------------------------------------------------------------------------

@query(f"""WITH {O.EDGES}, d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1),
  n AS (SELECT 'customer' AS kind, 'c' || c_custkey AS node FROM customer UNION ALL SELECT 'supplier', 's' || s_suppkey FROM supplier), k AS (SELECT kind, coalesce(degree, 0) AS d FROM n LEFT JOIN d USING (node))
  SELECT kind, count(*) AS nodes, count(*) FILTER (d = 0) AS isolated, count(*) FILTER (d = 1) AS d1, count(*) FILTER (d BETWEEN 2 AND 5) AS d2_5, count(*) FILTER (d BETWEEN 6 AND 10) AS d6_10, count(*) FILTER (d BETWEEN 11 AND 50) AS d11_50,
    count(*) FILTER (d BETWEEN 51 AND 100) AS d51_100, count(*) FILTER (d BETWEEN 101 AND 500) AS d101_500, count(*) FILTER (d > 500) AS d501 FROM k GROUP BY 1""")
def degree_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers that met in an order, by how many they met."""
    from tallyfold.operators import graph

    n = notices(spark, sf).select(F.concat(F.lit("c"), "authority").alias("src"), F.concat(F.lit("s"), "company").alias("dst")).distinct()
    nodes = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.concat(F.lit("c"), "c_custkey").alias("node")).unionByName(table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.concat(F.lit("s"), "s_suppkey").alias("node")))
    return graph.degree_classes(n, nodes)


@query("""WITH r AS (SELECT 'user ' || user_id AS job, ts AS started, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'success' ELSE 'running' END AS status FROM events),
  c AS (SELECT DISTINCT 'user ' || user_id AS job, 24 * (1 + user_id % 5) AS allowed FROM events UNION ALL SELECT 'idle', 240), n AS (SELECT max(ts) AS now FROM events), l AS (SELECT job, max(started) AS last FROM r WHERE status = 'success' GROUP BY 1),
  a AS (SELECT job, allowed, (epoch_us(now) - epoch_us(last)) / 3600000000.0::DOUBLE AS age FROM c LEFT JOIN l USING (job), n)
  SELECT job, floor(age + 0.5)::BIGINT AS hours, allowed, job || ' (' || coalesce(floor(age + 0.5)::BIGINT::VARCHAR, 'never') || 'h/' || allowed || 'h)' AS said FROM a WHERE age IS NULL OR age > allowed""")
def overdue_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Users as jobs, signups as successes, each with a cadence of its own, judged at the newest event; one job never ran."""
    e = table(spark, sf, "events")
    job = F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("job")
    runs = e.select(job, F.col("ts").alias("started"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "success").otherwise("running").alias("status"))
    cadence = e.select(job, (24 * (1 + F.col("user_id") % 5)).alias("hours")).distinct().unionByName(spark.createDataFrame([("idle", 240)], "job string, hours long"))
    return quality.overdue(runs, cadence, F.lit(e.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]))


@query(f"""WITH {O.PRICES}, t AS (SELECT DISTINCT p_brand AS ticker, 'even' AS sector FROM part WHERE right(p_brand, 1)::INT % 2 = 0 UNION ALL SELECT DISTINCT p_brand, 'odd' FROM part WHERE right(p_brand, 1)::INT % 2 = 1 UNION ALL SELECT 'none', 'odd'),
  a AS (SELECT sector, datediff('day', newest, DATE '1998-11-25') AS age FROM t LEFT JOIN (SELECT ticker, max(date) AS newest FROM prices GROUP BY 1) USING (ticker))
  SELECT sector, count(*) AS tickers, count(*) FILTER (age <= 7) AS fresh, count(*) FILTER (age BETWEEN 8 AND 30) AS ageing, count(*) FILTER (age > 30) AS stale, count(*) FILTER (age IS NULL) AS never, round(count(*) FILTER (age <= 7) / nullif(count(age), 0)::DOUBLE * 100, 1) AS fresh_pct FROM a GROUP BY 1""")
def price_ages(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as tickers in two sectors, judged at a day; one has no price."""
    from tallyfold.operators import finance
    from tallyfold.plans.views import prices

    last = F.substring("p_brand", -1, 1).cast("int")
    t = table(spark, sf, "part").select(F.col("p_brand").alias("ticker"), F.when(last % 2 == 0, "even").otherwise("odd").alias("sector")).distinct()
    return finance.price_ages(t.unionByName(spark.createDataFrame([("none", "odd")], "ticker string, sector string")), prices(spark, sf), F.lit("1998-11-25").cast("date"))


# Search, parties, edges and codes ----------------------------------------------------------------------------------

@query("""WITH n AS (SELECT p_partkey AS company, p_name AS name FROM part), l AS (SELECT p_partkey AS company, 'blu' || p_size AS ticker FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'blue' ELSE 'zz' || p_partkey END FROM part WHERE p_partkey % 6 = 0 OR p_partkey % 5 = 0),
  a AS (SELECT DISTINCT l_partkey AS company FROM lineitem WHERE l_quantity > 48),
  t AS (SELECT company, name, min(ticker) AS ticker, 1 AS source, max(CASE WHEN lower(name) = 'blue' THEN 4 WHEN lower(ticker) = 'blue' THEN 3 WHEN starts_with(lower(name), 'blue') THEN 2 WHEN starts_with(lower(ticker), 'blue') THEN 1 ELSE 0 END) AS tier FROM n JOIN l USING (company) WHERE contains(lower(name), 'blue') OR starts_with(lower(ticker), 'blue') GROUP BY ALL
    UNION ALL SELECT company, name, NULL, CASE WHEN company IN (SELECT company FROM a) THEN 2 ELSE 3 END, CASE WHEN lower(name) = 'blue' THEN 4 WHEN starts_with(lower(name), 'blue') THEN 2 ELSE 0 END FROM n WHERE contains(lower(name), 'blue') AND company NOT IN (SELECT company FROM n JOIN l USING (company) WHERE contains(lower(name), 'blue') OR starts_with(lower(ticker), 'blue')))
  SELECT company, name, ticker, source, tier FROM t ORDER BY source, tier DESC, length(name), name, company LIMIT 40""")
def company_search(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as companies, some listed once or twice, some with large orders: what Blue finds."""
    from tallyfold.operators import search

    p, k = table(spark, sf, "part"), F.col("p_partkey")
    first = p.filter("p_partkey % 3 = 0").select(k.alias("company"), F.concat(F.lit("blu"), "p_size").alias("ticker"))
    second = p.filter("p_partkey % 6 = 0 OR p_partkey % 5 = 0").select(k.alias("company"), F.when(k % 2 == 0, "blue").otherwise(F.concat(F.lit("zz"), k)).alias("ticker"))
    won = table(spark, sf, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("company"))
    return search.companies(p.select(k.alias("company"), F.col("p_name").alias("name")), first.unionByName(second), won, "Blue", 40)


@query("""WITH r AS (SELECT l_orderkey AS notice_id, (l_linenumber, l_partkey, l_extendedprice) AS place, l_suppkey % 20 AS company, CASE WHEN l_suppkey % 20 = 3 THEN '' ELSE 'S' || (l_partkey % 3) END AS name, l_returnflag <> 'R' AS win, l_linenumber % 3 AS layer, CASE WHEN l_linenumber = 5 THEN 'lei' END AS tier, l_discount AS confidence, l_partkey % 4 = 0 AS created FROM lineitem),
  f AS (SELECT notice_id, company, CASE WHEN win THEN 'winner' ELSE 'named_tenderer' END AS role, min_by({'name': name, 'tier': coalesce(tier, CASE WHEN layer = 1 THEN 'vat' END), 'confidence': CASE WHEN NOT created THEN confidence END, 'layer': layer}, place) AS p, count(*) AS lots FROM r WHERE name <> '' GROUP BY ALL)
  SELECT notice_id, company, role, p.name AS name, p.tier AS match_tier, p.confidence AS match_confidence, p.layer AS match_layer, lots FROM f""")
def notice_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as resolved suppliers of notices: returned ones lost, some have no name, some companies were made for it."""
    from tallyfold.operators import panels

    k, n = F.col("l_partkey"), F.col("l_linenumber")
    r = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("notice_id"), F.struct("l_linenumber", "l_partkey", "l_extendedprice").alias("place"), (F.col("l_suppkey") % 20).alias("company"), F.when(F.col("l_suppkey") % 20 == 3, "").otherwise(F.concat(F.lit("S"), k % 3)).alias("name"),
        (F.col("l_returnflag") != "R").alias("is_winner"), (n % 3).alias("layer"), F.when(n == 5, "lei").alias("tier"), F.col("l_discount").alias("confidence"), (k % 4 == 0).alias("created"))
    return panels.parties(r)


@query("""WITH e AS (SELECT DISTINCT 's' || l_suppkey AS subject, CASE l_returnflag WHEN 'A' THEN 'awardedTo' WHEN 'N' THEN 'namedIn' END AS predicate, 'o' || l_orderkey AS object, l_returnflag AS kind FROM lineitem)
  SELECT predicate, count(*) AS n FROM e WHERE predicate IS NOT NULL GROUP BY 1 UNION ALL SELECT 'kind', count(*) FROM e WHERE predicate IS NOT NULL UNION ALL SELECT 'unmapped R', count(*) FROM lineitem WHERE l_returnflag = 'R' HAVING count(*) > 0""")
def edge_triples(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as edges of three kinds between suppliers and orders, of which two have a predicate."""
    from tallyfold.operators import etl

    li = table(spark, sf, "lineitem").withColumn("kind", F.col("l_returnflag"))
    known, unknown = etl.edge_triples(li, {"A": "awardedTo", "N": "namedIn"}, F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("o"), "l_orderkey"), {"kind": F.col("kind")})
    return known.groupBy("predicate").agg(F.count("*").alias("n")).unionByName(unknown.select(F.concat(F.lit("unmapped "), "kind").alias("predicate"), "n"))


@query("""WITH c AS (SELECT CASE c_custkey % 6 WHEN 0 THEN 'EL' WHEN 1 THEN 'UK' || (c_custkey % 7) WHEN 2 THEN 'FRZ' WHEN 3 THEN 'de11' WHEN 4 THEN 'DE' || (c_custkey % 1000 + 1000) ELSE 'FR1' || (c_custkey % 9) END AS code,
    CASE c_custkey % 3 WHEN 0 THEN '2020-01-0' || (c_custkey % 9 + 1) WHEN 1 THEN 'soon' END AS sent, CASE WHEN c_custkey % 2 = 0 THEN '05/06/2021' END AS published FROM customer),
  v AS (SELECT *, regexp_matches(code, '^[A-Z]{2}[A-Z0-9]{0,3}$') AS ok FROM c)
  SELECT code, CASE WHEN ok THEN CASE substr(code, 1, 2) WHEN 'EL' THEN 'GR' WHEN 'UK' THEN 'GB' ELSE substr(code, 1, 2) END END AS country, ok AND NOT regexp_matches(code, '^[A-Z]{2}Z+$') AS valid, ok AND length(code) = 4 AS level2,
    CASE WHEN sent LIKE '2020%' THEN sent WHEN published IS NOT NULL THEN '2021-06-05' END AS day, CASE WHEN sent LIKE '2020%' THEN 'sent' WHEN published IS NOT NULL THEN 'published' END AS source, count(*) AS n FROM v GROUP BY ALL""")
def tagged_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Region codes of several kinds with their country and validity, and the first date that can be read with where it is from."""
    from tallyfold.functions import identifiers as I

    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    code = F.when(k % 6 == 0, "EL").when(k % 6 == 1, F.concat(F.lit("UK"), text(k % 7))).when(k % 6 == 2, "FRZ").when(k % 6 == 3, "de11").when(k % 6 == 4, F.concat(F.lit("DE"), text(k % 1000 + 1000))).otherwise(F.concat(F.lit("FR1"), text(k % 9)))
    rows = table(spark, sf, "customer").select(code.alias("code"), F.when(k % 3 == 0, F.concat(F.lit("2020-01-0"), text(k % 9 + 1))).when(k % 3 == 1, "soon").alias("sent"), F.when(k % 2 == 0, "05/06/2021").alias("published"))
    found = I.first_date(("sent", F.col("sent")), ("published", F.col("published")))
    out = rows.select("code", I.region_country(F.col("code")).alias("country"), I.valid_region(F.col("code")).alias("valid"), I.valid_region(F.col("code"), 2).alias("level2"), found["date"].cast("string").alias("day"), found["source"].alias("source"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT DISTINCT c_custkey AS company, c_custkey % 90 AS lei, CASE c_custkey % 4 WHEN 0 THEN 'T' || (c_custkey % 90) || '.L' WHEN 1 THEN 'X' || c_custkey || '.DE' WHEN 2 THEN 'T' || (c_custkey % 90) ELSE 'Y' || c_custkey END AS ticker FROM customer),
  c AS (SELECT s_suppkey % 70 AS lei, CASE WHEN s_suppkey % 3 = 0 THEN 'U' || s_suppkey ELSE 'T' || (s_suppkey % 70) END AS ticker, ['LN', 'GY', 'DE', ''][s_suppkey % 4 + 1] AS exchange, s_suppkey AS place FROM supplier WHERE s_suppkey <= 90),
  a AS (SELECT CASE exchange WHEN 'LN' THEN 'L' WHEN 'GY' THEN 'DE' ELSE exchange END AS alias, * FROM c),
  m AS (SELECT s.company, s.ticker, min_by(a.ticker, place) FILTER (a.ticker = split_part(s.ticker, '.', 1)) AS symbol, min_by(a.ticker, place) FILTER (contains(s.ticker, '.') AND exchange <> '' AND split_part(s.ticker, '.', 2) IN (exchange, alias)) AS venue, CASE WHEN count(*) = 1 THEN min(a.ticker) END AS sole
    FROM s JOIN a USING (lei) WHERE (lei, s.ticker) NOT IN (SELECT (lei, ticker) FROM c) GROUP BY ALL)
  SELECT company, ticker, coalesce(symbol, venue, sole) AS replacement, CASE WHEN symbol IS NOT NULL THEN 'symbol' WHEN venue IS NOT NULL THEN 'venue' ELSE 'sole' END AS tier FROM m WHERE coalesce(symbol, venue, sole) IS NOT NULL""")
def retired_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with tickers of several makes against suppliers' as canonical listings."""
    from tallyfold.operators import matching

    k, n = F.col("c_custkey"), F.col("s_suppkey")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    ticker = F.when(k % 4 == 0, text("T", k % 90, ".L")).when(k % 4 == 1, text("X", k, ".DE")).when(k % 4 == 2, text("T", k % 90)).otherwise(text("Y", k))
    suspects = table(spark, sf, "customer").select(k.alias("company"), (k % 90).alias("lei"), ticker.alias("ticker"))
    canonical = table(spark, sf, "supplier").filter("s_suppkey <= 90").select((n % 70).alias("lei"), F.when(n % 3 == 0, text("U", n)).otherwise(text("T", n % 70)).alias("ticker"), F.element_at(F.array(*map(F.lit, ("LN", "GY", "DE", ""))), (n % 4 + 1).cast("int")).alias("exchange"), n.alias("place"))
    return matching.retirements(suspects, canonical)


@query("""SELECT lpad(c_custkey::VARCHAR, 20, 'A') AS lei, c_name AS name, CASE c_nationkey % 2 WHEN 0 THEN 'AAA' ELSE 'B1' END AS country, (c_custkey % 700)::VARCHAR AS postal_code, CASE WHEN c_custkey % 3 = 0 THEN 'F1' WHEN c_custkey % 3 = 1 THEN 'other form' END AS legal_form, c_custkey % 4 > 0 AS active, 'GENERAL' AS entity_kind,
  'N' || c_custkey AS registered_as, c_mktsegment AS jurisdiction, 'ISSUED' AS registration_status, 'City ' || c_nationkey AS city, 'AAA' AS hq_country, CASE WHEN c_custkey % 2 = 0 THEN 'alias ' || c_custkey || ',second' END AS aliases FROM customer""")
def read_entity_records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as whole LEI records and read back."""
    from tallyfold.sources import readers

    k, path = F.col("c_custkey"), scratch(spark, "lei")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    legal = F.struct(F.lit(" ").alias("FirstAddressLine"), text("City ", F.col("c_nationkey")).alias("City"), F.when(F.col("c_nationkey") % 2 == 0, "a1").otherwise("B1").alias("Country"), (k % 700).cast("string").alias("PostalCode"))
    entity = F.struct(
        F.col("c_name").alias("LegalName"), F.when(k % 2 == 0, F.struct(F.array(text(" alias ", k), F.lit("second"), F.lit(" ")).alias("OtherEntityName"))).alias("OtherEntityNames"), legal.alias("LegalAddress"), F.struct(F.lit("A1").alias("Country")).alias("HeadquartersAddress"),
        F.struct(text("N", k).alias("RegistrationAuthorityEntityID")).alias("RegistrationAuthority"), F.col("c_mktsegment").alias("LegalJurisdiction"), F.lit("GENERAL").alias("EntityCategory"),
        F.struct(F.when(k % 3 == 0, "F1").alias("EntityLegalFormCode"), F.when(k % 3 == 1, "other form").alias("OtherLegalForm")).alias("LegalForm"), F.when(k % 4 > 0, "ACTIVE").otherwise("INACTIVE").alias("EntityStatus"))
    rows = table(spark, sf, "customer").select(F.lpad(k.cast("string"), 20, "A").alias("LEI"), entity.alias("Entity"), F.struct(F.lit("ISSUED").alias("RegistrationStatus")).alias("Registration"))
    got = readers.legal_entity_records_xml(spark, _xml(rows, path, "LEIRecord"), spark.createDataFrame([("A1", "AAA")], "alpha2 string, alpha3 string"))
    return got.select("lei", "name", "country", "postal_code", "legal_form", "active", "entity_kind", "registered_as", "jurisdiction", "registration_status", "city", "hq_country", F.array_join("aliases", ",").alias("aliases"))


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INT % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"

#: The query is an older one; this is its SQL.
ORACLE_SQL["resolve_cascade"] = f"""WITH w AS (SELECT s_suppkey AS id, s_acctbal AS tax, upper(trim(replace(s_name, 'Supplier#', 'Customer#'))) AS name, s_nationkey AS country FROM supplier),
  k AS (SELECT c_custkey AS entity, c_acctbal AS tax, upper(trim(c_name)) AS name, c_nationkey AS country FROM customer),
  t AS (SELECT w.*, (SELECT min(entity) FROM k WHERE k.tax = w.tax) AS by_tax, (SELECT min(entity) FROM k WHERE k.name = w.name AND k.country = w.country) AS by_name FROM w),
  f AS (SELECT t.id, count(DISTINCT k.entity) AS n, min(k.entity) AS entity FROM t JOIN k ON k.country = t.country AND 1 - levenshtein(k.name, t.name) / greatest(length(k.name), length(t.name))::DOUBLE >= 0.9 WHERE by_tax IS NULL AND by_name IS NULL GROUP BY 1),
  h AS (SELECT id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || (country || ':' || name)::BLOB) AS h FROM t)
  SELECT id, coalesce(by_tax::VARCHAR, by_name::VARCHAR, CASE WHEN f.n = 1 THEN f.entity::VARCHAR END, {_UUID}) AS entity, CASE WHEN by_tax IS NOT NULL THEN 'tax' WHEN by_name IS NOT NULL THEN 'name' WHEN f.n = 1 THEN 'fuzzy' ELSE 'minted' END AS tier
  FROM t JOIN h USING (id) LEFT JOIN f USING (id)"""
