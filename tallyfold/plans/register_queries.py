"""Named queries on matching, states, panels, codes and paging; each with its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import identifiers as I
from tallyfold.functions import scalars as S
from tallyfold.operators import folding, graph, matching, panels, procurement, quality
from tallyfold.plans import oracles as O
from tallyfold.plans.queries import _trade_edges
from tallyfold.plans.views import filings, lines, notices, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT 'customer' AS kind, count(*) AS n, count(*) FILTER (c_acctbal >= 0) AS active, count(*) FILTER (c_acctbal < 0) AS inactive,
    floor(count(CASE WHEN c_nationkey < 20 THEN 1 END) / greatest(count(*), 1)::DOUBLE * 100 * 10 + 0.5) / 10 AS code_pct FROM customer
  UNION ALL SELECT 'supplier', count(*), count(*) FILTER (s_acctbal >= 0), count(*) FILTER (s_acctbal < 0), floor(count(CASE WHEN s_nationkey < 20 THEN 1 END) / greatest(count(*), 1)::DOUBLE * 100 * 10 + 0.5) / 10 FROM supplier""")
def registry_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as registered entities; a balance of 0 or more is active, nations under 20 have a code."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    as_node = lambda d, kind, p: d.select(F.lit(kind).alias("kind"), (F.col(f"{p}_acctbal") >= 0).alias("active"), F.when(F.col(f"{p}_nationkey") < 20, F.col(f"{p}_nationkey")).alias("code"))
    return panels.registry_stats(as_node(c, "customer", "c").unionByName(as_node(s, "supplier", "s")))


@query(f"""WITH {O.FILINGS} SELECT year, count(*) AS filings, count(DISTINCT company) AS companies, floor(count(revenue) / greatest(count(*), 1)::DOUBLE * 100 * 10 + 0.5) / 10 AS revenue_pct,
    floor(count(cash) / greatest(count(*), 1)::DOUBLE * 100 * 10 + 0.5) / 10 AS cash_pct FROM filings WHERE year BETWEEN 1990 AND 2030 GROUP BY year""")
def filing_stats(spark: SparkSession, sf: str) -> DataFrame:
    return panels.filing_stats(filings(spark, sf), ["revenue", "cash"])


@query("""WITH p AS (SELECT event_type AS graph, props->>'$.k' AS predicate, count(*) AS n FROM events GROUP BY ALL)
  SELECT *, row_number() OVER (PARTITION BY graph ORDER BY n DESC, predicate) AS place FROM p QUALIFY place <= 5""")
def triple_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Event types as graphs, the key in props as predicate: the five most frequent ones each."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("graph"), F.get_json_object("props", "$.k").alias("predicate"))
    return panels.profile(e, 5, "predicate")


@query("""WITH a AS (SELECT l_orderkey AS work, l_linenumber AS expression, l_partkey AS manifestation, o_orderdate::DATE AS day, CASE WHEN o_orderstatus <> 'P' THEN 1 END AS link FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  r AS (SELECT 'decade' AS span, (year(day) // 10 * 10) || 's' AS label, * FROM a UNION ALL SELECT 'year', year(day)::VARCHAR, * FROM a WHERE year(day) >= 1996)
  SELECT span, label, count(DISTINCT work) AS works, count(DISTINCT (work, expression)) AS expressions, count(DISTINCT (work, manifestation)) AS manifestations,
    floor(count(DISTINCT CASE WHEN link = 1 THEN work END) / greatest(count(DISTINCT work), 1)::DOUBLE * 100 * 10 + 0.5) / 10 AS link_pct, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day FROM r GROUP BY ALL""")
def acts_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as works, their lines as expressions, parts as manifestations."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    acts = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("l_orderkey").alias("work"), F.col("l_linenumber").alias("expression"), F.col("l_partkey").alias("manifestation"),
                                                            F.to_date("o_orderdate").alias("day"), F.when(F.col("o_orderstatus") != "P", 1).alias("link"))
    return panels.acts_coverage(acts, 1996)


@query("""WITH u AS (SELECT conv_id AS item, CASE WHEN role = 'assistant' THEN 'answer' ELSE 'request' END AS kind, CASE WHEN role = 'assistant' THEN 0 ELSE coalesce(length(text), 0) END AS i, CASE WHEN role = 'assistant' THEN coalesce(length(text), 0) ELSE 0 END AS o FROM conversations),
  s AS (SELECT kind, count(DISTINCT item) AS items, sum(i)::BIGINT AS tokens_in, sum(o)::BIGINT AS tokens_out FROM u GROUP BY kind)
  SELECT kind, items, tokens_in, tokens_out, floor((tokens_in * 0.5::DOUBLE + tokens_out * 1.5::DOUBLE) / 1000000 * 1000000.0::DOUBLE + 0.5) / 1000000.0::DOUBLE AS cost,
    floor((tokens_in * 0.5::DOUBLE + tokens_out * 1.5::DOUBLE) / 1000000 / greatest(items, 1) * 100000000.0::DOUBLE + 0.5) / 100000000.0::DOUBLE AS per_item FROM s""")
def token_costs(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as usage, characters standing for tokens."""
    answer, size = F.col("role").eqNullSafe("assistant"), F.coalesce(F.length("text"), F.lit(0))
    u = table(spark, sf, "conversations").select(F.col("conv_id").alias("item"), F.when(answer, "answer").otherwise("request").alias("kind"), F.when(answer, 0).otherwise(size).alias("tokens_in"), F.when(answer, size).otherwise(0).alias("tokens_out"))
    return panels.token_costs(u, "kind", price_in=0.5, price_out=1.5)


@query("""WITH s AS (SELECT user_id, event_type FROM events GROUP BY ALL), l AS (SELECT user_id, max(ts) AS synced FROM events WHERE event_type = 'signup' GROUP BY 1), n AS (SELECT max(ts) AS now FROM events)
  SELECT event_type AS theme, count(*) AS n, count(*) FILTER (synced >= now - INTERVAL 8 DAY) AS fresh, count(*) FILTER (synced < now - INTERVAL 8 DAY) AS stale, count(*) FILTER (synced IS NULL) AS never FROM s LEFT JOIN l USING (user_id), n GROUP BY 1""")
def freshness_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Users per event type and how long ago they signed up, judged at the newest event."""
    e = table(spark, sf, "events")
    last = e.filter("event_type = 'signup'").groupBy("user_id").agg(F.max("ts").alias("synced"))
    sets = e.select("user_id", F.col("event_type").alias("theme")).distinct().join(last, "user_id", "left")
    now = e.agg(F.max("ts")).scalar()
    return panels.freshness(sets, now)


@query("""WITH b AS (SELECT o_orderstatus AS status, o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS place FROM orders WHERE o_totalprice < 20000)
  SELECT status, count(*) AS n, string_agg(o_orderkey || ':' || o_custkey, ', ' ORDER BY o_orderkey) FILTER (place <= 20) AS detail FROM b GROUP BY 1""")
def check_details(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a suspiciously small value: their number and the first twenty per status."""
    o = table(spark, sf, "orders").filter("o_totalprice < 20000").withColumnRenamed("o_orderstatus", "status")
    return panels.details(o, "status", "o_orderkey", F.concat_ws(":", "o_orderkey", "o_custkey"))


@query("""SELECT o_orderstatus AS status, o_orderkey, o_orderkey || ':' || o_custkey AS label, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders WHERE o_totalprice < 20000""")
def check_offenders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders that check_details counts, one row each."""
    o = table(spark, sf, "orders").filter("o_totalprice < 20000").withColumnRenamed("o_orderstatus", "status")
    return panels.offenders(o, "status", "o_orderkey", F.concat_ws(":", "o_orderkey", "o_custkey"))


@query("""WITH w AS (SELECT DISTINCT ON (l_orderkey, l_linenumber, l_suppkey) l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS value, l_partkey FROM lineitem WHERE l_returnflag <> 'R' ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice),
  l AS (SELECT l_orderkey, l_linenumber, count(*) AS parties, sum(value) AS payable, min_by(value, (l_partkey, value, l_suppkey)) AS estimate FROM w GROUP BY ALL)
  SELECT l_orderkey AS notice_id, sum(parties)::BIGINT AS parties, floor(sum(estimate) * 100 + 0.5) / 100 AS estimate, CASE WHEN sum(parties) = 1 THEN max(o_totalprice) END AS total, floor(sum(payable) * 100 + 0.5) / 100 AS payable FROM l JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def winner_values(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as notices, line numbers as lots, suppliers as parties; returned lines are losing bids."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    a = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("l_orderkey").alias("notice_id"), F.struct("l_partkey", "l_extendedprice", "l_suppkey").alias("place"), (F.col("l_returnflag") != "R").alias("is_winner"), F.col("l_linenumber").alias("lot"),
                                                         F.lit(None).cast("long").alias("party"), F.col("l_suppkey").alias("contractor"), F.col("l_extendedprice").alias("value"), F.col("l_extendedprice").alias("lot_estimate"), F.col("o_totalprice").alias("notice_total"))
    return panels.winner_values(a).withColumns({"estimate": S.rounded("estimate", 2), "payable": S.rounded("payable", 2)})


@query("""WITH c AS (SELECT ['EUR', 'PLN', 'HUF', 'SEK', 'XXX'][c_nationkey % 5 + 1] AS currency, o_orderdate::DATE AS day, o_totalprice AS amount FROM orders JOIN customer ON o_custkey = c_custkey),
  r AS (SELECT ['PLN', 'HUF', 'SEK'][l_linenumber % 3 + 1] AS currency, l_shipdate::DATE AS day, min(1 + l_tax * 10) AS per_euro FROM lineitem WHERE l_discount >= 0.09 GROUP BY ALL)
  SELECT currency, count(*) AS n, count(eur) AS converted, floor(sum(eur) + 0.5) AS eur FROM (SELECT c.currency, CASE WHEN c.currency = 'EUR' THEN amount ELSE amount / per_euro END AS eur FROM c ASOF LEFT JOIN r ON c.currency = r.currency AND c.day >= r.day) GROUP BY 1""")
def fx_to_euro(spark: SparkSession, sf: str) -> DataFrame:
    """Order values in their customer's currency at the newest rate; rates come from the tax of much discounted lines."""
    o, c, li = table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "lineitem")
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    a = o.join(c, o.o_custkey == c.c_custkey).select(pick(["EUR", "PLN", "HUF", "SEK", "XXX"], F.col("c_nationkey") % 5).alias("currency"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"))
    r = li.filter("l_discount >= 0.09").select(pick(["PLN", "HUF", "SEK"], F.col("l_linenumber") % 3).alias("currency"), F.to_date("l_shipdate").alias("day"), (1 + F.col("l_tax") * 10).alias("per_euro"))
    return panels.to_euro(a, r).groupBy("currency").agg(F.count("*").alias("n"), F.count("eur").alias("converted"), S.rounded(F.sum("eur"), 0).alias("eur"))


@query(f"""WITH {O.FILINGS}, g AS (SELECT company, year, revenue, lag(revenue) OVER (PARTITION BY company ORDER BY year) AS b FROM filings)
  SELECT company, year, floor((CASE WHEN b <> 0 THEN (revenue - b) / abs(b) * 100 END) * 10000.0::DOUBLE + 0.5) / 10000.0::DOUBLE AS growth FROM g""")
def revenue_growth(spark: SparkSession, sf: str) -> DataFrame:
    return panels.growth(filings(spark, sf), "company", "revenue").select("company", "year", S.rounded("growth", 4).alias("growth"))


@query("""SELECT o_custkey, count(*) AS orders, min(o_orderdate)::DATE::VARCHAR AS first_day, max(o_orderdate)::DATE::VARCHAR AS last_day FROM orders GROUP BY 1""")
def entity_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.to_date(F.min("o_orderdate")).cast("string").alias("first_day"), F.to_date(F.max("o_orderdate")).cast("string").alias("last_day"))


@query("""WITH u AS (SELECT user_id, max(ts) AS last, bool_or(event_type = 'error') AS bad FROM events GROUP BY 1), n AS (SELECT max(ts) AS now FROM events)
  SELECT count(*) AS backlog, count(*) FILTER (bad) AS tombstones, count(*) FILTER (NOT bad) AS refetch, floor(max(epoch_us(now) - epoch_us(last)) / 1000000)::BIGINT AS lag_seconds FROM u, n""")
def backlog_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """Users as waiting entities; those with an error are to be removed, others fetched again."""
    u = table(spark, sf, "events").groupBy("user_id").agg(F.unix_micros(F.max("ts").cast("timestamp")).alias("last"), F.bool_or(F.col("event_type") == "error").alias("bad"))
    return u.agg(F.count("*").alias("backlog"), F.count_if("bad").alias("tombstones"), F.count_if(~F.col("bad")).alias("refetch"), F.floor((F.max("last") - F.min("last")) / 1_000_000).cast("long").alias("lag_seconds"))


@query("""WITH p AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) <= 1998),
  i AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE year(o_orderdate) >= 1998),
  u AS (SELECT *, 0 AS new FROM p UNION ALL SELECT *, 1 FROM i), m AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY new DESC) = 1)
  SELECT o_orderstatus, count(*) AS n, floor(sum(o_totalprice) + 0.5) AS value FROM m GROUP BY 1""")
def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders up to 1998 as stored, those from 1998 coming in anew."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("y"))
    new = o.filter("y >= 1998").withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}).drop("y")
    return folding.upsert(o.filter("y <= 1998").drop("y"), new, ["o_orderkey"]).groupBy("o_orderstatus").agg(F.count("*").alias("n"), S.rounded(F.sum("o_totalprice"), 0).alias("value"))


@query("""WITH b AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1), a AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1)
  SELECT CASE WHEN b.o_custkey IS NULL THEN 'insert' WHEN a.o_custkey IS NULL THEN 'delete' ELSE 'update' END AS change, count(*) AS n FROM b FULL JOIN a ON a.o_custkey = b.o_custkey WHERE a.v IS DISTINCT FROM b.v GROUP BY 1""")
def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Two years' customer values as snapshots."""
    o = table(spark, sf, "orders")
    year = lambda y: o.filter(F.year("o_orderdate") == y).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return folding.snapshot_changes(year(1997), year(1998), "o_custkey").groupBy("change").agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT max(ts) AS now FROM events) SELECT event_type, count(*) AS n, count(*) FILTER (coalesce(value > 90 AND event_id % 7 < 5 AND (event_type <> 'error' OR ts < now - INTERVAL 15 MINUTE), false)) AS claimable FROM events, m GROUP BY 1""")
def claimable_work(spark: SparkSession, sf: str) -> DataFrame:
    """Events as lookups: errors are held by a worker since their time, values up to 90 have an answer, the key gives the attempts."""
    e = table(spark, sf, "events")
    now = e.agg(F.max("ts")).scalar()
    state = F.when(F.col("event_type") == "error", "in_progress").when(F.col("event_type") == "view", "pending")
    open_ = folding.claimable(state, F.col("ts"), F.col("event_id") % 7, F.when(~(F.col("value") > 90), F.col("value")), now)
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(open_ & F.col("value").isNotNull()).alias("claimable"))


@query("""SELECT s_name AS name, replace(trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g')), ' ', '|') AS words,
    CASE WHEN s_nationkey < 10 THEN 'C(2024)' || s_suppkey END AS document, CASE WHEN s_suppkey = floor(s_suppkey) THEN s_suppkey::VARCHAR END AS shown, s_suppkey * 3600 AS seconds FROM supplier""")
def supplier_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Names, document numbers and durations written from suppliers, parsed back."""
    key = F.col("s_suppkey").cast("string")
    number = F.when(F.col("s_nationkey") < 10, F.concat(F.lit("C_2024_"), F.lpad(key, 9, "0"))).otherwise(F.concat(F.lit("C-2024-"), key))
    return table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.array_join(F.split(I.normal_text(F.col("s_name")), " "), "|").alias("words"), I.document_number(number).alias("document"),
                                               I.shown_number(F.col("s_suppkey").cast("double")).alias("shown"), I.duration_seconds(F.concat(key, F.lit("h"))).alias("seconds"))


@query("""WITH d AS (SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS t FROM documents), b AS (SELECT item_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS t FROM benchmark)
  SELECT item_id, doc_id FROM b JOIN d ON contains(d.t, b.t) WHERE b.t <> ''""")
def contained_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark passages that are part of a document, both in normal form."""
    b, d = table(spark, sf, "benchmark"), table(spark, sf, "documents")
    return matching.contained(b.select(F.col("item_id").alias("n_id"), "text"), d.select(F.col("doc_id").alias("h_id"), "text")).select(F.col("n_id").alias("item_id"), F.col("h_id").alias("doc_id"))


@query("""WITH n AS (SELECT c_custkey AS id, c_nationkey AS country, unnest([replace(c_name, 'Customer', 'Firm'), replace(c_name, 'Customer', 'Supplier')]) AS name, unnest([0, 1]) AS place FROM customer),
  m AS (SELECT id, s_suppkey AS entity, name, place FROM n JOIN supplier ON s_name = name AND s_nationkey = country) SELECT id, entity, name, place FROM m""")
def sanctioned_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Customers under two names each against suppliers of the same nation."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    names = F.array(F.replace("c_name", F.lit("Customer"), F.lit("Firm")), F.replace("c_name", F.lit("Customer"), F.lit("Supplier")))
    return matching.first_alias(c.select(F.col("c_custkey").alias("id"), names.alias("names"), F.col("c_nationkey").alias("country")), s.select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("country")))


@query("""WITH e AS (SELECT c_custkey AS entity, c_mktsegment AS key, c_nationkey AS country, CASE WHEN c_acctbal > 9900 THEN c_custkey END AS lei, CASE WHEN c_acctbal < 0 THEN '0' ELSE (c_custkey % 3 + 100)::VARCHAR END AS vat FROM customer),
  v AS (SELECT *, CASE WHEN vat <> '0' THEN vat END AS clean FROM e), k AS (SELECT key, country, min_by(entity, entity) AS kept, arg_min_null(clean, entity) AS kvat FROM v WHERE lei IS NOT NULL GROUP BY ALL)
  SELECT CASE WHEN coalesce(kvat <> clean, false) THEN 'same_as' ELSE 'merge' END AS decision, count(*) AS n, count(DISTINCT kept) AS kept FROM k JOIN v USING (key, country) WHERE lei IS NULL GROUP BY 1""")
def duplicate_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of a segment and nation as bearers of one name; the rich ones have an LEI."""
    e = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("country"), F.when(F.col("c_acctbal") > 9900, F.col("c_custkey")).alias("lei"),
                                            F.when(F.col("c_acctbal") < 0, "0").otherwise((F.col("c_custkey") % 3 + 100).cast("string")).alias("vat"))
    return matching.duplicate_decisions(e).groupBy("decision").agg(F.count("*").alias("n"), F.count_distinct("kept").alias("kept"))


@query(f"""WITH {O.EDGES}, m AS (SELECT CASE WHEN starts_with(src, 'c') THEN 'c' || (substr(src, 2)::BIGINT // 10) ELSE src END AS src, dst FROM edges)
  SELECT src, count(DISTINCT dst) AS partners FROM m GROUP BY 1""")
def merged_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers merged by tens: their suppliers."""
    c = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("node"), F.concat(F.lit("c"), F.expr("c_custkey div 10")).alias("canonical"))
    return graph.merge_nodes(_trade_edges(spark, sf), c, lines(spark, sf)).groupBy("src").agg(F.count("*").alias("partners"))


@query("""WITH n AS (SELECT 0 AS tier, s_name AS name, s_acctbal AS v FROM supplier WHERE s_acctbal > 5000 UNION ALL SELECT 1, s_name, s_acctbal FROM supplier UNION ALL SELECT 2, c_name, c_acctbal FROM customer)
  SELECT name, tier, v FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY name ORDER BY tier, v DESC, name) = 1) ORDER BY tier, v DESC, name LIMIT 50""")
def waterfall_search(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty names: rich suppliers, then other suppliers, then customers."""
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("v"))
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("v"))
    return matching.waterfall([s.filter("v > 5000"), s, c], "name", 50, F.desc("v"), "name")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders) ORDER BY o_orderkey LIMIT 100""")
def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    """The hundred orders after the key that is half the greatest."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    after = o.agg(F.expr("max(o_orderkey) div 2")).scalar()
    return o.filter(F.col("o_orderkey") > after).orderBy("o_orderkey").limit(100)


@query(f"""WITH {O.NOTICES}, y AS (SELECT nation, year(pub_date) AS year, count(*) AS n, count(bidders) AS with_bidders FROM notices GROUP BY ALL)
  SELECT nation, count(*) AS years, count(*) FILTER (n >= 20 AND with_bidders = 0) AS empty_years, max(year) AS newest FROM y GROUP BY 1""")
def era_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Years with enough notices but no bidders at all, per nation."""
    y = notices(spark, sf).groupBy("nation", F.year("pub_date").alias("year")).agg(F.count("*").alias("n"), F.count("bidders").alias("with_bidders"))
    return y.groupBy("nation").agg(F.count("*").alias("years"), F.count_if((F.col("n") >= 20) & (F.col("with_bidders") == 0)).alias("empty_years"), F.max("year").alias("newest"))


@query(f"""WITH {O.CONTRACTS}, t AS (SELECT c_custkey AS node, [c_custkey, c_custkey // 2, c_custkey // 4] AS up FROM customer),
  a AS (SELECT DISTINCT node, unnest(up) AS ancestor FROM t), k AS (SELECT authority, count(*) FILTER (is_current) AS contracts FROM contracts GROUP BY 1)
  SELECT ancestor, count(*) AS members, coalesce(sum(contracts), 0)::BIGINT AS contracts FROM a LEFT JOIN k ON node = authority GROUP BY 1""")
def group_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Current contracts of group trees two levels deep (the parent of customer k is k div 2)."""
    c = table(spark, sf, "customer")
    tree = graph.ancestors(c.select(F.col("c_custkey").alias("node"), F.expr("c_custkey div 2").alias("parent")), 2)
    counts = procurement.totals(procurement.collapse_modifications(notices(spark, sf)), "authority").select("authority", "contracts")
    return tree.join(counts, F.col("node") == F.col("authority"), "left").groupBy("ancestor").agg(F.count("*").alias("members"), F.coalesce(F.sum("contracts"), F.lit(0)).alias("contracts"))


@query("""SELECT p_brand AS venue, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20""")
def common_venues(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("venue")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "venue").limit(20)


@query(f"""WITH {O.CONTRACTS}, {O.FILINGS.strip()},
  m AS (
    SELECT 'one_current_notice' AS assertion, 'block' AS severity, count(*) FILTER (n <> 1) AS value, count(*) AS total, count(*) FILTER (n <> 1) = 0 AS ok FROM (SELECT count(*) FILTER (is_current) AS n FROM contracts GROUP BY contract_key)
    UNION ALL SELECT 'awards_before_changes', 'warn', count(*) FILTER (a IS NULL), count(*), count(*) FILTER (a IS NULL) <= 10 FROM (SELECT min(pub_date) FILTER (notice_type <> 'can-modif') AS a FROM contracts GROUP BY contract_key HAVING count(*) FILTER (notice_type = 'can-modif') > 0)
    UNION ALL SELECT 'filing_years', 'block', count(*) FILTER (year NOT BETWEEN 1990 AND 2030), count(*), count(*) FILTER (year NOT BETWEEN 1990 AND 2030) = 0 FROM filings
    UNION ALL SELECT 'filings_unique', 'block', count(*) FILTER (n > 1), sum(n), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM filings GROUP BY company, year)
    UNION ALL SELECT 'equity_positive', 'warn', count(*) FILTER (equity <= 0), count(*), count(*) FILTER (equity <= 0) = 0 FROM filings
    UNION ALL SELECT 'cash_reported', 'warn', count(cash), count(*), count(cash) >= 0.95 * count(*) FROM filings
    UNION ALL SELECT 'bidders_reported', 'block', count(bidders), count(*), count(bidders) >= 0.5 * count(*) FROM notices
    UNION ALL SELECT 'single_bidder_band', 'warn', count(*) FILTER (bidders = 1), count(*), count(*) < 100 OR count(*) FILTER (bidders = 1) BETWEEN 0.05 * count(*) AND 0.6 * count(*) FROM notices
    UNION ALL SELECT 'urls_have_scheme', 'warn', count(*) FILTER (contains(url, '://')), count(*), count(*) FILTER (contains(url, '://')) >= 0.9 * count(*) FROM pages
    UNION ALL SELECT 'labels_have_documents', 'block', count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM documents)), count(*), count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM documents)) = 0 FROM labels)
  SELECT assertion, severity, value::BIGINT AS value, total::BIGINT AS total, CASE WHEN ok THEN 'pass' WHEN severity = 'block' THEN 'fail' ELSE 'warn' END AS status FROM m""")
def assertions_registers(spark: SparkSession, sf: str) -> DataFrame:
    """Checks on contracts, filings, notices, pages and labels."""
    n, f = notices(spark, sf), filings(spark, sf)
    contracts = procurement.collapse_modifications(n)
    pages, labels, documents = (table(spark, sf, t) for t in ("pages", "labels", "documents"))
    modif = F.col("notice_type") == "can-modif"
    per = contracts.groupBy("contract_key").agg(F.count_if("is_current").alias("current"), F.count_if(modif).alias("changes"), F.min(F.when(~modif, F.col("pub_date"))).alias("award"))
    A, bad = quality.Assertion, quality.violations
    return quality.report([
        A("one_current_notice", "block", lambda: bad(per, F.col("current") != 1), quality.zero()),
        A("awards_before_changes", "warn", lambda: bad(per.filter("changes > 0"), F.col("award").isNull()), quality.at_most(10)),
        A("filing_years", "block", lambda: bad(f, ~F.col("year").between(1990, 2030)), quality.zero()),
        A("filings_unique", "block", lambda: quality.repeated_keys(f, "company", "year"), quality.zero()),
        A("equity_positive", "warn", lambda: bad(f, F.col("equity") <= 0), quality.zero()),
        A("cash_reported", "warn", lambda: bad(f, F.col("cash").isNotNull()), quality.coverage(0.95)),
        A("bidders_reported", "block", lambda: bad(n, F.col("bidders").isNotNull()), quality.coverage(0.5)),
        A("single_bidder_band", "warn", lambda: bad(n, F.col("bidders") == 1), quality.band(0.05, 0.6, 100)),
        A("urls_have_scheme", "warn", lambda: bad(pages, F.col("url").contains("://")), quality.coverage(0.9)),
        A("labels_have_documents", "block", lambda: quality.orphans(labels, documents, "doc_id", "doc_id"), quality.zero()),
    ])
