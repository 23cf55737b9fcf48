"""Named queries over a folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.operators import finance, graph, procurement, quality, resolve, search, stats, text_index
from tallyfold.plans import adhoc
from tallyfold.plans.views import filings, lines, notices, observations, prices, regions, scratch, table
from tallyfold.sources.scratch import dealt, kept
from tallyfold.streaming import dirty_set

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _contracts(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.collapse_modifications(notices(spark, sf))


@query
def sector_summary(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.sector_totals(_contracts(spark, sf))


@query
def collapse_modifications(spark: SparkSession, sf: str) -> DataFrame:
    return _contracts(spark, sf).select("notice_id", "contract_key", S.rounded("current_value", 4).alias("current_value"), "is_current")


@query
def contract_projection(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.project_contracts(_contracts(spark, sf))


@query
def company_totals(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.totals(_contracts(spark, sf), "company")


@query
def authority_totals(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.totals(_contracts(spark, sf), "authority")


@query
def contracts_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.totals(_contracts(spark, sf), "nation")


@query
def top_companies_per_country(spark: SparkSession, sf: str) -> DataFrame:
    best = Window.partitionBy("nation").orderBy(F.desc("total_value"), "company")
    return procurement.totals(dealt(_contracts(spark, sf), lines(spark, sf), "nation", "company"), "nation", "company").filter("total_value > 0").withColumn("place", F.row_number().over(best)).filter("place <= 5")


@query
def trade_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = procurement.totals(dealt(_contracts(spark, sf), lines(spark, sf), "authority", "company"), "authority", "company")
    return pairs.agg(F.count("*").alias("pairs"), S.rounded(F.sum("total_value"), 0).alias("total_eur"), F.sum("contracts").alias("total_contracts"))


@query
def single_bidder_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return procurement.single_bidder_rate(_contracts(spark, sf), "nation", 20)


@query
def bidder_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return notices(spark, sf).groupBy("bidders").agg(F.count("*").alias("n")).select(F.coalesce(F.col("bidders").cast("string"), F.lit("Not disclosed")).alias("bidders"), "n")


@query
def value_confidence(spark: SparkSession, sf: str) -> DataFrame:
    scored = procurement.value_confidence(notices(spark, sf))
    return scored.groupBy("notice_id").agg(F.count("*").alias("n"), S.rounded(F.max("chosen_value"), 4).alias("chosen_value"), S.rounded(F.max("consistency"), 6).alias("consistency"), S.rounded(F.max("plausibility"), 6).alias("plausibility"),
                                           S.rounded(F.max("confidence"), 6).alias("confidence"), F.max("flag").alias("flag"), F.max("low_confidence").alias("low_confidence"), F.max("payable_discrepancy").alias("payable_discrepancy"))


@query
def value_quality_overview(spark: SparkSession, sf: str) -> DataFrame:
    scored = procurement.value_confidence(notices(spark, sf))
    return scored.groupBy("flag").agg(F.count("*").alias("n"), F.count_if("low_confidence").alias("low"), S.rounded(F.sum("chosen_value"), 0).alias("value"))


@query
def scale_normalise(spark: SparkSession, sf: str) -> DataFrame:
    fixed = procurement.normalise_scale(notices(spark, sf).withColumn("total", S.rounded("total", 2)))
    return fixed.groupBy("country", "scale_tier").agg(F.count("*").alias("n"), S.rounded(F.sum("total"), 0).alias("total"), S.rounded(F.sum("estimate"), 0).alias("estimate"), S.rounded(F.sum("payable"), 0).alias("payable"))


@query
def red_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = notices(spark, sf).withColumns({"procedure_type": F.when(F.col("line") == 7, "neg-wo-call").when(F.col("line") > 4, "restricted").otherwise("open"), "criterion": F.when(F.col("part") % 3 == 0, "price").otherwise("quality")})
    flagged = procurement.red_flags(rows)
    return flagged.groupBy("flags").agg(F.count("*").alias("n"), *(F.count_if(f).alias(f) for f in ("single_bidder", "non_open", "no_call", "price_only")))


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    n = notices(spark, sf)
    fields = ["bidders", "total", "division", "pub_date"]
    one = n.agg(F.count("*").alias("rows"), *(F.count_if(F.col(f).isNull()).alias(f) for f in fields))
    return one.select("rows", F.expr("stack(4, " + ", ".join(f"'{f}', {f}" for f in fields) + ") AS (field, missing)"))


@query
def currency_quality(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    code = F.upper(F.regexp_extract("o_orderpriority", r"-([A-Z]{3})", 1))
    return o.groupBy(code.alias("code")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("converted"), F.count_if(code.rlike("^[A-Z]{3}$")).alias("well_formed"))


@query
def contracts_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return notices(spark, sf).groupBy(F.substring(F.col("pub_date").cast("string"), 1, 10).alias("day")).agg(F.count("*").alias("n"))


@query
def value_timeline(spark: SparkSession, sf: str) -> DataFrame:
    c = _contracts(spark, sf).filter("current_value IS NOT NULL")
    return procurement.totals(c, "pub_date").withColumn("pub_date", F.col("pub_date").cast("string"))


@query
def outlier_months(spark: SparkSession, sf: str) -> DataFrame:
    """Months whose mean value is over one and a half times the median of the months."""
    return procurement.outlier_months(notices(spark, sf), 1.5, 30)


@query
def link_modifications(spark: SparkSession, sf: str) -> DataFrame:
    """Each modification with the first award of its contract."""
    n = notices(spark, sf)
    award = n.filter("notice_type <> 'can-modif'").groupBy("contract_key").agg(F.min(F.struct("pub_date", "line", "part", "company", "notice_id")).alias("a"))
    return n.filter("notice_type = 'can-modif'").join(award, "contract_key").select("contract_key", F.col("notice_id").alias("modification"), F.col("a.notice_id").alias("award"))


@query
def modifications_without_award(spark: SparkSession, sf: str) -> DataFrame:
    n = notices(spark, sf)
    return n.filter("notice_type = 'can-modif'").join(n.filter("notice_type <> 'can-modif'"), "contract_key", "left_anti").groupBy("contract_key").agg(F.count("*").alias("n"))


@query
def procurement_only(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    late = table(spark, sf, "lineitem").filter("l_shipdate >= '2001-10-01'")
    return s.join(late, s.s_suppkey == late.l_suppkey, "left_anti").select("s_suppkey", "s_name")


@query
def cross_source_overlap(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    both = o.filter("year(o_orderdate) = 1997").join(o.filter("year(o_orderdate) = 1998"), "o_custkey", "left_semi")
    return both.agg(F.count_distinct("o_custkey").alias("customers"))


@query
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    y = lambda n: o.filter(F.year("o_orderdate") == n).select("o_custkey")
    return y(1997).distinct().join(y(1998), "o_custkey", "left_anti")


@query
def symmetric_diff(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    y = lambda n: o.filter(F.year("o_orderdate") == n).select("o_custkey").distinct()
    gone, new = y(1997).exceptAll(y(1998)), y(1998).exceptAll(y(1997))
    return gone.withColumn("side", F.lit("missing")).unionByName(new.withColumn("side", F.lit("extra")))


@query
def dedup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").withColumn("band", F.floor(F.col("c_acctbal") / 100).cast("long"))
    return resolve.duplicate_pairs(c, "c_custkey", "c_mktsegment", "c_nationkey", "band")


@query
def fundamentals_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return finance.fundamentals(filings(spark, sf))


@query
def fundamentals_avg(spark: SparkSession, sf: str) -> DataFrame:
    return finance.averages(finance.fundamentals(filings(spark, sf)))


@query
def long_screen(spark: SparkSession, sf: str) -> DataFrame:
    return finance.long_screen(finance.averages(finance.fundamentals(filings(spark, sf))))


@query
def valuation(spark: SparkSession, sf: str) -> DataFrame:
    return finance.valuation(filings(spark, sf))


@query
def short_screen(spark: SparkSession, sf: str) -> DataFrame:
    """Limits that suit the given tables' volumes and prices; brands without prices have the empty result."""
    brands = table(spark, sf, "part").select(F.col("p_brand").alias("ticker"))
    return finance.short_screen(prices(spark, sf), brands, volume=50.0, low=900.0, high=1600.0)


@query
def win_probability(spark: SparkSession, sf: str) -> DataFrame:
    return finance.win_probability(finance.recent(prices(spark, sf)))


@query
def vup_vdown_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return finance.monthly_swings(prices(spark, sf))


@query
def mat_43(spark: SparkSession, sf: str) -> DataFrame:
    return finance.moving_average(prices(spark, sf))


@query
def market_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return finance.market_snapshot(prices(spark, sf))


@query
def annual_avg_price(spark: SparkSession, sf: str) -> DataFrame:
    return prices(spark, sf).groupBy("ticker", F.year("date").alias("year")).agg(S.rounded(F.avg("close"), 4).alias("price"))


@query
def slice_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.slice_stats(observations(spark, sf))


@query
def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.dataset_stats(observations(spark, sf))


@query
def level_universe(spark: SparkSession, sf: str) -> DataFrame:
    return stats.level_universe(observations(spark, sf), regions(spark, sf))


@query
def year_availability(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf)
    return stats.year_availability(o, stats.level_universe(o, regions(spark, sf)))


@query
def series(spark: SparkSession, sf: str) -> DataFrame:
    got = stats.series(observations(spark, sf), "1-URGENT", level=2, start=1996, end=1999, dims={"status": "F"})
    return got.select("geo", "year", "slice_key", S.rounded("value", 4).alias("value"))


@query
def bivariate(spark: SparkSession, sf: str) -> DataFrame:
    o = observations(spark, sf).filter("year = 1998 AND slice_key = 'flag=A|status=F'")
    return stats.bivariate(o.filter("dataset = '1-URGENT'"), o.filter("dataset = '5-LOW'"))


@query
def latest_run_per_key(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type", "value"), F.struct("ts", "event_id")).alias("e")).select("user_id", "e.event_id", "e.event_type", "e.value")


@query
def stale_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Users and the hours since their last signup, judged at the table's newest event; those without one stay, as never."""
    e = table(spark, sf, "events")
    now = e.agg(F.max("ts").alias("now"))
    users, last = e.select("user_id").distinct(), e.filter("event_type = 'signup'").groupBy("user_id").agg(F.max("ts").alias("last"))
    age = F.floor((F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))) / 3_600_000_000).cast("long")
    out = users.join(last, "user_id", "left").crossJoin(F.broadcast(now)).withColumn("hours", age)
    return out.select("user_id", "hours", F.when(F.col("last").isNull(), "never").when(F.col("hours") > 48, "stale").otherwise("fresh").alias("state"))


@query
def producer_metrics(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    now = e.agg(F.max("ts").alias("now"))
    return e.crossJoin(F.broadcast(now)).groupBy("event_type").agg(F.count("*").alias("total"), F.count_if(F.col("ts") > F.col("now") - F.expr("INTERVAL 7 DAYS")).alias("last_7d"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("newest"))


@query
def events_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type", F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"), S.rounded(F.sum("value"), 2).alias("value"))


@query
def failing_since(spark: SparkSession, sf: str) -> DataFrame:
    """Per user: the last purchase and the first error after it."""
    e = table(spark, sf, "events")
    # The last purchase is aggregated with partial sums and joined back, so a busy user is no one task's.
    e = e.join(e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("passed")), "user_id")
    bad = (F.col("event_type") == "error") & (F.col("passed").isNull() | (F.col("ts") > F.col("passed")))
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return e.groupBy("user_id").agg(show(F.max("passed")).alias("last_pass"), show(F.min(F.when(bad, F.col("ts")))).alias("failing_since"))


@query
def nuts_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers and their balance per region of both levels; regions without any stay with 0."""
    n, s = table(spark, sf, "nation"), table(spark, sf, "supplier")
    code = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    placed = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "s_acctbal", F.explode(F.array(code, F.substring(code, 1, 2))).alias("code"))
    sums = placed.groupBy("code").agg(F.count_distinct("s_suppkey").alias("companies"), S.rounded(F.sum("s_acctbal"), 2).alias("balance"))
    return regions(spark, sf).join(sums, "code", "left").select("code", F.coalesce("companies", F.lit(0)).alias("companies"), F.coalesce("balance", F.lit(0.0)).alias("balance"))


@query
def entity_by_region(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return procurement.totals(_contracts(spark, sf), "nation").join(n, F.col("nation") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name").agg(S.rounded(F.sum("total_value"), 0).alias("value"), F.sum("contracts").alias("contracts"))


def _trade_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers that met in an order."""
    n = notices(spark, sf).select(F.concat(F.lit("c"), "authority").alias("src"), F.concat(F.lit("s"), "company").alias("dst"))
    return dealt(n, lines(spark, sf), "src").distinct()


def _trade_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """_trade_edges, stored, with repeats and nodes as numbers: customers even, suppliers odd."""
    return kept(notices(spark, sf).select((F.col("authority") * 2).alias("src"), (F.col("company") * 2 + 1).alias("dst")), "edges")


def _supplier(number: str) -> F.Column:
    return F.concat(F.lit("s"), F.shiftright(number, 1)).alias(number)


@query
def khop(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes within two hops of each supplier that met a customer."""
    e = _trade_numbers(spark, sf)
    return graph.khop_sizes(e, e.select(F.col("dst").alias("node")), 2).select(_supplier("seed"), "hops", "nodes")


@query
def shortest_path(spark: SparkSession, sf: str) -> DataFrame:
    """Hops between suppliers next to each other in number."""
    key = F.col("s_suppkey").cast("long") * 2
    pairs = table(spark, sf, "supplier").select((key + 1).alias("src"), (key + 3).alias("dst"))
    return graph.shortest_paths(_trade_numbers(spark, sf), pairs, 4).select(_supplier("src"), _supplier("dst"), "hops")


@query
def group_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in a group tree (the parent of k is k div 2, up to five levels): members per ancestor."""
    c = table(spark, sf, "customer")
    parents = c.select(F.col("c_custkey").alias("node"), F.when(F.col("c_custkey") > 0, F.expr("c_custkey div 2")).alias("parent"))
    return graph.ancestors(parents, 5).groupBy("ancestor", "hops").agg(F.count("*").alias("members"))


@query
def degree_distribution(spark: SparkSession, sf: str) -> DataFrame:
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    nodes = c.select(F.lit("customer").alias("kind"), F.concat(F.lit("c"), "c_custkey").alias("node")).unionByName(s.select(F.lit("supplier").alias("kind"), F.concat(F.lit("s"), "s_suppkey").alias("node")))
    return graph.degrees(_trade_edges(spark, sf), nodes)


@query
def best_replacement(spark: SparkSession, sf: str) -> DataFrame:
    """Per part type the dearest part, large ones first."""
    p = table(spark, sf, "part")
    return resolve.first_choice(p, "p_type", (F.col("p_size") < 25).cast("int"), F.desc("p_retailprice"), "p_partkey").select("p_type", "p_partkey", "p_size")


@query
def resolve_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers against customers: equal balance as tax id, else names."""
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    wanted = s.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").cast("string").alias("tax_id"), F.regexp_replace("s_name", "Supplier#", "Customer#").alias("name"), F.col("s_nationkey").alias("country"))
    known = c.select(F.col("c_custkey").alias("entity"), F.col("c_acctbal").cast("string").alias("tax_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("country"))
    return resolve.cascade(wanted, known)


@query
def lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with all three words, from an index that is written once and read by its words' buckets."""
    path = scratch(spark, "words")
    text_index.write_index(table(spark, sf, "documents"), path, ["text"], "doc_id")
    return text_index.find(spark, path, ["the", "of", "and"], 1).withColumnRenamed("key", "doc_id")


@query
def vector_knn(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    q = e.orderBy("vec_id").select("embedding").first()[0]
    return search.vector(e, q)


@query
def hybrid_rrf(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    q = e.orderBy("vec_id").select("embedding").first()[0]
    return search.fuse(search.lexical(table(spark, sf, "documents"), ["the", "of", "and"]), search.vector(e, q, key="vec_id").withColumnRenamed("vec_id", "doc_id"), "doc_id")


@query
def unified_search(spark: SparkSession, sf: str) -> DataFrame:
    c, s, p = (table(spark, sf, t) for t in ("customer", "supplier", "part"))
    names = s.select(F.lit(1).alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).unionByName(c.select(F.lit(2).alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name")))
    return search.tiered(names.unionByName(p.select(F.lit(3).alias("kind"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))), "er#00000001")


@query
def assertions_report(spark: SparkSession, sf: str) -> DataFrame:
    o, li, c, s, e = (table(spark, sf, t) for t in ("orders", "lineitem", "customer", "supplier", "events"))
    A = quality.Assertion
    return quality.report([
        A("orders_unique", "block", lambda: quality.repeated_keys(o, "o_orderkey"), quality.zero()),
        A("lines_unique", "warn", lambda: quality.repeated_keys(li, "l_orderkey", "l_linenumber"), quality.zero()),
        A("lines_have_orders", "block", lambda: quality.orphans(li, o, "l_orderkey", "o_orderkey"), quality.zero()),
        A("orders_have_customers", "block", lambda: quality.orphans(o, c, "o_custkey", "c_custkey"), quality.zero()),
        A("balances_positive", "warn", lambda: quality.violations(c, F.col("c_acctbal") < 0), quality.at_most(10)),
        A("discount_band", "block", lambda: quality.violations(li, F.col("l_discount") > 0.05), quality.band(0.2, 0.7, 100)),
        A("supplier_names", "block", lambda: quality.violations(s, ~S.missing_name(F.col("s_name"))), quality.coverage(0.99)),
        A("error_events", "warn", lambda: quality.violations(e, F.col("event_type") == "error"), quality.at_least(100)),
    ])


def _changes(e: DataFrame) -> DataFrame:
    return e.select(F.col("user_id").alias("entity"), "ts", F.col("event_id").alias("seq"), (F.col("event_type") == "error").alias("deleted"))


def _shown(state: DataFrame) -> DataFrame:
    return state.select("entity", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_seen", "last_changed")), "edit_count", "is_deleted")


@query
def dirty_set_fold(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(dirty_set.fold(_changes(table(spark, sf, "events"))))


@query
def dirty_set_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a stream's keyed state over the table's files."""
    checkpoint = scratch(spark, "dirty-set")
    e = table(spark, sf, "events")
    # A stream reads a folder; a table in one file is read through a pattern on its folder.
    dirty_set.coalesce_stream(spark, f"{sf}/events.parque[t]", e.schema, _changes, checkpoint)
    return _shown(dirty_set.state(spark, checkpoint))


@query
def event_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the role of edits: errors are deletions, purchases are label edits in a language taken from props."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    lang = F.element_at(F.array(*map(F.lit, ("en", "fr", "bn", "hi", "mul"))), k % 5 + 1)
    edits = e.select(
        "event_id", F.when(F.col("event_type") == "error", "log").otherwise("edit").alias("type"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("/* wbsetlabel-add:1|"), lang, F.lit(" */"))).when(F.col("event_type") == "view", "/* wbsetsitelink-add:1|enwiki */").otherwise("/* wbcreateclaim-create:1|P31 */").alias("comment"),
        F.lit("delete").alias("log_type"), F.when(k % 2 == 0, "delete").when(k % 3 == 0, "restore").otherwise("revision").alias("log_action"))
    return dirty_set.classify(edits).groupBy("action").agg(F.count("*").alias("n"))


@query
def period_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written as periods of six kinds, parsed back to their starts."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    y = F.year(d).cast("string")
    p = (F.when(k == 0, y).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.concat(y, F.lit("M"), F.date_format(d, "MM")))
         .when(k == 3, F.concat(y, F.lit("-Q"), F.quarter(d).cast("string"))).when(k == 4, F.concat(y, F.lit("S"), F.when(F.month(d) <= 6, "1").otherwise("2"))).otherwise(F.concat(F.lit("x"), y)))
    o = table(spark, sf, "orders").select(p.alias("period"))
    return o.groupBy("period").agg(F.count("*").alias("n")).withColumn("start", S.period_start(F.col("period")).cast("string"))


@query
def adhoc_sql_guard(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").createOrReplaceTempView("adhoc_orders")
    return adhoc.run(spark, "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 0) AS value FROM adhoc_orders WHERE o_orderpriority = :p AND o_totalprice > :least GROUP BY o_orderstatus", {"p": "1-URGENT", "least": 1000.0})


@query
def events_windowed(spark: SparkSession, sf: str) -> DataFrame:
    """An extension: six-hour windows and their events."""
    w = F.window("ts", "6 hours")
    return table(spark, sf, "events").groupBy(w, "event_type").agg(F.count("*").alias("n")).select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query
def field_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Share of filled fields per priority, in per cent."""
    n = notices(spark, sf)
    share = lambda c: S.rounded(F.count(c) / F.greatest(F.count("*"), F.lit(1)) * 100, 1).alias(c)
    return n.groupBy("priority").agg(F.count("*").alias("n"), share("bidders"), share("total"), share("division"))


@query
def code_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Part types by length of the code."""
    size = F.length("p_type")
    return table(spark, sf, "part").agg(F.count_if(size <= 5).alias("short"), F.count_if(size.between(6, 7)).alias("middle"), F.count_if(size > 7).alias("long"), F.count_if(F.col("p_type").isNull()).alias("missing"))


@query
def price_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Brands by the age of their newest price, judged at the table's newest date."""
    p = prices(spark, sf)
    now = p.agg(F.max("date").alias("now"))
    age = p.groupBy("ticker").agg(F.max("date").alias("newest")).crossJoin(F.broadcast(now)).withColumn("age", F.datediff("now", "newest"))
    return age.agg(F.count("*").alias("tickers"), F.count_if(F.col("age") <= 7).alias("fresh"), F.count_if(F.col("age").between(8, 30)).alias("ageing"), F.count_if(F.col("age") > 30).alias("stale"))


@query
def common_status(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's most frequent order status; ties go to the smaller one."""
    n = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return n.groupBy("o_custkey").agg(F.min_by("o_orderstatus", F.struct(-F.col("n"), "o_orderstatus")).alias("status"))


@query
def spend_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by size class and month of their date."""
    v = F.col("o_totalprice")
    bucket = F.when(v < 50_000, "under 50k").when(v < 200_000, "50k to 200k").otherwise("200k and more")
    return table(spark, sf, "orders").groupBy(bucket.alias("bucket"), F.date_format("o_orderdate", "yyyy-MM-01").alias("month")).agg(F.count("*").alias("n"))


@query
def coverage_panel(spark: SparkSession, sf: str) -> DataFrame:
    n = notices(spark, sf)
    return n.agg(F.count_distinct("company").alias("companies"), F.count_distinct("authority").alias("authorities"), F.count_distinct("contract_key").alias("contracts"),
                 F.min("pub_date").cast("string").alias("first_day"), F.max("pub_date").cast("string").alias("last_day"))


@query
def top_division_per_nation(spark: SparkSession, sf: str) -> DataFrame:
    n = notices(spark, sf).groupBy("nation", "division").agg(F.count("*").alias("n"))
    return resolve.first_choice(n, "nation", F.desc("n"), "division")


@query
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Partial updates folded per user: each field keeps its newest non-null value (values over 50 count as not sent)."""
    e = table(spark, sf, "events").withColumn("value", F.when(F.col("value") <= 50, F.col("value")))
    at = F.struct("ts", "event_id")
    return e.groupBy("user_id").agg(F.max_by("event_type", at).alias("event_type"), F.max_by("value", F.when(F.col("value").isNotNull(), at)).alias("value"), F.max("event_id").alias("seq"))


@query
def status_facets(spark: SparkSession, sf: str) -> DataFrame:
    """Facet counts beside the counts under a filter."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("all"), F.count_if(F.col("o_totalprice") > 250_000).alias("matching"))


@query
def sibling_filings(spark: SparkSession, sf: str) -> DataFrame:
    """Years that two neighbouring companies both filed for."""
    f = filings(spark, sf).select("company", "year")
    other = f.select((F.col("company") - 1).alias("company"), "year")
    return f.join(other, ["company", "year"]).groupBy("company").agg(F.count("*").alias("years"), F.min("year").alias("first_year"))
