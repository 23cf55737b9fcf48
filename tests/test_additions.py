"""The SQL guard, degraded search, repeated delivery, screens, codes, pages and loads on small fixtures."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import codes
from tallyfold.operators import etl, finance, graph, listing, matching, procurement, quality, search
from tallyfold.plans import adhoc
from tallyfold.streaming import dirty_set


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


REFUSED = [
    "EXECUTE IMMEDIATE 'CREATE TEMP VIEW v AS SELECT 1'", "CACHE TABLE c AS SELECT 1", "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT java_method('java.lang.Math', 'abs', 1)",
    "SELECT try_reflect('java.lang.System', 'lineSeparator')", "SELECT * FROM text.`/etc/hostname`", "SELECT * FROM parquet.`/tmp/x`", "WITH a AS (SELECT 1 AS x) INSERT INTO known SELECT x FROM a",
    "CREATE OR REPLACE TABLE t USING parquet AS SELECT 1", "CREATE TEMP VIEW v AS SELECT 1", "ALTER TABLE known RENAME TO other", "ALTER TABLE known ADD COLUMNS (y int)", "ALTER TABLE known SET TBLPROPERTIES ('a' = 'b')",
    "LOAD DATA INPATH '/tmp/x' INTO TABLE known", "MSCK REPAIR TABLE known", "REFRESH TABLE known", "COMMENT ON TABLE known IS 'x'", "DROP VIEW known", "SET a = b", "TRUNCATE TABLE known", "ADD JAR '/tmp/x.jar'",
    "INSERT INTO known VALUES (1)", "DESCRIBE known", "SHOW TABLES", "EXPLAIN SELECT 1", "SELECT * FROM (SELECT reflect('java.lang.System', 'lineSeparator') AS x)", "SELECT (SELECT reflect('java.lang.System', 'lineSeparator'))",
    "SELECT 1 WHERE EXISTS (SELECT * FROM text.`/etc/hostname`)", "WITH a AS (SELECT * FROM text.`/etc/hostname`) SELECT * FROM a", "SELECT x FROM known WHERE x IN (SELECT value FROM text.`/etc/hostname`)",
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'java.version')", "SELECT IDENTIFIER('java_' || 'method')('java.lang.Math', 'abs', 1)", "SELECT * FROM IDENTIFIER('known')", "SELECT IDENTIFIER('x') FROM known",
    "SELECT IDENTIFIER(reflect('java.lang.System', 'lineSeparator')) FROM known", "SELECT * FROM known LATERAL VIEW IDENTIFIER('explode')(array(1)) t AS y", "SELECT transform(array(1), y -> reflect('java.lang.System', 'lineSeparator'))",
    "SELECT system.builtin.reflect('java.lang.System', 'lineSeparator')", "SELECT session_user()", "SELECT input_file_name() FROM known", "SELECT from_csv('1', 'a INT')", "SELECT sum(x) FILTER (WHERE reflect('a', 'b') = '') FROM known",
    "SELECT x FROM known ORDER BY reflect('java.lang.System', 'lineSeparator')", "SELECT rank() OVER (ORDER BY java_method('java.lang.System', 'lineSeparator')) FROM known",
    "FROM known INSERT OVERWRITE DIRECTORY '/tmp/x' USING csv SELECT x", "SELECT * FROM python_worker_logs()", "SELECT * FROM nowhere", "BEGIN SELECT 1; END",
]


@pytest.mark.parametrize("statement", REFUSED)
def test_guard_refuses(spark, statement):
    spark.range(3).select(F.col("id").alias("x")).createOrReplaceTempView("known")
    with pytest.raises(Exception) as e:
        adhoc.run(spark, statement).collect()
    assert isinstance(e.value, ValueError) or "PARSE" in str(e.value)
    assert "v" not in [t.name for t in spark.catalog.listTables()] and not spark.catalog.isCached("known")


def test_guard_lets_queries_through(spark):
    spark.range(3).select(F.col("id").alias("x")).createOrReplaceTempView("known")
    for statement, want in {
        "SELECT x FROM known ORDER BY x DESC LIMIT 1": [(2,)], "WITH a AS (SELECT x FROM known WHERE x > :least) SELECT count(*) FROM a": [(2,)],
        "SELECT a.x FROM known a JOIN known b ON a.x = b.x + 1 WHERE a.x IN (SELECT max(x) FROM known)": [(2,)], "SELECT sum(x) OVER () AS s FROM known UNION SELECT 7": [(3,), (7,)],
        "SELECT x, count(*) FROM known GROUP BY x HAVING x = 0": [(0, 1)], "VALUES (1), (2)": [(1,), (2,)], "SELECT explode(array(1, 2))": [(1,), (2,)], "SELECT id FROM range(2)": [(0,), (1,)],
        "SELECT CASE WHEN x BETWEEN 1 AND 2 THEN upper('a' || x) ELSE NULL END AS c FROM known WHERE x IS NOT NULL AND x NOT IN (7)": [(None,), ("A1",), ("A2",)], "SELECT transform(array(x), y -> y + 1)[0] FROM known": [(1,), (2,), (3,)],
        "SELECT x % 2 AS g, count(DISTINCT x), sum(x) FILTER (WHERE x > 0) FROM known GROUP BY ROLLUP (x % 2)": [(0, 2, 2), (1, 1, 1), (None, 3, 3)], "SELECT year(DATE '2020-01-01'), CAST('1' AS INT), extract(MONTH FROM DATE '2020-05-01'), coalesce(NULL, -1)": [(2020, 1, 5, -1)],
        "SELECT x FROM known PIVOT (count(x) FOR x IN (0, 1))": None, "SELECT x FROM known EXCEPT SELECT 1": [(0,), (2,)], "SELECT k.x, y FROM known k LATERAL VIEW explode(array(x)) t AS y WHERE x = 1": [(1, 1)],
    }.items():
        if want is not None:
            assert got(adhoc.run(spark, statement, {"least": 0} if ":least" in statement else None)) == sorted(want, key=repr), statement
    with pytest.raises(ValueError):
        adhoc.run(spark, "SELECT 1", {"a": "x" * 20_000})
    with pytest.raises(ValueError):
        adhoc.run(spark, "SELECT 1", {"a": [["nested"]]})


def test_fusion_without_one_list(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "id int, rank int")
    assert [r["id"] for r in search.fuse(a, None, "id").collect()] == [1, 2] and [r["id"] for r in search.fuse(None, a, "id").collect()] == [1, 2]
    with pytest.raises(ValueError):
        search.fuse(None, None, "id")


def test_short_screen(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [("A", day(i), 1.5 + 0.5 * (i % 2), 1.0, 1.2 + 0.1 * (i % 2), 2e6) for i in range(40)] + [("B", day(i), 9.0, 8.0, 8.5, 10.0) for i in range(3)]
    prices = spark.createDataFrame(rows, "ticker string, date date, high double, low double, close double, volume double")
    out = {r["ticker"]: r for r in finance.short_screen(prices, spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")).collect()}
    assert out["A"]["volume_ok"] and out["A"]["price_ok"] and out["A"]["diff_mat"] == pytest.approx((1.25 - 1.3) / 1.3, abs=1e-6)
    assert out["B"]["last_close"] == 8.5 and not out["B"]["passes"] and out["B"]["win"] == 0 and out["B"]["diff_mat"] is None  # fewer than five rows
    assert out["C"]["last_close"] is None and not any(out["C"][c] for c in ("volume_ok", "price_ok", "win_ok", "swing_ok", "mat_ok", "passes"))


def test_codes(spark):
    one = spark.range(1)
    show = lambda c: one.select(c.alias("x")).first()["x"]
    lit = F.lit
    assert [show(codes.comparable(lit(x))) for x in ("1.50", " 2 ", "x ", "-0.00001", "1e3", None)] == ["1.5", "2", "x", "-0", "1000", None]
    assert show(codes.id_of("lei", lit("X"))) == str(uuid.uuid5(uuid.UUID(codes.NAMESPACE), "lei:X"))
    assert show(codes.id_of("cik", lit("12"))) == str(uuid.uuid5(uuid.UUID(codes.NAMESPACE), "edgar:0000000012"))
    assert show(codes.id_of("name", lit("fr"), lit(" Ab "))) == str(uuid.uuid5(uuid.UUID(codes.NAMESPACE), "FR:AB"))
    assert tuple(show(codes.segments(lit("a —  — b — c — d")))) == ("a", "b", "c · d") and tuple(show(codes.segments(lit(None).cast("string")))) == ("", "", "")
    assert [show(codes.symbol(lit("BRK.B"), lit(x))) for x in ("US", " ln", "??")] == ["BRK-B", "BRK.B.L", None]
    assert show(codes.longest(F.array(lit("ab"), lit(None), lit("abc"), lit("abd")))) == "abd" and show(codes.unless_zero(lit(1e-10))) is None
    assert show(codes.json_amount(lit('{"a": ""}'), "a")) == 0 and show(codes.json_amount(lit(json.dumps({"a": "2.5"})), "a")) == 2.5
    assert show(codes.iri_kind(lit("http://x/id/Company/12345678-1234-1234-1234-123456789abc"))) == "Company" and show(codes.iri_kind(lit("http://x/id/Company/1"))) is None
    countries = spark.createDataFrame([("FR", "FRA"), ("GR", "GRC")], "alpha2 string, alpha3 string")
    rows = spark.createDataFrame([(" fr",), ("FRA",), ("EL",), ("UK",), ("zz",), ("",), (None,)], "code string")
    assert [r["alpha3"] for r in codes.with_alpha3(rows, "code", countries).orderBy("code").collect()] == [None, None, "FRA", "GRC", "FRA", "GBR", None]


def test_pages(spark):
    rows = spark.range(10).select(F.col("id"), (F.col("id") % 3).alias("k"))
    page = lambda n, at: listing.page(rows, [F.desc("k"), F.col("id")], n, at)
    assert [r["id"] for r in page(4, 0).collect()] == [2, 5, 8, 1] and [r["has_more"] for r in page(4, 0).collect()] == [True] * 4
    assert [r["id"] for r in page(4, 8).collect()] == [6, 9] and not page(4, 8).first()["has_more"] and page(4, 20).count() == 0
    assert listing.in_region(rows, None).count() == 10


def test_loads(spark):
    d = dt.date
    marks = spark.createDataFrame([("a", d(2020, 1, 2)), ("b", d(2020, 1, 5))], "source string, mark date")
    days = spark.createDataFrame([("a", d(2020, 1, 3), 5, 1), ("a", d(2020, 1, 4), 0, 3), ("a", d(2020, 1, 5), 9, 0), ("b", d(2020, 1, 4), 1, 0), ("c", d(2020, 1, 1), 0, 0)], "source string, day date, ok int, failed int")
    assert got(etl.advance(marks, days)) == [("a", d(2020, 1, 3)), ("b", d(2020, 1, 5)), ("c", d(2020, 1, 1))]
    held = spark.createDataFrame([("a", d(2020, 1, 5), 2019), ("b", d(2020, 1, 1), 2018)], "dataset string, updated date, max_year int")
    up = spark.createDataFrame([("a", d(2020, 1, 4)), ("b", d(2020, 1, 1)), ("c", d(2020, 1, 1))], "dataset string, updated date")
    assert got(etl.change_gate(held, up)) == [("a", "skip", None), ("b", "from", 2017), ("c", "full", None)]
    assert {a for _, a, _ in got(etl.change_gate(held, up, force=True))} == {"full"}


def test_graph_walks(spark):
    e = spark.createDataFrame([("a", "b", "x", dt.date(2020, 1, 1)), ("b", "c", "y", dt.date(2021, 1, 1)), ("c", "d", "x", dt.date(2021, 1, 1))], "src string, dst string, kind string, day date")
    seed = spark.createDataFrame([("a",)], "node string")
    nodes, edges = graph.typed_neighbourhood(e, seed, 2, most=2)
    assert got(nodes) == [("a", 0), ("b", 1)] and [r["src"] for r in edges.collect()] == ["a"]
    assert got(graph.typed_neighbourhood(e, seed, 3, excluded=("y",))[0]) == [("a", 0), ("b", 1)]
    assert got(graph.typed_neighbourhood(e, seed, 3, since="2021-01-01")[0]) == [("a", 0)]
    assert got(graph.reaching(e, seed, 2)) == [("a",), ("b",), ("c",)]


def test_values_and_gates(spark):
    rows = spark.createDataFrame([(1, 5.0, 0.0, None), (2, 5.0, -3.0, None), (3, 5.0, 5.0, 5.0)], "id int, estimate double, total double, payable double")
    out = {r["id"]: (r["estimate"], r["total"]) for r in procurement.withhold(procurement.value_confidence(rows)).collect()}
    assert out == {1: (5.0, None), 2: (None, None), 3: (5.0, 5.0)}
    results = quality.run(spark, [quality.Assertion("x", "block", lambda: quality.violations(rows, F.col("no")), quality.zero())])
    assert quality.exit_code(results) == 1 and quality.exit_code(results.filter("false")) == 0
    with pytest.raises(ValueError):
        quality.gate(rows, rows)
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.8)], "a int, b int, confidence double")
    mapping, state = matching.apply_decisions(pairs, spark.createDataFrame([(1, 2, True)], "a int, b int, approve boolean"))
    assert got(mapping) == [(2, 1)] and sorted(r["state"] for r in state.collect()) == ["merged", "pending"]
