"""Keyed state, loads, routes, the word index, the check catalogue, kept statistics, panels, money and artifacts."""

import contextlib
import datetime as dt
import io
import itertools
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import catalogue, cube_store, money, quality, routes, text_index
from tallyfold.plans import store_queries
from tallyfold.sources import artifacts
from tallyfold.streaming import dirty_set, ingest

EVENTS = "entity string, ts timestamp, seq long, deleted boolean"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def put(spark, rows, path):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def shown(spark, checkpoint):
    return got(dirty_set.state(spark, checkpoint).select("entity", "first_seen", "last_changed", "last_seq", "edit_count", "is_deleted"))


def test_keyed_state_goes_on_from_its_checkpoint(spark, tmp_path):
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/c"
    take = lambda: dirty_set.coalesce_stream(spark, source, EVENTS, lambda d: d, checkpoint, lateness="1 day")
    first = [("a", at(5), 1, False), ("b", at(6), 2, True), ("a", at(7), 3, False)]
    put(spark, first, source)
    take()
    assert shown(spark, checkpoint) == [("a", at(5), at(7), 3, 2, False), ("b", at(6), at(6), 2, 1, True)]
    take()  # nothing new: nothing counted again
    # A repeat, an event that is late within a day, an undeletion, and a new entity.
    put(spark, [("a", at(7), 3, False), ("a", at(1), 4, True), ("b", at(9), 5, False), ("c", at(8), 6, False)], source)
    take()
    want = [("a", at(1), at(7), 3, 3, False), ("b", at(6), at(9), 5, 2, False), ("c", at(8), at(8), 6, 1, False)]
    assert shown(spark, checkpoint) == want
    rows = spark.read.schema(EVENTS).parquet(source)
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in got(dirty_set.fold(rows).select("entity", "first_seen", "last_changed", "edit_count", "is_deleted"))] == [(e, f, c, n, d) for e, f, c, _, n, d in want]


def test_state_grows_with_entities_not_events(spark, tmp_path):
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/c"
    put(spark, [(f"e{i % 4}", at(i), i, False) for i in range(400)], source)
    dirty_set.coalesce_stream(spark, source, EVENTS, lambda d: d, checkpoint)
    assert dirty_set.state(spark, checkpoint).count() == 4 and {r["edit_count"] for r in dirty_set.state(spark, checkpoint).collect()} == {100}


def test_old_deletions_expire(spark, tmp_path):
    source, checkpoint, changes = f"{tmp_path}/in", f"{tmp_path}/c", f"{tmp_path}/changes"
    take = lambda: dirty_set.coalesce_stream(spark, source, EVENTS, lambda d: d, checkpoint, lateness="1 minute", keep_deleted_ms=60 * 60_000, changes=changes)
    put(spark, [("gone", at(0), 1, True), ("stays", at(0), 2, False)], source)
    take()
    put(spark, [("other", at(500), 3, False)], source)
    take()
    put(spark, [("other", at(501), 4, False)], source)
    take()
    assert {e for e, *_ in shown(spark, checkpoint)} == {"stays", "other"}
    assert spark.read.parquet(changes).filter("entity = 'other'").agg(F.max("edit_count")).first()[0] == 2


def test_loads_skip_what_is_there_and_replace_themselves(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = lambda *keys: spark.createDataFrame([(k, f"v{k}", dt.date(2024, 1, 1)) for k in keys], "k long, v string, d date")
    ingest.load_new(df(1, 2, 2), path, ["k"], 7)
    ingest.load_new(df(2, 3), path, ["k"], 8)
    ingest.load_new(df(2, 3), path, ["k"], 8)
    ingest.load_new(df(1, 3), path, ["k"], 9)
    assert got(ingest.loaded_keys(spark, path, df(1).schema).select("k", "v", "load")) == [(1, "v1", 7), (2, "v2", 7), (3, "v3", 8)]
    only_key = spark.createDataFrame([(1,), (1,)], "k long")
    ingest.load_new(only_key, f"{tmp_path}/u", ["k"], 0)
    assert ingest.loaded_keys(spark, f"{tmp_path}/u", only_key.schema).count() == 1


def test_stream_and_batch_load_alike(spark, tmp_path):
    source, path = f"{tmp_path}/in", f"{tmp_path}/t"
    take = lambda: ingest.load_stream(spark, source, EVENTS, lambda d: d, path, ["seq"], f"{tmp_path}/c", "ts", "1 hour")
    put(spark, [("a", at(0), 1, False), ("b", at(1), 2, False)], source)
    take()
    put(spark, [("b", at(1), 2, False), ("c", at(2), 3, False)], source)
    take()
    put(spark, [("z", at(900), 9, False)], source)
    take()
    put(spark, [("z", at(900), 9, False), ("y", at(901), 8, False), ("y", at(901), 8, False)], source)
    take()
    rows = ingest.loaded_keys(spark, path, spark.read.schema(EVENTS).parquet(source).schema)
    assert got(rows.select("seq")) == [(1,), (2,), (3,), (8,), (9,)]


def brute_route(edges, a, b, depth):
    near = {}
    for s, d, k in edges:
        for x, y in ((s, d), (d, s)):
            if x != y:
                near.setdefault(x, {})
                near[x][y] = min(k, near[x].get(y, k))
    paths = [[a]]
    for hops in range(depth + 1):
        done = sorted(p for p in paths if p[-1] == b)
        if done:
            return hops, done[0], [near[x][y] for x, y in itertools.pairwise(done[0])]
        paths = [[*p, n] for p in paths for n in near.get(p[-1], {}) if n not in p]
    return None


@pytest.mark.parametrize("seed", range(2))
def test_routes_like_brute_force(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(26)]
    edges = [(rng.choice(nodes), rng.choice(nodes), rng.choice("xyz")) for _ in range(36)]
    pairs = [(rng.choice(nodes), rng.choice([*nodes, "nowhere"])) for _ in range(24)] + [("n01", "n01")]
    df = spark.createDataFrame(edges, "src string, dst string, kind string")
    found = routes.shortest_routes(df, spark.createDataFrame(pairs, "src string, dst string"), 5, excluded=("z",))
    want = {(a, b): r for a, b in pairs if (r := brute_route([e for e in edges if e[2] != "z"], a, b, 5))}
    assert {(r["src"], r["dst"]): (r["hops"], r["nodes"], r["kinds"]) for r in found.collect()} == want


def test_index_reads_only_its_words(spark, tmp_path):
    rows = [(1, "red green", "blue blue red", "en"), (2, "red", None, "de"), (3, None, "red green blue yellow", "en"), (4, "", "green red", "fr"), (5, "green", "red", "en"), (6, "RED! Green", "", "en")]
    docs = spark.createDataFrame(rows, "id long, title string, body string, lang string")
    path = str(tmp_path / "i")
    text_index.write_index(docs, path, ["title", "body"], "id", ("lang",))
    hits = text_index.find(spark, path, ["red", "GREEN"], 2, [2.0, 1.0])
    assert [(r["key"], r["score"], r["rank"]) for r in hits.orderBy("rank").collect()] == [(1, 2.0, 1), (6, 2.0, 2), (4, 1.0, 3), (3, 0.5, 4)]
    assert [r["key"] for r in text_index.find(spark, path, ["red", "green"], 2, where=F.col("lang") == "en").orderBy("rank").collect()] == [1, 6, 3]
    assert text_index.find(spark, path, ["red", "nothing"], 2).count() == 0
    plan = plan_of(text_index.postings_of(spark, path, ["red"]))
    assert "PartitionFilters: [isnotnull(bucket" in plan.replace("'", "") or "bucket" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert "term" in plan.split("PushedFilters:")[1].split("\n")[0]
    assert len({f.split("bucket=")[1].split("/")[0] for f in text_index.postings_of(spark, path, ["red"]).inputFiles()}) <= len(os.listdir(path + "/postings"))


def test_checks_on_a_frame_share_one_scan(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    base = spark.range(100).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id")))
    frame = base.mapInArrow(count, base.schema)
    C = catalogue.Check
    checks = [C("f", f"c{i}", "x", f"id < {i}", rule=("at_most", i)) for i in range(20)] + [C("f", "cover", "x", "v IS NOT NULL", "warn", rule=("coverage", 0.95)), C("f", "broken", "x", "nothing > 1"), C("g", "other", "x", "true")]
    rows = {r["assertion"]: r for r in catalogue.run(spark, {"f": lambda: frame, "g": lambda: 1 / 0}, checks).collect()}
    assert reads.value == 100  # one pass for 21 checks
    assert all(rows[f"c{i}"]["status"] == "pass" and rows[f"c{i}"]["value"] == i for i in range(20))
    assert (rows["cover"]["status"], rows["cover"]["value"], rows["cover"]["total"]) == ("warn", 90, 100)
    assert rows["broken"]["status"] == rows["other"]["status"] == "error" and rows["broken"]["error"] and rows["other"]["error"]


def test_a_check_that_fails_while_running_stands_alone(spark):
    frame = spark.createDataFrame([("1",), ("x",)], "s string")
    C = catalogue.Check
    checks = [C("f", "fine", "x", "s = 'x'", "warn"), C("f", "bad", "x", "CAST(s AS INT) > 5"), C("f", "also_fine", "x", "s IS NULL")]
    rows = {r["assertion"]: (r["status"], r["value"]) for r in catalogue.run(spark, {"f": lambda: frame}, checks).collect()}
    assert rows == {"fine": ("warn", 1), "bad": ("error", None), "also_fine": ("pass", 0)}
    with pytest.raises(ValueError):
        catalogue.run(spark, {"f": lambda: frame}, [checks[0], checks[0]])
    assert len(store_queries.CHECKS) >= 60 and len({c.frame for c in store_queries.CHECKS}) <= 10


def test_rebuilt_years_leave_older_files_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = lambda *t: spark.createDataFrame(list(t), "dataset string, year int, value double")
    measure = lambda d: d.groupBy("dataset", "year").agg(F.count("value").alias("n"))
    cube_store.rebuild(rows(("a", 2000, 1.0), ("a", 2001, 1.0), ("a", 2002, 1.0)), path, measure)
    before = {str(f): (f.stat().st_mtime_ns, f.read_bytes()) for f in Path(path, "year=2000").iterdir()}
    cube_store.rebuild(rows(("a", 2000, None), ("a", 2001, None), ("b", 2001, 1.0)), path, measure, since_year=2001)
    assert {str(f): (f.stat().st_mtime_ns, f.read_bytes()) for f in Path(path, "year=2000").iterdir()} == before
    assert got(cube_store.stored(spark, path)) == [("a", 0, 2001), ("a", 1, 2000), ("b", 1, 2001)]
    assert "year" in plan_of(cube_store.stored(spark, path, year=2001)).split("PartitionFilters:")[1].split("\n")[0]
    cube_store.rebuild(rows(("a", 1999, 1.0)), str(tmp_path / "new"), measure, since_year=1999)
    assert cube_store.stored(spark, str(tmp_path / "new"), "a").count() == 1


def test_panel_is_one_pass_and_tells_missing_values_from_totals(spark):
    rows = spark.createDataFrame([("g", "p"), ("g", None), ("g", None), (None, "p")], "graph string, predicate string")
    panel = cube_store.panel(rows, (), ("graph",), ("graph", "predicate"))
    assert got(panel.select("graph", "predicate", "n", "level")) == sorted([(None, None, 4, 0), ("g", None, 3, 1), (None, None, 1, 1), ("g", "p", 1, 2), ("g", None, 2, 2), (None, "p", 1, 2)], key=repr)
    assert plan_of(panel).count("Expand") == plan_of(panel).count("Expand") and "Union" not in plan_of(panel)
    top = cube_store.panel(rows, ("graph",), ("graph", "predicate"), top=1, within="graph")
    assert ("g", None, 2, 1) in got(top.select("graph", "predicate", "n", "level"))


@pytest.mark.parametrize("span", [1, 7, 400])
def test_as_of_like_brute_force(spark, span):
    rng = random.Random(span)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(900))
    rows = [(i, rng.choice("ab"), day()) for i in range(80)] + [(98, None, day()), (99, "c", day())]
    facts = [(rng.choice("ab"), day(), float(rng.randrange(9))) for _ in range(25)] + [("a", None, 1.0), ("b", dt.date(2000, 5, 5), None)]
    found = money.as_of(spark.createDataFrame(rows, "i int, k string, d date"), spark.createDataFrame(facts, "k string, d date, v double"), "k", "d", "v", "v", span)
    known = {}
    for k, d, v in facts:
        if d and v is not None:
            known[k, d] = min(v, known.get((k, d), v))
    want = {i: (known[max((x for x in known if x[0] == k and x[1] <= d), key=lambda x: x[1])] if any(x[0] == k and x[1] <= d for x in known) else None) for i, k, d in rows}
    assert {r["i"]: r["v"] for r in found.collect()} == want


def test_published_amounts_and_currencies(spark):
    rows = [("eur", "POL", "2020-01-01", "10.5"), (None, "ITA", "1998-12-31", "1936.27"), ("n/a", "ITA", "1999-01-01", "5"), ("", "POL", "2020-01-01", "1"), (None, "XXX", "2020-01-01", "7"), ("PLN", "POL", "2020-01-01", "999999.99"), ("PLN", "POL", "2020-01-01", "-5"),
            ("PLN", "POL", "1990-01-01", "8"), ("PLN", None, "2020-01-01", "1 000"), ("PLN", None, "2020-01-01", "NaN"), ("PLN", None, None, "8")]
    df = spark.createDataFrame(rows, "declared string, country string, day string, published string").withColumn("day", F.col("day").cast("date"))
    rates = spark.createDataFrame([("PLN", dt.date(2019, 1, 1), 4.0), ("PLN", dt.date(2019, 6, 1), 0.0), ("ITL", dt.date(1990, 1, 1), 1936.27)], "currency string, day date, per_euro double")
    assert got(money.published_to_euro(df, rates).select("currency", "amount", "eur")) == sorted([("EUR", 10.5, 10.5), ("ITL", 1936.27, 1.0), ("EUR", 5.0, 5.0), ("PLN", None, None), (None, 7.0, None), ("PLN", None, None), ("PLN", None, None), ("PLN", 8.0, None),
                                                                                           ("PLN", 1000.0, 250.0), ("PLN", None, None), ("PLN", 8.0, None)], key=repr)


def test_only_damaged_parts_are_written_again(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.createDataFrame([(i, "x" * 20, i % 3) for i in range(90)], "id long, t string, p int")
    assert got(artifacts.write_artifacts(rows, path, F.col("p"), 10)) == [("0",), ("1",), ("2",)]
    files = {f: f.read_bytes() for f in Path(path, "data").rglob("*.json.gz")}
    assert len(files) >= 9 and artifacts.write_artifacts(rows, path, F.col("p"), 10).count() == 0
    victim = sorted(f for f in files if "part=1" in str(f))[0]
    (victim.parent / f".{victim.name}.crc").unlink(missing_ok=True)
    raw = bytearray(files[victim])
    raw[len(raw) // 2] ^= 255
    victim.write_bytes(raw)
    with pytest.raises(ValueError):
        artifacts.read_artifacts(spark, path, "id long, t string")
    assert got(artifacts.write_artifacts(rows, path, F.col("p"), 10)) == [("1",)]
    assert all(f.read_bytes() == b for f, b in files.items() if "part=1" not in str(f))
    assert got(artifacts.read_artifacts(spark, path, "id long, t string").select("id", "part")) == sorted(((i, str(i % 3)) for i in range(90)), key=repr)
    next(f for f in files if "part=2" in str(f)).unlink()
    assert got(artifacts.write_artifacts(rows, path, F.col("p"), 10)) == [("2",)]


def test_a_refused_graph_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "g")
    t = lambda *rows: spark.createDataFrame(list(rows), "subject string, predicate string, object string")
    rule = ["name"], {"size": "int"}, {}
    assert artifacts.replace_graph(t(("a", "name", "A"), ("p", "type", "Person"), ("p", "name", "P")), path, "g", *rule).count() == 0
    assert artifacts.replace_graph(t(("h", "name", "H")), path, "h", *rule).count() == 0
    broken = artifacts.replace_graph(t(("b", "name", "B"), ("c", "size", "big")), path, "g", *rule)
    assert got(broken) == [("c", "name", "missing"), ("c", "size", "type")]
    assert got(spark.read.parquet(path).select("graph", "subject")) == [("g", "a"), ("h", "h")]
    assert artifacts.replace_graph(t(("b", "name", "B")), path, "g", *rule).count() == 0
    assert got(spark.read.parquet(path).select("graph", "subject")) == [("g", "b"), ("h", "h")]


def test_resolver_expectations(spark):
    resolved = spark.createDataFrame([(1, "matched", "lei", 1.0, 10), (2, "ambiguous", "vat", 0.99, None), (3, "no_match", None, None, None), (4, "matched", "name_country", 0.95, 11)], "id long, hint string, tier string, score double, entity long")
    cases = [("a", "tier", 1, "lei", 0.9, None), ("b", "tier", 2, "vat", 0.9, None), ("c", "confident", 2, None, 0.9, None), ("d", "refused", 3, None, 0.9, None), ("e", "refused", 4, None, 0.9, None), ("f", "entity", 4, None, 0.0, 12), ("g", "entity", 1, None, 0.0, 10), ("h", "confident", 9, None, 0.0, None)]
    df = spark.createDataFrame(cases, "case string, expect string, id long, tier string, least double, entity long")
    same = spark.createDataFrame([(12, 11)], "node long, canonical long")
    assert {r["case"]: r["ok"] for r in quality.resolver_checks(df, resolved, same).collect()} == {"a": True, "b": False, "c": True, "d": True, "e": False, "f": True, "g": True, "h": False}


def test_divisors_and_lags_are_joins(spark):
    o = spark.createDataFrame([("r", 1, 10.0), ("r", 2, 10.0), ("s", 1, None)], "geo string, year int, value double")
    d = spark.createDataFrame([("r", 1, 4.0), ("r", 1, 2.0), ("r", 2, 0.0), ("s", 1, 1.0)], "geo string, year int, value double")
    found = cube_store.per_divisor(o, d)
    assert got(found.select("geo", "year", "ratio")) == [("r", 1, 5.0), ("r", 2, None), ("s", 1, None)]
    assert "Subquery" not in plan_of(found) and "CartesianProduct" not in plan_of(found)
    lag = cube_store.lags(spark.createDataFrame([("x", 5), ("x", 9)], "stream string, seq long"), spark.createDataFrame([("r", "x", 4), ("q", "x", None), ("r", "y", 3)], "reader string, stream string, seq long"))
    assert got(lag) == [("q", "x", 9), ("r", "x", 5), ("r", "y", 0)]


def test_sheets_have_their_heads(spark, tmp_path):
    from tallyfold.sources import sinks

    cols = "ticker string, price double, avg_volume double, current_assets double, inventory double, prepaid double, current_liabilities double, debt double, equity double, shares double, dividend_day date, dividend double, split_year int, split_ratio double"
    snapshot = spark.createDataFrame([("A", 1.5, 1000.0, 5.0, None, 0.5, 2.0, 3.0, 4.0, 10.0, dt.date(2020, 5, 1), 0.25, None, None), ("B", None, None, None, None, None, None, None, None, None, None, None, 2019, 2.0)], cols)
    annual = spark.createDataFrame([("A", 2019, 7.0, None), ("A", 2020, 8.25, 9.0), ("C", 2020, 1.0, 1.0)], "ticker string, year int, revenue double, earnings double")
    sinks.headed_sheets(snapshot, annual, str(tmp_path / "s"), {"Revenue": "revenue", "Earnings": "earnings"})
    lines = lambda t: [x for f in sorted(Path(tmp_path, "s", f"ticker={t}").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines("A") == ["Ticker,A,Price,1.50,Avg. Volume,1000", "Cur Assets,5,Inv.,,PrePaidEx.,0.50,Cur Liabi.,2,debt,3,equity,4,shares,10", "Last Div,2020-05-01,Amount,0.25,Last Split,,Split Ratio,No", "Year,Revenue,Earnings", "2020,8.25,9", "2019,7,"]
    assert lines("B")[0] == "Ticker,B,Price,,Avg. Volume," and lines("B")[2].endswith("Last Split,2019,Split Ratio,2") and len(lines("B")) == 4
    assert not Path(tmp_path, "s", "ticker=C").exists()


def test_windows_periods_and_identities(spark):
    from tallyfold.functions import scalars
    from tallyfold.operators import listing

    day = F.lit("2020-12-31").cast("date")
    names = ["6mo", "1y", "max", "4y", "18mo", "10d", "soon", "xy", "y"]
    row = spark.range(1).select(*(F.datediff(day, scalars.window_start(n, day)).alias(n) for n in names)).first()
    assert list(row) == [180, 365, 36500, 1460, 540, 10, 365, 365, 365]
    periods = spark.createDataFrame([("2019",), ("2020-Q2",), ("2018-12",), ("x",), (None,)], "p string")
    assert got(periods.filter(scalars.kept_period(F.col("p"), 2019))) == [("2019",), ("2020-Q2",)] and periods.filter(scalars.kept_period(F.col("p"), None)).count() == 3
    uuid = "0a1b2c3d-0000-5aaa-8bbb-cccccccccccc"
    wanted = spark.createDataFrame([(uuid,), (uuid.upper(),), ("AAA",), ("BBB",), ("CCC",), (None,)], "id string")
    listings = spark.createDataFrame([("AAA", uuid), ("BBB", "other")], "ticker string, company string")
    rows = spark.createDataFrame([(uuid, 2020)], "company string, year int")
    back = spark.createDataFrame([("BBB", 1), ("CCC", 2)], "ticker string, year int")
    assert got(listing.by_identity(wanted, listings, rows, back).select("id", "year", "source")) == sorted([(uuid, 2020, "store"), ("AAA", 2020, "store"), ("BBB", 1, "filings"), ("CCC", 2, "filings")], key=repr)


def test_regions_refuse_what_they_cannot_answer(spark):
    from tallyfold.operators import regional

    located = spark.createDataFrame([(1, "AA11"), (1, "AA12"), (2, "AB11"), (3, "A")], "company long, code string")
    contracts = spark.createDataFrame([(10, 1, 5.0, True, False), (11, 1, 9.0, True, True), (12, 2, 1.0, False, False)], "contract long, company long, value double, is_current boolean, low_confidence boolean")
    codes = spark.createDataFrame([(c,) for c in ("AA", "AB", "AC", "AA1", "AB1", "AA11", "AA12")], "code string")
    by = lambda *a, **k: dict(regional.by_region(located, contracts, codes, *a, **k).collect())
    assert by("companies", 0) == {"AA": 1.0, "AB": 1.0, "AC": 0.0} and by("contracts", 1) == {"AA1": 2.0, "AB1": 0.0}
    assert by("contracts_eur", 0) == {"AA": 10.0, "AB": 0.0, "AC": 0.0}  # once for each place
    assert by("companies", 2, scope="AA1") == {"AA11": 1.0, "AA12": 1.0}
    assert by("companies", 0, connected=spark.createDataFrame([(2,)], "company long")) == {"AA": 0.0, "AB": 1.0, "AC": 0.0}
    for wrong in (("companies", 4), ("money", 0), ("companies", 3)):
        with pytest.raises(ValueError):
            regional.by_region(located, contracts, codes, *wrong)


def test_kept_introspection_bounded_series_and_languages(spark):
    from tallyfold.operators import etl, stats
    from tallyfold.sources import sinks

    spark.range(1).createOrReplaceTempView("kept_view")
    now = [0.0]
    ask = lambda: etl.introspect_kept(spark, ["kept_view"], 600, lambda: now[0])
    assert ask() == [("kept_view", "id", "bigint")]
    spark.range(1).withColumnRenamed("id", "other").createOrReplaceTempView("kept_view")
    now[0] = 599
    assert ask()[0][1] == "id"
    now[0] = 600
    assert ask()[0][1] == "other"
    o = spark.createDataFrame([("d", "AA11", 2000 + i, "s", 1.0, {"k": "v"}) for i in range(5)], "dataset string, geo string, year int, slice_key string, value double, dims map<string, string>")
    for limit, more in ((4, True), (5, False), (9, False)):
        rows, truncated = stats.bounded_series(o, "d", limit, level=2)
        assert rows.count() == min(limit, 5) and truncated == more
    names = spark.createDataFrame([(" FR ", "DE"), (None, "gr"), ("", "XX"), (None, None)], "lang string, country string")
    assert [r[0] for r in names.select(sinks.source_language(F.col("lang"), F.col("country"))).collect()] == ["fr", "el", "en", "en"]


def test_control_characters_in_a_register_are_taken_out(spark, tmp_path):
    from tallyfold.sources import registers

    record = "<interestRepresentative><identificationCode>{0}</identificationCode><name><originalName>A\x02cme\n {0}</originalName></name><headOffice><country>FR</country></headOffice></interestRepresentative>"
    (tmp_path / "r.xml").write_text('<?xml version="1.0"?>\n<list>\n' + "\n".join(record.format(i) for i in (1, 2, 3)) + "\n</list>\n")
    rows = registers.lobbyists_xml(spark, str(tmp_path / "r.xml")).select("id", "name", "country")
    assert got(rows) == [(str(i), f"Acme\n {i}", "FR") for i in (1, 2, 3)]


def test_facts_of_the_far_future_are_no_filings(spark, tmp_path):
    import json

    from tallyfold.sources import readers

    entry = lambda year, val, form="10-K", fp="FY": {"end": f"{year}-12-31", "val": val, "fy": year, "fp": fp, "form": form}
    facts = {"cik": 7, "facts": {"us-gaap": {"Revenues": {"units": {"USD": [entry(y, y * 1.0) for y in (*range(2008, 2021), 2113)] + [entry(2020, 5.0), entry(2019, 9.0, "10-Q"), entry(2018, 9.0, fp="Q1")]}}, "Assets": {"units": {"USD": [entry(2012, 1.0), entry(2011, 1.0)]}}}}}
    (tmp_path / "f.json").write_text(json.dumps(facts))
    rows = {(r["field"], r["year"]): r["value"] for r in readers.annual_facts_json(spark, str(tmp_path / "f.json"), {"revenue": ["Revenues"], "assets": ["Assets"]}).collect()}
    # The ten newest years are 2113 and 2012 to 2020; the first of them isn't plausible, and 2011 isn't among them.
    assert rows == {("revenue", y): y * 1.0 for y in range(2012, 2020)} | {("revenue", 2020): 5.0, ("assets", 2012): 1.0}
