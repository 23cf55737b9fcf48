"""Steps whose cost has to follow the input: what they pair, write and read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import resolve


def test_names_of_one_beginning_make_few_candidates(spark):
    names = spark.range(2000).select(F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("n"), F.lit(1).alias("country"))
    candidates = resolve._near_short(names.withColumnRenamed("n", "x"), names.withColumnRenamed("n", "y")).distinct().count()
    assert candidates < 2000 * 200  # all pairs are 4,000,000


def test_near_names_of_all_lengths(spark):
    text = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN"
    xs = [text[:n] for n in range(1, 41)]
    ys = sorted({y for n in range(1, 41) for y in (text[:n], text[1:n], text[:n] + "!", "!" + text[2:n], text[:n // 2] + "!!" + text[n // 2:n])} - {""})
    x = spark.createDataFrame([(v, 1) for v in xs], "x string, country int")
    y = spark.createDataFrame([(v, 1) for v in ys], "y string, country int")
    score = 1 - F.levenshtein("x", "y") / F.greatest(F.length("x"), F.length("y"))
    want = sorted(map(tuple, x.join(y, "country").filter(score >= resolve.FUZZY_LEAST).select("x", "y", "country").collect()))
    assert sorted(map(tuple, resolve.near_names(x, y).collect())) == want


def test_paths_meet_from_both_ends(spark):
    from tallyfold.operators import graph

    # A star with 300 leaves beside a chain: a walk from one end alone would reach all leaves from each leaf.
    edges = spark.createDataFrame([("hub", f"leaf{i}") for i in range(300)] + [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f")], "src string, dst string")
    pairs = spark.createDataFrame([("leaf1", "leaf2"), ("leaf1", "hub"), ("a", "e"), ("a", "d"), ("a", "f"), ("a", "a"), ("a", "hub"), ("e", "a")], "src string, dst string")
    got = {(r.src, r.dst): r.hops for r in graph.shortest_paths(edges, pairs, 4).collect()}
    assert got == {("leaf1", "leaf2"): 2, ("leaf1", "hub"): 1, ("a", "e"): 4, ("a", "d"): 3, ("a", "a"): 0, ("e", "a"): 4}


def test_store_differences_state_one_rule(spark, tmp_path):
    import duckdb

    from tallyfold.plans import ledger_queries as L

    balances = [-0.0, 1.00005, 1.000049999, -0.00000005, 12.34, 0.0]
    rows = [(i, f"Customer#{i}", 0, b, "S") for i, b in zip((1, 2, 3, 4, 5, 6), balances, strict=True)]
    path = f"{tmp_path}/customer.parquet"
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(path)
    got = sorted(map(tuple, L.store_differences(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert got == sorted(con.sql(L.ORACLE_SQL["store_differences"]).fetchall()) == [(3, "c_acctbal")]


def test_xml_is_dealt_to_files(spark, tmp_path, monkeypatch):
    from tallyfold.plans import ledger_queries as L

    monkeypatch.setattr(L, "RECORDS_PER_FILE", 100)
    path = L._xml(spark.range(0, 1000, 1, 1), f"{tmp_path}/x", "Row")
    assert len(list((tmp_path / "x").glob("part-*"))) == 10
    assert spark.read.format("xml").option("rowTag", "Row").schema("id long").load(path).agg(F.count_distinct("id")).first()[0] == 1000


def test_cube_joins_its_lines_once(spark, sf, monkeypatch):
    from tallyfold.plans import ledger_queries as L

    names = []
    real = L.kept
    monkeypatch.setattr(L, "kept", lambda df, name: names.append(name) or real(df, name))
    plan = L.read_cube(spark, sf)._jdf.queryExecution().toString()
    assert names == ["observations"] and "lineitem" not in plan


def test_index_counts_words_where_it_cuts_them(spark, tmp_path, monkeypatch):
    from tallyfold.operators import text_index

    plans = []
    frame = type(spark.range(1))
    real = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *c, **k: plans.append(self._jdf.queryExecution().executedPlan().toString()) or real(self, *c, **k))
    docs = spark.createDataFrame([(1, "a b a", "c"), (2, None, "a")], "k long, t string, u string")
    text_index.write_index(docs, f"{tmp_path}/i", ["t", "u"], "k")
    assert plans[0].count("Exchange hashpartitioning") == 2 and "hashpartitioning(term" not in plans[0]
    got = {(r.term, r.key, r.tf0, r.n0, r.tf1, r.n1) for r in spark.read.parquet(f"{tmp_path}/i/postings").collect()}
    assert got == {("a", 1, 2, 3, 0, None), ("b", 1, 1, 3, 0, None), ("c", 1, 0, None, 1, 1), ("a", 2, 0, None, 1, 1)}


def test_contracts_are_dealt_by_their_number(spark, sf, monkeypatch):
    from tallyfold.plans import queries as Q
    from tallyfold.plans import views
    from tallyfold.sources import scratch

    n = views.lines(spark, sf)
    want = sorted(map(tuple, Q.collapse_modifications(spark, sf).collect()))
    monkeypatch.setattr(scratch, "ROWS_PER_TASK", n // 11)
    got = Q.collapse_modifications(spark, sf)
    assert got.rdd.getNumPartitions() in (11, 12) and sorted(map(tuple, got.collect())) == want


def test_contracts_are_dealt_whatever_the_session_has(spark, sf, monkeypatch):
    """With more shuffle partitions than the rows need they are dealt all the same: else Spark joins the partitions to few large ones."""
    from tallyfold.plans import queries as Q
    from tallyfold.plans import views
    from tallyfold.sources import scratch

    monkeypatch.setattr(scratch, "ROWS_PER_TASK", views.lines(spark, sf) // 11)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert Q.collapse_modifications(spark, sf).rdd.getNumPartitions() == 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_khop_lists_and_parts(spark, monkeypatch):
    from tallyfold.operators import graph

    monkeypatch.setattr(graph, "LIST", 4)
    # A hub's neighbours come in several lists; walks of one seed that end alike leave a batch once.
    edges = spark.createDataFrame([("hub", f"n{i}") for i in range(50)] + [(f"n{i}", f"m{i % 3}") for i in range(50)] + [("m0", "hub")], "src string, dst string")
    got = {(r.seed, r.node): r.hops for r in graph.khop(edges, spark.createDataFrame([("m1",), ("hub",), ("alone",)], "node string"), 2).collect()}
    want = {("alone", "alone"): 0, ("m1", "m1"): 0, ("m1", "hub"): 2, ("hub", "hub"): 0, ("hub", "m0"): 1, ("hub", "m1"): 2, ("hub", "m2"): 2}
    want |= {("m1", f"n{i}"): 1 for i in range(50) if i % 3 == 1} | {("hub", f"n{i}"): 1 for i in range(50)}
    assert got == want
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"seed": pa.array([1, 1, 2]), "part": pa.array([0, 0, 0], pa.int32()), "hops": pa.array([1, 1, 1], pa.int32()), "near": pa.array([[5, 6], [6, 7], [6]])})
    assert next(graph._once(iter([batch]))).column("near").to_pylist() == [[5, 6, 7], [6]]


def test_contained_needles_are_met_by_runs(spark, monkeypatch):
    """Texts of the same frequent words meet a needle only where a run of its words is theirs."""
    from tallyfold.operators import matching

    pairs = []
    real = matching._confirmed
    monkeypatch.setattr(matching, "_confirmed", lambda p, n, h: pairs.append(p.distinct().count()) or real(p, n, h))
    words = [f"w{i}" for i in range(12)]
    hay = spark.createDataFrame([(i, " ".join(words[i % 12:] + words[:i % 12][::-1])) for i in range(120)] + [(500, None), (501, "")], "h_id long, text string")
    needles = spark.createDataFrame([(1, " ".join(words)), (2, "w3 w4 w5"), (3, "4 w5"), (4, "w9 w8 w7 w6 w5 w4"), (5, "")], "n_id long, text string")
    got = sorted(map(tuple, matching.contained(needles.filter("n_id <> 3"), hay).collect()))
    texts = {r.h_id: r.text or "" for r in hay.collect()}
    want = sorted((n.n_id, k) for n in needles.collect() for k, t in texts.items() if n.text and n.text in t)
    assert got == [x for x in want if x[0] != 3] and len(got) == 70
    assert pairs[0] < 300  # by single words every text is met by every needle of three words or more: 360
    assert sorted(map(tuple, matching.contained(needles, hay).collect())) == want


def test_cascade_sends_no_table_through_the_driver(spark):
    """Tables whose files are small are joined by sorting all the same: their names' forms aren't small."""
    rows = [(1, "1.5", "Acme Holding", "A"), (2, None, "Acme Holdinx", "A"), (3, None, "Nobody", "A")]
    w = spark.createDataFrame(rows, "id int, tax_id string, name string, country string")
    k = spark.createDataFrame([(7, "1.5", "Other", "B"), (8, None, "Acme Holding", "A")], "entity int, tax_id string, name string, country string")
    out = resolve.cascade(w, k)
    assert {(r.id, r.tier) for r in out.collect()} == {(1, "tax"), (2, "fuzzy"), (3, "minted")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 6


def _walk(edges, seed):
    """Fewest hops from seed to all nodes that it reaches."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    hops, last = {seed: 0}, [seed]
    while last:
        last = sorted({n for m in last for n in near.get(m, ())} - hops.keys())
        hops |= dict.fromkeys(last, 1 + max(hops.values()))
    return hops


def _random_graphs():
    import random

    r = random.Random(4)
    yield [(r.randrange(40), r.randrange(40)) for _ in range(50)] + [(7, 7)]  # any node with any
    yield [(2 * r.randrange(60), 2 * r.randrange(30) + 1) for _ in range(90)]  # two sides
    yield [(0, i) for i in range(1, 40)] + [(1, -(1 << 62)), (-(1 << 62), (1 << 62) + 5), (500, 501)]  # a hub, far numbers, a part of its own


def test_paths_of_random_graphs(spark, monkeypatch):
    """Lists, parts and first tries of a few nodes at most: no pair's hops change, none is lost."""
    from tallyfold.operators import graph

    monkeypatch.setattr(graph, "LIST", 3)
    monkeypatch.setattr(graph, "TRIED", 1)
    monkeypatch.setattr(graph, "MORE", 6)
    for reach, edges in zip((4_000_000, 7, 4_000_000), _random_graphs(), strict=True):
        monkeypatch.setattr(graph, "REACH", reach)
        nodes = sorted({n for e in edges for n in e})[:25]
        pairs = [(a, b) for a in nodes for b in nodes if (a + b) % 3] + [(nodes[0], nodes[0]), (nodes[0], 999), (None, nodes[0])]
        got = graph.shortest_paths(spark.createDataFrame([*edges, (None, nodes[0]), (nodes[0], None)], "src long, dst long"), spark.createDataFrame(pairs, "src long, dst long"), 5)
        reached = {a: _walk(edges, a) for a in nodes}
        want = sorted({(a, b, reached[a][b]) for a, b in pairs if a is not None and reached[a].get(b, 9) <= 5})
        assert sorted(map(tuple, got.collect())) == want and want


def test_paths_write_no_second_step(spark, monkeypatch):
    """Pairs four hops apart are met without writing what is two hops from an end."""
    from tallyfold.operators import graph

    written = []
    real = graph.kept
    size = lambda df: df.agg(F.sum("n")).first()[0] if "n" in df.columns else df.count()
    monkeypatch.setattr(graph, "kept", lambda df, name: (written.append(size(df)) if name == "frontier" else None, real(df, name))[1])
    # Each of 100 suppliers has 5 customers of its own; each customer has the same 50 others.
    edges = [(10_000 + 5 * s + c, s) for s in range(100) for c in range(5)] + [(10_000 + 5 * s + c, 1000 + o) for s in range(100) for c in range(5) for o in range(50)]
    pairs = [(s, s + 1) for s in range(99)]
    got = graph.shortest_paths(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame(pairs, "src long, dst long"), 4)
    assert {(r.src, r.dst): r.hops for r in got.collect()} == dict.fromkeys(pairs, 4)
    assert 0 < sum(written) <= 2 * 5 * len(pairs)  # with the others: 50 a pair and more


def test_khop_of_random_graphs(spark, monkeypatch):
    from tallyfold.operators import graph

    monkeypatch.setattr(graph, "LIST", 3)
    for reach, edges in zip((7, 4_000_000, 4_000_000), _random_graphs(), strict=True):
        monkeypatch.setattr(graph, "REACH", reach)
        seeds = sorted({n for e in edges for n in e})[:20]
        e, s = spark.createDataFrame([*edges, (seeds[0], None)], "src long, dst long"), spark.createDataFrame([(n,) for n in [*seeds, 777, None]], "node long")
        # A missing node is reached, but leads nowhere.
        want = {(a, n): h for a in seeds for n, h in _walk(edges, a).items() if h <= 3} | {(777, 777): 0, (None, None): 0}
        want |= {(a, None): h + 1 for a in seeds if (h := _walk(edges, a).get(seeds[0], 9)) <= 2}
        assert {(r.seed, r.node): r.hops for r in graph.khop(e, s, 3).collect()} == want
        sizes = {}
        for (a, _), h in want.items():
            sizes[a, h] = sizes.get((a, h), 0) + 1
        assert {(r.seed, r.hops): r.nodes for r in graph.khop_sizes(e, s, 3).collect()} == sizes


def test_lists_are_small_and_whole():
    import numpy as np
    import pyarrow as pa

    from tallyfold.operators import graph

    lists = [[5], list(range(1, 720_001, 18_000)), [graph.MISSING, -3, 0, 127, 128, (1 << 63) - 1], [7, 8]]
    arrays = graph._packed(np.concatenate([np.array(x, np.int64) for x in lists]), np.array([len(x) for x in lists]))
    batch = pa.RecordBatch.from_arrays(arrays, ["n", "first", "rest"])
    assert graph._unpacked(batch).to_pylist() == lists and graph._unpacked(batch.slice(1, 2)).to_pylist() == lists[1:3]
    assert len(arrays[2][1].as_py()) <= 3 * 39  # as long numbers 320
    # A seed's rows lie in two batches: its nodes are counted once.
    keys = [pa.array([1, 1], pa.int64()), pa.array([0, 0], pa.int32()), pa.array([1, 1], pa.int32())]
    halves = [pa.RecordBatch.from_arrays([*keys, *graph._packed(np.array(x), np.array([2, 1]))], ["seed", "part", "hops", "n", "first", "rest"]) for x in ([1, 2, 3], [3, 4, 2])]
    for most in (1, 100):
        assert [b.to_pydict() for b in graph._fewest_sizes(iter(halves), most)] == [{"seed": [1], "hops": [1], "nodes": [4]}]


def test_khop_counts_nodes_where_they_meet(spark, sf):
    """A seed's nodes aren't dealt once more to be counted."""
    from tallyfold.plans import queries as Q

    plan = Q.khop(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(seed" in plan and not any("hashpartitioning(seed" in x and "node#" in x for x in plan.splitlines())
