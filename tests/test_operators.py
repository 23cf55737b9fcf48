"""Golden cases of the operators and readers."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.operators import finance, procurement, resolve
from tallyfold.plans import adhoc
from tallyfold.sources import readers
from tallyfold.streaming import dirty_set

VALUES = [
    (7317073.17, 7274615.93, 7274615930.0, True, "ok"),
    (100000.0, 98000.0, 98000.0, True, "ok"),
    (480000000.0, 500000000.0, 500000000.0, True, "ok"),
    (1083901.24, 1073062200000.0, 1073062200000.0, False, "implausible_magnitude"),
    (2997320.6, 252295847646.0, None, False, "value_disagreement"),
    (172000000.0, 182082833599378.0, None, False, "implausible_magnitude"),
    (72000000.0, 75968000000.0, None, False, "value_disagreement"),
    (None, 33260500000.0, None, False, "implausible_magnitude"),
    (35000094166.0, 29745741813.0, None, False, "implausible_magnitude"),
    (204000000.0, None, 20788495891.0, False, "value_disagreement"),
    (15000000000.0, 19000000000.0, None, False, "implausible_magnitude"),
    (None, 274166.0, 490.0, True, "ok"),
    (None, 1414542.0, 1414542000.0, True, "ok"),
    (None, 0.0, None, False, "zero_value"),
    (None, None, None, False, "no_awarded_value"),
    (None, -5.0, None, False, "concession_negative"),
]


def test_value_confidence(spark):
    df = spark.createDataFrame([(i, *v[:3]) for i, v in enumerate(VALUES)], "i int, estimate double, total double, payable double")
    got = {r["i"]: (not r["low_confidence"], r["flag"]) for r in procurement.value_confidence(df).collect()}
    assert got == {i: v[3:] for i, v in enumerate(VALUES)}


SCALES = [
    (9289549170.0, 9281922790.0, 9281922790.0, "PRT", "country_prior", 9281922.79),
    (7317073.17, 7274615930.0, 7274615930.0, "PRT", "ratio", 7274615.93),
    (3219000000.0, 3219000.0, None, "PRT", "ratio", 3219000.0),
    (150000.0, 149500.0, 149500.0, "PRT", None, 149500.0),
    (15.4e9, 15.47e9, None, "POL", None, 15.47e9),
    (None, 2e9, None, "PRT", "country_prior", 2e6),
    (None, 1.2e9, None, "ESP", None, 1.2e9),
    (200000.0, None, 199000000.0, "PRT", "ratio", None),
    (5169000.0, 5169000000.0, None, "POL", None, 5169000000.0),
    (7317073.17, 7274615930.0, None, "NLD", "ratio", 7274615.93),
    (4334378400.0, None, None, "PRT", "country_prior", None),
    (925162000.0, None, None, "PRT", None, None),
]


def test_scale(spark):
    df = spark.createDataFrame([(i, *v[:4]) for i, v in enumerate(SCALES)], "i int, estimate double, total double, payable double, country string")
    for r in procurement.normalise_scale(df).collect():
        want = SCALES[r["i"]]
        assert r["scale_tier"] == want[4]
        assert r["total"] == pytest.approx(want[5]) if want[5] is not None else r["total"] is None


def test_periods(spark):
    want = {"2024": "2024-01-01", "2024-M07": "2024-07-01", "2024M07": "2024-07-01", "2008-01": "2008-01-01", "2024-Q3": "2024-07-01", "2024W01": "2024-01-01", "2024-S2": "2024-07-01", "garbage": None, "": None}
    df = spark.createDataFrame([(k,) for k in want], "p string").withColumn("d", S.period_start(F.col("p")).cast("string"))
    assert {r["p"]: r["d"] for r in df.collect()} == want


def test_uuid5(spark):
    got = spark.range(1).select(S.uuid5(resolve.NAMESPACE, F.lit("lei:ÄB"))).first()[0]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_DNS, "lei:ÄB"))


def test_win_probability(spark):
    closes = [1.00, 1.02, 1.04, 1.06, 1.08, 1.10, 1.12, 1.14, 1.12, 1.10]
    df = spark.createDataFrame([("a", i, c) for i, c in enumerate(closes)], "ticker string, date int, close double")
    assert finance.win_probability(df).first()["win"] == 0.8


EVENTS = [
    ("log", "", "delete", "delete", "DELETED"), ("log", "", "delete", "restore", "DIRTY"), ("log", "", "delete", "revision", "IGNORE"), ("log", "", "block", "block", "IGNORE"),
    ("edit", "/* wbsetsitelink-add:1|enwiki */ x", None, None, "IGNORE"), ("edit", "/* wbsetlabel-add:1|fr */ x", None, None, "DIRTY"), ("edit", "/* wbsetdescription-add:1|bn */", None, None, "IGNORE"),
    ("edit", "/* wbsetlabel-set:1|en-gb */", None, None, "IGNORE"), ("edit", "/* wbsetlabel-add */ broken", None, None, "DIRTY"), ("edit", "/* wbcreateclaim-create:1|P31 */", None, None, "DIRTY"), ("edit", None, None, None, "DIRTY"),
]


def test_events(spark):
    df = spark.createDataFrame([(i, *e[:4]) for i, e in enumerate(EVENTS)], "i int, type string, comment string, log_type string, log_action string")
    assert {r["i"]: r["action"] for r in dirty_set.classify(df).collect()} == {i: e[4] for i, e in enumerate(EVENTS)}


def test_cube_tsv(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("freq,unit,geo\\TIME_PERIOD\t2023 \t2024 \nA,EUR,DE1\t1234.5 b p\t:\nA,EUR,FR\t: c\t-12.3\n")
    got = {(r["geo"], str(r["time"])): (r["value"], r["flags"]) for r in readers.cube_tsv(spark, str(tmp_path / "c.tsv"), "x").collect()}
    assert got == {("DE1", "2023-01-01"): (1234.5, ["b", "p"]), ("FR", "2023-01-01"): (None, ["c"]), ("FR", "2024-01-01"): (-12.3, [])}


def test_adhoc_guard(spark):
    spark.range(2000).createOrReplaceTempView("numbers")
    assert adhoc.run(spark, "SELECT id FROM numbers WHERE id >= :a", {"a": 0}).count() == adhoc.MOST_ROWS + 1
    for bad in ("DROP VIEW numbers", "CREATE TABLE t (a int)", "INSERT INTO t VALUES (1)", "SET a=b"):
        with pytest.raises(ValueError):
            adhoc.run(spark, bad)


def test_near_names_like_brute_force(spark):
    import random

    from tallyfold.operators import resolve

    rng, near = random.Random(8), 0
    xs = ["".join(rng.choice("ab ") for _ in range(n)).strip() or "a" for n in [1, 5, 8, 9, 10, 11, 17, 18, 19, 20, 27, 30, 31, 40, 45] * 3]

    def changed(t):
        t = list(t)
        for _ in range(rng.randint(0, len(t) // 8)):
            at = rng.randrange(len(t))
            t[at : at + 1] = rng.choice([[], ["c"], [t[at], "c"]])
            t = t or ["c"]
        return "".join(t)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, p in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, q in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != q))
        return row[-1]

    ys = [changed(x) for x in xs for _ in range(4)]
    left = [(x, i % 2) for i, x in enumerate(xs)] + [("", 0), (None, 0)]
    right = [(y, i // 4 % 2) for i, y in enumerate(ys)] + [("", 0), (None, 1)]
    got = {tuple(r) for r in resolve.near_names(spark.createDataFrame(left, "x string, country int"), spark.createDataFrame(right, "y string, country int")).select("x", "y", "country").collect()}
    want = {(x, y, c) for x, c in left for y, d in right if x and y and c == d and 10 * distance(x, y) <= max(len(x), len(y))}
    assert got == want and sum(x != y for x, y, _ in want) > 40


def test_cascade_finds_names_that_differ_in_the_first_word(spark):
    from tallyfold.operators import resolve

    known = spark.createDataFrame([(1, "t1", "Customer#000000012", 7), (2, "t2", "Customer#000000345", 7), (3, "t3", "Customer#000000346", 7), (4, "t4", "Customer#000000099", 8)], "entity long, tax_id string, name string, country int")
    wanted = spark.createDataFrame([(10, "x", "Customer#000000017", 7), (11, "x", "Customer#000000347", 7), (12, "x", "Customer#000000098", 7)], "id long, tax_id string, name string, country int")
    got = {r["id"]: (r["tier"], r["entity"]) for r in resolve.cascade(wanted, known).collect()}
    assert got[10] == ("fuzzy", "1") and got[11][0] == "minted" and got[12][0] == "minted"
