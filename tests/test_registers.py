"""Readers, writers, matching and states on small fixtures, matching against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import identifiers as I
from tallyfold.operators import folding, graph, matching, panels
from tallyfold.sources import registers, sinks


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_identifiers(spark):
    one = spark.range(1)
    show = lambda c: one.select(c.alias("x")).first()["x"]
    lit = F.lit
    assert show(I.vat(lit("fr 12-345.678901"))) == "FR12345678901" and show(I.vat(lit("12345678901234"))) is None
    assert show(I.siret(lit("123 456 789 01234"))) == "12345678901234" and show(I.lei(lit(" abcdefghij0123456789 "))) == "ABCDEFGHIJ0123456789"
    assert [show(I.cik(lit(x))) for x in ("000012", "0", "", "1a")] == ["12", "0", None, None]
    assert show(I.notice_like(lit("12-34-5-1"))) and not show(I.notice_like(lit("12-34")))
    assert show(I.document_number(lit("C_2026_0411"))) == "C(2026)411"
    assert show(I.normal_text(lit("  Čá-Ünder   ﬁ été! "))) == "ca under fi ete" or show(I.normal_text(lit("Čá-Ünder été!"))) == "ca under ete"
    assert [show(I.duration_seconds(lit(x))) for x in ("1d", "12h", "30m", "90s", "x")] == [86400, 43200, 1800, 90, None]
    assert [show(I.shown_number(lit(x))) for x in (3.0, 2.75)] == ["3", "2.75"]
    assert [show(I.act_kind(lit(x))) for x in ("32016R0679", "32016Z0679", "52023DC8362", "1")] == ["Regulation", "Legal act", "Preparatory act", "Legal document"]
    assert show(I.search_terms(lit("Acme (Gmb-H"))) == "+acme +gmb +h*" and show(I.search_terms(lit("()"))) == ""
    assert [show(I.region_level(lit(x))) for x in ("PT", "PT17A", "P")] == [0, 3, None] and show(I.region_parent(lit("PT17A"))) == "PT17"
    assert [str(show(I.date_of(lit(x)))) for x in ("03/04/2020", "2020-04-03T10:00", "soon")] == ["2020-04-03", "2020-04-03", "None"]


def norm(t):
    return " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())


def test_contained_and_covered_like_brute_force(spark):
    rng = random.Random(3)
    words = ["ab", "b", "abc", "cab", "the", "of", "bca", "aa"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    needles = [(i, text(4)) for i in range(60)] + [(60, ""), (61, None), (62, "zz q"), (63, "b"), (64, "a")]
    hay = [(i, text(9)) for i in range(40)] + [(40, None), (41, "")]
    n, h = spark.createDataFrame(needles, "n_id int, text string"), spark.createDataFrame(hay, "h_id int, text string")
    want = sorted((i, j) for i, a in needles for j, b in hay if norm(a or "") and norm(a or "") in norm(b or ""))
    assert sorted(tuple(r) for r in matching.contained(n, h).collect()) == want and want
    bag = lambda t: set(norm(t or "").split())
    want = sorted((i, j) for i, a in needles for j, b in hay if bag(a) - set(I.TITLE_STOP) and bag(a) - set(I.TITLE_STOP) <= bag(b))
    assert sorted(tuple(r) for r in matching.covered(n, h).collect()) == want and want


def test_answers_are_linked_closed(spark):
    d = dt.date
    p = [(1, ["C(2023)1"], "save bees", d(2020, 1, 1)), (2, [], "end the cage age", d(2020, 1, 1)), (3, [], "water right", d(2020, 1, 1)), (4, [], "far away", d(2020, 1, 1)),
         (5, [], "shared one", d(2020, 1, 1)), (6, [], "one shared", d(2020, 1, 1)), (7, None, "no act", None)]
    a = [("A", "C(2023)1", "other", d(2025, 1, 1)), ("B", None, "on End the Cage Age!", d(2020, 2, 1)), ("C", None, "right to water", d(2020, 1, 20)), ("D", None, "far away", d(2021, 1, 1)), ("E", None, "shared one", d(2020, 1, 1))]
    out = matching.link_answers(spark.createDataFrame(p, "n_id int, refs array<string>, text string, day date"), spark.createDataFrame(a, "h_id string, number string, text string, day date"))
    assert got(out) == [(1, "A", "ref-exact", 0), (2, "B", "title-substring", 31), (3, "C", "title-tokens", 19)]


def test_paths(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "d"), ("d", "e"), ("e", "c"), ("c", "f")], "src string, dst string")
    pairs = spark.createDataFrame([("a", "c"), ("a", "f"), ("a", "a"), ("a", "z")], "src string, dst string")
    short = graph.shortest_paths(e, pairs, 4)
    assert got(short) == [("a", "a", 0), ("a", "c", 2), ("a", "f", 3)]
    assert got(graph.simple_paths(e, pairs, short.filter("hops > 0"))) == [("a", "c", ["a", "d", "e", "c"], 3), ("a", "f", ["a", "d", "e", "c", "f"], 4)]
    assert got(graph.merge_nodes(e, spark.createDataFrame([("d", "b")], "node string, canonical string"))) == [("a", "b"), ("b", "c"), ("b", "e"), ("c", "f"), ("e", "c")]


def test_states(spark):
    s = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    i = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, t int")
    assert got(folding.upsert(s, i, ["k"], ["t"])) == [(1, "a", 1), (2, "y", 2), (3, "z", 1)]
    assert got(folding.insert_absent(s, i, "k")) == [(1, "a", 1), (2, "b", 1), (3, "z", 1)]
    assert got(folding.snapshot_changes(s, i.filter("t = 1"), "k")) == [(1, "delete"), (2, "update"), (3, "insert")]
    c = spark.createDataFrame([("x", ["a"], True), ("y", ["b"], True)], "code string, dims array<string>, enabled boolean")
    n = spark.createDataFrame([("x", [], None), ("z", ["c"], True)], "code string, dims array<string>, enabled boolean")
    assert got(folding.upsert_filled(c, n, "code", ["dims"])) == [("x", ["a"], True), ("y", ["b"], True), ("z", ["c"], True)]
    assert got(folding.disable_others(c, c.filter("code = 'x'"), "code")) == [("x", ["a"], True), ("y", ["b"], False)]
    d = spark.createDataFrame([("e", 1, 5, 2, False), ("g", 1, 1, 1, False)], "entity string, first_seen int, last_changed int, edit_count long, is_deleted boolean")
    late = spark.createDataFrame([("e", 0, 3, 1, True)], d.schema)
    assert got(folding.merge_changes(d, late)) == [("e", 0, 5, 3, False), ("g", 1, 1, 1, False)]
    assert got(folding.done(d, spark.createDataFrame([("e", 4), ("g", 1)], "entity string, last_changed int")).select("entity")) == [("e",)]


def test_outcomes_and_decisions(spark):
    rows = spark.createDataFrame([("a", None, "a", None, "in_progress", 0), ("b", None, "b", None, None, 1), ("c", "p", "p", None, "pending", 0), ("d", None, "d", "7", "done", 0), ("e", None, "9", None, "pending", 0), ("f", None, "f", None, "pending", 0)],
                                 "id string, procedure string, contract_key string, number string, state string, attempts int")
    o = spark.createDataFrame([("a", "done", "5"), ("b", "transient_error", None), ("c", "done", "6"), ("d", "done", "8"), ("f", "done", "9")], "id string, outcome string, found string")
    assert got(folding.record_outcomes(rows, o)) == [("a", None, "5", "5", "done", 0), ("b", None, "b", None, "transient_error", 2), ("c", "p", "p", "6", "done", 0), ("d", None, "d", "7", "done", 0), ("e", None, "9", None, "pending", 0), ("f", None, "f", "9", "done", 0)]
    q = spark.createDataFrame([(1, "pending", 5.0, 0.1), (2, "pending", 5.0, 0.1), (3, "pending", 5.0, 0.1), (4, "pending", 5.0, 0.1)], "id int, state string, value double, confidence double")
    v = spark.createDataFrame([(1, "corrected", 7.0), (2, "confirmed_bogus", None), (3, "corrected", 1e12)], "id int, verdict string, corrected double")
    assert got(folding.decide(q, v)) == [(1, "corrected", 7.0, 1.0), (2, "confirmed_bogus", None, 0.1), (3, "pending", 5.0, 0.1), (4, "pending", 5.0, 0.1)]


def test_money(spark):
    d = dt.date
    a = spark.createDataFrame([("PLN", d(2020, 1, 1), 8.0), ("PLN", d(2020, 1, 5), 8.0), ("PLN", d(2020, 4, 5), 8.0), ("EUR", d(2020, 1, 1), 3.0), ("XXX", d(2020, 1, 1), 3.0)], "currency string, day date, amount double")
    r = spark.createDataFrame([("PLN", d(2020, 1, 2), 4.0), ("PLN", d(2020, 2, 2), 2.0)], "currency string, day date, per_euro double")
    assert got(panels.to_euro(a, r).select("currency", "day", "eur")) == sorted([("PLN", d(2020, 1, 1), None), ("PLN", d(2020, 1, 5), 2.0), ("PLN", d(2020, 4, 5), 4.0), ("EUR", d(2020, 1, 1), 3.0), ("XXX", d(2020, 1, 1), None)], key=repr)


@pytest.fixture
def folder(tmp_path):
    return lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)


def test_xml_registers(spark, folder):
    rel = lambda a, b, k, s: f"<rr:RelationshipRecord><rr:Relationship><rr:StartNode><rr:NodeID>{a}</rr:NodeID></rr:StartNode><rr:EndNode><rr:NodeID>{b}</rr:NodeID></rr:EndNode><rr:RelationshipType>{k}</rr:RelationshipType><rr:RelationshipStatus>{s}</rr:RelationshipStatus></rr:Relationship></rr:RelationshipRecord>"
    direct = "IS_DIRECTLY_CONSOLIDATED_BY"
    f = folder("rr.xml", '<rr:Data xmlns:rr="urn:x">' + rel("A", "B", direct, "ACTIVE") + rel("A", "A", direct, "ACTIVE") + rel("C", "B", direct, "INACTIVE") + "</rr:Data>")
    assert got(registers.relationships_xml(spark, f)) == [("A", "B", "direct")]
    f = folder("s.xml", """<export><sanctionEntity euReferenceNumber="EU.1"><subjectType code="enterprise"/><nameAlias wholeName="Foo"/><nameAlias firstName="Bar" lastName="Baz"/><nameAlias wholeName="Foo"/>
      <address countryIso2Code="00" countryDescription="UNKNOWN"/><identification countryIso2Code="RU"/><regulation publicationDate="2020-02-01" programme=""/><regulation publicationDate="2019-01-05" programme="UKR"/></sanctionEntity></export>""")
    assert got(registers.sanctions_xml(spark, f)) == [("EU.1", ["Foo", "Bar Baz"], "Foo", "entity", "RU", "2019-01-05", "UKR")]
    f = folder("l.xml", """<l><interestRepresentative><identificationCode>1</identificationCode><name><originalName>X</originalName></name><registrationDate>2020-01-02T00</registrationDate>
      <financialData><closedYear><costs><range><min>20</min><max>10</max></range></costs></closedYear></financialData><interests><interest><name>Trade</name></interest></interests></interestRepresentative></l>""")
    r = registers.lobbyists_xml(spark, f).first()
    assert (r["cost_low"], r["cost_high"], r["registered"], r["interests"]) == (10, 20, "2020-01-02", ["Trade"])
    f = folder("c.xml", """<c><Row><Value ColumnRef="code"><SimpleValue>45200000</SimpleValue></Value><Value ColumnRef="parentCode"><SimpleValue>45000000</SimpleValue></Value><Value ColumnRef="eng_label"><SimpleValue>Works</SimpleValue></Value></Row></c>""")
    assert got(registers.codes_xml(spark, f, {"eng": "en"})) == [("45200000", "45000000", "en", "Works", 3)]
    f = folder("f.xml", """<f><NewRcrd><FinInstrmGnlAttrbts><Id>DE0000000001</Id><FullNm>N</FullNm><ClssfctnTp>ESVUFR</ClssfctnTp><NtnlCcy>EUR</NtnlCcy></FinInstrmGnlAttrbts><Issr>ABCDEFGHIJ0123456789</Issr><TradgVnRltdAttrbts><Id>XETR</Id></TradgVnRltdAttrbts></NewRcrd>
      <TermntdRcrd><FinInstrmGnlAttrbts><Id>DE0000000002</Id><FullNm>M</FullNm><ClssfctnTp>CIXXXX</ClssfctnTp></FinInstrmGnlAttrbts><Issr>short</Issr></TermntdRcrd></f>""")
    assert got(registers.instruments_xml(spark, f).select("isin", "kind", "venue", "lei", "active")) == [("DE0000000001", "equity", "XETR", "ABCDEFGHIJ0123456789", True), ("DE0000000002", "fund", None, None, False)]


def test_text_registers(spark, folder):
    head = "Operation_Unique_Identifier,Operation_Name_English,Operation_Name_Programme_Language,Total_Eligible_Expenditure_amount,Project_EU_Budget,Operation_Start_Date,Operation_End_Date,NUTS3_Code,NUTS2_Code,NUTS1_Code,CountryCode,Beneficiary_Name,Beneficiary_Unique_Identifier\n"
    f = folder("k.csv", head + 'http://x/Q12,,"Pont, neuf","1,000.5",7,03/04/2020,,,FR10,FR1,FR,nan,http://x/Q9\nnone,a,b,1,1,,,,,,FR,B,\n')
    assert got(registers.projects_csv(spark, f, "2020-01-01").drop("start", "end")) == [("Q12", "Pont, neuf", 1000.5, 7.0, "FR10", "FR", None, "Q9", None, None, None)]
    assert got(registers.isins_csv(spark, folder("i.csv", "LEI,ISIN\nA,X\nB,Y\n"), spark.createDataFrame([("A",)], "lei string"))) == [("A", "X")]
    with pytest.raises(ValueError):
        registers.isins_csv(spark, folder("j.csv", "ISIN,LEI\nA,X\n"))
    assert got(registers.tickers_json(spark, folder("t.json", '{"0": {"cik_str": 12, "ticker": "ab", "title": "Ab Co"}}'))) == [("AB", "0000000012", "Ab Co", "ab co")]
    assert got(registers.catalogue_tsv(spark, folder("toc.txt", "title\tcode\tlast update of data\nx\tabc\t05.02.2021\ny\tfolder\t \n"))) == [("abc", dt.date(2021, 2, 5))]


def test_writers(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    for _ in range(2):
        sinks.append_events(rows, at("log"), "me", "upsert", "id", batch="b1")
    assert spark.read.parquet(at("log")).count() == 2
    sinks.replace_partitions(rows, at("p"), "id")
    sinks.replace_partitions(spark.createDataFrame([(2, "c")], rows.schema), at("p"), "id")
    assert got(spark.read.parquet(at("p")).select("id", "name")) == [(1, "a"), (2, "c")]
    sinks.spreadsheet(spark.createDataFrame([("T", 2020, 1.0, 2.5), ("T", 2021, None, 3.0)], "ticker string, year int, a double, b double"), at("s"), "ticker", ["a", "b"])
    assert got(spark.read.option("header", True).csv(at("s")).select("year", "a", "b", "ticker")) == [("2020", "1", "2.50", "T"), ("2021", None, "3", "T")]
    names = spark.createDataFrame([("1", "Haus", "de"), ("2", "House", None)], "id string, name string, lang string")
    sinks.translation_requests(names, at("t"), ["de", "en", "fr"])
    assert got(spark.read.json(at("t")).select("id", "source", "targets")) == [("1", "de", ["en", "fr"]), ("2", "en", ["de", "fr"])]
    (tmp_path / "answers.json").write_text('{"id": "1", "names": {"en": " House ", "de": "Haus", "xx": "y", "fr": ""}}\n')
    assert got(sinks.translations(spark, at("answers.json"), names, ["de", "en", "fr"])) == [("1", "en", "House")]
    assert sinks.manifest(spark, at("answers.json")).first()["bytes"] == (tmp_path / "answers.json").stat().st_size
    left, counts = sinks.erase(spark.createDataFrame([(1,)], "id int"), {"n": (rows, "id")})
    assert got(left["n"]) == [(2, "b")] and got(counts) == [("n", 1)]
