"""Readers of reports, metadata, petitions, triples, indices and shapes over small files."""

import datetime
import json

from tallyfold.sources import reports


def written(folder, text, name="a.txt"):
    (folder / name).write_text(text)
    return str(folder)


def test_index_passes_over_unknown_lines(spark, tmp_path):
    text = "stray: 1\n# note\n'AB.C':\n  last: '2024-01-02'\n  last: 2024-01-03\n  rows: ~\n  nothing\nXY:\n\nZ:\n  url: http://a:8/b\n"
    got = {r["ticker"]: r["fields"] for r in reports.price_index(spark, written(tmp_path, text)).collect()}
    assert got == {"AB.C": {"last": "2024-01-03", "rows": None}, "XY": {}, "Z": {"url": "http://a:8/b"}}


def test_triples_with_blank_nodes_escapes_and_bad_lines(spark, tmp_path):
    text = '_:a <urn:p> _:b .\n<urn:s> <urn:p> "x \\"y\\" . z"@fr .\nnot a triple\n<urn:s> <urn:p> "" .\n'
    got = sorted(tuple(r) for r in reports.ntriples(spark, written(tmp_path, text)).collect())
    assert got == sorted([("_:a", "urn:p", "_:b", None, None), ("urn:s", "urn:p", 'x "y" . z', "fr", None), ("urn:s", "urn:p", "", None, None)])


def test_whole_documents_in_files(spark, tmp_path):
    doc = {"lei": "L" * 20, "name": "n", "country": "SE", "filings": [{"year": 2020, "revenue": 5}, {"year": 1800, "revenue": 6}, {"revenue": 7}]}
    path = written(tmp_path, json.dumps(doc, indent=1), "a.json")
    written(tmp_path, json.dumps(doc | {"lei": "short"}, indent=1), "b.json")
    got = reports.annual_reports_json(spark, path, ["revenue"], {"SE": "SEK"}).collect()
    assert [tuple(r) for r in got] == [("L" * 20, "n", "SE", "SEK", 2020, 5.0)]


def test_metadata_without_date_is_of_now(spark, tmp_path):
    doc = {"label": "x", "updated": "?", "id": ["freq", "unit"], "size": [1, 2], "dimension": {"freq": {"category": {"label": {"A": "a"}}}, "unit": {"category": {"label": {"E": "euro"}}}}}
    (row,) = reports.cube_metadata_json(spark, written(tmp_path, json.dumps(doc, indent=1), "a.json")).collect()
    assert row["labels"] == {"unit": {"E": "euro"}} and row["sizes"] == [1, 2] and abs((row["updated"] - datetime.datetime.now()).days) <= 1


def test_shapes_and_list(spark, tmp_path):
    feature = lambda code, shape, **more: {"properties": {"NUTS_ID": code} | more, "geometry": shape}
    square = {"type": "Polygon", "coordinates": [[[0, 0, 1], [1.25, 2], [0, 0]]]}
    doc = {"features": [feature("AB", square, NUTS_NAME="b"), feature("ABC", square), feature("AD", {"type": "Polygon", "coordinates": []}), feature(None, square), feature("AE", {"type": "Point", "coordinates": [1, 2]}), feature("AF", None)]}
    shapes = reports.region_shapes(spark, written(tmp_path, json.dumps(doc, indent=1), "a.json"))
    assert [tuple(r) for r in reports.region_list(shapes).collect()] == [("AB", "b", 0), ("ABC", "ABC", 1)]
    assert {r["wkt"] for r in shapes.collect()} == {"MULTIPOLYGON(((0 0, 1.25 2, 0 0)))"}


def test_facts_years_forms_and_fallbacks(spark):
    day = datetime.date
    fact = lambda concept, value, form, kind, start, end, filed, fp="FY": ("e", concept, value, form, fp, kind, start, end, filed)
    rows = [fact("rev", 1.0, "10-K", "duration", day(2020, 1, 1), day(2020, 12, 31), day(2021, 2, 1)), fact("rev", 2.0, "10-K", "duration", day(2020, 1, 1), day(2020, 12, 31), day(2022, 2, 1)),
            fact("rev", 9.0, "10-K", "duration", day(2021, 10, 1), day(2021, 12, 31), day(2022, 2, 1)), fact("eq", 3.0, "20-F", "instant", None, day(2021, 12, 31), day(2022, 2, 1)),
            fact("eq", 4.0, "10-Q", "instant", None, day(2022, 3, 31), day(2022, 5, 1), "Q1"), fact("eq", None, "10-K", "instant", None, day(2019, 12, 31), day(2020, 2, 1)), fact("x", 5.0, "10-K", "duration", None, day(2019, 12, 31), day(2020, 2, 1))]
    facts = spark.createDataFrame(rows, reports.FACT)
    assert sorted(tuple(r) for r in reports.concept_years(facts).collect()) == [("e", "eq", 2021, 3.0), ("e", "rev", 2020, 2.0)]
    assert [tuple(r) for r in reports.common_form(facts).collect()] == [("e", "10-K")]
    assert [tuple(r) for r in reports.common_form(facts.filter("form = '20-F' OR form = '10-Q'").replace("20-F", "8-K", "form")).collect()] == [("e", "10-K")]
    years = spark.createDataFrame([("a", 1, 5.0, 2.0, None, 3.0, 1.0), ("a", 2, 5.0, 2.0, 4.0, 3.0, None), ("b", 1, 5.0, 2.0, None, None, 1.0)],
                                  "entity string, year int, assets double, liabilities double, equity double, operating_cashflow double, capex double")
    assert sorted((r["entity"], r["year"], r["equity"], r["free_cashflow"]) for r in reports.derived_fields(years).collect()) == [("a", 1, None, 2.0), ("a", 2, 4.0, None), ("b", 1, 3.0, None)]


def test_petitions_edge_cases(spark, tmp_path):
    docs = [{"id": 1, "comRegNum": "p", "linguisticVersions": [{"languageCode": "FR", "title": " t "}], "progress": [{"name": "R", "date": "2020-01-02"}, {"name": "R", "date": "bad"}],
             "members": [{"fullName": " a ", "type": "T"}, {"fullName": "b", "privacyApplied": True}, {"fullName": " "}], "funding": {"sponsors": [{"amount": 2.5}, {}]}}, {"id": 2, "comRegNum": "q"}]
    got = {r["petition"]: r for r in reports.petitions_json(spark, written(tmp_path, "\n".join(map(json.dumps, docs)), "a.json"), {"R": "registered"}).collect()}
    assert (got["p"]["title"], got["p"]["organizers"], got["p"]["countries"], got["p"]["funding"], got["p"]["sponsors"], got["p"]["registered"]) == ("t", ["a"], [""], 2.5, 2, datetime.date(2020, 1, 2))
    assert got["q"]["title"] is None and got["q"]["registered"] is None and got["q"]["funding"] == 0 and got["q"]["sponsors"] == 0
