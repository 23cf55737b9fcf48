"""Readers of filed facts, annual reports, cube metadata, petitions, emissions, triples, price indices and region shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Forms that report a whole year, and the days that a year's flow has to span.
ANNUAL_FORMS = ("10-K", "20-F", "40-F")
ANNUAL_DAYS = 340

FACT = "entity string, concept string, value double, form string, fiscal_period string, period_type string, start date, end date, filed date"


def _filled(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def filed_facts_json(spark: SparkSession, path: str) -> DataFrame:
    """Filed facts, one a line."""
    return spark.read.schema(FACT).json(path)


def _whole_year(facts: DataFrame) -> DataFrame:
    long_enough = (F.coalesce("period_type", F.lit("")) != "duration") | (F.date_diff("end", "start") >= ANNUAL_DAYS)
    return facts.filter(F.col("value").isNotNull() & F.col("end").isNotNull() & (F.col("fiscal_period") == "FY") & long_enough)


def concept_years(facts: DataFrame) -> DataFrame:
    """(entity, concept, year, value): the year is the period's, not the filing's; of several filings the latest counts, on one day the larger value."""
    return _whole_year(facts).groupBy("entity", "concept", F.year("end").alias("year")).agg(F.max_by("value", F.struct("filed", "value")).alias("value"))


def common_form(facts: DataFrame, default: str = "10-K") -> DataFrame:
    """(entity, form): the annual form most facts are from, at a tie the first by name; default where there is none."""
    n = F.count(F.when(F.col("form").isin(*ANNUAL_FORMS), 1))
    per = _whole_year(facts).groupBy("entity", "form").agg(n.alias("n"))
    return per.groupBy("entity").agg(F.coalesce(F.min_by(F.when(F.col("n") > 0, F.col("form")), F.struct(-F.col("n"), "form")), F.lit(default)).alias("form"))


def derived_fields(rows: DataFrame, entity: str = "entity") -> DataFrame:
    """Equity as assets less liabilities for entities that report none in any year; free cash flow as operating cash flow less capital expenditure."""
    none = F.max("equity").over(Window.partitionBy(entity)).isNull()
    return rows.withColumn("equity", F.when(none, F.col("assets") - F.col("liabilities")).otherwise(F.col("equity"))).withColumn("free_cashflow", F.col("operating_cashflow") - F.col("capex"))


def annual_reports_json(spark: SparkSession, path: str, fields: list[str], currencies: dict[str, str], first_year: int = 1990, last_year: int | None = None, lines: bool = False) -> DataFrame:
    """(lei, name, country, currency, year, fields...) of summaries with a list of filings, a file or (lines) a line each; an LEI has 20 characters, years up to the next one, euro where no currency is known."""
    filing = ", ".join(["year: int", *(f"`{f}`: double" for f in fields)])
    raw = spark.read.schema(f"lei string, name string, country string, filings array<struct<{filing}>>").option("multiLine", not lines).json(path).filter(F.length("lei") == 20)
    known = F.create_map(*(F.lit(x) for kv in currencies.items() for x in kv)) if currencies else F.lit(None).cast("map<string, string>")
    last = F.lit(last_year) if last_year is not None else F.year(F.current_date()) + 1
    rows = raw.select("lei", "name", "country", F.coalesce(known[F.col("country")], F.lit("EUR")).alias("currency"), F.explode("filings").alias("f"))
    return rows.filter(F.col("f.year").between(F.lit(first_year), last)).select("lei", "name", "country", "currency", "f.year", *(F.col(f"f.`{f}`").alias(f) for f in fields))


def cube_metadata_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(label, updated, dims, sizes, labels) per metadata document, a file or (lines) a line each; labels: dimension to code to text, without frequency and time; now where the date can't be read."""
    schema = "label string, updated string, id array<string>, size array<int>, dimension map<string, struct<category: struct<label: map<string, string>>>>"
    raw = spark.read.schema(schema).option("multiLine", not lines).json(path)
    told = F.map_filter(F.transform_values("dimension", lambda _, d: d.category.label), lambda k, v: ~k.isin("freq", "time") & (F.size(v) > 0))
    return raw.select(F.coalesce("label", F.lit("")).alias("label"), F.coalesce(F.try_to_timestamp("updated"), F.current_timestamp()).alias("updated"), F.col("id").alias("dims"), F.col("size").alias("sizes"), told.alias("labels"))


def petitions_json(spark: SparkSession, path: str, milestones: dict[str, str]) -> DataFrame:
    """(petition, title, status, organizers, roles, countries, funding, sponsors, a date per milestone) of the register's details, one a line; an id that comes again counts once.

    The English version counts, else the first; organizers who asked for privacy or have no name are left out. milestones: step name to column; of steps named alike the last with a date counts."""
    schema = ("id bigint, comRegNum string, status string, linguisticVersions array<struct<languageCode: string, title: string>>, progress array<struct<name: string, date: string>>, "
              "members array<struct<fullName: string, type: string, residenceCountry: string, privacyApplied: boolean>>, funding struct<sponsors: array<struct<amount: double>>>")
    raw = spark.read.schema(schema).json(path).dropDuplicates(["id"])
    version = F.coalesce(F.get(F.filter("linguisticVersions", lambda v: v.languageCode == "EN"), F.lit(0)), F.get("linguisticVersions", F.lit(0)))
    shown = F.filter("members", lambda m: ~F.coalesce(m.privacyApplied, F.lit(False)) & (F.trim(F.coalesce(m.fullName, F.lit(""))) != ""))
    sponsors = F.coalesce(F.col("funding.sponsors"), F.array())
    day = lambda step: F.element_at(F.filter(F.transform(F.filter("progress", lambda p: p["name"] == step), lambda p: F.try_to_date(F.substring(p["date"], 1, 10))), lambda d: d.isNotNull()), -1)
    dated = lambda step: F.when(F.exists("progress", lambda p: (p["name"] == step) & F.try_to_date(F.substring(p["date"], 1, 10)).isNotNull()), day(step))
    return raw.select(F.col("comRegNum").alias("petition"), _filled(version.title).alias("title"), "status", F.transform(shown, lambda m: F.trim(m.fullName)).alias("organizers"),
                      F.transform(shown, lambda m: F.trim(F.coalesce(m.type, F.lit("")))).alias("roles"), F.transform(shown, lambda m: F.trim(F.coalesce(m.residenceCountry, F.lit("")))).alias("countries"),
                      F.aggregate(sponsors, F.lit(0.0), lambda a, s: a + F.coalesce(s.amount, F.lit(0.0))).alias("funding"), F.size(sponsors).alias("sponsors"), *(dated(step).alias(c) for step, c in milestones.items()))


def emissions_json(spark: SparkSession, path: str, year: int) -> DataFrame:
    """(company, country, score, scope1, scope2, year) of one reporting year; rows without a company go, figures that aren't numbers are missing."""
    raw = spark.read.schema("organization string, country string, score string, cdp_score string, scope_1_emissions string, scope1 string, scope_2_emissions string, scope2 string, reporting_year string").json(path)
    number = lambda *names: F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names)).try_cast("double")
    text = lambda *names: F.coalesce(*(_filled(F.col(n)) for n in names))
    return raw.filter((F.col("reporting_year") == str(year)) & text("organization").isNotNull()).select(
        text("organization").alias("company"), text("country").alias("country"), text("score", "cdp_score").alias("score"), number("scope_1_emissions", "scope1").alias("scope1"), number("scope_2_emissions", "scope2").alias("scope2"),
        F.lit(year).alias("year"))


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """(subject, predicate, object, language, datatype) of triple lines; object is the address or the literal's text without escapes of quotes; other lines go."""
    line = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*$'
    part = lambda i: F.regexp_extract("value", line, i)
    literal = F.regexp_replace(part(5), r'\\(["\\])', "$1")
    address = F.coalesce(F.nullif(part(3), F.lit("")), F.nullif(part(4), F.lit("")))
    return spark.read.text(path).filter(F.col("value").rlike(line)).select(
        F.regexp_replace(part(1), "^<|>$", "").alias("subject"), part(2).alias("predicate"), F.coalesce(address, literal).alias("object"), F.nullif(part(6), F.lit("")).alias("language"), F.nullif(part(7), F.lit("")).alias("datatype"))


def price_index(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, fields) of index files: a name at the line's start opens an entry, indented ``key: value`` lines belong to it; comments and other lines are passed over."""
    blocks = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n(?=[^\s#][^\n]*:[ \t]*(?:\n|$))")).alias("block"))
    bare = lambda x: F.regexp_replace(F.trim(x), r"^['\"]+|['\"]+$", "")
    lines = F.filter(F.slice(F.split("block", "\n"), 2, 1 << 30), lambda s: s.contains(":") & ~F.ltrim(s).startswith("#"))
    value = lambda s: F.when(~bare(F.regexp_replace(s, r"^[^:]*:", "")).isin("null", "~", ""), bare(F.regexp_replace(s, r"^[^:]*:", "")))
    head = F.rtrim(F.get(F.split("block", "\n"), F.lit(0)))
    rows = blocks.filter(head.rlike(r"^[^\s#].*:$")).select(bare(F.regexp_replace(head, ":$", "")).alias("ticker"), F.transform(lines, lambda s: F.struct(F.trim(F.regexp_extract(s, r"^([^:]*):", 1)).alias("k"), value(s).alias("v"))).alias("kv"))
    keys = F.array_distinct(F.col("kv.k"))
    return rows.select("ticker", F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter("kv", lambda e: e.k == k), -1).v)).alias("fields"))


def region_shapes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(code, level, name, native, parent, wkt) of feature collections, a file or (lines) a line each; polygons become multipolygons with coordinates as written, features without code or shape go."""
    schema = "features array<struct<properties: struct<NUTS_ID: string, LEVL_CODE: int, NAME_LATN: string, NUTS_NAME: string, NAME: string>, geometry: struct<type: string, coordinates: string>>>"
    f = spark.read.schema(schema).option("multiLine", not lines).json(path).select(F.explode("features").alias("f")).select("f.properties.*", F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("xy"))
    ring = "array<array<string>>"
    shapes = F.when(F.col("type") == "Polygon", F.array(F.from_json("xy", f"array<{ring}>"))).when(F.col("type") == "MultiPolygon", F.from_json("xy", f"array<array<{ring}>>"))
    listed = lambda parts: F.concat(F.lit("("), F.array_join(parts, ", "), F.lit(")"))
    wkt = F.concat(F.lit("MULTIPOLYGON"), listed(F.transform("shapes", lambda p: listed(F.transform(p, lambda r: listed(F.transform(r, lambda c: F.concat_ws(" ", F.slice(c, 1, 2)))))))))
    rows = f.withColumn("shapes", shapes).filter((F.col("NUTS_ID") != "") & (F.size("shapes") > 0) & (F.size(F.get("shapes", F.lit(0))) > 0))
    parent = F.when(F.length("NUTS_ID") > 2, F.expr("left(NUTS_ID, length(NUTS_ID) - 1)"))
    return rows.select(F.col("NUTS_ID").alias("code"), F.coalesce("LEVL_CODE", F.length("NUTS_ID") - 2).alias("level"), F.coalesce(_filled(F.col("NAME_LATN")), F.col("NUTS_NAME")).alias("name"), F.col("NAME").alias("native"), parent.alias("parent"), wkt.alias("wkt"))


def region_list(shapes: DataFrame) -> DataFrame:
    """(code, name, level) of region shapes, a code stands for a missing name; ordered by level and name."""
    return shapes.select("code", F.coalesce("name", "code").alias("name"), "level").orderBy("level", "name", "code")
