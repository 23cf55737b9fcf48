"""Readers of public registers: consolidation, instruments, sanctions, lobbying, product codes, funded projects, ISINs, catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import identifiers as I
from tallyfold.functions.scalars import missing_name


def _xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", True).schema(schema).load(path)


def _filled(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def relationships_xml(spark: SparkSession, path: str) -> DataFrame:
    """(child, parent, kind): active direct and ultimate consolidations between two different entities; no status counts as active."""
    node = "struct<NodeID: string>"
    raw = _xml(spark, path, "RelationshipRecord", f"Relationship struct<StartNode: {node}, EndNode: {node}, RelationshipType: string, RelationshipStatus: string>")
    r = F.col("Relationship")
    kind = F.when(_filled(r.RelationshipType) == "IS_DIRECTLY_CONSOLIDATED_BY", "direct").when(_filled(r.RelationshipType) == "IS_ULTIMATELY_CONSOLIDATED_BY", "ultimate")
    out = raw.filter(F.coalesce(_filled(r.RelationshipStatus), F.lit("ACTIVE")) == "ACTIVE").select(_filled(r.StartNode.NodeID).alias("child"), _filled(r.EndNode.NodeID).alias("parent"), kind.alias("kind"))
    return out.filter("child <> parent AND kind IS NOT NULL")


def instruments_xml(spark: SparkSession, path: str) -> DataFrame:
    """(isin, name, kind, cfi, venue, currency, lei, active): equities and funds with an ISIN of 12 characters; terminated ones aren't active."""
    schema = "FinInstrmGnlAttrbts struct<Id: string, FullNm: string, ClssfctnTp: string, NtnlCcy: string>, Issr string, TradgVnRltdAttrbts struct<Id: string>"
    rows = None
    for wrapper in ("NewRcrd", "ModfdRcrd", "TermntdRcrd"):
        some = _xml(spark, path, wrapper, schema).withColumn("active", F.lit(wrapper != "TermntdRcrd"))
        rows = some if rows is None else rows.unionByName(some)
    g = F.col("FinInstrmGnlAttrbts")
    kind = F.when(g.ClssfctnTp.startswith("E"), "equity").when(g.ClssfctnTp.startswith("C"), "fund")
    lei = F.trim("Issr")
    out = rows.select(g.Id.alias("isin"), F.substring(g.FullNm, 1, 200).alias("name"), kind.alias("kind"), g.ClssfctnTp.alias("cfi"), F.col("TradgVnRltdAttrbts.Id").alias("venue"), g.NtnlCcy.alias("currency"),
                      F.when(F.length(lei) == 20, lei).alias("lei"), "active")
    return out.filter("length(isin) = 12 AND kind IS NOT NULL")


def sanctions_xml(spark: SparkSession, path: str) -> DataFrame:
    """(reference, names, name, kind, country, designated, programme): names in order without repeats, the first is primary; country by citizenship, address, identification."""
    place = "array<struct<_countryIso2Code: string, _countryDescription: string>>"
    schema = (f"_euReferenceNumber string, _logicalId string, subjectType struct<_code: string>, nameAlias array<struct<_wholeName: string, _firstName: string, _lastName: string>>, "
              f"citizenship {place}, address {place}, identification {place}, regulation array<struct<_publicationDate: string, _programme: string>>")
    raw = _xml(spark, path, "sanctionEntity", schema)
    whole = lambda a: _filled(a["_wholeName"])
    named = lambda a: F.when(F.length(whole(a)) > 1, whole(a)).otherwise(F.trim(F.concat_ws(" ", F.trim(a["_firstName"]), F.trim(a["_lastName"]))))
    names = F.array_distinct(F.filter(F.transform("nameAlias", named), lambda n: F.length(n) > 1))
    code = lambda p: F.nullif(_filled(p["_countryIso2Code"]), F.lit("00"))
    where = lambda c: F.get(F.filter(F.transform(c, lambda p: F.coalesce(code(p), F.nullif(_filled(p["_countryDescription"]), F.lit("UNKNOWN")))), lambda v: v.isNotNull()), F.lit(0))
    days = F.filter(F.transform("regulation", lambda r: _filled(F.substring(r["_publicationDate"], 1, 10))), lambda d: d.isNotNull())
    programmes = F.filter(F.transform("regulation", lambda r: _filled(r["_programme"])), lambda p: p.isNotNull())
    return raw.select(F.coalesce(_filled(F.col("_euReferenceNumber")), _filled(F.col("_logicalId"))).alias("reference"), names.alias("names"), F.get(names, F.lit(0)).alias("name"),
                      F.when(F.lower("subjectType._code").contains("person"), "person").otherwise("entity").alias("kind"), F.coalesce(*map(where, ("citizenship", "address", "identification"))).alias("country"),
                      F.array_min(days).alias("designated"), F.get(programmes, F.lit(0)).alias("programme")).filter("reference IS NOT NULL")


def _cleaned_xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    """Records of an XML file that holds control characters, which no XML parser takes: the file is cut behind each record as text, the characters go, and each record is parsed by itself."""
    parts = spark.read.option("lineSep", f"</{row}>").text(path)
    opened = F.regexp_extract("value", rf"(?s)(<{row}[\s>].*)$", 1)
    records = parts.select(opened.alias("r")).filter("r <> ''").select(F.concat(F.regexp_replace("r", r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), F.lit(f"</{row}>")).alias("r"))
    return records.select(F.from_xml("r", schema).alias("x")).select("x.*")


def lobbyists_xml(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, country, category, cost_low, cost_high, registered, interests): a swapped cost band is put in order, a lone lower bound is both; 0 is not given.
    Control characters in the file are taken out."""
    schema = ("identificationCode string, name struct<originalName: string>, headOffice struct<country: string, city: string>, registrationCategory string, registrationDate string, "
              "financialData struct<closedYear: struct<costs: struct<`range`: struct<min: string, max: string>>>>, interests struct<interest: array<struct<name: string>>>")
    raw = _cleaned_xml(spark, path, "interestRepresentative", schema)
    bound = lambda b: F.coalesce(F.col(f"financialData.closedYear.costs.range.{b}").try_cast("long"), F.lit(0))
    low, high = bound("min"), bound("max")
    both = (low != 0) & (high != 0)
    return raw.select(F.col("identificationCode").alias("id"), F.col("name.originalName").alias("name"), F.col("headOffice.country").alias("country"), F.col("registrationCategory").alias("category"),
                      F.when(both, F.least(low, high)).otherwise(low).alias("cost_low"), F.when(both, F.greatest(low, high)).when(low != 0, low).otherwise(high).alias("cost_high"),
                      F.substring("registrationDate", 1, 10).alias("registered"), F.filter("interests.interest.name", lambda n: n != "").alias("interests"))


def codes_xml(spark: SparkSession, path: str, languages: dict[str, str]) -> DataFrame:
    """(code, parent, language, label, level) of a code list; languages: label column prefix to language. The level is the code's length without trailing zeros, 1 at least."""
    raw = _xml(spark, path, "Row", "Value array<struct<_ColumnRef: string, SimpleValue: string>>")
    cells = F.map_from_entries(F.transform(F.filter("Value", lambda v: v["_ColumnRef"].isNotNull() & v["SimpleValue"].isNotNull()), lambda v: F.struct(v["_ColumnRef"], v["SimpleValue"])))
    rows = raw.withColumn("c", cells).select(F.col("c")["code"].alias("code"), F.col("c")["parentCode"].alias("parent"), F.explode("c").alias("column", "label")).filter("code <> '' AND label <> ''")
    known = F.create_map(*(F.lit(x) for k, v in languages.items() for x in (f"{k}_label", v)))
    level = F.greatest(F.length(F.regexp_replace("code", "0+$", "")), F.lit(1))
    return rows.select("code", _filled(F.col("parent")).alias("parent"), known[F.col("column")].alias("language"), "label", level.alias("level")).filter("language IS NOT NULL")


def projects_csv(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """(qid, title, budget, grant, start, end, region, country, beneficiary, beneficiary_qid, description, fund, programme); since goes by the start, else the end, and takes out what has neither;
    the finest region code counts; columns that a file hasn't are missing."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    optional = ("Operation_Summary_English", "Operation_Summary_Programme_Language", "Fund_Name", "Fund_Code", "Programme_Name")
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in optional if c not in raw.columns})
    first = lambda size, *cs: F.substring(F.coalesce(*(_filled(F.col(c)) for c in cs)), 1, size)
    qid = lambda c: _filled(F.regexp_extract(c, r"(Q\d+)\s*$", 1))
    money = lambda c: F.regexp_replace(c, ",", "").try_cast("double")
    day = lambda c: I.date_of(F.trim(c))
    name = F.substring(F.trim("Beneficiary_Name"), 1, 300)
    out = raw.select(qid("Operation_Unique_Identifier").alias("qid"), F.coalesce(_filled(F.col("Operation_Name_English")), _filled(F.col("Operation_Name_Programme_Language"))).alias("title"),
                     money("Total_Eligible_Expenditure_amount").alias("budget"), money("Project_EU_Budget").alias("grant"), day("Operation_Start_Date").alias("start"), day("Operation_End_Date").alias("end"),
                     F.coalesce(*(_filled(F.col(f"NUTS{i}_Code")) for i in (3, 2, 1))).alias("region"), _filled(F.col("CountryCode")).alias("country"),
                     F.when(~missing_name(name), name).alias("beneficiary"), qid("Beneficiary_Unique_Identifier").alias("beneficiary_qid"),
                     first(2000, "Operation_Summary_English", "Operation_Summary_Programme_Language").alias("description"), first(200, "Fund_Name", "Fund_Code").alias("fund"), first(200, "Programme_Name").alias("programme")).filter("qid IS NOT NULL")
    return out.filter(F.coalesce("start", "end") >= F.lit(since).cast("date")) if since else out


def isins_csv(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(lei, isin) of the daily mapping, for wanted(lei) only if given; the header has to be LEI, ISIN."""
    raw = spark.read.option("header", True).csv(path)
    if raw.columns != ["LEI", "ISIN"]:
        raise ValueError(f"unexpected header {raw.columns}")
    out = raw.select(F.trim("LEI").alias("lei"), F.trim("ISIN").alias("isin")).filter("lei <> '' AND isin <> ''").distinct()
    return out.join(wanted.select("lei"), "lei", "left_semi") if wanted is not None else out


def catalogue_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(code, updated) of the table of contents; dates are DD.MM.YYYY, codes without one go."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    return raw.select(F.trim("code").alias("code"), F.try_to_date(F.trim("last update of data"), "dd.MM.yyyy").alias("updated")).filter("code <> '' AND updated IS NOT NULL").groupBy("code").agg(F.max("updated").alias("updated"))


def tickers_json(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, cik, name, search_name) of a map of numbered entries; the CIK has ten digits."""
    raw = spark.read.text(path, wholetext=True)
    entries = raw.select(F.explode(F.from_json("value", "map<string, struct<cik_str: bigint, ticker: string, title: string>>")).alias("k", "e"))
    return entries.select(F.upper("e.ticker").alias("symbol"), F.lpad(F.col("e.cik_str").cast("string"), 10, "0").alias("cik"), F.col("e.title").alias("name"), F.lower("e.title").alias("search_name")).filter("symbol <> ''")
