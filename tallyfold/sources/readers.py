"""Readers of the public file formats, as declared scans with parsing in column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalars import period_start, postcode


def prices_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Daily price files named by ticker; bad numbers become null, rows without a close go."""
    raw = spark.read.option("header", True).csv(folder)
    number = lambda c: F.col(c).try_cast("double").alias(c.lower())
    ticker = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "").alias("ticker")
    return raw.select(ticker, F.to_date("Date").alias("date"), *map(number, ("Open", "High", "Low", "Close", "Volume"))).dropna(subset=["close"])


def cube_tsv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Wide statistics TSV to observations(dataset, geo, time, dims, slice_key, value, flags); cells without value and flags go."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    head, *periods = raw.columns
    names = [n.strip() for n in head.split("\\")[0].split(",")]
    keys = F.split(F.col(f"`{head}`"), ",")
    cells = F.array(*(F.struct(F.lit(p.strip()).alias("p"), F.trim(F.col(f"`{p}`")).alias("cell")) for p in periods))
    rows = raw.select(*(F.trim(keys[i]).alias(f"k{i}") for i in range(len(names))), F.explode(cells).alias("c")).select("*", "c.p", "c.cell")
    parts = F.split("cell", r"\s+")
    value = parts[0].try_cast("double")
    flags = F.when(value.isNull() & (parts[0] != ":"), parts).otherwise(F.slice(parts, 2, 1000))
    dims = [n for n in names if n not in ("geo", "freq")]
    mapping = F.create_map(*(x for n in sorted(dims) for x in (F.lit(n), F.col(f"k{names.index(n)}"))))
    out = rows.select(F.lit(dataset).alias("dataset"), F.col(f"k{names.index('geo')}").alias("geo"), period_start(F.col("p")).alias("time"), mapping.alias("dims"),
                      F.concat_ws("|", *(F.concat(F.lit(n + "="), F.col(f"k{names.index(n)}")) for n in sorted(dims))).alias("slice_key"), value.alias("value"),
                      F.filter(flags, lambda f: f != "").alias("flags"))
    return out.filter(F.col("value").isNotNull() | (F.size("flags") > 0))


def postcodes_csv(spark: SparkSession, path: str) -> DataFrame:
    """(country, postcode, nuts3); quotes go, the smallest code wins where one postcode has several."""
    raw = spark.read.option("sep", ";").option("quote", "'").option("header", True).csv(path)
    country, code, region = raw.columns[:3]
    return raw.select(F.upper(country).alias("country"), postcode(F.col(code)).alias("postcode"), F.col(region).alias("nuts3")).groupBy("country", "postcode").agg(F.min("nuts3").alias("nuts3"))


def regions_csv(spark: SparkSession, path: str) -> DataFrame:
    """(code, name, level, parent) of two to five character region codes."""
    raw = spark.read.option("header", True).csv(path)
    code, name = raw.columns[:2]
    rows = raw.select(F.trim(code).alias("code"), F.coalesce(name, code).alias("name")).filter(F.length("code").between(2, 5))
    return rows.select("code", "name", (F.length("code") - 2).alias("level"), F.expr("CASE WHEN length(code) > 2 THEN left(code, length(code) - 1) END").alias("parent"))


def legal_entities_xml(spark: SparkSession, path: str) -> DataFrame:
    """LEI records of an XML file; an LEI has 20 characters."""
    schema = "LEI string, Entity struct<LegalName: string, LegalAddress: struct<Country: string, PostalCode: string>>"
    raw = spark.read.format("xml").option("rowTag", "LEIRecord").schema(schema).load(path)
    return raw.select(F.col("LEI").alias("lei"), F.col("Entity.LegalName").alias("name"), F.col("Entity.LegalAddress.Country").alias("country"), F.col("Entity.LegalAddress.PostalCode").alias("postcode")).filter(F.length("lei") == 20)


#: An LEI record as the file nests it; optional parts may be missing anywhere.
_ADDRESS = "struct<FirstAddressLine: string, City: string, Region: string, Country: string, PostalCode: string>"
LEI_RECORD = (
    f"LEI string, Entity struct<LegalName: string, OtherEntityNames: struct<OtherEntityName: array<string>>, LegalAddress: {_ADDRESS}, HeadquartersAddress: {_ADDRESS}, "
    "RegistrationAuthority: struct<RegistrationAuthorityID: string, RegistrationAuthorityEntityID: string>, LegalJurisdiction: string, EntityCategory: string, "
    "LegalForm: struct<EntityLegalFormCode: string, OtherLegalForm: string>, EntityStatus: string, EntityCreationDate: string>, Registration struct<RegistrationStatus: string>"
)


def legal_entity_records_xml(spark: SparkSession, path: str, countries: DataFrame | None = None) -> DataFrame:
    """Whole LEI records: identity, both addresses, form, register, jurisdiction, status, creation and other names; what a record omits stays missing, nothing is inferred. countries(alpha2, alpha3) turns
    the file's country codes into three letters; an LEI has 20 characters, records without an entity are left out."""
    raw = spark.read.format("xml").option("rowTag", "LEIRecord").schema(LEI_RECORD).load(path).filter((F.length("LEI") == 20) & F.col("Entity").isNotNull())
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    e = lambda c: text(F.col(f"Entity.{c}"))
    names = F.filter(F.transform("Entity.OtherEntityNames.OtherEntityName", lambda n: F.trim(n)), lambda n: n != "")
    out = raw.select(
        F.col("LEI").alias("lei"), e("LegalName").alias("name"), e("LegalAddress.Country").alias("country"), e("LegalAddress.PostalCode").alias("postal_code"),
        F.coalesce(e("LegalForm.EntityLegalFormCode"), e("LegalForm.OtherLegalForm")).alias("legal_form"), F.coalesce(e("EntityStatus") == "ACTIVE", F.lit(False)).alias("active"), e("EntityCategory").alias("entity_kind"),
        e("RegistrationAuthority.RegistrationAuthorityEntityID").alias("registered_as"), e("RegistrationAuthority.RegistrationAuthorityID").alias("registered_at"), e("LegalJurisdiction").alias("jurisdiction"),
        text(F.col("Registration.RegistrationStatus")).alias("registration_status"), e("EntityCreationDate").alias("entity_creation_date"), e("LegalAddress.FirstAddressLine").alias("address"), e("LegalAddress.City").alias("city"),
        e("LegalAddress.Region").alias("region"), e("HeadquartersAddress.FirstAddressLine").alias("hq_address"), e("HeadquartersAddress.City").alias("hq_city"), e("HeadquartersAddress.Region").alias("hq_region"),
        e("HeadquartersAddress.Country").alias("hq_country"), e("HeadquartersAddress.PostalCode").alias("hq_postal_code"), F.when(F.size(names) > 0, names).alias("aliases"))
    if countries is None:
        return out
    for column in ("country", "hq_country"):  # a table of some 250 codes
        known = countries.select(F.col("alpha2").alias("_a2"), F.col("alpha3").alias("_a3")).distinct()
        out = out.join(known, F.upper(column) == F.col("_a2"), "left").withColumn(column, F.coalesce("_a3", column)).drop("_a2", "_a3")
    return out


def annual_facts_json(spark: SparkSession, path: str, concepts: dict[str, list[str]], first_year: int = 1990, last_year: int | None = None) -> DataFrame:
    """Company facts to (cik, year, field, value): annual forms only, first listed concept wins, later entries overwrite earlier ones; of a company's ten newest years, whatever they hold, those from
    first_year to last_year (the next year) are kept, as a filing can't be about the far future."""
    order = spark.createDataFrame([(f, c, i) for f, cs in concepts.items() for i, c in enumerate(cs)], "field string, concept string, priority int")
    schema = "cik long, facts map<string, map<string, struct<units: map<string, array<struct<end: string, val: double, fy: int, fp: string, form: string>>>>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    concept = raw.select("cik", F.explode("facts").alias("taxonomy", "c")).select("cik", F.explode("c").alias("concept", "fact"))
    entries = concept.select("cik", "concept", F.explode("fact.units").alias("unit", "list")).select("cik", "concept", F.posexplode("list").alias("place", "e"))
    annual = entries.filter(F.col("e.form").isin("10-K", "20-F", "40-F") & (F.col("e.fp") == "FY")).select("cik", "concept", "place", F.substring("e.end", 1, 4).try_cast("int").alias("year"), "e.val")
    best = Window.partitionBy("cik", "field", "year").orderBy("priority", F.desc("place"))
    newest = Window.partitionBy("cik").orderBy(F.desc("year"))
    ranked = annual.join(F.broadcast(order), "concept").withColumn("n", F.row_number().over(best)).filter("n = 1")
    return ranked.withColumn("n", F.dense_rank().over(newest)).filter("n <= 10").filter(F.col("year").between(F.lit(first_year), F.lit(last_year) if last_year else F.year(F.current_date()) + 1)).select("cik", "year", "field", F.col("val").alias("value"))
