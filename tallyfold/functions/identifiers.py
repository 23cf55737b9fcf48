"""Identifiers, codes and names as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The shapes of VAT numbers by country.
VAT_SHAPES = [
    r"ATU\d{8}", r"BE0?\d{9,10}", r"BG\d{9,10}", r"CY\d{8}[A-Z]", r"CZ\d{8,10}", r"DE\d{9}", r"DK\d{8}", r"EE\d{9}", r"EL\d{9}", r"GR\d{9}", r"ES[A-Z0-9]\d{7}[A-Z0-9]", r"FI\d{8}",
    r"FR[A-Z0-9]{2}\d{9}", r"GB(\d{9}|\d{12}|GD\d{3}|HA\d{3})", r"HR\d{11}", r"HU\d{8}", r"IE\d[A-Z0-9\+\*]\d{5}[A-Z]{1,2}", r"IT\d{11}", r"LT(\d{9}|\d{12})", r"LU\d{8}", r"LV\d{11}",
    r"MT\d{8}", r"NL\d{9}B\d{2}", r"PL\d{10}", r"PT\d{9}", r"RO\d{2,10}", r"SE\d{12}", r"SI\d{8}", r"SK\d{10}",
]
VAT = "^(" + "|".join(VAT_SHAPES) + ")$"
#: Words that say nothing in a title.
TITLE_STOP = ["the", "a", "an", "of", "for", "in", "on", "and", "to", "eu", "european"]


def _bare() -> tuple[str, str]:
    """Latin letters with marks and their base letters, by Unicode decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)) for c in block if unicodedata.decomposition(chr(c)).partition(" ")[0] not in ("", "<compat>")]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, BARE = _bare()


def _kept(x: Column, pattern: str) -> Column:
    return F.when(x.rlike(pattern), x)


def compact(x: Column) -> Column:
    """Upper case without white space, dots, hyphens and slashes."""
    return F.upper(F.regexp_replace(x, r"[\s.\-/]", ""))


def lei(x: Column) -> Column:
    return _kept(F.upper(F.trim(x)), "^[A-Z0-9]{20}$")


def cik(x: Column) -> Column:
    """Digits without leading zeros; all zeros give 0, an empty text NULL."""
    return F.when(x != "", _kept(F.coalesce(F.nullif(F.regexp_replace(F.trim(x), "^0+", ""), F.lit("")), F.lit("0")), r"^\d+$"))


def siret(x: Column) -> Column:
    return _kept(compact(x), r"^\d{14}$")


def vat(x: Column) -> Column:
    """The compact number if it fits any country's shape; company registers and notice numbers written here by mistake don't."""
    return _kept(compact(x), VAT)


def notice_like(x: Column) -> Column:
    return F.coalesce(F.trim(x).rlike(r"^\d+-\d+-\d+-\d+$"), F.lit(False))


def document_number(x: Column) -> Column:
    """C_2026_0411 as C(2026)411."""
    part = lambda i: F.regexp_extract(x, r"^([A-Z]+)_(\d{4})_(\d+)$", i)
    return F.when(x.rlike(r"^[A-Z]+_\d{4}_\d+$"), F.concat(part(1), F.lit("("), part(2), F.lit(")"), part(3).cast("long").cast("string")))


def normal_text(x: Column) -> Column:
    """Without marks, lower case, runs of anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.translate(x, MARKED, BARE), r"\p{M}+", "")), r"[^a-z0-9]+", " "))


def tokens(x: Column, stop: list[str] | None = None) -> Column:
    """Distinct words of normal_text, without stop words."""
    words = F.array_distinct(F.filter(F.split(normal_text(x), " "), lambda w: w != ""))
    return F.array_except(words, F.array(*map(F.lit, stop))) if stop else words


def region_level(code: Column) -> Column:
    """0 to 3 for codes of two to five characters; else NULL."""
    return F.when(code.rlike("^[A-Z]{2}[A-Z0-9]{0,3}$"), F.length(code) - 2)


def region_parent(code: Column) -> Column:
    return F.when(region_level(code) > 0, F.substring(code, F.lit(1), F.length(code) - 1))


def region_country(code: Column) -> Column:
    """The ISO country of a region code: its first two letters, with the statistics' own EL and UK as GR and GB; NULL where it is no region code."""
    two = F.substring(code, 1, 2)
    return F.when(region_level(code).isNotNull(), F.when(two == "EL", "GR").when(two == "UK", "GB").otherwise(two))


def valid_region(code: Column, level: int | None = None) -> Column:
    """Whether it is a region code, of that level if one is given; extra-regional codes (Z behind the country) are none."""
    found = region_level(code)
    return F.coalesce(found.isNotNull() & ~code.rlike("^[A-Z]{2}Z+$") & (F.lit(True) if level is None else found == level), F.lit(False))


def first_date(*tagged: tuple[str, Column]) -> Column:
    """The first of the columns that holds a date, as a struct (date, source), source being its tag; NULL where none does."""
    return F.coalesce(*(F.when(date_of(c).isNotNull(), F.struct(date_of(c).alias("date"), F.lit(tag).alias("source"))) for tag, c in tagged))


def duration_seconds(x: Column) -> Column:
    """1d, 12h, 30m, 90s; else NULL."""
    unit = F.regexp_extract(x, r"([dhms])$", 1)
    size = F.when(unit == "d", 86400).when(unit == "h", 3600).when(unit == "m", 60).otherwise(1)
    return F.when(x.rlike(r"^\d+[dhms]$"), F.regexp_extract(x, r"^(\d+)", 1).cast("long") * size)


def contract_key(procedure: Column, notice_type: Column, own: Column, modified: Column, notice: Column) -> Column:
    """The procedure, else the modified or own publication number by kind of notice, else the notice."""
    return F.coalesce(procedure, F.when(notice_type == "can-modif", modified).otherwise(own), notice)


def shown_number(x: Column) -> Column:
    """Whole numbers without decimals, others with two; missing ones empty."""
    return F.when(x.isNull(), "").when(x == F.floor(x), F.floor(x).cast("string")).otherwise(F.format_string("%.2f", x))


def date_of(x: Column) -> Column:
    """ISO dates (also with a time behind) and DD/MM/YYYY; else NULL."""
    return F.coalesce(F.try_to_date(F.substring(x, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring(x, 1, 10), "dd/MM/yyyy"))


#: Kinds of acts by the sixth character of a sector 3 number.
ACT_KINDS = {"L": "Directive", "R": "Regulation", "D": "Decision", "H": "Recommendation", "A": "Opinion", "C": "Declaration"}


def act_kind(number: Column) -> Column:
    kind = F.coalesce(F.create_map(*(F.lit(v) for kv in ACT_KINDS.items() for v in kv))[F.substring(number, 6, 1)], F.lit("Legal act"))
    return F.when(number.startswith("3"), kind).when(number.startswith("5"), "Preparatory act").otherwise("Legal document")


def search_terms(text: Column) -> Column:
    """Words that a search has to find, each with a plus, the last as a prefix; empty without words."""
    words = F.filter(F.split(F.lower(text), r"[\s+\-&|!(){}\[\]^\"~*?:\\/]+"), lambda w: w != "")
    return F.when(F.size(words) > 0, F.concat(F.array_join(F.transform(words, lambda w: F.concat(F.lit("+"), w)), " "), F.lit("*"))).otherwise("")
