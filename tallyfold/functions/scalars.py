"""Scalar rules as column expressions; a missing number is NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(x: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def rounded(x: Column | str, digits: int) -> Column:
    """Half up by plain double arithmetic, which every engine does alike."""
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x * 10.0**digits + 0.5).cast("double") / 10.0**digits


def safe_div(num: Column, den: Column) -> Column:
    """NULL where either side is missing or zero: a zero numerator counts as not reported."""
    return F.when((num != 0) & (den != 0), num / den)


def price_ratio(price: Column, per: Column) -> Column:
    return F.when(per > 0, price / per)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def agreement(a: Column, b: Column, sigma: float = 0.7) -> Column:
    """Gaussian of the gap between two amounts in decades."""
    return F.exp(-F.pow(F.abs(F.log10(a) - F.log10(b)) / sigma, 2))


def plausibility(x: Column) -> Column:
    """1 up to a billion, then linear in decades down to 0 over two and a half of them."""
    return F.when(x <= 1e9, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - (F.log10(x) - 9) / 2.5))


def cents_signature(x: Column) -> Column:
    """An integral amount, divisible by 10 but not by 1000."""
    n = F.rint(x)
    return F.coalesce((F.abs(x - n) < 1e-6) & (F.pmod(n, F.lit(10.0)) == 0) & (F.pmod(n, F.lit(1000.0)) != 0), F.lit(False))


def about_thousandfold(a: Column, b: Column) -> Column:
    return F.coalesce((a > 0) & (b > 0) & (a / b).between(900, 1100), F.lit(False))


def canonical(is_current: Column, notice_type: Column) -> Column:
    """Row gate of contract aggregates."""
    return F.coalesce(is_current, notice_type.isNull() | (notice_type != "can-modif"))


def trusted_sum(gate: Column, low_confidence: Column, value: Column) -> Column:
    """Sum of values that pass the gate and aren't flagged; flagged rows add 0."""
    return F.sum(F.when(gate & ~F.coalesce(low_confidence, F.lit(False)), F.coalesce(value, F.lit(0.0))).otherwise(0.0))


def missing_name(name: Column) -> Column:
    return F.lower(F.trim(F.coalesce(name, F.lit("")))).isin("nan", "", "n/a", "none", "null", "-")


def postcode(x: Column) -> Column:
    return F.upper(F.regexp_replace(x, "[^0-9A-Za-z]", ""))


def period_start(p: Column) -> Column:
    """First day of a period: YYYY, YYYY-MM, YYYY[-]Mmm, YYYY[-]Qn, YYYY[-]Sn, YYYY[-]Wnn (ISO week); else NULL."""
    year = F.regexp_extract(p, r"^(\d{4})", 1).try_cast("int")
    number = F.regexp_extract(p, r"(\d+)$", 1).try_cast("int")
    month = F.when(p.rlike(r"^\d{4}$"), F.lit(1)).when(p.rlike(r"^\d{4}(-|-?M)(0[1-9]|1[0-2])$"), number)
    month = month.when(p.rlike(r"^\d{4}-?Q[1-4]$"), number * 3 - 2).when(p.rlike(r"^\d{4}-?S[12]$"), number * 6 - 5)
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    week = F.date_add(F.trunc(fourth, "week"), (number - 1) * 7)
    return F.when(p.rlike(r"^\d{4}-?W\d{1,2}$"), week).otherwise(F.make_date(year, month, F.lit(1)))


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version 5 id of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Days of a named price window; fixed values.
WINDOW_DAYS = {"1d": 1, "5d": 5, "1mo": 30, "3mo": 90, "6mo": 180, "1y": 365, "2y": 730, "3y": 1095, "5y": 1825, "10y": 3650, "max": 36500}


def window_start(name: str, as_of: Column) -> Column:
    """The first day of a window that ends on a day: a name of WINDOW_DAYS, or any number with y (365 days each), mo (30) or d; anything else is a year."""
    days = WINDOW_DAYS.get(name)
    if days is None:
        number, unit = next(((name[: -len(u)], n) for u, n in (("mo", 30), ("y", 365), ("d", 1)) if name.endswith(u)), ("", 0))
        days = int(number) * unit if number.lstrip("-").isdigit() else 365
    return F.date_sub(as_of, days)


def kept_period(p: Column, start_year: int | None) -> Column:
    """Whether a period counts: one that can be read and, with a start year, doesn't begin before it."""
    start = period_start(p)
    return start.isNotNull() if start_year is None else F.coalesce(F.year(start) >= start_year, F.lit(False))
