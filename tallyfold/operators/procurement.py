"""Contract values: confidence, scale errors, modification collapse, trusted aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S

#: Fixed values of the scoring rule.
WEIGHT_ESTIMATE, WEIGHT_PAYABLE, NO_ESTIMATE, PAYABLE_ONLY_CAP, DISCREPANCY_FACTOR = 1.0, 0.4, 0.6, 0.75, 5.0
LOW_CONFIDENCE, QUARANTINE_FLOOR = 0.5, 0.05
#: Fixed values of the scale rule.
SCALE, PRIOR_FLOOR, CORRECTED_LEAST, CORRECTED_MOST, LEAKING_COUNTRIES = 1000.0, 1e9, 1e4, 5e8, ("PRT",)


def value_confidence(df: DataFrame, estimate: str = "estimate", total: str = "total", payable: str = "payable") -> DataFrame:
    """Adds chosen_value, chosen_field, consistency, plausibility, confidence, flag, low_confidence, payable_discrepancy, quarantine."""
    raw_total, raw_payable = F.col(total), F.col(payable)
    est, tot, pay = (F.when(F.col(c) > 0, F.col(c)) for c in (estimate, total, payable))
    negative = F.coalesce(raw_total < 0, F.lit(False)) | F.coalesce(raw_payable < 0, F.lit(False))
    negative_field = F.when(F.coalesce(raw_total < 0, F.lit(False)), F.lit("total")).otherwise(F.lit("payable"))
    chosen, usable = F.coalesce(tot, pay), tot.isNotNull() | pay.isNotNull()
    check = tot.isNotNull() & pay.isNotNull()
    near_pay = S.agreement(chosen, pay)
    apart = check & (F.abs(F.log10(chosen) - F.log10(pay)) > F.log10(F.lit(DISCREPANCY_FACTOR)))
    near_est = S.agreement(chosen, est)
    with_est = F.when(check, (near_est * WEIGHT_ESTIMATE + near_pay * WEIGHT_PAYABLE) / (WEIGHT_ESTIMATE + WEIGHT_PAYABLE)).otherwise(near_est)
    alone = F.when(check & ~apart, F.least(F.greatest(F.lit(NO_ESTIMATE), near_pay), F.lit(PAYABLE_ONLY_CAP))).otherwise(F.lit(NO_ESTIMATE))
    zero = F.coalesce(raw_total == 0, F.lit(False)) | F.coalesce(raw_payable == 0, F.lit(False))
    signed = F.when(negative_field == "total", raw_total).otherwise(raw_payable)
    out = df.withColumns({
        "chosen_value": F.when(negative, signed).when(usable, chosen).when(zero, F.lit(0.0)),
        "chosen_field": F.when(negative, negative_field).when(tot.isNotNull(), F.lit("total")).when(pay.isNotNull(), F.lit("payable"))
        .when(F.coalesce(raw_total == 0, F.lit(False)), F.lit("total")).when(zero, F.lit("payable")),
        "consistency": F.when(negative, F.lit(NO_ESTIMATE)).when(usable, F.when(est.isNotNull(), with_est).otherwise(alone)).otherwise(0.0),
        "plausibility": F.when(negative, S.plausibility(F.abs(signed))).when(usable, S.plausibility(chosen)).otherwise(0.0),
        "payable_discrepancy": F.coalesce(~negative & usable & apart, F.lit(False)),
        "_negative": negative, "_usable": usable, "_zero": zero, "_estimated": est.isNotNull(),
    })
    product = F.col("consistency") * F.col("plausibility")
    out = out.withColumn("confidence", F.when(F.col("_negative"), F.least(F.lit(0.5), product)).when(F.col("_usable"), product).otherwise(0.0))
    out = out.withColumn("low_confidence", F.col("_negative") | ~F.col("_usable") | (F.col("confidence") < LOW_CONFIDENCE))
    flag = (
        F.when(F.col("_negative"), "concession_negative")
        .when(~F.col("_usable") & F.col("_zero"), "zero_value")
        .when(~F.col("_usable"), "no_awarded_value")
        .when(~F.col("low_confidence"), "ok")
        .when(F.col("_estimated") & (F.col("consistency") < F.col("plausibility")), "value_disagreement")
        .when(~F.col("_estimated") & (F.col("plausibility") >= LOW_CONFIDENCE), "unverified_single_signal")
        .otherwise("implausible_magnitude")
    )
    out = out.withColumn("flag", flag)
    tier = (
        F.when(F.col("flag") == "zero_value", "auto")
        .when(F.col("flag").isin("concession_negative", "unverified_single_signal"), "review")
        .when((F.col("flag") == "implausible_magnitude") & (F.col("confidence") < QUARANTINE_FLOOR), "review")
    )
    return out.withColumn("quarantine", tier).drop("_negative", "_usable", "_zero", "_estimated")


def normalise_scale(df: DataFrame, estimate: str = "estimate", total: str = "total", payable: str = "payable", country: str = "country") -> DataFrame:
    """Adds scale_tier ('ratio', 'country_prior' or null) and divides leaking amounts by 1000."""
    e, t, p = F.col(estimate), F.col(total), F.col(payable)
    leaking = F.coalesce(F.col(country).isin(*LEAKING_COUNTRIES), F.lit(False))
    by_total = S.about_thousandfold(t, e) & (S.cents_signature(t) | leaking)
    by_estimate = S.about_thousandfold(e, t) & (S.cents_signature(e) | leaking)
    by_payable = t.isNull() & S.about_thousandfold(p, e) & (S.cents_signature(p) | leaking)
    chosen = F.coalesce(t, p, e)
    consistent = e.isNull() | ~(S.about_thousandfold(chosen, e) | S.about_thousandfold(e, chosen))
    prior = leaking & F.coalesce(chosen >= PRIOR_FLOOR, F.lit(False)) & consistent & (chosen / SCALE).between(CORRECTED_LEAST, CORRECTED_MOST)
    case = F.when(by_total, "total").when(by_estimate, "estimate").when(by_payable, "payable").when(prior, "all")
    out = df.withColumns({"_case": case, "_both": S.about_thousandfold(p, e)})
    case = F.coalesce(F.col("_case"), F.lit(""))
    return out.withColumns({
        estimate: F.when(case.isin("estimate", "all"), e / SCALE).otherwise(e),
        total: F.when(case.isin("total", "all"), t / SCALE).otherwise(t),
        payable: F.when(case.isin("payable", "all") | ((case == "total") & F.col("_both")), p / SCALE).otherwise(p),
        "scale_tier": F.when(case == "all", "country_prior").when(case != "", "ratio"),
    }).drop("_case", "_both")


def collapse_modifications(notices: DataFrame) -> DataFrame:
    """Adds is_current and current_value per contract_key.

    The award is canonical (the earliest one), with the value of the newest notice that has one; a contract of modifications only has its newest valued one.
    One window per contract; contracts are small groups.
    """
    ident = [F.col("line"), F.col("part"), F.col("company")]
    days = F.datediff("pub_date", F.lit("1970-01-01"))
    modif = F.col("notice_type") == "can-modif"
    first = Window.partitionBy("contract_key").orderBy(modif.cast("int"), F.when(modif, F.col("total").isNull().cast("int")).otherwise(0), F.when(modif, -days).otherwise(days), *ident)
    whole = Window.partitionBy("contract_key")
    newest = F.max_by("total", F.when(F.col("total").isNotNull(), F.struct("pub_date", "line", "part", "company"))).over(whole)
    return notices.withColumns({"is_current": F.row_number().over(first) == 1, "_newest": newest}).withColumn(
        "current_value", F.when(F.col("is_current"), F.col("_newest")).otherwise(F.col("total"))).drop("_newest")


def totals(contracts: DataFrame, *keys: str) -> DataFrame:
    """Trusted value and canonical count per key."""
    gate = S.canonical(F.col("is_current"), F.col("notice_type"))
    return contracts.groupBy(*keys).agg(
        S.rounded(S.trusted_sum(gate, F.col("low_confidence"), F.col("current_value")), 4).alias("total_value"),
        F.count_if(gate).alias("contracts"))


def single_bidder_rate(contracts: DataFrame, key: str, least: int) -> DataFrame:
    gate = S.canonical(F.col("is_current"), F.col("notice_type")) & F.col("bidders").isNotNull()
    out = contracts.filter(gate).groupBy(key).agg(F.count_if(F.col("bidders") == 1).alias("single"), F.count("*").alias("total"))
    return out.filter(F.col("total") >= least).withColumn("rate", S.rounded(F.col("single") / F.col("total"), 6))


def red_flags(contracts: DataFrame) -> DataFrame:
    """Four additive flags and their number."""
    flags = {
        "single_bidder": F.coalesce(F.col("bidders") == 1, F.lit(False)),
        "non_open": F.coalesce(~F.col("procedure_type").isin("open"), F.lit(False)),
        "no_call": F.coalesce(F.col("procedure_type") == "neg-wo-call", F.lit(False)),
        "price_only": F.coalesce(F.col("criterion") == "price", F.lit(False)),
    }
    return contracts.withColumns(flags).withColumn("flags", sum((F.col(f).cast("int") for f in flags), F.lit(0)))


def project_contracts(collapsed: DataFrame) -> DataFrame:
    """One row per contract: notices, canonical value, first award's own value, latest date."""
    award = F.when(F.col("notice_type") != "can-modif", F.struct("pub_date", "line", "part", "company"))
    return collapsed.groupBy("contract_key").agg(
        F.count("*").alias("notice_count"),
        S.rounded(F.max(F.when(F.col("is_current"), F.col("current_value"))), 4).alias("current_value"),
        S.rounded(F.min_by("total", award), 4).alias("award_value"),
        F.max("pub_date").cast("string").alias("last_date"))


#: The fields that a withheld value takes with it.
VALUE_FIELDS, OTHER_VALUE_FIELDS = ("total", "current_value", "chosen_value"), ("estimate", "payable", "value_before")


def withhold(df: DataFrame) -> DataFrame:
    """Values of quarantined rows go; unless the value was reported as zero, the estimate and what was paid go too."""
    held, zero = F.col("quarantine").isNotNull(), F.coalesce(F.col("flag") == "zero_value", F.lit(False))
    gone = {c: F.when(~held, F.col(c)) for c in VALUE_FIELDS if c in df.columns} | {c: F.when(~held | zero, F.col(c)) for c in OTHER_VALUE_FIELDS if c in df.columns}
    return df.withColumns(gone)


def still_carrying(df: DataFrame, key: str, value: str, after: object = None, limit: int = 500) -> DataFrame:
    """The next rows, by key, that are flagged but still have their value: a page of the backfill. df has a boolean column low_confidence."""
    rows = df.filter(F.col("low_confidence") & F.col(value).isNotNull())
    rows = rows.filter(F.col(key) > F.lit(after)) if after is not None else rows
    return rows.orderBy(key).limit(limit)


def correct_scale(history: DataFrame, key: str, order: list[str], floor: float) -> DataFrame:
    """history(key, estimate, total, payable, country, ...): the newest state of each key whose total reaches the floor, brought to scale and scored again, where that changes it."""
    newest = history.groupBy(key).agg(F.max_by(F.struct(*history.columns), F.struct(*order)).alias("_n")).select("_n.*").filter(F.col("total") >= floor)
    return value_confidence(normalise_scale(newest).filter("scale_tier IS NOT NULL"))


def contract_details(contracts: DataFrame, authorities: DataFrame, awards: DataFrame) -> DataFrame:
    """contracts(contract, authority), authorities(authority, name, country), awards(contract, place, party, part): contract, authority (name, country) and award (lines, parties, first_part) as a detail
    page nests them; award is missing where nothing was awarded."""
    of = awards.groupBy("contract").agg(F.struct(F.count("*").alias("lines"), F.count_distinct("party").alias("parties"), F.min_by("part", F.struct("place", "part", "party")).alias("first_part")).alias("award"))
    named = authorities.select("authority", F.struct("name", "country").alias("_named"))
    return contracts.select("contract", "authority").join(named, "authority").join(of, "contract", "left").select("contract", F.col("_named").alias("authority"), "award")


def company_profile(companies: DataFrame, contracts: DataFrame, filings: DataFrame) -> DataFrame:
    """companies(company, name, country), contracts(company, authority, current_value, is_current, low_confidence), filings(company, year, revenue): a row per company with its contracts, trusted value,
    authorities, newest filing and years on file; zeros and missing values where it has none."""
    trusted = F.when(F.col("is_current") & ~F.coalesce("low_confidence", F.lit(False)), F.coalesce("current_value", F.lit(0.0))).otherwise(0.0)
    won = contracts.groupBy("company").agg(F.count_if("is_current").alias("contracts"), F.sum(trusted).alias("value"), F.count_distinct("authority").alias("authorities"))
    filed = filings.groupBy("company").agg(F.count("*").alias("years"), F.max("year").alias("newest"), F.max_by("revenue", "year").alias("revenue"))
    out = companies.join(won, "company", "left").join(filed, "company", "left")
    return out.select("company", "name", "country", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("contracts", "authorities", "years")), F.coalesce("value", F.lit(0.0)).alias("value"), "newest", "revenue")


def outlier_months(notices: DataFrame, factor: float = 3.0, least: int = 500) -> DataFrame:
    """Months (of pub_date) with at least so many notices whose mean value is over ``factor`` times the median of such months' means: month, n, mean."""
    m = notices.groupBy(F.date_format("pub_date", "yyyy-MM").alias("month")).agg(F.avg("total").alias("mean"), F.count("*").alias("n")).filter(F.col("n") >= least)
    middle = m.agg(F.percentile("mean", 0.5).alias("_middle"))  # one row, of one row a month
    return m.crossJoin(F.broadcast(middle)).filter(F.col("mean") > factor * F.col("_middle")).select("month", "n", S.rounded("mean", 4).alias("mean"))


def sector_totals(contracts: DataFrame, country: str | None = None, year: int | None = None, limit: int = 20) -> DataFrame:
    """The sectors of most trusted value, of one country or year if given."""
    rows = contracts if country is None else contracts.filter(F.col("country") == country)
    rows = rows if year is None else rows.filter(F.year("pub_date") == year)
    return totals(rows, "division").orderBy(F.desc("total_value"), "division").limit(limit)
