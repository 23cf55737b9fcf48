"""Reports on a store's contents: registry, filings, triples, acts, costs, freshness; and money rules of notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S


def percent(part: Column, whole: Column) -> Column:
    """Share in per cent to one digit; an empty whole gives 0."""
    return S.rounded(part / F.greatest(whole, F.lit(1)) * 100, 1)


def registry_stats(nodes: DataFrame) -> DataFrame:
    """nodes(kind, active, code): per kind the rows, active and inactive ones and the coverage of the code."""
    n = F.count("*")
    return nodes.groupBy("kind").agg(n.alias("n"), F.count_if("active").alias("active"), F.count_if(~F.col("active")).alias("inactive"), percent(F.count("code"), n).alias("code_pct"))


def filing_stats(filings: DataFrame, fields: list[str], first: int = 1990, last: int = 2030) -> DataFrame:
    """Per plausible year: filings, companies, and each field's coverage."""
    n = F.count("*")
    return filings.filter(F.col("year").between(first, last)).groupBy("year").agg(n.alias("filings"), F.count_distinct("company").alias("companies"), *(percent(F.count(f), n).alias(f"{f}_pct") for f in fields))


def profile(triples: DataFrame, top: int, *by: str) -> DataFrame:
    """triples(graph, ...): rows per graph and column, the top most frequent values per graph."""
    per = triples.groupBy("graph", *by).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("graph").orderBy(F.desc("n"), *by))
    return per.withColumn("place", place).filter(F.col("place") <= top)


def acts_coverage(acts: DataFrame, since: int) -> DataFrame:
    """acts(work, expression, manifestation, day, link): distinct ones per year and decade, first and last day, coverage of the link per work."""
    year = F.year("day")
    spans = F.array(F.struct(F.lit("decade").alias("span"), F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s")).alias("label")),
                    F.struct(F.when(year >= since, "year").alias("span"), year.cast("string").alias("label")))
    rows = acts.filter("day IS NOT NULL").withColumn("s", F.explode(spans)).filter("s.span IS NOT NULL").select("*", "s.span", "s.label")
    per_work = rows.groupBy("span", "label", "work").agg(F.count_distinct("expression").alias("e"), F.count_distinct("manifestation").alias("m"), F.max(F.col("link").isNotNull()).alias("linked"), F.min("day").alias("d0"), F.max("day").alias("d1"))
    return per_work.groupBy("span", "label").agg(F.count("*").alias("works"), F.sum("e").alias("expressions"), F.sum("m").alias("manifestations"), percent(F.count_if("linked"), F.count("*")).alias("link_pct"),
                                                 F.min("d0").cast("string").alias("first_day"), F.max("d1").cast("string").alias("last_day"))


def token_costs(usage: DataFrame, *keys: str, price_in: float, price_out: float) -> DataFrame:
    """usage(item, tokens_in, tokens_out): sums, cost by prices per million tokens, cost per item."""
    cost = (F.sum("tokens_in") * price_in + F.sum("tokens_out") * price_out) / 1_000_000
    return usage.groupBy(*keys).agg(F.count_distinct("item").alias("items"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), S.rounded(cost, 6).alias("cost"),
                                    S.rounded(cost / F.greatest(F.count_distinct("item"), F.lit(1)), 8).alias("per_item"))


def freshness(datasets: DataFrame, now: Column, days: int = 8) -> DataFrame:
    """datasets(theme, synced): per theme the fresh, stale and never synced ones."""
    fresh = F.col("synced") >= now - F.make_interval(days=F.lit(days))
    return datasets.groupBy("theme").agg(F.count("*").alias("n"), F.count_if(fresh).alias("fresh"), F.count_if(~fresh).alias("stale"), F.count_if(F.col("synced").isNull()).alias("never"))


def details(rows: DataFrame, group: str, key: str, label: Column, most: int = 20) -> DataFrame:
    """Per group the number of rows and the labels of its first ones by key, at most `most`, as one text; later ones are counted only, so no group is collected whole."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(key, "_label"))
    first = rows.select(group, key, label.alias("_label")).withColumn("_n", place).filter(F.col("_n") <= most)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_label"))), lambda s: s["_label"]), ", ")
    listed = first.groupBy(F.col(group).alias("_g")).agg(text.alias("detail"))
    counts = rows.groupBy(group).agg(F.count("*").alias("n"))
    return counts.join(listed, F.col(group).eqNullSafe(F.col("_g"))).select(group, "n", "detail")


def offenders(rows: DataFrame, group: str, key: str, label: Column) -> DataFrame:
    """All rows as (group, key, label) with the number of rows of their group; the key gives their order, so no group is collected or sorted in one place."""
    counts = rows.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("n"))
    return rows.withColumn("label", label).join(counts, F.col(group).eqNullSafe(F.col("_g"))).select(group, key, "label", "n")


def winner_values(awards: DataFrame) -> DataFrame:
    """awards(notice_id, place, is_winner, lot, party, contractor, value, lot_estimate, notice_total): (notice_id, parties, estimate, total, payable).

    Only winners count, each (lot, party or contractor) once, the first by place, as members of a party restate the same value; a lot's estimate counts
    once; the notice's total belongs to a party only if there is one.
    """
    one = awards.filter("is_winner").groupBy("notice_id", "lot", F.coalesce("party", "contractor").alias("party")).agg(
        F.min_by(F.struct("value", "lot_estimate", "notice_total"), "place").alias("a"), F.min("place").alias("place"))
    lots = one.groupBy("notice_id", "lot").agg(F.count("*").alias("parties"), F.sum("a.value").alias("payable"), F.min_by("a.lot_estimate", "place").alias("estimate"), F.max("a.notice_total").alias("total"))
    parties = F.sum("parties")
    return lots.groupBy("notice_id").agg(parties.alias("parties"), F.sum("estimate").alias("estimate"), F.when(parties == 1, F.max("total")).alias("total"), F.sum("payable").alias("payable"))


def to_euro(amounts: DataFrame, rates: DataFrame) -> DataFrame:
    """amounts(currency, day, amount), rates(currency, day, per_euro): adds eur at the newest rate of that day or before; without one NULL. EUR stays.

    Rates and amounts of a currency and month go through one window, with each month opened by the newest rate before it, so a currency that has most
    rows is still split by month.
    """
    month = lambda d: F.trunc(d, "month")
    a = amounts.withColumns({"_month": month("day"), "_rate": F.lit(None).cast("double"), "_is": F.lit(1)})
    r = rates.filter("per_euro > 0").groupBy("currency", "day").agg(F.min("per_euro").alias("_rate"))
    months = a.select("currency", "_month").distinct()
    # The last rate of each month with rates, carried over months with amounts; both are small: currencies times months.
    last = r.groupBy("currency", month("day").alias("_month")).agg(F.max_by("_rate", "day").alias("_last"))
    before = Window.partitionBy("currency").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    opened = months.join(last, ["currency", "_month"], "full").withColumn("_open", F.last("_last", ignorenulls=True).over(before)).select("currency", "_month", "_open")
    day = Window.partitionBy("currency", "_month").orderBy("day", "_is").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A day's amounts share one rate, so distinct days are enough in the window.
    days = a.select("currency", "_month", "day", "_rate", "_is").distinct().unionByName(r.select("currency", month("day").alias("_month"), "day", "_rate", F.lit(0).alias("_is")))
    known = days.withColumn("_rate", F.last("_rate", ignorenulls=True).over(day)).filter("_is = 1").join(opened, ["currency", "_month"], "left").select(
        F.col("currency").alias("_c"), F.col("day").alias("_d"), F.coalesce("_rate", "_open").alias("_known"))
    out = amounts.join(known, (F.col("currency") == F.col("_c")) & (F.col("day") == F.col("_d")), "left")
    return out.withColumn("eur", F.when(F.col("currency") == "EUR", F.col("amount")).otherwise(F.col("amount") / F.col("_known"))).drop("_c", "_d", "_known")


def growth(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Change to the previous year present, in per cent of its absolute value; NULL after a missing or zero year."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy("year"))
    return rows.withColumn("growth", F.when(before != 0, (F.col(value) - before) / F.abs(before) * 100))


def granted(rows: DataFrame, by: str, amount: Column) -> DataFrame:
    """Per group the grants and their sum; one without an amount counts, with 0."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), S.rounded(F.sum(F.coalesce(amount, F.lit(0.0))), 0).alias("granted"))


def parties(resolved: DataFrame) -> DataFrame:
    """resolved(notice_id, place, company, name, is_winner, layer, tier, confidence, created): a row per notice, company and role (winner, named_tenderer), the first by place, with where the match came
    from: its tier, or vat for layer 1; no confidence for a company that was made for it. Suppliers without a name can't be shown and are left out."""
    role = F.when(F.coalesce("is_winner", F.lit(True)), "winner").otherwise("named_tenderer")
    rows = resolved.filter("name IS NOT NULL AND name <> ''").withColumns({
        "role": role, "match_tier": F.coalesce("tier", F.when(F.col("layer") == 1, "vat")), "match_confidence": F.when(~F.coalesce("created", F.lit(False)), F.col("confidence"))})
    first = rows.groupBy("notice_id", "company", "role").agg(F.min_by(F.struct("name", "match_tier", "match_confidence", "layer"), "place").alias("p"), F.count("*").alias("lots"))
    return first.select("notice_id", "company", "role", "p.name", "p.match_tier", "p.match_confidence", F.col("p.layer").alias("match_layer"), "lots")
