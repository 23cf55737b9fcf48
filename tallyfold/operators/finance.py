"""Company fundamentals, valuation and screens from annual filings; prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S


def fundamentals(filings: DataFrame, years: int = 5) -> DataFrame:
    """Ratios per company and year for the newest years present; growth is against the previous year present."""
    c = F.col
    by_year = Window.partitionBy("company").orderBy(F.desc("year"))
    previous = lambda x: F.lead(x).over(by_year)
    growth = lambda x: F.when(previous(x) != 0, (c(x) - previous(x)) / F.abs(previous(x)) * 100)
    out = filings.withColumn("n", F.dense_rank().over(by_year)).withColumns({
        "eps": S.safe_div(c("net_income"), c("shares")),
        "revenue_growth": growth("revenue"), "earnings_growth": growth("net_income")})
    out = out.filter(c("n") <= years).withColumns({
        "pe": S.price_ratio(c("price"), c("eps")),
        "pb": S.price_ratio(c("price"), S.safe_div(c("equity"), c("shares"))),
        "ps": S.price_ratio(c("price"), S.safe_div(c("revenue"), c("shares"))),
        "roe": S.safe_div(c("net_income"), c("equity")) * 100,
        "npm": S.safe_div(c("net_income"), c("revenue")) * 100,
        "debt_to_equity": S.safe_div(c("liabilities"), c("equity")),
        "dividend_yield": F.coalesce(S.price_ratio(c("dividend"), c("price")) * 100, F.lit(0.0))})
    return out.select("company", "year", *(S.rounded(x, 4).alias(x) for x in RATIOS))


RATIOS = ("eps", "pe", "pb", "ps", "roe", "npm", "debt_to_equity", "dividend_yield", "revenue_growth", "earnings_growth")
#: Fixed limits of the long-term screen: ratio, at most (-1) or at least (1), limit.
LONG_LIMITS = (("pe", -1, 15.0), ("pb", -1, 1.5), ("roe", 1, 15.0), ("npm", 1, 15.0), ("debt_to_equity", -1, 1.5), ("dividend_yield", 1, 3.5))


def averages(per_year: DataFrame) -> DataFrame:
    return per_year.groupBy("company").agg(F.count("*").alias("years"), *(S.rounded(F.avg(x), 3).alias(f"avg_{x}") for x in RATIOS))


def long_screen(averaged: DataFrame) -> DataFrame:
    """A flag per limit (false where the ratio is missing) and passes_all."""
    flags = {f"{r}_ok": F.coalesce(F.col(f"avg_{r}") <= limit if way < 0 else F.col(f"avg_{r}") >= limit, F.lit(False)) for r, way, limit in LONG_LIMITS}
    out = averaged.withColumns(flags)
    return out.withColumn("passes_all", F.forall(F.array(*flags), lambda x: x)).select("company", *flags, "passes_all")


def valuation(filings: DataFrame) -> DataFrame:
    """EBITDA, NOPAT, ROIC and enterprise-value multiples of each company's newest year."""
    c = F.col
    newest = filings.groupBy("company").agg(F.max_by(F.struct(*filings.columns), "year").alias("f")).select("f.*")
    tax = S.clamp(F.coalesce(S.safe_div(c("tax"), c("pretax")), F.lit(0.21)), 0.0, 0.5)
    out = newest.withColumns({
        "ebitda": c("operating_income") + F.coalesce(c("depreciation"), F.lit(0.0)),
        "net_debt": F.coalesce(c("debt"), F.lit(0.0)) - F.coalesce(c("cash"), F.lit(0.0)),
        "nopat": c("operating_income") * (1 - tax)})
    out = out.withColumns({"ev": c("price") * c("shares") + c("net_debt"), "roic": S.safe_div(c("nopat"), c("equity") + c("net_debt")) * 100})
    return out.select("company", "year", *(S.rounded(x, 4).alias(n) for n, x in {
        "ebitda": c("ebitda"), "ebitda_margin": S.safe_div(c("ebitda"), c("revenue")) * 100, "net_debt": c("net_debt"), "nopat": c("nopat"), "roic": c("roic"),
        "ev": c("ev"), "ev_ebitda": S.safe_div(c("ev"), c("ebitda")), "ev_revenue": S.safe_div(c("ev"), c("revenue")), "ev_ebit": S.safe_div(c("ev"), c("operating_income"))}.items()))


def change_ranks(prices: DataFrame) -> DataFrame:
    """ticker, date, probability: each day's place by its rise, falling, as a share of the ticker's days; equal rises in order of the days, the first day counts as no change."""
    w = Window.partitionBy("ticker")
    before = F.lag("close").over(w.orderBy("date"))
    changed = prices.withColumn("change", F.coalesce((F.col("close") - before) / F.nullif(before, F.lit(0.0)), F.lit(0.0)))
    return changed.select("ticker", "date", S.rounded(F.row_number().over(w.orderBy(F.desc("change"), "date")) / F.count("*").over(w), 6).alias("probability"))


def recent(prices: DataFrame, months: int = 6) -> DataFrame:
    """Rows of the last months before each ticker's newest date."""
    newest = F.max("date").over(Window.partitionBy("ticker"))
    return prices.withColumn("_newest", newest).filter(F.col("date") > F.add_months("_newest", -months)).drop("_newest")


def win_probability(prices: DataFrame) -> DataFrame:
    """(days with a rise + 1) / days: the place of the first day without a fall among the changes; the first day counts as no change."""
    w = Window.partitionBy("ticker").orderBy("date")
    change = F.coalesce(S.safe_div(F.col("close") - F.lag("close").over(w), F.lag("close").over(w)), F.lit(0.0))
    return prices.withColumn("change", change).groupBy("ticker").agg(S.rounded((F.count_if(F.col("change") > 0) + 1) / F.count("*"), 6).alias("win"))


def monthly_swings(prices: DataFrame) -> DataFrame:
    """Per ticker and month: the largest rise from a day's low to a later high, the deepest fall from a later low to a day's high."""
    # Running extremes from the month's end backwards; a frame that only grows is linear.
    back = Window.partitionBy("ticker", "month").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, 0)
    rows = prices.withColumn("month", F.date_format("date", "yyyy-MM")).withColumns({"top": F.max("high").over(back), "floor": F.min("low").over(back)})
    rows = rows.withColumns({"up": F.when(F.col("low") > 0, F.col("top") / F.col("low") - 1), "down": F.when(F.col("floor") > 0, 1 - F.col("high") / F.col("floor"))})
    return rows.groupBy("ticker", "month").agg(S.rounded(F.max("up"), 6).alias("vup"), S.rounded(F.min("down"), 6).alias("vdown"))


def moving_average(prices: DataFrame, rows: int = 43) -> DataFrame:
    """Mean of the newest closes, and how far it lies above the last close, as a share of that close."""
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    out = prices.withColumn("n", F.row_number().over(newest)).filter(F.col("n") <= rows).groupBy("ticker").agg(F.avg("close").alias("mat"), F.max_by("close", "date").alias("last"))
    return out.select("ticker", S.rounded("mat", 4).alias("mat"), S.rounded(F.when(F.col("last") > 0, (F.col("mat") - F.col("last")) / F.col("last")), 6).alias("diff_mat"))


def market_snapshot(prices: DataFrame, rows: int = 252) -> DataFrame:
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    return prices.withColumn("n", F.row_number().over(newest)).filter(F.col("n") <= rows).groupBy("ticker").agg(
        S.rounded(F.max_by("close", "date"), 4).alias("last_close"), S.rounded(F.avg("volume"), 4).alias("avg_volume"), S.rounded(F.max("high"), 4).alias("high_52w"), S.rounded(F.min("low"), 4).alias("low_52w"))


#: Fixed limits of the short-term screen: least volume, price band, least win probability, rise, fall and distance of the moving average.
SHORT_LIMITS = {"volume": 1_000_000.0, "low": 0.40, "high": 2.50, "win": 0.5, "up": 0.3, "down": -0.3, "mat": -0.025}
LEAST_ROWS = 5


def short_screen(prices: DataFrame, tickers: DataFrame | None = None, **limits: float) -> DataFrame:
    """Volume, price, win probability, swings and distance from the moving average with a flag for each limit and passes. Tickers with fewer than LEAST_ROWS rows in the
    window, and those of tickers(ticker) without prices, have the empty result: 0 or missing, all flags false."""
    at = SHORT_LIMITS | limits
    window = recent(prices)
    enough = window.groupBy("ticker").agg(F.count("*").alias("rows")).filter(F.col("rows") >= LEAST_ROWS).select("ticker")
    window = window.join(enough, "ticker", "left_semi")
    swings = monthly_swings(window).groupBy("ticker").agg(S.rounded(F.avg("vup"), 6).alias("avg_vup"), S.rounded(F.avg("vdown"), 6).alias("avg_vdown"))
    snap = market_snapshot(prices).select("ticker", "last_close", "avg_volume")
    if tickers is not None:
        snap = tickers.select("ticker").distinct().join(snap, "ticker", "left")
    out = snap.join(win_probability(window), "ticker", "left").join(swings, "ticker", "left").join(moving_average(window), "ticker", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("win", "avg_vup", "avg_vdown")})
    c = F.col
    flags = {
        "volume_ok": c("avg_volume") > at["volume"], "price_ok": c("last_close").between(at["low"], at["high"]), "win_ok": c("win") > at["win"],
        "swing_ok": (c("avg_vup") > at["up"]) & (c("avg_vdown") < at["down"]), "mat_ok": c("diff_mat") > at["mat"]}
    out = out.withColumns({n: F.coalesce(f & c("mat").isNotNull(), F.lit(False)) for n, f in flags.items()})
    return out.withColumn("passes", F.forall(F.array(*flags), lambda x: x)).select("ticker", "last_close", "avg_volume", "win", "avg_vup", "avg_vdown", "diff_mat", *flags, "passes")


INPUTS = ("revenue", "gross_profit", "operating_income", "net_income", "assets", "liabilities", "equity", "shares", "current_assets", "current_liabilities", "inventory", "prepaid",
          "operating_cashflow", "capex", "dividend", "price")
FULL = ("avg_price", "revenue", "gross_profit", "operating_income", "net_income", "eps", "total_assets", "total_liabilities", "equity", "shares", "current_assets", "current_liabilities",
        "operating_cashflow", "capex", "free_cashflow", "book_value_per_share", "revenue_per_share", "fcf_per_share", "dividend_per_share", "pe", "pb", "ps", "roe", "roa", "npm",
        "gross_margin", "operating_margin", "current_ratio", "quick_ratio", "debt_to_equity", "debt_to_assets", "fcf_yield", "dividend_yield", "revenue_growth", "earnings_growth")


def _with_inputs(filings: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Columns that a source doesn't report are missing."""
    return filings.withColumns({n: F.lit(None).cast("double") for n in names if n not in filings.columns})


def fundamentals_full(filings: DataFrame, years: int = 5) -> DataFrame:
    """All figures and ratios per company and year for the newest years present. Shares, not reported per filing, may be missing; free cash flow is operating cash flow less
    capital expenditure, whatever its sign is reported as; inventory and prepaid costs count as 0 in the quick ratio where they are missing."""
    c = F.col
    by_year = Window.partitionBy("company").orderBy(F.desc("year"))
    previous = lambda x: F.lead(x).over(by_year)
    growth = lambda x: F.when(previous(x) != 0, (c(x) - previous(x)) / F.abs(previous(x)) * 100)
    div = lambda a, b: S.safe_div(a, b)
    out = _with_inputs(filings, INPUTS).withColumns({"n": F.dense_rank().over(by_year), "revenue_growth": growth("revenue"), "earnings_growth": growth("net_income")}).filter(c("n") <= years)
    out = out.withColumns({"avg_price": c("price"), "total_assets": c("assets"), "total_liabilities": c("liabilities"), "dividend_per_share": c("dividend"), "eps": div(c("net_income"), c("shares")),
                           "free_cashflow": c("operating_cashflow") - F.abs("capex"), "book_value_per_share": div(c("equity"), c("shares")), "revenue_per_share": div(c("revenue"), c("shares"))})
    quick = c("current_assets") - F.coalesce("inventory", F.lit(0.0)) - F.coalesce("prepaid", F.lit(0.0))
    out = out.withColumns({
        "fcf_per_share": div(c("free_cashflow"), c("shares")), "pe": S.price_ratio(c("price"), c("eps")), "pb": S.price_ratio(c("price"), c("book_value_per_share")),
        "ps": S.price_ratio(c("price"), c("revenue_per_share")), "roe": div(c("net_income"), c("equity")) * 100, "roa": div(c("net_income"), c("assets")) * 100,
        "npm": div(c("net_income"), c("revenue")) * 100, "gross_margin": div(c("gross_profit"), c("revenue")) * 100, "operating_margin": div(c("operating_income"), c("revenue")) * 100,
        "current_ratio": div(c("current_assets"), c("current_liabilities")), "quick_ratio": div(quick, c("current_liabilities")), "debt_to_equity": div(c("liabilities"), c("equity")),
        "debt_to_assets": div(c("liabilities"), c("assets")), "dividend_yield": F.coalesce(F.when(c("price") > 0, c("dividend") / c("price") * 100), F.lit(0.0))})
    out = out.withColumn("fcf_yield", div(c("fcf_per_share"), c("price")) * 100)
    return out.select("company", "year", *(S.rounded(x, 4).alias(x) for x in FULL))


VALUATION_INPUTS = ("depreciation", "interest_expense", "cash", "long_term_debt", "free_cashflow")


def valuation_per_year(filings: DataFrame, years: int = 5) -> DataFrame:
    """Per company and year of the newest years: EBITDA, debt, coverage, tax rate (tax of income before it, within 0 to 0.5, 0.21 where it can't be told), invested capital and its
    return. Debt, cash and depreciation count as 0 where they are missing and aren't shown where they are 0."""
    c = F.col
    zero = lambda x: F.coalesce(c(x), F.lit(0.0))
    newest = F.dense_rank().over(Window.partitionBy("company").orderBy(F.desc("year")))
    shown = lambda x: F.when(F.abs(zero(x)) > 1e-9, zero(x))
    tax = F.coalesce(F.when(c("net_income") + c("tax") != 0, S.clamp(c("tax") / (c("net_income") + c("tax")), 0.0, 0.5)), F.lit(0.21))
    out = _with_inputs(filings, (*VALUATION_INPUTS, "tax")).withColumn("n", newest).filter(c("n") <= years).withColumns({
        "ebitda": c("operating_income") + zero("depreciation"), "net_debt": zero("long_term_debt") - zero("cash"), "tax_rate": tax,
        "invested_capital": c("equity") + zero("long_term_debt") - zero("cash")})
    out = out.withColumn("nopat", c("operating_income") * (1 - c("tax_rate")))
    return out.select("company", "year", *(S.rounded(x, 4).alias(n) for n, x in {
        "da": shown("depreciation"), "cash": shown("cash"), "long_term_debt": shown("long_term_debt"), "ebitda": c("ebitda"), "ebitda_margin": S.safe_div(c("ebitda"), c("revenue")) * 100,
        "net_debt": c("net_debt"), "net_debt_to_ebitda": S.safe_div(c("net_debt"), c("ebitda")), "interest_coverage": F.when(c("interest_expense") > 0, S.safe_div(c("operating_income"), c("interest_expense"))),
        "effective_tax_rate": c("tax_rate") * 100, "nopat": c("nopat"), "invested_capital": c("invested_capital"), "roic": S.safe_div(c("nopat"), c("invested_capital")) * 100}.items()))


def valuation_averages(per_year: DataFrame) -> DataFrame:
    """Means over the years of the ratios that aren't missing."""
    return per_year.groupBy("company").agg(*(S.rounded(F.avg(x), 4).alias(f"avg_{x}") for x in ("ebitda_margin", "net_debt_to_ebitda", "interest_coverage", "roic")))


def filing_source(source: Column, country: Column) -> Column:
    """Where a filing is from: as reported, else by the company's country."""
    return F.coalesce(F.lower(source), F.when(country == "US", "edgar").otherwise("esef"))


def as_series(filings: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Filings under the names that the analysis knows; rows without a year go."""
    return filings.filter("year IS NOT NULL").withColumnsRenamed(renamed)


def raw_dataset(full: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Annual rows beside the market snapshot, as the spreadsheet has them: capital expenditure as an outflow."""
    return full.join(snapshot, "company", "left").withColumn("capex", -F.abs("capex"))


def enterprise_multiples(filings: DataFrame, snapshot: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """snapshot(company, price, shares): market value, net debt of the newest year (missing debt and cash count as 0), their sum and its multiples of EBITDA (of the newest year that has it), revenue,
    free cash flow and operating income. A company without filings has its market value alone; one of companies(company) that nothing is known of has only missing values."""
    c = F.col
    rows = _with_inputs(filings, (*VALUATION_INPUTS, *INPUTS)).withColumns({
        "ebitda": c("operating_income") + F.coalesce("depreciation", F.lit(0.0)), "net_debt": F.coalesce("long_term_debt", F.lit(0.0)) - F.coalesce("cash", F.lit(0.0)), "fcf": c("operating_cashflow") - F.abs("capex")})
    newest = rows.groupBy("company").agg(*(F.max_by(x, "year").alias(x) for x in ("net_debt", "revenue", "fcf", "operating_income")), F.max_by("ebitda", F.when(c("ebitda").isNotNull(), c("year"))).alias("ebitda"))
    held = snapshot.select("company", F.when((c("shares") > 0) & (c("price") > 0), c("price") * c("shares")).alias("market_cap"))
    out = held.join(newest, "company", "full")
    if companies is not None:
        out = companies.select("company").distinct().join(out, "company", "left")
    out = out.withColumn("ev", c("market_cap") + c("net_debt"))
    of = {"market_cap": c("market_cap"), "net_debt": c("net_debt"), "ev": c("ev"), "ev_ebitda": S.safe_div(c("ev"), c("ebitda")), "ev_revenue": S.safe_div(c("ev"), c("revenue")), "ev_fcf": S.safe_div(c("ev"), c("fcf")), "ev_ebit": S.safe_div(c("ev"), c("operating_income"))}
    return out.select("company", *(S.rounded(x, 4).alias(n) for n, x in of.items()))


def price_ages(tickers: DataFrame, prices: DataFrame, as_of: Column, fresh: int = 7, ageing: int = 30) -> DataFrame:
    """tickers(ticker, sector): per sector how many have a newest price of at most so many days, of more, of more still, or none at all, and the share of fresh ones among those with prices."""
    newest = prices.groupBy("ticker").agg(F.max("date").alias("_newest"))
    age = F.datediff(as_of, F.col("_newest"))
    n = {"fresh": age <= fresh, "ageing": (age > fresh) & (age <= ageing), "stale": age > ageing, "never": F.col("_newest").isNull()}
    out = tickers.join(newest, "ticker", "left").groupBy("sector").agg(F.count("*").alias("tickers"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in n.items()))
    return out.withColumn("fresh_pct", S.rounded(F.col("fresh") / F.nullif(F.col("tickers") - F.col("never"), F.lit(0)) * 100, 1))
