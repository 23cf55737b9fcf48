"""Declarative assertions: each is a one-row aggregate with an evaluator; a report has one row per assertion."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Assertion:
    """measured: a one-row frame with columns value and total; holds: the condition over them; severity: block or warn."""

    name: str
    severity: str
    measured: Callable[[], DataFrame]
    holds: Column


def zero(column: str = "value") -> Column:
    return F.col(column) == 0


def at_most(limit: float) -> Column:
    return F.col("value") <= limit


def at_least(limit: float) -> Column:
    return F.col("value") >= limit


def coverage(share: float) -> Column:
    """value of total covered; an empty total passes."""
    return (F.col("total") == 0) | (F.col("value") / F.nullif(F.col("total"), F.lit(0)) >= share)


def band(low: float, high: float, least_sample: int) -> Column:
    """The rate value / total lies in a band; small samples pass."""
    return (F.col("total") < least_sample) | (F.col("value") / F.nullif(F.col("total"), F.lit(0))).between(low, high)


def violations(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).cast("long").alias("value"), F.count("*").alias("total"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose key has no parent."""
    keys = parent.select(F.col(parent_key).alias("_key")).distinct()
    return child.join(keys, child[child_key] == F.col("_key"), "left").agg(F.count_if(F.col("_key").isNull()).cast("long").alias("value"), F.count("*").alias("total"))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).cast("long").alias("value"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


def report(assertions: list[Assertion]) -> DataFrame:
    """assertion, severity, value, total, status (pass, fail, warn)."""
    out = None
    for a in assertions:
        held = F.coalesce(a.holds, F.lit(False))
        row = a.measured().select(F.lit(a.name).alias("assertion"), F.lit(a.severity).alias("severity"), F.col("value").cast("long").alias("value"), F.col("total").cast("long").alias("total"),
                                  F.when(held, "pass").when(F.lit(a.severity == "block"), "fail").otherwise("warn").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def run(spark: SparkSession, assertions: list[Assertion], run_at: datetime | None = None) -> DataFrame:
    """Measure each assertion by itself, so one that fails leaves the others standing: its row has no figures and status error (warn where the assertion only warns).
    One row per assertion reaches the driver. All rows share run_at."""
    rows = []
    for a in assertions:
        try:
            r = report([a]).first()
            rows.append((a.name, a.severity, r["value"], r["total"], r["status"], None))
        except Exception as e:
            rows.append((a.name, a.severity, None, None, "error" if a.severity == "block" else "warn", str(e).split("\n")[0][:200]))
    out = spark.createDataFrame(rows, "assertion string, severity string, value long, total long, status string, error string")
    return out.withColumn("run_at", F.lit(run_at or datetime.now(UTC).replace(tzinfo=None)))


def exit_code(results: DataFrame) -> int:
    """1 if anything that blocks failed or couldn't be measured."""
    return int(results.filter("severity = 'block' AND status IN ('fail', 'error')").limit(1).count() > 0)


def keep_results(results: DataFrame, path: str) -> None:
    results.write.mode("append").parquet(path)


def broken_product(df: DataFrame, whole: str, a: str, b: str, tolerance: float = 0.011, spared: Column | None = None) -> DataFrame:
    """Rows whose value isn't the product of its two parts."""
    off = F.abs(F.col(whole) - F.col(a) * F.col(b)) > tolerance
    return violations(df, F.coalesce(off & ~F.coalesce(spared, F.lit(False)) if spared is not None else off, F.lit(False)))


def broken_identity(df: DataFrame, whole: str, a: str, b: str, share: float = 0.02) -> DataFrame:
    """Rows whose positive whole differs from the sum of its parts by more than a share of it."""
    off = (F.col(whole) > 0) & (F.abs(F.col(whole) - (F.col(a) + F.col(b))) / F.col(whole) > share)
    return violations(df, F.coalesce(off, F.lit(False)))


def first_difference(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per key of either store: the first field whose comparable values differ (-0 being 0), or missing_left, missing_right; equal rows are left out. All rows, not a sample."""
    from tallyfold.functions.codes import comparable

    side = lambda d, p: d.select(F.col(key), F.lit(True).alias(f"{p}_here"), *(F.regexp_replace(comparable(F.col(f)), "^-0$", "0").alias(f"{p}_{f}") for f in fields))
    both = side(a, "a").join(side(b, "b"), key, "full")
    differs = F.when(F.col("a_here").isNull(), "missing_left").when(F.col("b_here").isNull(), "missing_right")
    for f in fields:
        differs = differs.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), f)
    return both.withColumn("difference", differs).filter("difference IS NOT NULL").select(key, "difference")


def shortfall(store: DataFrame, mirror: DataFrame, key: str, most: float = 0.05) -> DataFrame:
    """One row: counts of both, keys that only one has, and ok: nothing in excess and at most that share missing."""
    s, m = store.select(F.col(key).alias("k")).distinct().withColumn("s", F.lit(1)), mirror.select(F.col(key).alias("k")).distinct().withColumn("m", F.lit(1))
    out = s.join(m, "k", "full").agg(F.count("s").alias("stored"), F.count("m").alias("mirrored"), F.count_if(F.col("m").isNull()).alias("missing"), F.count_if(F.col("s").isNull()).alias("excess"))
    return out.withColumn("ok", (F.col("excess") == 0) & (F.col("missing") <= most * F.col("stored")))


def shape_violations(triples: DataFrame, required: list[str], kinds: dict[str, str], allowed: dict[str, list[str]]) -> DataFrame:
    """subject, predicate, reason for entities that break a shape: a required predicate missing or repeated, an object not of its type, or not of a list."""
    counts = triples.groupBy("subject").agg(*(F.count_if(F.col("predicate") == p).alias(p) for p in required))
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("predicate"), F.when(F.col(p) == 0, "missing").when(F.col(p) > 1, "repeated").alias("reason")) for p in required)))
    lacking = counts.select("subject", each.alias("v")).select("subject", "v.predicate", "v.reason").filter("reason IS NOT NULL")
    wrong = F.lit(None).cast("string")
    for p, kind in kinds.items():
        wrong = F.when((F.col("predicate") == p) & F.col("object").try_cast(kind).isNull(), "type").otherwise(wrong)
    for p, values in allowed.items():
        wrong = F.when((F.col("predicate") == p) & ~F.col("object").isin(values), "value").otherwise(wrong)
    return lacking.unionByName(triples.withColumn("reason", wrong).filter("reason IS NOT NULL").select("subject", "predicate", "reason"))


def gate(rows: DataFrame, broken: DataFrame) -> DataFrame:
    """rows, unless any shape is broken: then the whole batch is refused."""
    if n := broken.count():
        raise ValueError(f"{n} violations of the shape; nothing is written")
    return rows


def resolver_checks(cases: DataFrame, resolved: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Expected answers against a resolver's: cases(case, expect, id, tier, least, entity), resolved(id, hint, tier, score, entity): case, expect, ok, said.

    expect is one of: confident (matched or ambiguous at least at that score), refused (nothing matched, or only below that score), tier (matched by that very tier, at least at that score, never
    ambiguous), entity (matched with that entity). duplicates(node, canonical) are known to be one: a match with either counts as the other. A case without an answer fails, whatever it expects.
    """
    got = resolved.select(F.col("id").alias("_id"), "hint", F.col("tier").alias("got_tier"), "score", F.col("entity").alias("got"))
    rows = cases.join(got, F.col("id").eqNullSafe(F.col("_id")), "left")
    if duplicates is not None:
        to = lambda c: duplicates.select(F.col("node").alias(f"_{c}_node"), F.col("canonical").alias(f"_{c}"))
        rows = rows.join(to("e"), F.col("entity") == F.col("_e_node"), "left").join(to("g"), F.col("got") == F.col("_g_node"), "left")
        rows = rows.withColumns({"entity": F.coalesce("_e", "entity"), "got": F.coalesce("_g", "got")})
    score, found = F.coalesce("score", F.lit(0.0)), F.col("hint") == "matched"
    ok = (
        F.when(F.col("_id").isNull(), False)
        .when(F.col("expect") == "confident", F.col("hint").isin("matched", "ambiguous") & (score >= F.col("least")))
        .when(F.col("expect") == "refused", ~found & ((F.col("hint") == "no_match") | (score < F.col("least"))))
        .when(F.col("expect") == "tier", found & (F.col("got_tier") == F.col("tier")) & (score >= F.col("least")))
        .when(F.col("expect") == "entity", found & (F.col("got") == F.col("entity")))
    )
    said = F.concat_ws(" ", F.coalesce("hint", F.lit("unanswered")), F.coalesce("got_tier", F.lit("-")))
    return rows.select("case", "expect", F.coalesce(ok, F.lit(False)).alias("ok"), said.alias("said"))


def overdue(runs: DataFrame, cadence: DataFrame, now: Column) -> DataFrame:
    """runs(job, started, status), cadence(job, hours): jobs whose last success is older than their cadence, or that have none: job, hours (since then, rounded; missing if never), allowed, said."""
    last = runs.filter("status = 'success'").groupBy("job").agg(F.max("started").alias("_last"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("_last").cast("timestamp"))) / 3_600_000_000
    rows = cadence.select("job", F.col("hours").alias("allowed")).join(last, "job", "left").withColumns({"_age": age, "hours": F.floor(age + 0.5).cast("long")})
    late = rows.filter(F.col("_age").isNull() | (F.col("_age") > F.col("allowed")))
    said = F.concat(F.col("job"), F.lit(" ("), F.coalesce(F.col("hours").cast("string"), F.lit("never")), F.lit("h/"), F.col("allowed").cast("string"), F.lit("h)"))
    return late.select("job", "hours", "allowed", said.alias("said"))
