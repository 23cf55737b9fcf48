"""A catalogue of checks that share scans: all checks on one frame are aggregates of one pass over it.

A check is declared as a condition that its violations (or, for coverage, its covered rows) fulfil. The columns of all checks on a frame go into one ``agg``; checks that can't even be analysed are
set aside before, and where a pass fails, its checks are measured in halves until the faulty ones stand alone, so one broken check costs a few passes and not the others' results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "frame string, assertion string, family string, severity string, value long, total long, status string, error string"


@dataclass(frozen=True)
class Check:
    """frame: the name of what is scanned; violates: SQL condition over its rows; among: rows that count at all; rule: over value and total; label: what names an offender."""

    frame: str
    name: str
    family: str
    violates: str
    severity: str = "block"
    among: str = "true"
    rule: tuple = ("zero",)
    label: str | None = None


def holds(rule: tuple, value: int, total: int) -> bool:
    """zero; at_most n; at_least n; coverage share (an empty total passes); band low high least_sample (small samples pass); within tolerance (share of total)."""
    kind, *given = rule
    if kind == "zero":
        return value == 0
    if kind == "at_most":
        return value <= given[0]
    if kind == "at_least":
        return value >= given[0]
    if kind == "coverage":
        return total == 0 or value >= given[0] * total
    if kind == "within":
        return value <= given[0] * total
    if kind == "band":
        low, high, least = given
        return total < least or low * total <= value <= high * total
    raise ValueError(f"no rule {kind!r}")


def status(check: Check, value: int, total: int) -> str:
    return "pass" if holds(check.rule, value, total) else "fail" if check.severity == "block" else "warn"


def _columns(check: Check, place: int) -> list[Column]:
    return [F.expr(f"count_if(({check.among}) AND coalesce({check.violates}, false))").cast("long").alias(f"v{place}"), F.expr(f"count_if({check.among})").cast("long").alias(f"t{place}")]


def measure(frame: DataFrame, checks: list[Check]) -> list[tuple]:
    """(check, value, total, error) of all checks, in one pass over the frame unless one of them fails."""
    good, out = [], []
    for c in checks:
        try:
            frame.agg(*_columns(c, 0)).schema  # analysis alone
            good.append(c)
        except Exception as e:
            out.append((c, None, None, str(e).split("\n")[0][:200]))

    def pass_over(part: list[Check]) -> None:
        if not part:
            return
        try:
            row = frame.agg(*(x for i, c in enumerate(part) for x in _columns(c, i))).first()
            out.extend((c, row[f"v{i}"], row[f"t{i}"], None) for i, c in enumerate(part))
        except Exception as e:
            if len(part) == 1:
                out.append((part[0], None, None, str(e).split("\n")[0][:200]))
                return
            pass_over(part[: len(part) // 2])
            pass_over(part[len(part) // 2 :])

    pass_over(good)
    return out


def run(spark: SparkSession, frames: dict[str, Callable[[], DataFrame]], checks: list[Check]) -> DataFrame:
    """A row per check: frame, assertion, family, severity, value, total, status (pass, fail, warn, error), error. As many passes as frames; one row of each reaches the driver."""
    if repeated := {c.name for c in checks if sum(c.name == d.name for d in checks) > 1}:
        raise ValueError(f"repeated names: {sorted(repeated)}")
    rows = []
    for name in dict.fromkeys(c.frame for c in checks):
        own = [c for c in checks if c.frame == name]
        try:
            measured = measure(frames[name](), own)
        except Exception as e:  # the frame itself can't be made
            measured = [(c, None, None, str(e).split("\n")[0][:200]) for c in own]
        for c, value, total, error in measured:
            state = ("error" if c.severity == "block" else "warn") if error else status(c, value, total)
            rows.append((c.frame, c.name, c.family, c.severity, value, total, state, error))
    return spark.createDataFrame(rows, RESULT)


def offenders(frames: dict[str, Callable[[], DataFrame]], checks: list[Check]) -> DataFrame:
    """assertion, label: every row that breaks a check with a label; of one frame in one pass."""
    out = None
    for name in dict.fromkeys(c.frame for c in checks if c.label):
        own = [c for c in checks if c.frame == name and c.label]
        each = F.array_compact(F.array(*(F.when(F.expr(f"({c.among}) AND coalesce({c.violates}, false)"), F.struct(F.lit(c.name).alias("assertion"), F.expr(c.label).cast("string").alias("label"))) for c in own)))
        rows = frames[name]().select(F.explode(each).alias("o")).select("o.assertion", "o.label")
        out = rows if out is None else out.unionByName(rows)
    return out


def as_sql(checks: list[Check], views: dict[str, str]) -> str:
    """The same results as one SQL statement over views (name: query), for comparison with another engine."""
    def rule_sql(c: Check) -> str:
        kind, *given = c.rule
        return {
            "zero": lambda: "value = 0", "at_most": lambda: f"value <= {given[0]}", "at_least": lambda: f"value >= {given[0]}", "coverage": lambda: f"total = 0 OR value >= {given[0]}::DOUBLE * total",
            "within": lambda: f"value <= {given[0]}::DOUBLE * total", "band": lambda: f"total < {given[2]} OR value BETWEEN {given[0]}::DOUBLE * total AND {given[1]}::DOUBLE * total",
        }[kind]()

    parts = []
    for c in checks:
        one = f"SELECT count(*) FILTER (({c.among}) AND coalesce({c.violates}, false)) AS value, count(*) FILTER ({c.among}) AS total FROM {c.frame}_"
        parts.append(f"SELECT '{c.frame}' AS frame, '{c.name}' AS assertion, '{c.family}' AS family, '{c.severity}' AS severity, value, total, CASE WHEN {rule_sql(c)} THEN 'pass' ELSE '{'fail' if c.severity == 'block' else 'warn'}' END AS status FROM ({one})")
    return "WITH " + ", ".join(f"{k}_ AS ({v})" for k, v in views.items()) + " " + " UNION ALL ".join(parts)
