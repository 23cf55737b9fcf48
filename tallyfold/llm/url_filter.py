"""URL allow and block rules by hashed host-suffix and path-prefix expressions. DataFrame operations only.

A rule is a host with a path; it fits its host and all subdomains when the URL's path starts with the rule's path.
Each URL expands into one expression per (host suffix, path prefix) whose label count and path length occur among the
rules. Expressions meet rules on the first eight hex digits of a SHA-256 alone; what meets is then confirmed on all 64 digits.
Of several fitting rules the longest (host plus path) wins, then the longer host, then block before allow.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule; repeated rows are each judged;
an empty table gives an empty result; columns of the input beyond ``keep`` and the URL are left out, so names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules of up to so many bytes in all are sent to every executor; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
PREFIX_DIGITS = 8

RULE_SCHEMA = "rule_host string, rule_path string, action string"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """rules: (host, path, 'allow' or 'block'); a path starts with '/'."""
    return spark.createDataFrame(rules, RULE_SCHEMA)


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for a null URL or one without '://'."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return df.withColumns({"host": F.translate(host, upper, lower), "path": path})


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow") -> DataFrame:
    """One row per row of pages: keep columns, host, path, rule, verdict."""
    rules = rules.select("rule_host", "rule_path", "action").distinct()
    # One small row: the label counts and path lengths in use (each at most the longest possible URL), and the rule count.
    shape = rules.agg(
        F.coalesce(F.sum(F.length("rule_host") + F.length("rule_path") + 200), F.lit(0)).alias("bytes"),
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    hashed = rules.select(
        _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"),
        "action",
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))

    # _row keeps repeated rows apart while their expressions are looked up, so no page, however often repeated, is one task's.
    rows = with_host_path(pages.select(F.monotonically_increasing_id().alias("_row"), *keep, F.col(url).alias("_url")), "_url")
    hosts = [F.when((F.size(F.split("host", r"\.")) >= n) & (F.col("host") != ""), F.substring_index("host", ".", -n)) for n in sorted(shape["labels"])]
    paths = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shape["lengths"])]
    # The first, null expression stands for the row itself, so rows without a match stay.
    digests = [F.lit(None).cast("string")] + [_digest(h, p) for h in hosts for p in paths]
    expanded = rows.withColumn("digest", F.explode(F.array_union(F.array(digests[0]), F.array_compact(F.array(*digests)))))
    expanded = expanded.withColumn("probe", F.substring("digest", 1, PREFIX_DIGITS))
    if shape["bytes"] <= BROADCAST_BYTES:
        hashed = F.broadcast(hashed)
    met = expanded.join(hashed, F.col("probe") == F.col("prefix"), "left")
    met = met.filter(F.col("digest").isNull() | (F.col("digest") == F.col("rule_digest")))
    won = F.struct(F.length("rule").alias("length"), F.col("host_length"), (F.col("action") == "block").alias("blocks"), F.col("rule"))
    judged = met.groupBy("_row", *keep, "_url").agg(F.max(F.when(F.col("rule").isNotNull(), won)).alias("won"))
    judged = with_host_path(judged, "_url")
    verdict = F.when(F.col("won").isNull(), F.lit(default)).when(F.col("won.blocks"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(*keep, "host", "path", F.col("won.rule").alias("rule"), verdict.alias("verdict"))
