"""States as merges: what is stored and what comes in give what is to be stored.

Every function takes and gives frames; the caller writes the result as a new table or partition, so a repeated run gives the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key; incoming rows win over stored ones, and later ones by order over earlier. One shuffle with partial aggregation, no join."""
    rest = [c for c in stored.columns if c not in keys]
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.select(*stored.columns).withColumn("_new", F.lit(1)))
    last = F.max_by(F.struct(*rest), F.struct("_new", *(order or rest)))
    return both.groupBy(*keys).agg(last.alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*stored.columns)


def upsert_filled(stored: DataFrame, incoming: DataFrame, key: str, lists: list[str]) -> DataFrame:
    """As upsert, but null columns and empty lists of incoming rows leave what is stored."""
    new = incoming.select(*(F.col(c).alias(f"_{c}") for c in stored.columns))
    both = stored.join(new, F.col(key) == F.col(f"_{key}"), "full")
    sent = lambda c: F.when(F.size(f"_{c}") > 0, F.col(f"_{c}")) if c in lists else F.col(f"_{c}")
    return both.select(*(F.coalesce(sent(c), F.col(c)).alias(c) for c in stored.columns))


def merge_changes(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """(entity, first_seen, last_changed, edit_count, is_deleted): earliest and latest times, edits added up, deletion as the later change has it (incoming on a tie)."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return both.groupBy("entity").agg(F.min("first_seen").alias("first_seen"), F.max("last_changed").alias("last_changed"), F.sum("edit_count").alias("edit_count"),
                                      F.max_by("is_deleted", F.struct("last_changed", "_new")).alias("is_deleted"))


def done(stored: DataFrame, finished: DataFrame, key: str = "entity", version: str = "last_changed") -> DataFrame:
    """Removes finished rows, but for those that changed while they were worked on."""
    return stored.join(finished.select(key, version).distinct(), [key, version], "left_anti")


def insert_absent(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Stored rows stay as they are; of new keys the smallest row comes in."""
    rest = [c for c in stored.columns if c != key]
    fresh = incoming.join(stored.select(key), key, "left_anti").groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in rest))
    return stored.unionByName(fresh.select(*stored.columns))


def disable_others(catalog: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """enabled goes false where the key isn't kept; nothing kept disables all."""
    kept = keep.select(F.col(key).alias("_kept")).distinct()
    out = catalog.join(kept, F.col(key) == F.col("_kept"), "left")
    return out.withColumn("enabled", F.col("enabled") & F.col("_kept").isNotNull()).drop("_kept")


def snapshot_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """A full snapshot as changes: (key, change) with insert, update, delete; equal rows give none."""
    rest = [c for c in after.columns if c != key]
    old = before.select(F.col(key).alias("_key"), F.struct(*rest).alias("_old"))
    both = old.join(after.select(key, F.struct(*rest).alias("_new")), F.col("_key") == F.col(key), "full")
    change = F.when(F.col("_key").isNull(), "insert").when(F.col(key).isNull(), "delete").when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    return both.select(F.coalesce(key, "_key").alias(key), change.alias("change")).filter("change IS NOT NULL")


def claimable(state: Column, claimed: Column, attempts: Column, found: Column, now: Column, most_attempts: int = 5, stale_minutes: int = 15) -> Column:
    """Work that is open: nothing found yet, attempts left, and not held by a worker whose claim is still fresh."""
    stale = (state == "in_progress") & (claimed < now - F.make_interval(mins=F.lit(stale_minutes)))
    return found.isNull() & (F.coalesce(attempts, F.lit(0)) < most_attempts) & F.coalesce(state.isNull() | state.isin("pending", "transient_error") | stale, F.lit(False))


def record_outcomes(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """rows(id, procedure, contract_key, number, state, attempts), outcomes(id, outcome, found), one outcome per id at most.

    A number is written once; a transient error costs an attempt; settled rows don't change. A contract without procedure that is keyed by its own id
    moves to the number, unless another contract holds that key already; of several that would, the smallest id does.
    """
    o = outcomes.select(F.col("id").alias("_id"), "outcome", "found")
    held = rows.select(F.col("contract_key").alias("_held")).distinct()
    first = rows.join(o, F.col("id") == F.col("_id")).filter("number IS NULL AND procedure IS NULL AND contract_key = id").groupBy(F.col("found").alias("_num")).agg(F.min("id").alias("_first"))
    both = rows.join(o, F.col("id") == F.col("_id"), "left").join(first, F.col("found") == F.col("_num"), "left").join(held, F.col("found") == F.col("_held"), "left")
    live = F.col("_id").isNotNull() & F.col("number").isNull() & (F.col("state").isNull() | F.col("state").isin("pending", "in_progress", "transient_error"))
    failed = F.coalesce(F.col("outcome") == "transient_error", F.lit(False))
    state = F.when(live & F.col("found").isNotNull(), "done").when(live & F.col("outcome").isin("not_published", "transient_error"), F.col("outcome")).otherwise(F.col("state"))
    moves = live & F.col("found").isNotNull() & F.col("procedure").isNull() & (F.col("contract_key") == F.col("id")) & F.col("_held").isNull() & (F.col("_first") == F.col("id"))
    return both.select("id", "procedure", F.when(moves, F.col("found")).otherwise(F.col("contract_key")).alias("contract_key"), F.when(live, F.col("found")).otherwise(F.col("number")).alias("number"),
                       state.alias("state"), (F.coalesce("attempts", F.lit(0)) + (live & failed).cast("int")).alias("attempts"))


def decide(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """queue(id, state, value, confidence), decisions(id, verdict, corrected): a correction between 0 and 1e12 gives the value at confidence 1, bogus ones lose theirs; others stay pending."""
    d = decisions.select(F.col("id").alias("_id"), "verdict", "corrected")
    both = queue.join(d, F.col("id") == F.col("_id"), "left")
    open_ = F.col("state") == "pending"
    fixed = F.coalesce(open_ & (F.col("verdict") == "corrected") & (F.col("corrected") > 0) & (F.col("corrected") < 1e12), F.lit(False))
    bogus = F.coalesce(open_ & (F.col("verdict") == "confirmed_bogus"), F.lit(False))
    return both.select("id", F.when(fixed, "corrected").when(bogus, "confirmed_bogus").otherwise(F.col("state")).alias("state"),
                       F.when(fixed, F.col("corrected")).when(~bogus, F.col("value")).alias("value"), F.when(fixed, 1.0).otherwise(F.col("confidence")).alias("confidence"))
