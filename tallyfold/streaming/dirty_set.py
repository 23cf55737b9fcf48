"""Change events: classification and the keyed set of entities that changed, as batch and as stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The 24 languages whose label edits count, and the one for all; fixed values.
LANGUAGES = ("bg", "cs", "da", "de", "el", "en", "es", "et", "fi", "fr", "ga", "hr", "hu", "it", "lt", "lv", "mt", "nl", "pl", "pt", "ro", "sk", "sl", "sv", "mul")


def classify(events: DataFrame) -> DataFrame:
    """events(type, comment, log_type, log_action): adds action DIRTY, DELETED or IGNORE; what can't be read is DIRTY."""
    kind = F.regexp_extract(F.coalesce("comment", F.lit("")), r"^/\*\s*([a-z-]+)", 1)
    language = F.regexp_extract(F.coalesce("comment", F.lit("")), r":\d+\|([A-Za-z-]+)", 1)
    term = kind.rlike("^wbset(label|description|aliases)")
    action = (
        F.when((F.col("type") == "log") & (F.col("log_type") == "delete") & (F.col("log_action") == "delete"), "DELETED")
        .when((F.col("type") == "log") & (F.col("log_type") == "delete") & (F.col("log_action") == "restore"), "DIRTY")
        .when(F.col("type") == "log", "IGNORE")
        .when(kind.rlike("sitelink"), "IGNORE")
        .when(term & (language != "") & ~language.isin(*LANGUAGES), "IGNORE")
        .otherwise("DIRTY")
    )
    return events.withColumn("action", action)


def fold(events: DataFrame) -> DataFrame:
    """events(entity, ts, seq, deleted): per entity first and last change, edits, and whether its last event deletes. By event time and seq, so late and
    repeated delivery don't matter."""
    return events.groupBy("entity").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_changed"), F.count_distinct("seq").alias("edit_count"),
        F.max_by("deleted", F.struct("ts", "seq")).alias("is_deleted"))


#: Times are kept in microseconds, which have no zone to lose.
STATE = "first_seen long, last_changed long, last_seq long, edit_count long, is_deleted boolean"


class Coalescing(StatefulProcessor):
    """One value per entity: first and last change, the last event's number, edits, and whether that event deletes. With ``keep_deleted_ms`` a timer in event time drops the value of an entity
    that was deleted so long ago and hasn't changed since."""

    def __init__(self, keep_deleted_ms: int | None = None):
        self.keep_deleted_ms = keep_deleted_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entity = handle.getValueState("entity", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        first, last, seq, edits, deleted = self.entity.get() if self.entity.exists() else (None, None, None, 0, False)
        for r in rows:
            edits += 1
            first = r["at"] if first is None else min(first, r["at"])
            if last is None or (r["at"], r["seq"]) > (last, seq):
                last, seq, deleted = r["at"], r["seq"], r["deleted"]
        self.entity.update((first, last, seq, edits, deleted))
        if self.keep_deleted_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if deleted:
                self.handle.registerTimer(last // 1000 + self.keep_deleted_ms)
        yield Row(entity=key[0], first_seen=first, last_changed=last, last_seq=seq, edit_count=edits, is_deleted=deleted)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.entity.clear()
        yield from ()

    def close(self) -> None:
        pass


def coalesce_stream(spark: SparkSession, source: str, schema: str, shape, checkpoint: str, lateness: str = "30 days", keep_deleted_ms: int | None = None, changes: str | None = None, files: int = 100) -> None:
    """Take all new files of a folder into the keyed state under checkpoint, which is the cursor too: a stream that is started again goes on behind the last file that it has finished.

    State is a value per entity in RocksDB, whatever the number of events. An event that is delivered again (same entity, seq) within ``lateness`` of event time counts once; one that comes later
    than that is left out, like every event before the watermark. With ``changes`` each round's new values are appended there as Parquet. The number of state partitions is the session's
    spark.sql.shuffle.partitions at the first start.
    """
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        events = shape(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source))
        events = events.select("entity", F.col("ts").cast("timestamp").alias("ts"), "seq", "deleted").withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["entity", "seq"])
        kind = events.schema["entity"].dataType.simpleString()
        events = events.withColumn("at", F.unix_micros("ts"))
        values = _timed(events.groupBy("entity").transformWithState(Coalescing(keep_deleted_ms), f"entity {kind}, {STATE}", "append", "eventTime" if keep_deleted_ms is not None else "none"))
        out = values.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        (out.format("parquet").start(changes) if changes else out.format("noop").start()).awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The dirty set as it stands, a row per entity, read from the state store itself."""
    values = spark.read.format("statestore").option("operatorId", "0").option("stateVarName", "entity").load(checkpoint)
    return _timed(values.select("key.entity", "value.*"))


def _timed(values: DataFrame) -> DataFrame:
    return values.withColumns({c: F.timestamp_micros(c) for c in ("first_seen", "last_changed")})
