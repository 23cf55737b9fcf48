"""Loads by watermark, change gates, run logs, and entities as triples."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, job string, started timestamp, finished timestamp, status string, message string"


def triples(df: DataFrame, subject: Column, fields: dict[str, Column]) -> DataFrame:
    """A triple per field that isn't missing: subject, predicate, object."""
    pairs = F.array(*(F.struct(F.lit(p).alias("predicate"), c.cast("string").alias("object")) for p, c in fields.items()))
    return df.select(subject.alias("subject"), F.explode(pairs).alias("t")).select("subject", "t.predicate", "t.object").filter("object IS NOT NULL")


def edge_triples(edges: DataFrame, predicates: dict[str, str], subject: Column, target: Column, fields: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """edges(kind, ...): (triples, unmapped): a triple for each edge whose kind has a predicate; an edge with fields of its own is a node as well, named by both its ends, with a triple per field. unmapped
    counts the edges of kinds without a predicate, which would otherwise be lost without a word."""
    to = F.create_map(*(F.lit(x) for kv in predicates.items() for x in kv))
    named = edges.withColumns({"subject": subject, "object": target, "predicate": F.try_element_at(to, F.col("kind"))})
    known = named.filter("predicate IS NOT NULL AND subject IS NOT NULL AND object IS NOT NULL")
    out = known.select("subject", "predicate", "object")
    if fields:
        out = out.unionByName(triples(known, F.concat_ws("/", "subject", "predicate", "object"), fields))
    return out.distinct(), named.filter("predicate IS NULL").groupBy("kind").agg(F.count("*").alias("n"))


def replace_entities(stored: DataFrame, incoming: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """All triples of the subjects that come in are replaced; those of gone(subject) only go."""
    touched = incoming.select("subject").unionByName(gone.select("subject")).distinct() if gone is not None else incoming.select("subject").distinct()
    kept = stored.join(touched, "subject", "left_anti")
    new = incoming.join(gone.select("subject").distinct(), "subject", "left_anti") if gone is not None else incoming
    return kept.unionByName(new.select(*stored.columns))


#: The type of literals that are places; a fixed value.
WKT = "http://www.opengis.net/ont/geosparql#wktLiteral"


def entity_triples(rows: DataFrame, entity: str | F.Column, languages: list[str]) -> DataFrame:
    """rows(subject, predicate, object, language, datatype): those about the entity (one, or a column with each row's own) itself, in wanted languages, however they are written, or none. Of places
    those on other globes go, whose text begins with the globe's address; other objects may begin as they like."""
    wanted = entity if isinstance(entity, F.Column) else F.lit(entity)
    lang = F.lower("language")
    elsewhere = (F.col("datatype") == WKT) & F.col("object").startswith("<")
    return rows.filter((F.col("subject") == wanted) & (lang.isNull() | lang.isin([x.lower() for x in languages])) & ~F.coalesce(elsewhere, F.lit(False)))


def closure(works: DataFrame, *links: tuple[DataFrame, str, str]) -> DataFrame:
    """works(id) with what hangs on them, step by step: each (links, parent column, child column) adds the children of what the step before added; distinct."""
    level = works.select("id").distinct()
    out = level
    for table, parent, child in links:
        level = table.join(level, table[parent] == level["id"]).select(F.col(child).alias("id")).distinct()
        out = out.unionByName(level)
    return out.distinct()


def hierarchy_edges(regions: DataFrame, code: str = "code", step: int = 1, least: int = 2) -> DataFrame:
    """child, parent, level of codes that grow by ``step`` signs a level from ``least`` on; the parent must be there itself."""
    level = F.expr(f"CAST((length({code}) - {least}) DIV {step} AS INT)")
    rows = regions.select(F.col(code).alias("child"), level.alias("level")).distinct()
    parents = rows.select(F.col("child").alias("parent"))
    return rows.filter("level > 0").join(parents, F.expr(f"substring(child, 1, length(child) - {step})") == F.col("parent")).select("child", "parent", "level")


def with_watermark(rows: DataFrame, marks: DataFrame, source: str = "source", time: str = "ts") -> DataFrame:
    """Rows newer than their source's watermark (marks(source, mark)); sources without one are new as a whole. marks is a row per source."""
    held = marks.select(F.col(source).alias("_s"), F.col("mark").alias("_m"))
    return rows.join(held, F.col(source) == F.col("_s"), "left").filter(F.col("_m").isNull() | (F.col(time) > F.col("_m"))).drop("_s", "_m")


def advance(marks: DataFrame, days: DataFrame) -> DataFrame:
    """days(source, day, ok, failed): the watermark moves over days in order and stops before the first day that failed whole; it never moves back."""
    bad = days.filter("ok = 0 AND failed > 0").groupBy("source").agg(F.min("day").alias("bad"))
    reached = days.join(bad, "source", "left").filter(F.col("bad").isNull() | (F.col("day") < F.col("bad"))).groupBy("source").agg(F.max("day").alias("reached"))
    return marks.join(reached, "source", "full").select("source", F.greatest("mark", "reached").alias("mark"))


def change_gate(held: DataFrame, upstream: DataFrame, force: bool = False) -> DataFrame:
    """held(dataset, updated, max_year), upstream(dataset, updated): per upstream dataset whether to skip, load from a year on, or load whole.

    Upstream strictly older than what is held is skipped; a dataset that is held is read from the year before its newest; force reads all of it."""
    h = held.select("dataset", F.col("updated").alias("_held"), "max_year")
    both = upstream.join(h, "dataset", "left")
    skip = F.lit(not force) & F.coalesce(F.col("updated") < F.col("_held"), F.lit(False))
    start = F.when(F.lit(not force), F.col("max_year") - 1)
    return both.select("dataset", F.when(skip, "skip").when(start.isNull(), "full").otherwise("from").alias("action"), F.when(~skip, start).alias("start_year"))


def record_run(spark: SparkSession, path: str, job: str, work: Callable[[], str | None]) -> None:
    """Run work and append one row to the run log, whatever comes of it; its error is raised again."""
    import uuid

    began, status, message = datetime.now(UTC).replace(tzinfo=None), "success", None
    try:
        message = work()
    except Exception as e:
        status, message = "failed", str(e)[:2000]
        raise
    finally:
        row = (uuid.uuid4().hex, job, began, datetime.now(UTC).replace(tzinfo=None), status, message)
        spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def runs(log: DataFrame, job: str | None = None, status: str | None = None, limit: int = 50) -> DataFrame:
    """Newest runs first."""
    for name, value in (("job", job), ("status", status)):
        if value is not None:
            log = log.filter(F.col(name) == value)
    return log.orderBy(F.desc("started"), "run_id").limit(limit)


def by_producer(dead: DataFrame, events: DataFrame, key: str, producer: str) -> DataFrame:
    """Dead letters per producer of the event that they stem from."""
    return dead.select(key).join(events.select(key, producer), key).groupBy(producer).agg(F.count("*").alias("dead"))


def registry_metrics(registry: DataFrame, metrics: DataFrame, runs_of: DataFrame, producer: str = "producer", job: str = "job") -> DataFrame:
    """registry(producer, job) with the producer's metrics(producer, events) and the job's runs_of(job, runs); 0 where there are none."""
    out = registry.join(metrics, producer, "left").join(runs_of, job, "left")
    return out.withColumns({"events": F.coalesce("events", F.lit(0)), "runs": F.coalesce("runs", F.lit(0))})


_INTROSPECTED: dict[tuple, tuple[float, list]] = {}


def introspect_kept(spark: SparkSession, names: list[str], seconds: float = 600.0, clock=time.monotonic) -> list[tuple[str, str, str]]:
    """What introspect says, asked again only after so many seconds."""
    key = (id(spark), tuple(sorted(names)))
    at, known = _INTROSPECTED.get(key, (None, None))
    if known is None or clock() - at >= seconds:
        _INTROSPECTED[key] = (clock(), introspect(spark, names))
    return _INTROSPECTED[key][1]


def introspect(spark: SparkSession, names: list[str]) -> list[tuple[str, str, str]]:
    """(table, column, type) of tables and views that the session knows."""
    return [(t, f.name, f.dataType.simpleString()) for t in sorted(names) for f in spark.table(t).schema.fields]
