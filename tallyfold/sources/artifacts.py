"""Compressed artifacts with a manifest, of which a resumed run writes only missing and damaged parts; and a graph that is replaced behind a gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallyfold.operators.quality import shape_violations
from tallyfold.sources.scratch import kept
from tallyfold.sources.sinks import replace_partitions

MANIFEST = "file string, bytes long, sha256 string, part string"
#: Rows of a file at most: a part of any size is several files, each of which is hashed as one row.
ROWS_PER_FILE = 250_000


def _artifact_files(spark: SparkSession, path: str) -> DataFrame:
    """part, file, bytes and sha256 of the files as they are now; none if there is no folder. The hash is taken where a file is read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json.gz").load(f"{path}/data")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)
    part = F.regexp_extract("path", r"/part=([^/]*)/[^/]*$", 1)
    return files.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.url_decode(part).alias("part"))


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """The manifest that the last finished run has left."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def unsound_parts(spark: SparkSession, path: str) -> DataFrame:
    """Parts of the manifest, or of the folder, with a file that is missing, additional, or of other bytes than the manifest says."""
    now, then = _artifact_files(spark, path), manifest_of(spark, path)
    side = lambda d, p: d.select("part", "file", *(F.col(c).alias(f"{p}_{c}") for c in ("bytes", "sha256")))
    both = side(now, "now").join(side(then, "then"), ["part", "file"], "full")
    sound = F.col("now_bytes").eqNullSafe(F.col("then_bytes")) & F.col("now_sha256").eqNullSafe(F.col("then_sha256"))
    return both.filter(~sound).select("part").distinct()


def write_artifacts(rows: DataFrame, path: str, part: F.Column, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write rows as gzip JSON lines, a folder per part, and the manifest; parts whose files are all there with the bytes of the manifest are reused, only the others are written. Returns the parts
    that were written. A run that breaks off leaves no entry for what it hasn't finished, so the next one writes that again.

    Rows that changed since count as well only if their part is new or unsound: whoever wants a part anew deletes its manifest entry, or its folder.
    """
    spark = rows.sparkSession
    named = rows.withColumn("part", part.cast("string"))
    wanted = named.select("part").distinct()
    unsound = unsound_parts(spark, path)
    known = manifest_of(spark, path).select("part").distinct()
    todo = kept(wanted.join(known.join(unsound, "part", "left_anti"), "part", "left_anti"), "unsound")
    if not todo.isEmpty():
        out = named.join(todo, "part", "left_semi").write.partitionBy("part").option("compression", "gzip").option("maxRecordsPerFile", rows_per_file)
        out.option("partitionOverwriteMode", "dynamic").mode("overwrite").json(f"{path}/data")
    # The manifest is made of the bytes that are there; old entries of sound parts agree with them.
    kept(_artifact_files(spark, path).join(wanted, "part", "left_semi"), "manifest").write.mode("overwrite").json(f"{path}/manifest")
    return todo


def read_artifacts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of sound artifacts, with their part; an unsound part is an error."""
    if broken := [r["part"] for r in unsound_parts(spark, path).limit(5).collect()]:
        raise ValueError(f"unsound parts, such as {broken}")
    return spark.read.schema(f"{schema}, part string").json(f"{path}/data")


def replace_graph(triples: DataFrame, path: str, graph: str, required: list[str], kinds: dict[str, str], allowed: dict[str, list[str]], persons: tuple[str, str] = ("type", "person")) -> DataFrame:
    """Replace one graph (a folder of path) by triples(subject, predicate, object), if they keep to the shape; else leave the old ones. Returns the violations; none means replaced.

    Natural persons (subjects with that predicate and object) are taken out first. What is checked is what is committed: the batch is staged once, validated as staged, and only then moved into the
    graph's folder by a job that commits it whole.
    """
    natural = triples.filter((F.col("predicate") == persons[0]) & (F.lower("object") == persons[1])).select("subject").distinct()
    staged = kept(triples.join(natural, "subject", "left_anti").select("subject", "predicate", "object"), "staged")
    broken = kept(shape_violations(staged, required, kinds, allowed), "violations")
    if broken.isEmpty():
        replace_partitions(staged.withColumn("graph", F.lit(graph)), path, "graph")
    return broken
