"""Content-addressed WARC archive.

Every row gives one record. Payload bytes are stored once per content, under their SHA-256; the exact header bytes of each record are
stored separately with the digest of its payload. The record of the smallest id among equal payloads of at least ``least_bytes`` bytes is the ``response``; the
others are ``revisit`` records that refer to it and have no payload of their own. Reading rebuilds the response records (header, payload, two line ends) by joining headers with
payloads, and checks each against its address, its digest and its length; what an index tells of a record is read from its header bytes.

An archive is a folder with ``headers``, ``payloads`` and ``layout`` as Parquet, written by Spark, so any file system that Spark knows will do and lost tasks leave nothing behind.
Payloads lie in hash buckets of their SHA-256, so that joining them moves the headers only.

Defined cases: a null html is an empty payload and a null url an empty target; equal ids: equal payloads elect the smallest id, and of rows with that id and
payload one is the response (the row of the smallest url), the others revisit it; a null id comes last and is written ``-``; an empty table gives an empty archive; other columns
are left out. Record ids differ even where page ids repeat.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import batches, materialise

#: Bytes of payload and records in a bucket, about: one task reads a bucket, and holds the headers of its responses (some 500 bytes each) in a hash table.
BUCKET_BYTES, BUCKET_ROWS = 256 << 20, 200_000
LEAST_BYTES = 0
HEADER_SCHEMA = "sha256 string, response boolean, header binary"
PAYLOAD_SCHEMA = "sha256 string, payload binary"
END = b"\r\n\r\n"


def base32_of(hex_column: str) -> F.Column:
    """Upper-case base32 (no padding) of a 40-digit hex column: groups of five hex digits are four base32 digits."""
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(F.col(hex_column), i * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    digit = lambda n, k: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(n, 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.array_join(F.transform(groups, lambda n: F.concat(digit(n, 3), digit(n, 2), digit(n, 1), digit(n, 0))), "")


def _records(pages: DataFrame, html: str, url: str, page_id: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"))
    return rows.withColumns({"sha256": F.sha2("payload", 256), "sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})


def _header(date: str) -> F.Column:
    """Header bytes. A response's id is made of its page and content, so that revisits can name it; any other record's id of its page and a number in the archive."""
    named = lambda page, rest: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("-")), F.lit(":"), rest, F.lit(">"))
    revisit, elected = F.col("record_type") == "revisit", F.col("first_sha256").isNotNull()
    own = named(F.col("page_id"), F.when(~revisit & elected, F.col("sha256")).otherwise(F.monotonically_increasing_id().cast("string")))
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Record-ID: "), own),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), named(F.col("refers_to"), F.col("sha256")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of("sha1")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    ]
    return F.encode(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n")), "UTF-8")


def write_archive(pages: DataFrame, out: str, least_bytes: int = LEAST_BYTES, html: str = "html", url: str = "url", page_id: str = "page_id", date: datetime | None = None) -> None:
    """Write the archive of all rows of pages to the folder out; date: when the pages were fetched (now)."""
    spark = pages.sparkSession
    rows = _records(pages, html, url, page_id)
    # Election sees digests only. Ordered by (has an id, id, url); partial minima keep a digest of very many rows out of one task.
    place = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "url")
    light = rows.select("sha256", "bytes", "page_id", "url")
    first = light.filter(F.col("bytes") >= least_bytes).groupBy("sha256").agg(F.min(place).alias("first"))
    first = first.select(F.col("sha256").alias("first_sha256"), F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("first_url"))
    heads = rows.drop("payload").join(first, F.col("sha256") == F.col("first_sha256"), "left")
    leads = F.col("first_sha256").isNull() | (F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("url") == F.col("first_url")))
    # Rows equal in payload, id and url: one of them leads. Only candidates for the lead are numbered, so such a group is one repeated row.
    same = Window.partitionBy("sha256", "page_id", "url").orderBy(F.lit(0))
    lead = heads.filter(leads).withColumn("place", F.when(F.col("first_sha256").isNull(), 1).otherwise(F.row_number().over(same)))
    rest = heads.filter(~leads).withColumn("place", F.lit(2))
    typed = lead.unionByName(rest).withColumn("record_type", F.when(F.col("place") == 1, "response").otherwise("revisit"))
    typed = typed.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("refers_to")))
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    headers = typed.select("sha256", (F.col("record_type") == "response").alias("response"), _header(stamp).alias("header"))
    headers.write.mode("overwrite").parquet(f"{out}/headers")
    # One copy of each content: the aggregation keeps one payload per content and map task before the shuffle, which deals them as the buckets are.
    # So many buckets that none holds over BUCKET_BYTES or BUCKET_ROWS on average, and as many at least as a shuffle has parts.
    total, count = pages.agg(F.coalesce(F.sum(F.octet_length(html)), F.lit(0)), F.count("*")).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES), -(-count // BUCKET_ROWS))
    stored, name = rows.select("sha256", "payload").dropDuplicates(["sha256"]), f"tallyfold_{uuid.uuid4().hex}"
    stored.write.mode("overwrite").option("compression", "zstd").option("path", f"{out}/payloads").bucketBy(buckets, "sha256").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{out}/layout")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Per record: sha256 (its payload's address), response, header (exact bytes), and what the bytes say: page_id, record_type, refers_to, payload_digest."""
    text = F.decode("header", "UTF-8")
    field = lambda name, what=r"([^\r\n]*)": F.regexp_extract(text, f"\r\n{name}: {what}", 1)
    page = lambda name: F.nullif(field(name, r"<urn:page:(-?\d*):"), F.lit("")).try_cast("long")
    return spark.read.schema(HEADER_SCHEMA).parquet(f"{path}/headers").withColumns({
        "page_id": page("WARC-Record-ID"), "record_type": field("WARC-Type"), "refers_to": page("WARC-Refers-To"), "payload_digest": field("WARC-Payload-Digest", r"sha1:(\w+)"),
    })


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored contents, in their hash buckets."""
    buckets, name = spark.read.parquet(f"{path}/layout").first()["buckets"], f"tallyfold_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({PAYLOAD_SCHEMA}) USING parquet CLUSTERED BY (sha256) INTO {buckets} BUCKETS LOCATION '{path}/payloads'")
    stored = spark.table(name)
    stored.schema  # analysed while the name exists
    spark.sql(f"DROP TABLE {name}")
    return stored


def reconstruct(spark: SparkSession, path: str, with_payload_of_revisits: bool = False) -> DataFrame:
    """Per record: page_id, sha256, record (exact WARC bytes). Responses are joined with their payloads; revisits are records without payload, or filled from the store if so wanted."""
    headers = read_headers(spark, path).select("page_id", "sha256", "response", "header")
    filled = headers if with_payload_of_revisits else headers.filter("response")
    if not with_payload_of_revisits:  # one header for each content; revisits may be any number, and are sorted
        filled = filled.hint("shuffle_hash")
    whole = read_payloads(spark, path).join(filled, "sha256").select("page_id", "sha256", F.concat(F.col("header"), "payload", F.lit(END)).alias("record"))
    if with_payload_of_revisits:
        return whole
    return whole.unionByName(headers.filter("NOT response").select("page_id", "sha256", F.concat(F.col("header"), F.lit(END)).alias("record")))


def check_responses(records: DataFrame) -> DataFrame:
    """Per response record: sha256, payload_bytes, payload_digest (base32 SHA-1), computed from the record's bytes; a record whose payload doesn't match its address, digest or
    length fails the job."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            names, sizes, digests = [], [], []
            for name, record in zip(batch.column("sha256").to_pylist(), batch.column("record"), strict=True):
                raw = record.as_py()
                head, _, rest = raw.partition(END)
                payload = memoryview(rest)[: -len(END)]
                digest = base64.b32encode(hashlib.sha1(payload).digest())
                fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
                if hashlib.sha256(payload).hexdigest() != name or fields[b"WARC-Payload-Digest"] != b"sha1:" + digest or int(fields[b"Content-Length"]) != len(payload) or not rest.endswith(END):
                    raise ValueError(f"record of payload {name} is damaged")
                names.append(name)
                sizes.append(len(payload))
                digests.append(digest.decode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["sha256", "payload_bytes", "payload_digest"])

    return records.select("sha256", "record").mapInArrow(run, "sha256 string, payload_bytes long, payload_digest string")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per record, from its header bytes: page_id, record_type, refers_to; and of the full payload, from the rebuilt response records: payload_bytes, payload_digest."""
    headers = read_headers(spark, path).select("page_id", "sha256", "record_type", "refers_to")
    responses = read_payloads(spark, path).join(read_headers(spark, path).filter("response").select("sha256", "header").hint("shuffle_hash"), "sha256")
    with batches(spark):
        contents = materialise(check_responses(responses.select("sha256", F.concat(F.col("header"), "payload", F.lit(END)).alias("record"))), "contents")
    return headers.join(contents.dropDuplicates(["sha256"]), "sha256").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
