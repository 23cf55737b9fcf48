"""Token-ID files: a wavelet matrix per shard.

A shard holds the ids of whole documents in ascending doc_id order, at most ``shard_tokens`` ids unless one document has more. Its bit-planes run from
the highest bit down; each plane is the bit of every id in the order that the planes above have dealt (zeros first, stably), packed, and
compressed where that saves a tenth or more, beside the stored count of ones before each block of 512 bits. From these alone come the id at a place (access), the count of
an id before a place (rank), the place of its k-th occurrence (select) and all ids of the shard. A plane is decompressed when it is first asked for.

Files: a folder of Parquet written by Spark, a row per shard: its bucket (a range of documents, written by one task), its number and the ids before it in the bucket, the
documents' ids and lengths, the blob. Spark's writer commits them, so tasks that run twice and lost executors leave no half files, and any file system that
Spark knows will do. The place of a shard among all ids needs the totals of the buckets only, one number per write task.

Defined cases: a null text is empty (end id only); rows with equal or null doc_id keep one entry each, nulls first, equal ones in the order in which the
table was read (so a hot id is dealt over many tasks); an empty table writes no shard and reads back as no rows; other columns aren't stored.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.chunk_tokens import chunk_tokens
from tallyfold.llm.common import batches

MAGIC = b"WVMX2"
BLOCK = 512
SHARD_TOKENS = 1 << 19
FILE_SCHEMA = "bucket int, shard int, before long, n_docs int, n_tokens long, doc_ids array<long>, lengths array<int>, blob binary"
_ROW = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("blob", pa.binary())])
#: Totals of so many buckets are broadcast (16 bytes each, 16 MB); more are joined by a shuffle.
BROADCAST_BUCKETS = 1_000_000


class WaveletMatrix:
    """Succinct sequence of unsigned integers below 2**bits."""

    def __init__(self, n: int, planes: list[np.ndarray | bytes], zeros: list[int], before: list[np.ndarray] | None = None):
        """planes: packed bits, highest first, or the same compressed; zeros: how many zeros each has; before: ones before each block."""
        self.n, self._planes, self.zeros = n, planes, zeros
        self.before = before or [_counts(p) for p in planes]
        self.levels = len(planes)

    def plane(self, level: int) -> np.ndarray:
        if isinstance(self._planes[level], bytes):
            import zstandard

            self._planes[level] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._planes[level]), dtype=np.uint8)
        return self._planes[level]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids, dtype=np.uint32)
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        order = ids.astype(np.uint16) if bits <= 16 else ids
        planes, zeros = [], []
        for level in range(bits - 1, -1, -1):
            ones = (order & order.dtype.type(1 << level)).astype(bool)
            planes.append(np.packbits(ones))
            dealt = np.empty_like(order)
            zeros.append(len(order) - int(np.count_nonzero(ones)))
            np.compress(ones, order, out=dealt[zeros[-1] :])
            np.compress(np.logical_not(ones, out=ones), order, out=dealt[: zeros[-1]])
            order = dealt
        return cls(len(ids), planes, zeros)

    def dump(self) -> bytes:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        packed, raw = [], []
        for level in range(self.levels):
            bits = self.plane(level).tobytes()
            small = squeeze(bits)
            raw.append(10 * len(small) > 9 * len(bits))
            packed.append(bits if raw[-1] else small)
        counts = squeeze(np.diff(np.array(self.before, dtype=np.int64), axis=1).astype("<u2").tobytes())
        head = json.dumps({"n": self.n, "zeros": self.zeros, "sizes": [len(p) for p in packed], "raw": raw, "counts": len(counts)}).encode()
        return b"".join([MAGIC, struct.pack("<I", len(head)), head, counts, *packed])

    @classmethod
    def load(cls, blob: bytes) -> WaveletMatrix:
        import zstandard

        if blob[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet matrix")
        (size,) = struct.unpack_from("<I", blob, len(MAGIC))
        at = len(MAGIC) + 4
        head = json.loads(blob[at : at + size])
        at += size
        counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at : at + head["counts"]]), dtype="<u2").reshape(len(head["sizes"]), -1)
        before = list(np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, axis=1, dtype=np.int64)], axis=1))
        at += head["counts"]
        planes = []
        for size, raw in zip(head["sizes"], head["raw"], strict=True):
            part = blob[at : at + size]
            planes.append(np.frombuffer(part, dtype=np.uint8) if raw else part)
            at += size
        return cls(head["n"], planes, head["zeros"], before)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        plane, block = self.plane(level), i // BLOCK
        start, end = block * BLOCK // 8, i // 8
        count = int(self.before[level][block]) + int(np.bitwise_count(plane[start:end]).sum())
        return count + (int(plane[end]) >> (8 - i % 8)).bit_count() if i % 8 else count

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            plane = self.plane(level)
            bit = int(plane[i // 8]) >> (7 - i % 8) & 1
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of value among the first i places stand after the last plane."""
        a, b = 0, i
        if value >> self.levels:
            return 0, 0
        for level in range(self.levels):
            bit = value >> (self.levels - 1 - level) & 1
            x, y = self._ones(level, a), self._ones(level, b)
            a, b = (self.zeros[level] + x, self.zeros[level] + y) if bit else (a - x, b - y)
        return a, b

    def rank(self, value: int, i: int | None = None) -> int:
        """Occurrences of value among the first i places (all)."""
        a, b = self._range(value, self.n if i is None else i)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Place of the k-th occurrence of value, k from 0."""
        a, b = self._range(value, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(self.levels - 1, -1, -1):
            bit = value >> (self.levels - 1 - level) & 1
            i = self._place(level, bit, i - self.zeros[level] if bit else i)
        return i

    def _place(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th bit of that kind in a plane: its block by bisection, then within the block."""
        before = self.before[level]
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        start = block * BLOCK // 8
        bits = np.unpackbits(self.plane(level)[start : start + BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def ids(self) -> np.ndarray:
        """All ids in order, from the lowest plane up: each plane tells which places its zeros and its ones came from."""
        value = np.zeros(self.n, dtype=np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            ones, zeros = np.unpackbits(self.plane(level), count=self.n).view(bool), self.zeros[level]
            value[zeros:] |= value.dtype.type(1 << (self.levels - 1 - level))
            above = np.empty_like(value)
            above[np.flatnonzero(ones)] = value[zeros:]
            above[np.flatnonzero(~ones)] = value[:zeros]
            value = above
        return value.astype(np.uint32)


def _counts(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and in all."""
    ones = np.bitwise_count(plane)
    blocks = np.add.reduceat(ones, np.arange(0, len(plane), BLOCK // 8), dtype=np.int64) if len(plane) else np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(blocks)])


def write_shards(docs: DataFrame, out: str, tokenizer: str, split: str = "whole", end_id: int = 0, shard_tokens: int = SHARD_TOKENS, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode every whole text, append end_id, and write wavelet shards in ascending doc_id order to the folder out."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
    # Ranges of (doc_id, place): a bucket is a partition, and its number orders the shards. Their number follows spark.sql.shuffle.partitions, and AQE joins small ones.
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "place").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "place")
    dealt = dealt.select("doc_id", "text", F.spark_partition_id().alias("bucket"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = chunk_tokens(tokenizer, split)
        held, keys, sizes, total, shard, before, bucket = [], [], [], 0, 0, 0, 0

        def flush() -> pa.RecordBatch:
            blob = WaveletMatrix.build(np.concatenate(held)).dump()
            ids, lengths = np.concatenate(keys), np.concatenate(sizes).astype(np.int32)
            one = [pa.array([x], t) for x, t in zip((bucket, shard, before, len(ids), total), _ROW.types[:5], strict=True)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), x) for x in (pa.array(ids.tolist(), pa.int64()), pa.array(lengths))]
            return pa.RecordBatch.from_arrays([*one, *lists, pa.array([blob], pa.binary())], schema=_ROW)

        for batch in parts:
            if not batch.num_rows:
                continue
            bucket = batch.column("bucket")[0].as_py()
            ids, lengths = tokens.flat_ids(batch.column("text").to_pylist(), end_id)
            names, upto, at = np.array(batch.column("doc_id").to_pylist(), dtype=object), np.cumsum(lengths), 0
            while at < len(lengths):
                done = int(upto[at - 1]) if at else 0
                end = int(np.searchsorted(upto, done + shard_tokens - total, side="right"))  # as many documents as fit
                if end == at and not total:
                    end = at + 1
                if end > at:
                    held.append(ids[done : upto[end - 1]])
                    keys.append(names[at:end])
                    sizes.append(lengths[at:end])
                    total += int(upto[end - 1]) - done
                at = end
                if at < len(lengths):
                    yield flush()
                    held, keys, sizes, before, shard, total = [], [], [], before + total, shard + 1, 0
        if total:
            yield flush()

    with batches(spark):
        dealt.mapInArrow(run, FILE_SCHEMA).write.mode("overwrite").parquet(out)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``: the ids in all shards before. Blobs don't move; the running sum is over one total per bucket."""
    shards = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = shards.groupBy("bucket").agg(F.sum("n_tokens").alias("bucket_tokens"))
    starts = totals.select("bucket", F.coalesce(F.sum("bucket_tokens").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bucket_start"))
    if (shards.agg(F.max("bucket")).first()[0] or 0) < BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    return shards.join(starts, "bucket").withColumn("start", F.col("bucket_start") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it) and token_ids (array<int>, end id included)."""
    return _documents(spark, path, "doc_id long, start long, token_ids array<int>", False)


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """As read_documents, with the length and the CRC-32 of the ids (little-endian unsigned 32-bit integers) instead of the ids."""
    return _documents(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", True)


def _documents(spark: SparkSession, path: str, schema: str, sums: bool) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in parts:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("doc_ids", "lengths", "start", "blob")}
                flat = WaveletMatrix.load(row["blob"].as_py()).ids().astype("<u4")
                ends = np.concatenate([[0], np.cumsum(row["lengths"].values.to_numpy())]).astype(np.int64)
                columns = [row["doc_ids"].values, pa.array(ends[:-1] + row["start"].as_py())]
                if sums:
                    raw = memoryview(flat).cast("B")
                    columns += [pa.array(np.diff(ends)), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], type=pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                else:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "token_ids"])

    return read_shards(spark, path).select("doc_ids", "lengths", "start", "blob").mapInArrow(run, schema)


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Per shard, how often an id occurs: rank on the bit-planes, without decoding the shard."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for bucket, shard, blob in zip(*(batch.column(c) for c in ("bucket", "shard", "blob")), strict=True):
                n = WaveletMatrix.load(blob.as_py()).rank(token)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket.as_py()], pa.int32()), "shard": pa.array([shard.as_py()], pa.int32()), "n": pa.array([n], pa.int64())})

    return spark.read.schema(FILE_SCHEMA).parquet(path).select("bucket", "shard", "blob").mapInArrow(run, "bucket int, shard int, n long")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every global place of an id, by select."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for start, blob in zip(batch.column("start"), batch.column("blob"), strict=True):
                matrix = WaveletMatrix.load(blob.as_py())
                yield pa.RecordBatch.from_pydict({"place": pa.array([start.as_py() + matrix.select(token, k) for k in range(matrix.rank(token))], pa.int64())})

    return read_shards(spark, path).select("blob", "start").mapInArrow(run, "place long")
