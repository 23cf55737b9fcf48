"""MinHash document fingerprints.

Words as for SimHash (ASCII white space, A-Z folded); a shingle is five words (fewer: the whole sequence), hashed as a polynomial of word hashes.
``PERMUTATIONS`` universal hash functions h(x) = (a x + b mod 2**64) >> 32 run over all shingles of a batch in numpy; the least value of each per text is its signature,
written as 8 hex digits a function. The likeness of two fingerprints is the share of equal values, an estimate of the Jaccard similarity.

near_pairs joins signature bands in Spark between classes of equal shingle sets and verifies the Jaccard similarity on the sets.

Defined cases: null counts as empty; texts without words share one fingerprint (all digits f) and are like each other only; repeated rows are
each fingerprinted; empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.blocks import Postings, compare_in_blocks, parted
from tallyfold.llm.common import batches as bounded
from tallyfold.llm.common import materialise, slices

WORDS = 5
PERMUTATIONS = 64
BANDS = 16
SIMILARITY = 0.8
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz     ")
#: Shingles of one numpy pass; a longer text is passed in pieces.
PASS = 1 << 16
REMEMBERED = 300_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        got = self[word] = xxh64_intdigest(word, 7)
        return got


@functools.lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The factors (odd) and summands of the hash functions."""
    rng = np.random.Generator(np.random.PCG64(2024))
    a = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingles(text: str) -> np.ndarray:
    """Hashes of the text's shingles, repeats included."""
    words = text.encode("utf-8").translate(_FOLD).split(b" ")
    known = _word_hashes()
    w = np.array([known[x] for x in words if x], dtype=np.uint64)
    if not len(w):
        return w
    size = min(WORDS, len(w))
    h = np.zeros(len(w) - size + 1, dtype=np.uint64)
    for i in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - size + 1 + i]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of PERMUTATIONS uint32 per set; all ones for an empty set."""
    out = np.full((len(sets), PERMUTATIONS), 0xFFFFFFFF, dtype=np.uint32)
    a, b = permutations()
    some: list[int] = []

    def run(rows: list[int], parts: list[np.ndarray]) -> None:
        flat = np.concatenate(parts)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts[:-1]])]).astype(np.int64)
        for k in range(PERMUTATIONS):
            least = np.minimum.reduceat(flat * a[k] + b[k], starts) >> np.uint64(32)
            out[rows, k] = np.minimum(out[rows, k], least.astype(np.uint32))

    held = 0
    for i, s in enumerate(sets):
        if len(s) > PASS:
            for at in range(0, len(s), PASS):
                run([i], [s[at : at + PASS]])
        elif len(s):
            some.append(i)
            held += len(s)
            if held > PASS:
                run(some, [sets[j] for j in some])
                some, held = [], 0
    if some:
        run(some, [sets[j] for j in some])
    return out


def as_hex(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """text with its last third of code points replaced by as many (or all) from the start of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def in_order(docs: DataFrame, buckets: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows dealt so that a bucket holds a range of (doc_id descending, hash of the text) and, as ``borrowed`` row, the first row of the next bucket.

    The bounds are quantiles of doc_id (at most ``buckets`` numbers). A doc_id, or the missing one, with more than two buckets' rows is a bound too and is cut into as many buckets as it needs by
    ranges of the hash. The heads of buckets are one row each.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    light = rows.select("doc_id", F.xxhash64("text").alias("h"))
    # The only things that reach the driver: at most ``buckets`` bounds, half as many frequent ids, then at most three times as many heads (two numbers each).
    total, bounds = light.agg(F.count("*"), F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10_000)).first()
    often = light.groupBy("doc_id").count().filter(F.col("count") * buckets > 2 * total).collect() if total else []
    pieces = {r["doc_id"]: -(-r["count"] * buckets // total) for r in often}
    bounds = sorted({*(bounds or []), *(i for i in pieces if i is not None)}, reverse=True)
    # Bucket numbers rise as doc_ids fall; a null doc_id is last. Among the ids of a bound's bucket the bound is the smallest, so its pieces come behind the others.
    most = 1 + max(pieces.values(), default=0)
    above = F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<bigint>"), lambda b: b > F.col("doc_id"))), F.lit(0))
    above = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(above)
    piece = F.lit(0)
    for i, n in pieces.items():
        part = 1 + F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * n)
        piece = F.when(F.col("doc_id").eqNullSafe(F.lit(i)), F.least(part, F.lit(n))).otherwise(piece)
    number = (above * most + piece).cast("int")
    heads = light.withColumn("bucket", number).groupBy("bucket").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.bitwise_not(F.col("h")).alias("g"))).alias("head")).collect()
    heads = sorted(heads, key=lambda r: r["bucket"])
    lend = [(r["head"]["doc_id"], ~r["head"]["g"], heads[i - 1]["bucket"]) for i, r in enumerate(heads)]
    spark = docs.sparkSession
    lent = spark.createDataFrame(lend, "head_id long, head_h long, lender int") if lend else spark.createDataFrame([], "head_id long, head_h long, lender int")
    keyed = rows.withColumn("h", F.xxhash64("text")).withColumn("bucket", number)
    # At most ``buckets`` rows of three numbers.
    keyed = keyed.join(F.broadcast(lent), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")), "left")
    both = F.array_compact(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("borrowed")), F.when(F.col("lender").isNotNull(), F.struct(F.col("lender").alias("b"), F.lit(1).alias("borrowed")))))
    dealt = keyed.select("doc_id", "text", "h", F.explode(both).alias("to")).select(F.col("to.b").alias("bucket"), F.col("to.borrowed").alias("borrowed"), "doc_id", "h", "text")
    return dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "borrowed", F.col("doc_id").desc_nulls_last(), "h")


def fingerprint_with_edits(docs: DataFrame, buckets: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, next_fingerprint; next is by descending doc_id, after the last the first."""
    spark = docs.sparkSession
    buckets = buckets or 4 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("next_fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            """rows: (bucket, borrowed, doc_id, text); the last one only serves as what follows."""
            sets = [shingles(r[3]) for r in rows]
            own = signatures(sets)
            own_hex = [as_hex(s) for s in own]
            pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
            texts = [edited(rows[i][3], rows[i + 1][3]) for i in pairs]
            changed = signatures([shingles(t) for t in texts])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][2] for i in pairs], pa.int64()),
                    pa.array([len(rows[i][3]) for i in pairs], pa.int64()),
                    pa.array(texts, pa.string()),
                    pa.array([own_hex[i] for i in pairs], pa.string()),
                    pa.array([as_hex(s) for s in changed], pa.string()),
                    pa.array([own_hex[i + 1] for i in pairs], pa.string()),
                ],
                schema=schema,
            )

        held: list[tuple] = []
        for batch in slices(batches, "text", 1 << 20):
            columns = [batch.column(c).to_pylist() for c in ("bucket", "borrowed", "doc_id", "text")]
            held += zip(*columns, strict=True)
            if len(held) > 1:
                yield out(held)
                held = held[-1:]

    return in_order(docs, buckets, text, doc_id).mapInArrow(run, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, next_fingerprint string")


def likeness(a: str, b: str) -> F.Column:
    """Share of equal values of two fingerprint columns."""
    same = F.expr(f"size(filter(sequence(0, {PERMUTATIONS - 1}), i -> substring(`{a}`, i * 8 + 1, 8) = substring(`{b}`, i * 8 + 1, 8)))")
    return same / F.lit(float(PERMUTATIONS))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, fingerprint and shingle_set (sorted distinct shingle hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = [np.unique(shingles(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([as_hex(s) for s in signatures(sets)], pa.string()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "fingerprint", "shingle_set"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string, shingle_set array<long>")


def near_pairs(docs: DataFrame, threshold: float = SIMILARITY, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members(doc_id, class) has a row per document; a class is all texts of one shingle set, named by the set's hash, whatever their ids.
    pairs(a, b, jaccard), a < b, links classes of at least the threshold (in tenths) that share a band; copies are never paired with each other. A band that very many classes share is dealt anew by
    parts of the sets, of which alike ones have one in common, then compared in blocks, so a common band is no one task's and no pair of it is lost. Texts without words are one class without links."""
    with bounded(docs.sparkSession):
        prints = materialise(fingerprints(docs, text, doc_id), "minhash")
    keyed = prints.withColumn("class", F.xxhash64("shingle_set"))
    classes = materialise(keyed.groupBy("class").agg(F.first("fingerprint").alias("fingerprint"), F.first("shingle_set").alias("set")), "classes")
    width, tenths = PERMUTATIONS // BANDS * 8, round(threshold * 10)
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("fingerprint"), i * width + 1, F.lit(width))))
    classes_bands = classes.filter(F.size("set") > 0).select("class", band.alias("bands"))
    dealt = parted(classes_bands.select("class", F.explode("bands").alias("band")), classes.select("class", "set"), "class", "set", tenths)
    banded = dealt.join(classes.select("class", "set"), "class")

    def compare(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        held, out = Postings(right["set"].tolist()), []
        names = right["class"].tolist()
        for name, x in zip(left["class"].tolist(), left["set"], strict=True):
            both = None
            for j in held.alike(x, tenths).tolist():
                if not same or name < names[j]:
                    both = held.shared(x) if both is None else both
                    out.append((min(name, names[j]), max(name, names[j]), both[j] / (len(x) + held.sizes[j] - both[j])))
        return pd.DataFrame(out, columns=["a", "b", "jaccard"]).astype({"a": "int64", "b": "int64", "jaccard": "float64"})

    pairs = compare_in_blocks(banded, "band", "class", "set", compare, "a long, b long, jaccard double").distinct()
    return keyed.select("doc_id", "class"), pairs
