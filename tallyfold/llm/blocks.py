"""Sets that share a bucket, compared in blocks: no task gets a whole large bucket, and pairs are compared in numpy without becoming rows.

Buckets of more than ``HOT`` sets are first dealt anew by parts of the sets of which alike ones have one in common (``parted``), which loses no pair; ``refined`` deals them by further bands instead, which may. A bucket is cut into blocks by hash, each of at most about ``ROWS`` sets and ``ITEMS`` items (a longer set is a block of its own); every two blocks of a bucket, and each block with
itself, meet in one group. Within a group, one side's items are a sorted list with their owners, so a set's shares with all others cost a bisection and a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import batches, materialise
from tallyfold.llm.mph import mixed

ROWS = 1_024
ITEMS = 500_000
#: Rows of a bucket that is dealt anew, and how often.
HOT, LEVELS = 4 * ROWS, 3
#: Sizes of a level grow by half; the first ends here.
FIRST_LEVEL = 12


def level_ends(most: int) -> list[int]:
    ends = [FIRST_LEVEL]
    while ends[-1] < most:
        ends.append(ends[-1] * 3 // 2)
    return ends


def part_hashes(items: np.ndarray, percent: int) -> np.ndarray:
    """The hashes (int64) that a set of distinct shingle hashes (uint64) is put under."""
    n = len(items)
    differ = n * (100 - percent) // percent
    if not differ:  # only an equal set can link
        return np.zeros(0, np.int64)
    ends, out = level_ends(n), []
    while 100 * n >= percent * (ends[-1] + 1):  # a set of the next level may link
        ends.append(ends[-1] * 3 // 2)
    spread, weights = mixed(items, 1), mixed(items, 2)
    for at, end in enumerate(ends):
        if end < n:
            continue
        parts = 2 * end * (100 - percent) // (100 + percent) + 1
        part = (spread % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.diff(part[order], prepend=-1))
        filled, sums = part[order][starts], np.add.reduceat(weights[order], starts)
        names = (np.uint64(at + 1) << np.uint64(32)) + np.arange(parts, dtype=np.uint64)
        own = mixed(sums ^ mixed(names[filled], 3), 4)
        if len(own) > differ:
            own = own[: differ + 1]
        else:
            own = np.append(own, mixed(mixed(np.delete(names, filled), 5), 6))
        out.append(own)
    return np.concatenate(out).view(np.int64)


class Postings:
    """The items of some sets with their owners."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.items, self.owner = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def shared(self, x: np.ndarray) -> np.ndarray:
        """How many items of x each set has."""
        low = np.searchsorted(self.items, x, side="left")
        n = np.searchsorted(self.items, x, side="right") - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.owner[at], minlength=len(self.sizes))

    def alike(self, x: np.ndarray, tenths: int) -> np.ndarray:
        """Sets whose Jaccard similarity with x is at least so many tenths; an empty set is like no other."""
        both = self.shared(x)
        return np.flatnonzero((both > 0) & (10 * both >= tenths * (len(x) + self.sizes - both)))


def refined(rows: DataFrame, bands: DataFrame, key: str, bucket: str = "band") -> DataFrame:
    """rows(bucket, key, ...), bands(key, bands: array): the rows with each bucket of over HOT rows cut into buckets of the sets that agree on one more band, for every band, until they are small or LEVELS
    bands were added. The rows move without their sets: a hot bucket's are as many as there are bands, whatever its size, and sets that agree on nothing else part here.

    Of a pair that is alike nearly all stay together: it agrees on some other of the bands with the chance that it shares a bucket at all, so a level loses as much as the banding itself. A bucket that is
    still hot then stays whole."""
    others = [c for c in rows.columns if c not in (key, bucket)]
    waiting, done = rows.withColumn("_used", F.array().cast("array<int>")), None
    for level in range(LEVELS + 1):
        sizes = waiting.groupBy(bucket).agg(F.count("*").alias("_n")).filter("_n > 1")
        placed = waiting.join(sizes, bucket)
        small = placed.filter(F.col("_n") <= HOT) if level < LEVELS else placed
        small = small.select(bucket, key, *others)
        done = small if done is None else done.unionByName(small)
        if level == LEVELS or sizes.filter(F.col("_n") > HOT).limit(1).count() == 0:
            return done
        hot = placed.filter(F.col("_n") > HOT).join(bands.select(F.col(key), F.posexplode("bands").alias("_place", "_band")), key)
        # The bucket's own band is the same for all and would bring them together again.
        fresh = hot.filter((F.col("_band") != F.col(bucket)) & ~F.array_contains("_used", F.col("_place")))
        waiting = materialise(fresh.select(F.xxhash64(bucket, "_place", "_band").alias(bucket), key, *others, F.array_append("_used", F.col("_place")).alias("_used")), "refined")
    return done


def parted(rows: DataFrame, sets: DataFrame, key: str, items: str, tenths: int, bucket: str = "band") -> DataFrame:
    """rows(bucket, key, ...), sets(key, items): the rows, where those of buckets of over HOT rows are under new buckets, in which any two of them meet that are alike in at least so many tenths and unequal
    or of four items and more. No such pair is lost, however large the bucket was; equal sets of fewer than four items don't meet.

    A crowded key is once under each of its parts (``part_hashes``), whatever crowded buckets it was in; what shares a part is named by its smallest key, so rows with the same company in many parts are few.
    A part that very many sets share stays whole."""
    others = [c for c in rows.columns if c not in (key, bucket)]
    sizes = rows.groupBy(bucket).agg(F.count("*").alias("_n"))
    hot = materialise(sizes.filter(F.col("_n") > HOT).select(bucket), "hot")
    if hot.limit(1).count() == 0:
        return rows

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            lists = batch.column(items)
            out = [part_hashes(lists[i].values.to_numpy(zero_copy_only=False).view(np.uint64), 10 * tenths) for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.list_(pa.int64()))], [key, "_parts"])

    crowd = materialise(rows.join(hot, bucket, "left_semi").select(key, *others).dropDuplicates([key]), "crowd")
    with batches(rows.sparkSession):
        under = materialise(sets.join(crowd.select(key), key, "left_semi").select(key, items).mapInArrow(run, f"{key} long, _parts array<long>"), "parts")
    under = under.select(key, F.explode("_parts").alias("_part"))
    heads = under.groupBy("_part").agg(F.min(key).alias("_head"), F.max(key).alias("_last")).filter("_head < _last").select("_part", "_head")
    met = under.join(heads, "_part").select(F.xxhash64(F.lit(13), "_head").alias(bucket), key).distinct()
    return rows.join(hot, bucket, "left_anti").select(bucket, key, *others).unionByName(met.join(crowd, key).select(bucket, key, *others))


def compare_in_blocks(rows: DataFrame, bucket: str, key: str, items: str, compare: Callable[[pd.DataFrame, pd.DataFrame, bool], pd.DataFrame], schema: str) -> DataFrame:
    """rows: a bucket, a bigint key and an array of distinct bigints each. compare(left, right, same) gets the rows of two blocks of a bucket, once for every two
    blocks; same tells that both are one block."""
    wanted = F.greatest(F.ceil(F.count("*") / ROWS), F.ceil(F.sum(F.size(items)) / ITEMS)).cast("int")
    blocks = rows.groupBy(bucket).agg(F.count("*").alias("_n"), wanted.alias("_blocks")).filter("_n > 1").select(bucket, F.greatest("_blocks", F.lit(1)).alias("_blocks"))
    placed = rows.join(blocks, bucket).withColumn("_block", F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.col("_blocks")).cast("int"))
    dealt = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.withColumns({"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")}).drop("_other", "_blocks")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        low, high = f["_low"].iloc[0], f["_high"].iloc[0]
        return compare(f[f["_block"] == low].reset_index(drop=True), f[f["_block"] == high].reset_index(drop=True), bool(low == high))

    return dealt.groupBy(bucket, "_low", "_high").applyInPandas(run, schema)
