"""Ranked lexical search of many items over all documents, exact, with per-term geometric blocking.

Terms are maximal runs of ASCII letters, digits and anything beyond ASCII, A-Z folded. A document's impact for a term is an integer that grows with its occurrences and falls with the document's
length, an item's score the sum of term weight times impact (see ``search``).

The index has shards of whole documents. In a shard each term's posting list is clustered by the similarity of its documents (projections of their impact vectors, each document to the nearest of
evenly spread members of the list), and every cluster is a block with a summary: per term the largest impact in the block, in 63rds of the largest possible impact, rounded up. A block's bound for an
item is the item's weights times that summary, never less than the score of any of its documents; lists of at most ``SHORT`` documents have no summary and are always looked into. For an item only
lists without which the score to beat could be reached are opened, their blocks by falling bound, and a block is left out only when its bound is below the tenth best score. That score comes from a first round
over all shards, in which every item looks into the best blocks only; the second round is complete. Documents that are looked at are scored exactly from their whole vectors.

Items are answered in groups of at most about ``ITEMS`` items and ``TERMS`` terms, so that what a group sends to the workers (its terms, weights and scores to beat) is bounded; the index of a group
holds the postings of its terms, lengths and counts are over all terms of all documents.

Defined cases: a null or empty text has no terms and isn't counted; a document with a null doc_id is ranked, last among equals; repeated rows are documents (items) of their own; items without
terms or hits give no rows; empty tables give no rows; other columns are left out; texts are read whole.
"""

from __future__ import annotations

import contextlib
import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import batches as bounded
from tallyfold.llm.common import materialise, scratch_path, slices

#: Items and terms of a group, about.
ITEMS, TERMS = 4_096, 1 << 16
#: Documents and postings of a shard at most, and bytes of its documents-by-terms matrix.
SHARD_DOCS, SHARD_POSTINGS, SHARD_BYTES = 1 << 10, 1 << 18, 4 << 20
#: Documents of a block, about; documents of a list that has no summary; dimensions in which documents are compared.
BLOCK, SHORT, DIMENSIONS = 64, 16, 32
#: The largest possible impact; it is cut into this many levels.
FULL, LEVELS = 1_000_000, 63
#: Bytes of a row group of the index, and rows of it that Spark decodes at once.
ROW_GROUP, ROWS_AT_ONCE = 8 << 20, 1
#: Blocks that are looked into first.
FIRST = 4

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(32 if b in _SEPARATORS and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else b for b in range(256))

INDEX = "doc_ids array<long>, list_terms array<int>, list_starts array<int>, block_lists array<int>, block_starts array<int>, docs array<int>, impacts array<int>, summarised array<int>, summaries binary"


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split() if text else []


def counted_terms(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n (terms of the whole text with repeats), terms and tfs (numbers and occurrences of its terms that the vocabulary has), for documents with terms."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value
        for batch in slices(batches, "text"):
            ids, sizes, found, times, ends = [], [], [], [], [0]
            for i, t in enumerate(batch.column("text").to_pylist()):
                words = terms(t)
                if not words:
                    continue
                ids.append(i)
                sizes.append(len(words))
                for w, k in Counter(words).items():
                    if (number := numbers.get(w)) is not None:
                        found.append(number)
                        times.append(k)
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((found, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def impacts_of(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """In 64-bit integers: 1e9 tf over 1000 tf + 8 m, where m is 10 + 90 n / (mean length), each rounded down."""
    m = 10 + (90 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _blocks(owner: np.ndarray, term: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order of the postings by list and block, list terms and starts, each block's list and start."""
    order = np.lexsort((owner, term))
    list_terms, list_starts = np.unique(term[order], return_index=True)
    ends = np.append(list_starts[1:], len(order))
    project = np.random.Generator(np.random.PCG64(11)).standard_normal((levels.shape[1], DIMENSIONS), dtype=np.float32)
    places = np.concatenate([levels[at : at + 1024].astype(np.float32) @ project for at in range(0, len(levels), 1024)])
    places /= np.maximum(np.linalg.norm(places, axis=1, keepdims=True), 1e-9)
    block_lists, block_starts = [], []
    for k, (low, high) in enumerate(zip(list_starts.tolist(), ends.tolist(), strict=True)):
        wanted = -(-(high - low) // BLOCK)
        if wanted == 1:
            block_lists.append([k])
            block_starts.append([low])
            continue
        own = order[low:high]
        heads = owner[own][np.linspace(0, high - low - 1, wanted).astype(np.int64)]
        nearest = np.argmax(places[owner[own]] @ places[heads].T, axis=1)
        by_head = np.argsort(nearest, kind="stable")
        order[low:high] = own[by_head]
        starts = np.flatnonzero(np.diff(nearest[by_head], prepend=-1))
        block_lists.append(np.full(len(starts), k))
        block_starts.append(low + starts)
    return order, list_terms, list_starts, np.concatenate(block_lists).astype(np.int64), np.concatenate(block_starts).astype(np.int64)


def _shard(doc_ids: list, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, width: int) -> pa.RecordBatch:
    import zstandard

    levels = np.zeros((len(doc_ids), width), dtype=np.uint8)
    levels[owner, term] = -(-impact * LEVELS // FULL)
    order, list_terms, list_starts, block_lists, block_starts = _blocks(owner, term, levels)
    docs = owner[order]
    sizes = np.diff(np.append(list_starts, len(order)))
    summarised = np.flatnonzero(sizes[block_lists] > SHORT)
    ends = np.append(block_starts[1:], len(order))
    summaries = np.zeros((len(summarised), width), dtype=np.uint8)
    for i, b in enumerate(summarised.tolist()):
        summaries[i] = levels[docs[block_starts[b] : ends[b]]].max(axis=0)
    whole = lambda x: pa.array([x], pa.list_(pa.int32()))
    columns = [pa.array([doc_ids], pa.list_(pa.int64())), *map(whole, (list_terms, list_starts, block_lists, block_starts, docs, impact[order], summarised))]
    return pa.RecordBatch.from_arrays([*columns, pa.array([zstandard.compress(summaries.tobytes(), 1)], pa.binary())], [c.split()[0] for c in INDEX.split(", ")])


def write_index(counted: DataFrame, path: str, width: int, documents: int, length: int) -> None:
    """Shards of what ``counted_terms`` gives, a row each, as Parquet; no row is moved between tasks."""
    most = max(64, min(SHARD_DOCS, SHARD_BYTES // max(1, width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, postings = [], [], 0

        def out() -> pa.RecordBatch:
            n, sizes, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            owner = np.repeat(np.arange(len(ids)), sizes)
            return _shard(ids, owner, term, impacts_of(tf, n[owner], documents, length), width)

        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("tfs")
            sizes, n = np.diff(lists.offsets.to_numpy()).astype(np.int64), batch.column("n").to_numpy()
            flat, times = lists.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()
            upto, known = np.concatenate([[0], np.cumsum(sizes)]), batch.column("doc_id").to_pylist()
            low = 0
            while low < len(known):
                high = min(len(known), low + most - len(ids))
                high = max(low + 1, int(np.searchsorted(upto[: high + 1], upto[low] + SHARD_POSTINGS - postings, side="right")) - 1)
                ids += known[low:high]
                held.append((n[low:high], sizes[low:high], flat[upto[low] : upto[high]], times[upto[low] : upto[high]]))
                postings += int(upto[high] - upto[low])
                if len(ids) >= most or postings >= SHARD_POSTINGS:
                    if postings:
                        yield out()
                    ids, held, postings = [], [], 0
                low = high
        if postings:
            yield out()

    # A row is a shard of some megabytes, so row groups are small.
    counted.mapInArrow(run, INDEX).write.option("parquet.block.size", ROW_GROUP).parquet(path)


class Shard:
    """A row of the index, with the documents' vectors put together from the lists."""

    def __init__(self, batch: pa.RecordBatch, i: int, width: int):
        import zstandard

        get = lambda c: batch.column(c)[i].values.to_numpy(zero_copy_only=False)
        self.doc_ids = batch.column("doc_ids")[i].values
        self.docs, impacts, self.block_lists, self.block_starts = get("docs"), get("impacts").astype(np.int64), get("block_lists"), get("block_starts")
        list_terms, list_starts = get("list_terms"), get("list_starts")
        self.block_ends = np.append(self.block_starts[1:], len(self.docs))
        self.list_of = np.full(width, -1, dtype=np.int64)
        self.list_of[list_terms] = np.arange(len(list_terms))
        self.best = np.maximum.reduceat(impacts, list_starts)
        self.first_block = np.searchsorted(self.block_lists, np.arange(len(list_terms) + 1))
        summarised = get("summarised")
        self.summary_of = np.full(len(self.block_lists), -1, dtype=np.int64)
        self.summary_of[summarised] = np.arange(len(summarised))
        self.summaries = np.frombuffer(zstandard.decompress(batch.column("summaries")[i].as_py()), dtype=np.uint8).reshape(-1, width)
        order = np.argsort(self.docs, kind="stable")
        self.terms = np.repeat(list_terms, np.diff(np.append(list_starts, len(self.docs))))[order]
        self.impacts = impacts[order]
        self.starts = np.searchsorted(self.docs[order], np.arange(len(self.doc_ids) + 1))

    def bounds(self, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document of a block scores more; without a summary there is no bound."""
        at = self.summary_of[blocks]
        sums = self.summaries[np.maximum(at, 0)[:, None], terms[None, :]].astype(np.int64) @ weights if len(self.summaries) else np.zeros(len(blocks), np.int64)
        return np.where(at < 0, np.iinfo(np.int64).max, -(-sums * FULL // LEVELS))

    def scores(self, docs: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        n = self.starts[docs + 1] - self.starts[docs]
        at = np.repeat(self.starts[docs] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.add.reduceat(weight_of[self.terms[at]] * self.impacts[at], np.cumsum(n) - n)


class Best:
    """The best documents of an item so far, by falling score and rising doc_id (null last)."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows = k, floor, []

    def beat(self) -> int:
        """The least score that can still matter."""
        return max(1, self.floor, -self.rows[-1][0] if len(self.rows) == self.k else 0)

    def add(self, shard: Shard, docs: np.ndarray, scores: np.ndarray) -> None:
        ok = np.flatnonzero(scores >= self.beat())
        if len(ok) > self.k:
            ok = ok[scores[ok] >= np.partition(scores[ok], len(ok) - self.k)[len(ok) - self.k]]
        new = [(-int(s), d is None, d or 0) for s, d in zip(scores[ok].tolist(), (shard.doc_ids[int(i)].as_py() for i in docs[ok]), strict=True)]
        self.rows = sorted(self.rows + new)[: self.k]


def look_up(shard: Shard, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, best: Best, complete: bool) -> None:
    """Add the shard's documents for one item; unless ``complete`` only those of the best blocks."""
    lists = shard.list_of[terms]
    there = np.flatnonzero((lists >= 0) & (weights > 0))
    if not len(there):
        return
    most = weights[there] * shard.best[lists[there]]
    order = np.argsort(most, kind="stable")
    # Documents that are in none but these lists stay below the score to beat.
    open_lists = lists[there[order[np.cumsum(most[order]) >= best.beat()]]]
    if not len(open_lists):
        return
    blocks = np.concatenate([np.arange(shard.first_block[i], shard.first_block[i + 1]) for i in open_lists.tolist()])
    bounds = shard.bounds(blocks, terms, weights)
    order = np.argsort(-bounds, kind="stable")
    blocks, bounds = blocks[order], bounds[order]
    seen, low, step = np.zeros(len(shard.doc_ids), dtype=bool), 0, FIRST
    while low < len(blocks) and bounds[low] >= best.beat():
        some = blocks[low : low + step][bounds[low : low + step] >= best.beat()]
        docs = np.unique(np.concatenate([shard.docs[shard.block_starts[b] : shard.block_ends[b]] for b in some.tolist()]))
        docs = docs[~seen[docs]]
        seen[docs] = True
        if len(docs):
            best.add(shard, docs, shard.scores(docs, weight_of))
        low, step = low + step, 4 * step
        if not complete:
            return


def _round(index: DataFrame, sent, floors: dict[int, int], k: int, complete: bool) -> DataFrame:
    spark = index.sparkSession
    floor = spark.sparkContext.broadcast(floors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, width = sent.value
        best = {q: Best(k, floor.value.get(q, 0)) for q, _, _ in items}
        weight_of = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch, i, width)
                for q, terms, weights in items:
                    weight_of[terms] = weights
                    look_up(shard, terms, weights, weight_of, best[q], complete)
                    weight_of[terms] = 0
        rows = [(q, None if unknown else d, -s) for q, b in best.items() for s, unknown, d in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], ["q", "doc_id", "score"])

    found = index.mapInArrow(run, "q long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    with bounded(spark, rows=1), few_rows_decoded(spark):
        return materialise(found.withColumn("rank", place).filter(F.col("rank") <= k), "ranked")


@contextlib.contextmanager
def few_rows_decoded(spark) -> Iterator[None]:
    """Parquet rows are decoded so few at a time, for the actions within the block: a row of the index is large."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _answer(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int, text: str, doc_id: str) -> DataFrame:
    """The ranked documents of one group of items."""
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    with bounded(spark):
        counted = materialise(counted_terms(docs, vocabulary, text, doc_id), "counted-terms")
    documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # a row for each term of the group at most
        df[r["t"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
    asked = []
    for q, words in items:
        own = np.array(sorted(vocabulary[w] for w in words), dtype=np.int64)
        asked.append((q, own, weight[own]))
    path = scratch_path(spark, "postings")
    with bounded(spark):
        write_index(counted, path, len(vocabulary), documents, length)
    index = spark.read.schema(INDEX).parquet(path)
    sent = spark.sparkContext.broadcast((asked, len(vocabulary)))
    first = _round(index, sent, {}, k, complete=False)
    floors = {r["q"]: r["score"] for r in first.filter(F.col("rank") == k).toLocalIterator()}  # a row for each item at most
    return _round(index, sent, floors, k, complete=True)


def search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Per row of items its k highest-scoring documents with a score above 0: item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id.

    With N documents that have terms and df of them holding a term, its weight is floor(1000 ln((2 N + 2) / (2 df + 1))); an item's terms count once each."""
    spark = docs.sparkSession

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.binary())), pa.array([len(x) for x in found], pa.int64())], ["item_id", "terms", "n"])

    rows = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    with bounded(spark):
        known = rows.mapInArrow(split, f"item_id {kind}, terms array<binary>, n long").filter("n > 0")
        known = materialise(known.withColumn("q", F.monotonically_increasing_id()), "items")
    number, all_terms = known.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(1, -(-number // ITEMS), -(-all_terms // TERMS))
    found = []
    for group in range(groups):
        own = known.filter(F.pmod(F.xxhash64("q"), F.lit(groups)) == group)
        own = [(r["q"], [bytes(w) for w in r["terms"]]) for r in own.select("q", "terms").toLocalIterator()]  # a group's items at most
        if own:
            found.append(_answer(docs, own, k, text, doc_id))
    if not found:
        return rows.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    ranked = functools.reduce(DataFrame.unionByName, found)
    return ranked.join(known.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
