"""Similarity join of texts on the Jaccard similarity of their word n-grams, exact, by T-occurrence search.

A set is a text's distinct shingles; equal sets are one class before anything is compared. Two sets of sizes s and t link when ``100 * shared >= percent * union``; then they differ in at most
(s + t) (100 - percent) / (100 + percent) shingles, so at most d(s) = s (100 - percent) / percent. Shingles are dealt by hash to more parts than that, and a set is put under the hash of each of its
first d(s) + 1 parts that hold any: of these one at least is equal in a set that links. (If it has fewer such parts, it is put under all of them and under its empty ones.) The number of parts goes by levels of
size, and a set that may link into the next level is put there too. Nothing here is approximate: no link is lost.

What shares a part's hash are candidates, named by the smallest of them. Each group of candidates is cut into shards of bounded size, and in a shard queries are answered by an inverted index with
DivideSkip: a query that needs T shared shingles sets its L longest lists aside, counts whom it meets in the short ones, keeps whom it meets T - L times, and probes the long lists for them by bisection (or
counts them too, where they are few for that many probes).
First each group's smallest member is its only query, which links nearly all copies in work that grows with the rows. The others of a group, if they are then still of several components, ask for all members that aren't of
their largest component; a link between different components has one of those at an end. A query's answers become one link for each component that they join, never all pairs.

Defined cases: a null or empty text, or one without words, is an empty set, linked with nothing; with fewer words than a shingle the whole sequence is one; repeated rows stay and share their
class; a null doc_id takes part, but names a component only if all its members are null; an empty table gives no rows; other columns are left out. Sets are compared by 64-bit hashes of their
shingles, classes by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.blocks import part_hashes
from tallyfold.llm.common import batches as bounded
from tallyfold.llm.common import early_filters, materialise, slices
from tallyfold.llm.components import components
from tallyfold.llm.mph import mixed
from tallyfold.llm.simhash import shingle_hashes

WORDS, PERCENT = 3, 90
#: Sets and shingles of a shard, about.
SHARD_ROWS, SHARD_ITEMS = 1_024, 500_000
#: Weighs the probes against the counted elements when the long lists are chosen.
MU = 0.2
#: Elements that are counted in the time of one probe, about, and lists that are probed at once.
PROBE, LISTS = 30, 32


class Index:
    """An inverted index over sets: the sets that hold a shingle, as a sorted list."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.items, starts = np.unique(flat[order], return_index=True)
        self.owner, self.bounds = owner[order], np.append(starts, len(flat))
        #: Shingle and owner as one number, in order.
        self.places = np.repeat(np.arange(len(self.items)) * len(sets), np.diff(self.bounds)) + self.owner

    def _met(self, at: np.ndarray) -> np.ndarray:
        """Per set in how many of those lists it is."""
        n = self.bounds[at + 1] - self.bounds[at]
        flat = np.repeat(self.bounds[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.owner[flat], minlength=len(self.sizes))

    def search(self, x: np.ndarray, percent: int, among: np.ndarray | None = None) -> np.ndarray:
        """Sets of at least that similarity to x, of all or of those marked in ``among``."""
        if not len(x) or not len(self.items):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.items, x)
        at = at[(at < len(self.items)) & (self.items[np.minimum(at, len(self.items) - 1)] == x)]
        least = -(-percent * len(x) // 100)  # the larger set is no smaller than x, and this share of it must be met
        if len(at) < least:
            return np.zeros(0, np.int64)
        lengths = self.bounds[at + 1] - self.bounds[at]
        order = np.argsort(-lengths, kind="stable")
        at, lengths = at[order], lengths[order]
        aside = min(least - 1, int(least / (MU * np.log2(max(2, lengths.max())) + 1)))
        met = self._met(at[aside:])
        fit = (met >= least - aside) & (100 * self.sizes >= percent * len(x)) & (percent * self.sizes <= 100 * len(x))
        who = np.flatnonzero(fit if among is None else fit & among)
        met = met[who]
        if lengths[:aside].sum() <= PROBE * aside * len(who):
            met = met + self._met(at[:aside])[who]
        else:
            for k in range(0, aside, LISTS):
                wanted = at[k : min(k + LISTS, aside), None] * len(self.sizes) + who
                place = np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)
                met = met + (self.places[place] == wanted).sum(axis=0)
                going = met + max(0, aside - k - LISTS) >= least
                who, met = who[going], met[going]
                if not len(who):
                    break
        return who[100 * met >= percent * (len(x) + self.sizes[who] - met)]


def _answers(rows: DataFrame, percent: int) -> DataFrame:
    """rows: head, shard, asks (false: in the index, true: a query), node, component, set. Links (a, b) that join components, made shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index, of, label = None, [], None, None, {}

        def root(c: int) -> int:
            while (up := label.get(c, c)) != c:
                c = up
            return c

        for batch in batches:
            out = []
            sets = batch.column("set")
            columns = [batch.column(c).to_pylist() for c in ("head", "shard", "asks", "node", "component")]
            for i, (head, shard, asks, node, component) in enumerate(zip(*columns, strict=True)):
                if (head, shard) != key:
                    key, held, index, label = (head, shard), [], None, {}
                own = sets[i].values.to_numpy(zero_copy_only=False)
                if not asks:
                    held.append((node, component, own.copy()))
                    continue
                if not held:  # chance may leave a shard empty
                    continue
                if index is None:
                    index, of = Index([h[2] for h in held]), np.array([h[1] for h in held])
                for j in index.search(own, percent, of != component).tolist():
                    a, b = root(component), root(held[j][1])
                    if a != b:
                        label[max(a, b)] = min(a, b)
                        out.append((node, held[j][0]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    dealt = rows.select("head", "shard", "asks", "node", "component", "set").repartition(F.col("head"), F.col("shard")).sortWithinPartitions("head", "shard", "asks", "node")
    return dealt.mapInArrow(run, "a long, b long")


def _ask(groups: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """groups: head, node, component, asks. Every member is in one shard of its group's index; those that ask go to all of them."""
    known = groups.join(sets, "node")
    shards = known.groupBy("head").agg(F.greatest(F.ceil(F.count("*") / SHARD_ROWS), F.ceil(F.sum(F.size("set")) / SHARD_ITEMS)).cast("int").alias("shards"))
    placed = known.join(shards, "head")
    kept = placed.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("shards")).cast("int")).withColumn("asks", F.lit(False))
    asking = placed.filter("asks").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    with bounded(groups.sparkSession):
        return materialise(_answers(kept.unionByName(asking), percent), name)


def similar(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included)."""
    spark = docs.sparkSession
    digest = [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(9), text).alias("t2")]

    def prints_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in slices(batches, "text"):
            sets = [shingle_hashes(t or "", words, False) for t in batch.column("text").to_pylist()]
            names = np.array([np.frombuffer(xxh3_128_digest(s.tobytes()), dtype="<i8") for s in sets]).reshape(-1, 2)
            parts = [part_hashes(s, percent) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "t1", "t2")), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([len(s) for s in sets], pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                ["doc_id", "t1", "t2", "k1", "k2", "n", "parts"],
            )

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_hashes(t or "", words, False).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "set"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *digest, F.col(text).alias("text"))
    with bounded(spark):
        prints = materialise(rows.mapInArrow(prints_of, "doc_id long, t1 long, t2 long, k1 long, k2 long, n long, parts array<long>"), "prints")
    one = prints.filter("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.min(F.struct("t1", "t2")).alias("t"), F.first("parts").alias("parts"))
    classes = materialise(one.select("k1", "k2", "least", "t.t1", "t.t2", "parts", F.monotonically_increasing_id().alias("node")), "classes")
    # Candidates: what shares a part's hash, under the smallest of them.
    under = classes.select("node", F.explode("parts").alias("part"))
    heads = under.groupBy("part").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head < last").select("part", "head")
    groups = materialise(under.join(heads, "part").groupBy("head", "node").agg(F.lit(1).alias("one")).select("head", "node"), "groups")
    wanted = materialise(classes.join(groups.select("node").distinct(), "node").select("t1", "t2", "node"), "wanted")
    # The filter holds for all; without one Spark takes the keys for unselective.
    texts = docs.select(*digest, F.col(text).alias("text")).join(wanted.filter("node >= 0"), ["t1", "t2"]).groupBy("node").agg(F.first("text").alias("text"))
    with bounded(spark), early_filters(spark):
        sets = materialise(texts.mapInArrow(sets_of, "node long, set array<long>"), "sets")
    first = _ask(groups.withColumns({"component": F.col("node"), "asks": F.col("head") == F.col("node")}), sets, percent, "links")
    # The head has met all its group. Where the others are still of several components, whoever isn't of the largest asks.
    placed = groups.filter("node <> head").join(components(first), "node", "left").select("head", "node", F.coalesce("component", "node").alias("component"))
    sizes = placed.groupBy("head", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("head").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts")).filter("parts > 1").drop("parts")
    rest = materialise(placed.join(largest, "head").select("head", "node", "component", (F.col("component") != F.col("largest")).alias("asks")), "rest")
    links = first.unionByName(_ask(rest, sets, percent, "links"))
    linked = components(links).withColumnRenamed("node", "linked")
    named = classes.select("k1", "k2", "least", "node").join(linked, F.col("node") == F.col("linked"), "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = materialise(named.join(names, "component").select("k1", "k2", "component_id"), "names")
    found = prints.select("doc_id", "n", "k1", "k2").join(by_class, ["k1", "k2"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
