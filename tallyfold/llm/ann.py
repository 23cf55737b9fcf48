"""Approximate nearest neighbours by learned partitions.

1. A bounded sample (``SAMPLE`` rows by hash) is split in two. Of the larger part the exact neighbour graph is cut into partitions of equal size by recursive spectral bisection at
   the median.
2. A small classifier (one hidden layer, softmax) learns which partition a vector belongs to.
3. Every row of the table goes to its most probable partition. A query is routed to its most probable partitions and reranked there by the exact distance in double precision. How
   many partitions it looks into is set by the part of the sample that nothing was fitted on: as many as its rows need for ``RECALL`` of their true neighbours in the other part.

The number of partitions grows with the square root of the rows, from ``LEAST_PARTITIONS`` to ``MOST_PARTITIONS``, at every size by the same rule. Partitions are cut into
blocks of ``BLOCK`` rows and a partition's queries into blocks of ``QUERIES``, so no task depends on how many rows share a partition. Of rows with one and the same vector,
``k + 1`` of the smallest ids can be among the nearest of a query, so only these are candidates (exact); equal query vectors are searched once. A query that finds fewer than k in
its partitions, though there are more rows, is searched in all of them.

Defined cases: vectors that are null, zero or hold a null or non-finite component, and null ids, take no part; a vector shorter than the longest counts as filled up with zeros; ties
go to the smaller id; an id with several vectors stands for all of them: the distance of two ids is the least of their vectors', and an id is found once; fewer rows than k give
all; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import batches, materialise

SAMPLE = 8_192
NEIGHBOURS = 10
RECALL = 0.93
BLOCK = 8_192
QUERIES = 2_048
#: A partition has at least so many rows of the sample, which bounds the partitions at SAMPLE / LEAF_ROWS.
LEAF_ROWS = 12
LEAST_PARTITIONS = 8
MOST_PARTITIONS = 512


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k nearest other rows of each row, in blocks."""
    out, norms = np.empty((len(x), k), dtype=np.int64), (x * x).sum(1)
    for at in range(0, len(x), 1024):
        d = norms[None, :] - 2 * x[at : at + 1024] @ x.T
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        out[at : at + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_partitions(graph: np.ndarray, depth: int, seed: int = 5) -> np.ndarray:
    """2**depth parts of equal size: each part is halved at the median of the slow mode of a lazy walk on its graph."""
    rng, n = np.random.default_rng(seed), len(graph)
    part = np.zeros(n, dtype=np.int64)
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(depth):
        inner = part[source] == part[target]
        s, t = source[inner], target[inner]
        degree = np.bincount(s, minlength=n) + np.bincount(t, minlength=n) + 1e-9
        v = rng.standard_normal(n)
        for _ in range(60):
            mean = np.bincount(part, degree * v) / np.bincount(part, degree)
            v -= mean[part]
            v = 0.5 * v + 0.5 * (np.bincount(s, v[t], n) + np.bincount(t, v[s], n)) / degree
            v /= np.sqrt(np.bincount(part, v * v) / np.bincount(part))[part] + 1e-30
        order = np.lexsort((v, part))
        sizes = np.bincount(part)
        starts = np.cumsum(sizes) - sizes
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n) - starts[part[order]]
        part = 2 * part + (place >= sizes[part] // 2)
    return part


@dataclass
class Router:
    """Classifier of vectors into partitions; probes: partitions a query looks into."""

    centre: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def best(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n most probable partitions of each row."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]


def train_router(x: np.ndarray, part: np.ndarray, parts: int, hidden: int = 128, epochs: int = 30, seed: int = 3) -> Router:
    """Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    centre, scale = x.mean(0), float(x.std()) or 1.0
    z = (x - centre) / scale
    p = [rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden), rng.standard_normal((hidden, parts)) / np.sqrt(hidden), np.zeros(parts)]
    m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 256):
            i = order[at : at + 256]
            h = np.tanh(z[i] @ p[0] + p[1])
            o = h @ p[2] + p[3]
            q = np.exp(o - o.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            q[np.arange(len(i)), part[i]] -= 1
            q /= len(i)
            back = (q @ p[2].T) * (1 - h * h)
            step += 1
            for k, g in enumerate((z[i].T @ back, back.sum(0), h.T @ q, q.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] -= 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Router(centre, scale, *p, probes=1)


def partitions(rows: int, sample: int) -> int:
    """A power of two near a sixth of the root of the rows, as far as the sample has LEAF_ROWS rows for each."""
    wanted = min(max(rows**0.5 / 6, LEAST_PARTITIONS), MOST_PARTITIONS, max(1, sample // LEAF_ROWS))
    return 1 << max(0, round(np.log2(wanted)))


def fit(x: np.ndarray, rows: int, k: int = NEIGHBOURS, recall: float = RECALL) -> Router:
    """Router from sample vectors x (in random order), for a table of so many rows."""
    held, x = (x[: len(x) // 4], x[len(x) // 4 :]) if len(x) > 8 else (x, x)
    parts, k = partitions(rows, len(x)), min(k, len(x) - 1)
    if k < 1:
        return Router(np.zeros(x.shape[1]), 1.0, np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    router = train_router(x, balanced_partitions(neighbour_graph(x, k), parts.bit_length() - 1), parts)
    # How many partitions a row that nothing was fitted on must look into for the wanted share of its true neighbours.
    home, needed = router.best(x, 1)[:, 0], []
    norms = (x * x).sum(1)
    for at in range(0, len(held), 512):
        q = held[at : at + 512]
        near = np.argpartition(norms[None, :] - 2 * q @ x.T, k - 1, axis=1)[:, :k]
        needed.append(np.argsort(router.best(q, parts), axis=1)[np.arange(len(q))[:, None], home[near]].ravel())
    flat = np.sort(np.concatenate(needed))
    router.probes = int(flat[min(len(flat) - 1, int(np.ceil(recall * len(flat))))]) + 1
    return router


def _clean(table: DataFrame, vector: str, vec_id: str) -> DataFrame:
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    good = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    return rows.filter(good)


def _routed(rows: DataFrame, router: Router, probes: int) -> DataFrame:
    """Adds part: an array of the most probable partitions."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                f["part"] = list(router.best(np.array(f["v"].tolist()), probes).astype(np.int32))
                yield f

    return rows.mapInPandas(run, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", part array<int>")


def nearest(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance) of each query's k nearest ids; exact, ties to the smaller id. A product shortlists, differences decide."""
    out: list[tuple] = []
    norms, repeated = (vectors * vectors).sum(1), len(np.unique(ids)) < len(ids)
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        rough = (q * q).sum(1)[:, None] + norms[None, :] - 2 * q @ vectors.T
        error = 1e-9 * (norms.max() + (q * q).sum(1))
        last = min(k, rough.shape[1]) - 1
        bound = np.full(len(q), np.inf) if repeated else np.partition(rough, last, axis=1)[:, last] + error
        for i in range(len(q)):
            near = np.flatnonzero(rough[i] <= bound[i])
            exact = np.sqrt(((vectors[near] - q[i]) ** 2).sum(1))
            order = np.lexsort((ids[near], exact))
            if repeated:  # the nearest vector of each id
                order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])]
            order = order[:k]
            out.append((np.full(len(order), at + i), ids[near][order], exact[order]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _searched(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """base(part, vec_id, v), asked(part, vec_id, v): the k + 1 nearest ids found for each asker (vec_id of asked) in its partitions: asker, found, score."""
    # Blocks per partition; two small tables of one number per partition.
    count = lambda df, size, name: df.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    blocks = F.broadcast(count(base, BLOCK, "blocks").join(count(asked, QUERIES, "query_blocks"), "part"))
    number = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = base.join(blocks, "part").withColumn("b", number("blocks")).withColumn("q", every("query_blocks")).withColumn("asks", F.lit(False))
    right = asked.join(blocks, "part").withColumn("q", number("query_blocks")).withColumn("b", every("blocks")).withColumn("asks", F.lit(True))
    columns = ["part", "b", "q", "asks", "vec_id", "v"]

    def rerank(f: pd.DataFrame) -> pd.DataFrame:
        asks, held = f[f["asks"]], f[~f["asks"]]
        if not len(asks) or not len(held):
            return pd.DataFrame({"asker": [], "vec_id": [], "score": []}).astype({"asker": "int64", "vec_id": "int64"})
        rows, ids, score = nearest(np.array(asks["v"].tolist()), held["vec_id"].to_numpy(), np.array(held["v"].tolist()), k + 1)
        return pd.DataFrame({"asker": asks["vec_id"].to_numpy()[rows], "vec_id": ids, "score": score})

    met = left.select(columns).unionByName(right.select(columns)).groupBy("part", "b", "q").applyInPandas(rerank, "asker long, vec_id long, score double")
    first = Window.partitionBy("asker").orderBy("score", "vec_id")
    once = met.groupBy("asker", "vec_id").agg(F.min("score").alias("score"))
    return once.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).select("asker", F.col("vec_id").alias("found"), "score")


def search(table: DataFrame, is_query: str = "vec_id % 100 = 0", k: int = 10, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the k nearest rows found for each row that the SQL condition takes as a query."""
    spark = table.sparkSession
    clean = _clean(table, vector, vec_id)
    longest = clean.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    filled = F.expr(f"IF(size(v) < {longest}, concat(v, array_repeat(0.0D, {longest} - size(v))), v)")
    clean = materialise(clean.withColumn("v", filled), "vectors")
    total = clean.count()
    sample = clean.withColumn("h", F.xxhash64("v")).dropDuplicates(["h"]).orderBy("h").limit(SAMPLE).select("v").collect()
    router = fit(np.array([r["v"] for r in sample]), total)

    # Of equal vectors the k + 1 smallest ids; the limit works before the shuffle too.
    same = Window.partitionBy("v").orderBy("vec_id")
    candidates = clean.dropDuplicates(["vec_id", "v"]).withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1).drop("n")
    with batches(spark, 4096):
        base = materialise(_routed(candidates, router, 1).withColumn("part", F.col("part")[0]), "index")
    queries = materialise(clean.filter(is_query).select("vec_id", "v").distinct(), "queries")
    # An asker is a distinct query vector, with a number.
    askers = materialise(queries.select("v").distinct().withColumn("asker", F.monotonically_increasing_id()), "askers")
    with batches(spark, 4096):
        routed = _routed(askers.select(F.col("asker").alias("vec_id"), "v"), router, router.probes)
        routed = materialise(routed.select("vec_id", "v", F.explode("part").alias("part")), "routed")
    best = materialise(_searched(base, routed, k), "best")
    # Askers that found too few where they looked, of an id's own rows and k more, look everywhere.
    ids = base.select("vec_id").distinct().limit(k + 1).count()
    few = best.groupBy("asker").agg(F.count("*").alias("n")).join(askers, "asker", "right").filter(F.coalesce("n", F.lit(0)) < ids)
    few = materialise(few.select(F.col("asker").alias("vec_id"), "v"), "few")
    if router.probes < len(router.b2) and few.limit(1).count():
        again = few.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(len(router.b2) - 1))))
        best = best.join(few.select(F.col("vec_id").alias("asker")), "asker", "left_anti").unionByName(_searched(base, again, k))
    # Every query with the vectors that were asked about; what one id's vectors find is one answer.
    named = queries.join(askers.select(F.col("v").alias("w"), "asker"), F.col("v") == F.col("w")).select(F.col("vec_id").alias("query_id"), "asker")
    answers = named.join(best, "asker").filter("found <> query_id").groupBy("query_id", "found").agg(F.min("score").alias("score"))
    last = Window.partitionBy("query_id").orderBy("score", "found")
    return answers.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("vec_id"), "score")
