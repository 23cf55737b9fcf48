"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits; a bit is 1 if it is set in over half the XXH64 hashes (seed 42) of the text's word shingles. Two
fingerprints link at ``max_bits`` or fewer differing bits, and documents of one component form a group.

Anchors are the 2**57 words of the perfect Hamming code on the low 63 bits: every word is within one bit (the covering radius) of exactly
one anchor. Two fingerprints at distance d have a midpoint within ceil(d/2) of both, and the midpoint's anchor is within one more bit; so a fingerprint
is replicated to all anchors within 1 + ceil(max_bits/2) bits, and any two that link meet at an anchor. For two bits these are 32 anchors or one, and an anchor's
group lies in a ball of radius 2, so it can hold 2 * 2,017 distinct fingerprints at most however the data are. Equal fingerprints are one
before they are replicated. At each anchor the members are compared in numpy and only a spanning star of each linked cluster leaves: no group
emits all its pairs, and no link is lost.

Where shingles count once (``repeats=False``), texts whose shingle sets have a Jaccard similarity of ``LIKE`` or more link as well, as two bits are far tighter
than that. Candidates share one of 16 bands of four MinHash values, which misses a pair of similarity 0.8 with a chance of 0.0002, and are confirmed on the
sets. In each bucket of a band the texts are first held against one of them; what others of different groups are left in a bucket are then compared in blocks (once, where several buckets hold the same), each
pair within one task and without becoming a row. Very large ones are dealt by parts of the sets first, so that all their pairs that are alike still meet.

Defined cases: a text without words (or null) has fingerprint zero and links like any other; fewer words than a shingle make one shingle of the
whole sequence; repeated rows stay and share their group; a null doc_id takes part, but never names a group unless all its members are null;
an empty table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.blocks import Postings, compare_in_blocks, parted
from tallyfold.llm.common import batches, early_filters, materialise, slices, unsigned_hex
from tallyfold.llm.components import components
from tallyfold.llm.minhash import BANDS, PERMUTATIONS, signatures

SEED = 42
#: Least Jaccard similarity, in tenths, of texts that link where shingles count once.
LIKE = 8
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz     ")


def shingle_hashes(text: str, size: int, repeats: bool) -> np.ndarray:
    """XXH64 of each run of ``size`` words, as uint64."""
    from xxhash import xxh64_intdigest as digest

    words = [w for w in text.encode("utf-8").translate(_FOLD).split(b" ") if w]
    if len(words) <= size:
        hashes = [digest(b" ".join(words), SEED)] if words else []
    else:
        join = b" ".join
        hashes = [digest(join(s), SEED) for s in zip(*(words[i:] for i in range(size)), strict=False)]
    out = np.array(hashes, dtype=np.uint64)
    return out if repeats else np.unique(out)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if set in over half the hashes; zero for none."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 255):  # so many bits fit a byte's sum
        ones += np.add.reduce(np.unpackbits(hashes[at : at + 255].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Per set the hashes of its MinHash bands, as int64."""
    parts = signatures(sets).astype(np.uint64).reshape(len(sets), BANDS, PERMUTATIONS // BANDS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        out = (out ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, size: int = 3, repeats: bool = True, text: str = "text", doc_id: str = "doc_id", row: str | None = None) -> DataFrame:
    """doc_id and fp: the fingerprint of each whole text as a bigint with the same bits; with ``row`` that key too, without repeats a hash of the text,
    the number of its shingles and its bands."""
    kept = ["doc_id"] + ["row"] * (row is not None) + ["text_hash"] * (not repeats)
    names = [*kept, "fp"] + ["shingles", "bands"] * (not repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_hashes(t or "", size, repeats) for t in batch.column("text").to_pylist()]
            fps = np.array([fingerprint(s) for s in sets], dtype=np.uint64)
            made = [pa.array(fps.view(np.int64))]
            if not repeats:
                made += [pa.array([len(s) for s in sets], pa.int64()), pa.array(list(bands(sets)), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names)

    keys = {"doc_id": F.col(doc_id).cast("long"), "row": F.col(row or doc_id).cast("long"), "text_hash": F.xxhash64(text)}
    rows = docs.select(*(keys[c].alias(c) for c in kept), F.col(text).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} {'array<long>' if c == 'bands' else 'long'}" for c in names))


def _syndromes() -> np.ndarray:
    """Per byte place and value, its part of the Hamming syndrome: the XOR of the numbers 1..63 of the bits set."""
    out = np.zeros((8, 256), dtype=np.uint8)
    for place in range(8):
        for value in range(256):
            s = 0
            for bit in range(8):
                number = 8 * place + bit + 1
                if value >> bit & 1 and number < 64:
                    s ^= number
            out[place, value] = s
    return out


def anchor_masks(radius: int) -> list[np.ndarray]:
    """Per syndrome, the bit masks of at most ``radius`` bits that lead from a word to an anchor."""
    found: list[list[int]] = [[] for _ in range(64)]
    for n in range(radius + 1):
        for numbers in combinations(range(1, 64), n):
            s = mask = 0
            for x in numbers:
                s ^= x
                mask |= 1 << (x - 1)
            found[s].append(mask)
    return [np.array(f, dtype=np.uint64) for f in found]


def anchors_of(fps: np.ndarray, masks: list[np.ndarray], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor within the masks' radius; bit 63 takes no part."""
    low = fps & np.uint64((1 << 63) - 1)
    octets = np.ascontiguousarray(low.astype("<u8")).view(np.uint8).reshape(-1, 8)
    syndrome = np.zeros(len(fps), dtype=np.uint8)
    for place in range(8):
        syndrome ^= table[place, octets[:, place]]
    rows, out = [], []
    for s in np.unique(syndrome):
        at = np.flatnonzero(syndrome == s)
        rows.append(np.repeat(at, len(masks[s])))
        out.append((low[at][:, None] ^ masks[s][None, :]).ravel())
    return np.concatenate(rows), np.concatenate(out)


def stars(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first member) of each cluster under links of max_bits among distinct fingerprints, in blocks."""
    n = len(fps)
    label = np.arange(n)
    for i in range(n):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= max_bits) + i + 1
        if len(near):
            old = np.unique(np.append(label[near], label[i]))
            label[np.isin(label, old)] = old[0]
    away = np.flatnonzero(label != np.arange(n))
    return fps[away], fps[label[away]]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """distinct(fp): links (x, y) between fingerprints that connect exactly the components under max_bits."""
    radius = 1 + -(-max_bits // 2)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, table = anchor_masks(radius), _syndromes()
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            if len(fps):
                rows, anchors = anchors_of(fps, masks, table)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(fps[rows].view(np.int64))], ["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partitions come sorted by anchor; a group may go on in the next batch."""
        kept_a, kept_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def groups(a: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            ends = np.append(starts[1:], len(a))
            xs, ys = [], []
            for i, j in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
                x, y = stars(f[i:j].view(np.uint64), max_bits)
                xs.append(x)
                ys.append(y)
            flat = [np.concatenate(z).view(np.int64) if z else np.zeros(0, np.int64) for z in (xs, ys)]
            return pa.RecordBatch.from_arrays([pa.array(flat[0]), pa.array(flat[1])], ["x", "y"])

        for batch in batches:
            a = np.concatenate([kept_a, batch.column("anchor").to_numpy()])
            f = np.concatenate([kept_f, batch.column("fp").to_numpy()])
            if not len(a):
                continue
            cut = int(np.searchsorted(a, a[-1], side="left"))
            if cut:
                yield groups(a[:cut], f[:cut])
            kept_a, kept_f = a[cut:], f[cut:]
        if len(kept_a):
            yield groups(kept_a, kept_f)

    replicas = distinct.select("fp").mapInArrow(replicate, "anchor long, fp long")
    dealt = replicas.repartition(F.col("anchor")).sortWithinPartitions("anchor")
    return dealt.mapInArrow(compare, "x long, y long").distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int, text: str = "text") -> DataFrame:
    """text_hash and set (sorted shingle hashes) of the texts in wanted(text_hash), each once; wanted may have repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_hashes(t or "", size, False).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("text_hash"), pa.array(sets, pa.list_(pa.int64()))], ["text_hash", "set"])

    texts = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).join(wanted, "text_hash", "left_semi")
    return texts.groupBy("text_hash").agg(F.first("text").alias("text")).mapInArrow(run, "text_hash long, set array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(x, y, a, b) whose texts x and y have shingle sets of the least similarity: their fingerprints (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column("x_set"), batch.column("y_set")
            like = []
            for i in range(len(batch)):
                x, y = (c[i].values.to_numpy(zero_copy_only=False) for c in (xs, ys))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                like.append(10 * shared >= LIKE * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(like, pa.bool_()))

    side = lambda n: sets.select(F.col("text_hash").alias(n), F.col("set").alias(f"{n}_set"))
    return pairs.join(side("y"), "y").join(side("x"), "x").select("a", "b", "x_set", "y_set").mapInArrow(run, "a long, b long")


def _join_components(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
    """One link between fingerprints for each two components that a pair of texts of the least similarity joins."""
    held, label, out = Postings(right["set"].tolist()), {}, []

    def root(c: int) -> int:
        while (up := label.get(c, c)) != c:
            label[c] = c = label.get(up, up)
        return c

    components, prints = right["component"].tolist(), right["fp"].tolist()
    for x, fp, component in zip(left["set"], left["fp"].tolist(), left["component"].tolist(), strict=True):
        for j in held.alike(x, LIKE).tolist():
            a, b = root(component), root(components[j])
            if a != b:
                label[max(a, b)] = min(a, b)
                out.append((fp, prints[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def likeness_links(docs: DataFrame, prints: DataFrame, edges: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Links (a, b) between fingerprints of texts of the least similarity that edges(a, b) leave in different components."""
    spark = docs.sparkSession
    texts = materialise(prints.filter("shingles > 0").groupBy("text_hash").agg(*(F.first(c).alias(c) for c in ("fp", "shingles", "bands"))), "texts")

    def in_buckets(rows: DataFrame, edges: DataFrame) -> DataFrame:
        """rows(text_hash, fp, shingles, band) with their component, of bands that more than one component has."""
        placed = rows.join(components(edges).withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        mixed = placed.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
        return materialise(placed.join(mixed.select("band"), "band"), "buckets")

    def unmet(rows: DataFrame) -> DataFrame:
        """The rows of whole buckets without the text that all others were held against, where those are still of more than one component; of buckets with the same texts one."""
        heads = rows.groupBy("band").agg(F.min("text_hash").alias("head"))
        others = rows.join(heads, "band").filter("text_hash <> head").drop("head")
        names = [F.count("*").alias("n"), *(F.bit_xor(F.xxhash64(F.lit(i), "text_hash")).alias(f"name{i}") for i in range(2))]
        open_ = others.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"), *names).filter("least < most")
        once = open_.groupBy("n", "name0", "name1").agg(F.min("band").alias("band"))
        return materialise(others.join(once.select("band"), "band"), "unmet")

    exploded = texts.select("text_hash", "fp", "shingles", F.explode("bands").alias("band"))
    buckets = in_buckets(exploded, edges)
    with batches(spark), early_filters(spark):  # the filter holds for all; without one Spark takes the keys for unselective
        sets = materialise(shingle_sets(docs, buckets.filter("shingles > 0").select("text_hash"), size, text), "sets")
    # First each text against one of its bucket, in a number of pairs that grows with the rows.
    first = buckets.groupBy("band").agg(F.min(F.struct("text_hash", "fp", "shingles", "component")).alias("f")).select("band", "f.*")
    met = buckets.alias("x").join(first.alias("y"), "band").filter("x.component <> y.component AND least(x.shingles, y.shingles) * 10 >= greatest(x.shingles, y.shingles) * %d" % LIKE)
    low, high = (f(F.struct("x.text_hash", "x.fp"), F.struct("y.text_hash", "y.fp")) for f in (F.least, F.greatest))
    tried = met.select(low.alias("l"), high.alias("h")).select(F.col("l.text_hash").alias("x"), F.col("h.text_hash").alias("y"), F.col("l.fp").alias("a"), F.col("h.fp").alias("b")).distinct()
    with batches(spark):
        found = materialise(confirmed(tried, sets), "found")
    # Then what is left in different components, in blocks. Equal sets have one fingerprint, so they are in one component.
    mixed = parted(unmet(in_buckets(buckets.drop("component"), edges.unionByName(found))), sets, "text_hash", "set", LIKE)
    rest = mixed.join(sets, "text_hash").select("band", "text_hash", "fp", "component", "set")
    more = materialise(compare_in_blocks(rest, "band", "text_hash", "set", _join_components, "a long, b long").distinct(), "found")
    return found.unionByName(more)


def grouped(docs: DataFrame, size: int = 3, max_bits: int = 2, repeats: bool = True, text: str = "text", doc_id: str = "doc_id", row: str | None = None) -> DataFrame:
    """Per row: doc_id, (with ``row``: row,) fp, (without repeats: text_hash, shingles, bands,) component (a fingerprint that names the group) and component_id."""
    spark = docs.sparkSession
    with batches(spark):
        prints = materialise(fingerprints(docs, size, repeats, text, doc_id, row), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    edges = links(distinct, max_bits).select(F.col("x").alias("a"), F.col("y").alias("b"))
    if not repeats:
        edges = materialise(edges, "edges")
        edges = edges.unionByName(likeness_links(docs, prints, edges, size, text))
    linked = components(edges)
    # Components are named by fingerprints; their smallest doc_id names them for the documents.
    groups = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialise(groups.join(names, "component").select("fp", "component", "component_id"), "groups")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, repeats: bool = True, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, fp, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    return grouped(docs, size, max_bits, repeats, text, doc_id).select("doc_id", "fp", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, size: int = 5, max_bits: int = 2, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Exactly one row of each group (shingles count once), with the columns of docs: the least by doc_id (nulls last), hash of the text and place among the rows."""
    row = "_row"
    if clash := {row} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has {sorted(clash)}")
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "row")
    first = grouped(numbered, size, max_bits, False, text, doc_id, row).groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.row").alias("kept_row"))
    return numbered.join(first, F.col(row) == F.col("kept_row"), "left_semi").select(*docs.columns)
