"""Traversal on edge tables: neighbourhoods, shortest paths, closures, rollups, degrees.

Each hop is a join of the frontier with the edge table; the frontier of visited nodes is kept distinct, so rows don't multiply along paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.sources.scratch import ROWS_PER_TASK, dealt, kept


def undirected(edges: DataFrame) -> DataFrame:
    """edges(src, dst) both ways, distinct."""
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


#: Nodes in one list at most, the seeds from which on a seed's nodes aren't spread over parts, and the nodes of a seed from which on they are all the same.
LIST, MANY_SEEDS, REACH = 256, 1_024, 4_000_000
#: Stands for a missing node, which is reached but leads nowhere.
MISSING = -(1 << 63)
#: Nodes of an end whose neighbours are looked at first when a pair may meet, and how many times more each time after.
TRIED, MORE = 32, 8

_LISTS = "seed long, part int, hops int, at int, n int, first long, rest binary"


def _packed(values: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """Ascending nodes, list after list, and the lists' sizes (none is 0): (n, first, rest). rest has the steps from node to node, seven bits a byte, the last byte of a step under 128."""
    starts = np.cumsum(n) - n
    inner = np.ones(len(values), bool)
    inner[starts] = False
    steps = np.diff(values, prepend=values[:1]).view(np.uint64)[inner]
    width = np.ones(len(steps), np.int64)
    for bits in range(7, 64, 7):
        wider = steps >> np.uint64(bits) > 0
        if not wider.any():
            break
        width += wider
    ends = np.cumsum(width)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(width.max(initial=0))):
        has = width > k
        data[ends[has] - width[has] + k] = (steps[has] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | ((width[has] > k + 1) << 7).astype(np.uint8)
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n - 1)])].astype(np.int32)
    rest = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return [pa.array(n.astype(np.int32)), pa.array(values[starts]), rest]


def _unpacked(batch: pa.RecordBatch) -> pa.ListArray:
    """The lists that _packed has packed."""
    n, first, rest = batch.column("n").to_numpy().astype(np.int64), batch.column("first").to_numpy(), batch.column("rest")
    offsets = np.frombuffer(rest.buffers()[1], np.int32)[rest.offset:rest.offset + len(rest) + 1]
    data = np.frombuffer(rest.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if rest.buffers()[2] else np.empty(0, np.uint8)
    ends = np.flatnonzero(data < 128)
    begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    steps, width = (data[begins] & 127).astype(np.int64), ends - begins
    for k in range(1, int(width.max(initial=0)) + 1):
        has = np.flatnonzero(width >= k)
        steps[has] |= (data[begins[has] + k] & 127).astype(np.int64) << (7 * k)
    starts = np.cumsum(n) - n
    values, inner = np.zeros(int(n.sum()), np.int64), np.ones(int(n.sum()), bool)
    inner[starts] = False
    values[inner] = steps
    np.cumsum(values, out=values)
    values += np.repeat(first - values[starts], n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values))


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of (node, part, far, side), in that order: lists of up to most far nodes per node and part; side has the bits of a list's rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, part, far, side = (batch.column(c).to_numpy() for c in ("node", "part", "far", "side"))
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (part[1:] != part[:-1])])
        place = np.arange(len(node))
        place -= np.maximum.accumulate(np.where(new, place, 0))
        starts = np.flatnonzero(place % most == 0)
        once = np.concatenate([[True], far[1:] != far[:-1]])
        once[starts] = True
        yield pa.RecordBatch.from_arrays([pa.array(node[starts]), pa.array(part[starts]), pa.array(np.bitwise_or.reduceat(side, starts)), *_packed(far[once], np.add.reduceat(once.astype(np.int64), starts))], ["node", "part", "side", "n", "first", "rest"])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (seed, part, hops, near), in that order: the lists of equal rows in a batch as one, each node once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        seed, near = batch.column("seed"), batch.column("near")
        keys = [pc.dictionary_encode(seed).indices.to_numpy(), batch.column("part").to_numpy(), batch.column("hops").to_numpy()]
        starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]))
        lists = [pc.unique(near.slice(i, j - i).flatten()) for i, j in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True)]
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(starts)) for c in ("seed", "part", "hops")), pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(lists))], ["seed", "part", "hops", "near"])


def _whole(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Packed lists by (seed, part, hops) as lists, in batches that hold a seed's part whole. Of one that runs on, nodes are made one whenever there are most more."""
    joined = lambda held: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    held, key, size, full = [], None, 0, most
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays([batch.column("seed"), batch.column("part"), batch.column("hops"), _unpacked(batch)], ["seed", "part", "hops", "near"])
        seed, part = batch.column("seed").to_numpy(), batch.column("part").to_numpy()
        other = np.flatnonzero((seed != seed[-1]) | (part != part[-1]))
        start = int(other[-1]) + 1 if len(other) else 0
        if start or key != (seed[-1], part[-1]):
            if held or start:
                yield joined([*held, *([batch.slice(0, start)] if start else [])])
            held, key, size, full = [], (seed[-1], part[-1]), 0, most
        held.append(batch.slice(start))
        size += len(held[-1].column("near").flatten())
        if size > full:
            held = list(_once(iter([joined(held)])))
            size = len(held[0].column("near").flatten())
            full = size + most
    if held:
        yield joined(held)


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, int, list[tuple[int, pa.Array]]]]:
    """(seed, part, [(hops, nodes)]) of packed lists by (seed, part, hops): each node once per hops."""
    for batch in _once(_whole(batches, most)):
        seed, part, hops = (batch.column(c).to_pylist() for c in ("seed", "part", "hops"))
        near, i = batch.column("near"), 0
        for j in range(1, batch.num_rows + 1):
            if j == batch.num_rows or seed[j] != seed[i] or part[j] != part[i]:
                yield seed[i], part[i], [(hops[k], near.slice(k, 1).flatten()) for k in range(i, j)]
                i = j


def _fewest(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, int, int, pa.Array]]:
    """(seed, part, hops, nodes): each node of a seed by its fewest hops."""
    for seed, part, lists in _groups(batches, most):
        seen = None
        for hops, nodes in lists:
            new = nodes
            if seen is not None:
                both = pc.unique(pa.concat_arrays([seen, nodes]))
                new, nodes = both.slice(len(seen)), both
            seen = nodes
            if len(new):
                yield seed, part, hops, new


def _fewest_lists(batches: Iterator[pa.RecordBatch], most: int, size: int) -> Iterator[pa.RecordBatch]:
    """_fewest as packed lists of up to size nodes; at: the place of a list's first node among its seed's."""
    for rows in _some(_fewest(batches, most)):
        n, keys, at = [], [], []
        for seed, part, hops, nodes in rows:
            cuts = range(0, len(nodes), size)
            at += cuts
            n += [min(size, len(nodes) - c) for c in cuts]
            keys += [(seed, part, hops)] * len(cuts)
        seed, part, hops = zip(*keys, strict=True)
        values = np.concatenate([np.sort(x[3].to_numpy()) for x in rows])
        yield pa.RecordBatch.from_arrays([pa.array(seed, pa.int64()), pa.array(part, pa.int32()), pa.array(hops, pa.int32()), pa.array(at, pa.int32()), *_packed(values, np.array(n, np.int64))], ["seed", "part", "hops", "at", "n", "first", "rest"])


def _fewest_rows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """_fewest as rows of (seed, node, hops)."""
    for rows in _some(_fewest(batches, most)):
        n = [len(x[3]) for x in rows]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([x[0] for x in rows], n)), pa.concat_arrays([x[3] for x in rows]), pa.array(np.repeat([x[2] for x in rows], n).astype(np.int32))], ["seed", "node", "hops"])


def _fewest_sizes(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(seed, hops, nodes): the number of _fewest's nodes."""
    for rows in _some(_fewest(batches, most)):
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.int32()), pa.array([len(x[3]) for x in rows], pa.int64())], ["seed", "hops", "nodes"])


def _some(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows that end in nodes, in lists with some 100,000 nodes or 10,000 rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= 100_000 or len(held) >= 10_000:
            yield held
            held, size = [], 0
    if held:
        yield held


def _nodes(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of (seed, node) of packed lists; of a seed's nodes only those whose place is under most."""
    for batch in batches:
        if batch.num_rows:
            near, n = _unpacked(batch), batch.column("n").to_numpy()
            rows = pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("seed").to_numpy(), n)), near.flatten()], ["seed", "node"])
            if most is not None:
                place = np.arange(rows.num_rows) - np.repeat(np.cumsum(n) - n, n) + np.repeat(batch.column("at").to_numpy(), n)
                rows = rows.filter(pa.array(place < most))
            yield rows


def _meeting(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Seeds with a node that has both hops."""
    met = [seed for seed, _, lists in _groups(batches, most) if len(lists) == 2 and pc.any(pc.is_in(lists[1][1], value_set=lists[0][1])).as_py()]
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64())], ["seed"])


def _numbered(edges: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """edges and others with nodes as numbers, and the (name, number) of all nodes, which are joined by sorting, however small their file; numbers stay as they are, without such a table."""
    if all(t in ("tinyint", "smallint", "int", "bigint") for _, t in edges.dtypes + others.dtypes):
        return edges, others, None
    columns = [d.select(F.col(c).alias("name")) for d in (edges, others) for c in d.columns]
    names = columns[0]
    for c in columns[1:]:
        names = names.unionByName(c)
    names = kept(names.filter("name IS NOT NULL").distinct().withColumn("number", F.monotonically_increasing_id()), "names")

    def numbers(d: DataFrame) -> DataFrame:
        for c in d.columns:
            d = d.join(names.select(F.col("name").alias(c), F.col("number").alias("_n")).hint("merge"), c, "left").drop(c).withColumnRenamed("_n", c)
        return d

    return numbers(edges), numbers(others), names


def _named(rows: DataFrame, names: DataFrame | None, *columns: str) -> DataFrame:
    """rows with the names of the numbers in columns."""
    for c in columns if names is not None else ():
        rows = rows.join(names.select(F.col("number").alias(c), F.col("name").alias("_n")).hint("merge"), c, "left").drop(c).withColumnRenamed("_n", c)
    return rows


def _lists(edges: DataFrame, rows: int, parts: int) -> DataFrame:
    """(node, part, side, n, first, rest): the neighbours of a node in packed lists, in parts by their hash; side has bit 1 where the node is a src, 2 where it is a dst. Dealt by ranges, a node of many neighbours is no single task's."""
    both = edges.select(F.col("src").cast("long").alias("node"), F.col("dst").cast("long").alias("far"), F.lit(1).alias("side"))
    both = both.unionByName(edges.select(F.col("dst").cast("long").alias("node"), F.col("src").cast("long").alias("far"), F.lit(2).alias("side"))).filter("node IS NOT NULL")
    both = both.select("node", _part("far", parts), F.coalesce("far", F.lit(MISSING)).alias("far"), "side")
    order = ("node", "part", "far")
    both = both.repartitionByRange(max(1, -(-2 * rows // ROWS_PER_TASK)), *order).sortWithinPartitions(*order)
    size = LIST
    return kept(both.mapInArrow(lambda batches: _runs(batches, size), "node long, part int, side int, n int, first long, rest binary"), "near")


def _part(node: str, parts: int) -> F.Column:
    return F.pmod(F.xxhash64(node), F.lit(parts)).cast("int").alias("part")


def _single(rows: DataFrame, parts: int) -> DataFrame:
    """rows(seed, node, hops) as packed lists of one node."""
    return rows.select("seed", _part("node", parts), "hops", F.lit(0).alias("at"), F.lit(1).alias("n"), F.col("node").alias("first"), F.lit(b"").alias("rest"))


def _near(edges: DataFrame, seeds: int, depth: int) -> tuple[DataFrame, int]:
    """_lists and the number of its parts. Few seeds have their nodes in several parts, or all would be one task's; so have seeds that may reach more than REACH nodes."""
    rows, parts = edges.count(), max(1, min(64, MANY_SEEDS // max(1, seeds)))
    near = _lists(edges, rows, parts)
    nodes, most = near.groupBy("node").agg(F.sum("n").alias("n")).agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    needed = -(-min(nodes, most ** min(depth, 64)) // REACH)
    return (_lists(edges, rows, needed), needed) if needed > parts else (near, parts)


def _walked(front: DataFrame, rows: int, near: DataFrame, hops: int) -> DataFrame:
    """front(seed, node), of about that many rows: the lists of the nodes' neighbours, under their seeds."""
    lists = dealt(near, rows, "node").select("node", "part", "n", "first", "rest").hint("merge")
    return dealt(front, rows, "node").join(lists, "node").select("seed", "part", F.lit(hops).alias("hops"), F.lit(0).alias("at"), "n", "first", "rest")


def _laid(lists: DataFrame, rows: int) -> DataFrame:
    """lists together by seed and part, in the order of hops."""
    tasks = -(-rows // ROWS_PER_TASK)
    many = tasks > int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = lists.repartition(tasks, "seed", "part") if many else lists.repartition("seed", "part")
    return lists.sortWithinPartitions("seed", "part", "hops")


def _total(lists: DataFrame) -> int:
    """The number of nodes in lists."""
    return lists.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _reached(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """Lists of the nodes within depth of each seed(node), nodes being numbers; one may be in lists of several hops."""
    seen = seeds.select(F.coalesce(F.col("node").cast("long"), F.lit(MISSING)).alias("node")).distinct()
    near, parts = _near(edges, seen.count(), depth)
    seen = kept(_single(seen.select(F.col("node").alias("seed"), "node", F.lit(0).alias("hops")), parts), "seen")
    most, size = REACH, LIST
    met = _laid(seen, 0)
    for hop in range(1, depth + 1):
        last = seen.filter(F.col("hops") == hop - 1)
        rows = _total(last)
        step = _walked(last.mapInArrow(lambda batches: _nodes(batches), "seed long, node long"), rows, near, hop)
        met = _laid(step.unionByName(seen), rows)
        if hop < depth:
            seen = kept(met.mapInArrow(lambda batches: _fewest_lists(batches, most, size), _LISTS), "seen")
    return met


def khop(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(seed, node, hops): nodes within depth of each seed(node), by the fewest hops. edges(src, dst) are read three times, so they had better be stored.

    A step moves packed lists of neighbours, not walks, to their seeds. Walks are many more than the nodes they end at; all that end alike are made one where their seed lies, before they become rows.
    """
    edges, seeds, names = _numbered(edges.select("src", "dst"), seeds.select("node"))
    most = REACH
    rows = _reached(edges, seeds, depth).mapInArrow(lambda batches: _fewest_rows(batches, most), "seed long, node long, hops int")
    rows = rows.withColumns({c: F.when(F.col(c) != MISSING, F.col(c)) for c in ("seed", "node")})
    return _named(rows, names, "seed", "node").select("seed", "node", "hops")


def khop_sizes(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(seed, hops, nodes): how many nodes khop has, counted where their seed lies."""
    edges, seeds, names = _numbered(edges.select("src", "dst"), seeds.select("node"))
    most = REACH
    sizes = _reached(edges, seeds, depth).mapInArrow(lambda batches: _fewest_sizes(batches, most), "seed long, hops int, nodes long")
    sizes = sizes.withColumn("seed", F.when(F.col("seed") != MISSING, F.col("seed"))).groupBy("seed", "hops").agg(F.sum("nodes").alias("nodes"))
    return _named(sizes, names, "seed").select("seed", "hops", "nodes")


def shortest_paths(edges: DataFrame, pairs: DataFrame, depth: int) -> DataFrame:
    """(src, dst, hops) for pairs(src, dst) within depth; others are left out. A pair that is found spreads no further. edges(src, dst) are read three times, so they had better be stored.

    Both ends spread by turns, and a pair is found where they meet: its hops are those of both. Walks may turn back, which finds no pair sooner. The last step of an end isn't written out, only
    the lists of its nodes' neighbours are met with the other end's, first of a few nodes of each end, then of more, then of all: one meeting is enough, and a pair is passed over only when all have been.
    Where no node is both a src and a dst of edges, each hop changes sides, so a pair is not looked for by hops of the wrong parity.
    """
    edges, pairs, names = _numbered(edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL"), pairs.select("src", "dst").distinct())
    wanted = kept(pairs.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")).withColumn("seed", F.monotonically_increasing_id()), "pairs")
    found = wanted.filter("src = dst").select("seed", F.lit(0).alias("hops"))
    near, parts = _near(edges, wanted.count(), (depth + 1) // 2)
    sides = kept(near.groupBy("node").agg(F.bit_or("side").alias("side")), "sides")
    two_sided = sides.filter("side = 3").isEmpty()
    left = wanted.filter("src <> dst")
    for end in ("src", "dst"):  # an end without edges is not met
        left = left.join(sides.select(F.col("node").alias(end), F.col("side").alias(f"{end}_side")).hint("merge"), end)
    left = kept(left.select("seed", "src", "dst", (F.col("src_side") != F.col("dst_side")).cast("int").alias("odd")), "left")
    fronts = [_single(left.select("seed", F.col(end).alias("node"), F.lit(turn).alias("hops")), parts) for turn, end in enumerate(("src", "dst"))]
    opened, most, size = [False, False], REACH, LIST

    def walked(lists: DataFrame, open_pairs: DataFrame, turn: int, tried: int | None = None) -> tuple[DataFrame, int]:
        lists = lists.join(open_pairs.select("seed"), "seed", "left_semi")
        lists = lists.filter(F.col("at") < tried) if tried else lists
        rows = min(_total(lists), tried * open_pairs.count() * parts) if tried else _total(lists)
        return _walked(lists.select("seed", "at", "n", "first", "rest").mapInArrow(lambda batches: _nodes(batches, tried), "seed long, node long"), rows, near, turn), rows

    for hop in range(1, depth + 1):
        turn = (hop - 1) % 2
        if opened[turn]:
            step, rows = walked(fronts[turn], left, turn)
            fronts[turn] = kept(_laid(step, rows).mapInArrow(lambda batches: _fewest_lists(batches, most, size), _LISTS), "frontier")
        opened[turn] = True
        wide = max(f.agg(F.coalesce(F.max(F.col("at") + F.col("n")), F.lit(0))).first()[0] for f in fronts)
        tried, all_tried = TRIED, False
        while not all_tried:
            sought = left.filter(F.col("odd") == hop % 2) if two_sided else left
            if sought.isEmpty():
                break
            all_tried = tried >= wide
            sets, moved = [], 0
            for side, front in enumerate(fronts):
                lists, rows = walked(front, sought, side, tried) if opened[side] else (front.join(sought.select("seed"), "seed", "left_semi"), 0)
                sets, moved = [*sets, lists.select("seed", "part", "hops", "n", "first", "rest")], moved + rows
            met = _laid(sets[0].unionByName(sets[1]), moved).mapInArrow(lambda batches: _meeting(batches, most), "seed long")
            met = kept(met.distinct().withColumn("hops", F.lit(hop)), "reached")
            found = found.unionByName(met)
            left = kept(left.join(met, "seed", "left_anti"), "left")
            tried *= MORE
    return _named(found.join(wanted, "seed").select("src", "dst", "hops"), names, "src", "dst").select("src", "dst", "hops")


def simple_paths(edges: DataFrame, pairs: DataFrame, shortest: DataFrame, extra: int = 2, depth: int = 6, limit: int = 9) -> DataFrame:
    """(src, dst, path, hops): paths without repeated nodes that are 1 to extra hops longer than shortest(src, dst, hops), the limit shortest ones per pair."""
    both = undirected(edges).select(F.col("src").alias("near"), F.col("dst").alias("far"))
    most = F.least(F.col("hops") + extra, F.lit(depth))
    walk = pairs.select("src", "dst").distinct().join(shortest, ["src", "dst"]).select("src", "dst", F.array("src").alias("path"), "hops", most.alias("most"))
    out = None
    for hop in range(1, depth + 1):
        walk = walk.join(both, (F.element_at("path", -1) == F.col("near")) & (F.col("most") >= hop)).filter(~F.array_contains("path", F.col("far")))
        walk = walk.select("src", "dst", F.concat("path", F.array("far")).alias("path"), "hops", "most")
        ended = walk.filter((F.element_at("path", -1) == F.col("dst")) & (F.lit(hop) > F.col("hops"))).select("src", "dst", "path", F.lit(hop).alias("hops"))
        out = ended if out is None else out.unionByName(ended)
        walk = walk.filter(F.element_at("path", -1) != F.col("dst"))
    place = F.row_number().over(Window.partitionBy("src", "dst").orderBy("hops", "path"))
    return out.withColumn("place", place).filter(F.col("place") <= limit).drop("place")


def merge_nodes(edges: DataFrame, mapping: DataFrame, rows: int = 0) -> DataFrame:
    """edges(src, dst) with both ends moved to their canonical nodes by mapping(node, canonical); loops and repeats go. rows: about how many edges there are, to deal them by."""
    to = lambda end: mapping.select(F.col("node").alias(f"_{end}"), F.col("canonical").alias(f"_{end}_to"))
    moved = edges.select("src", "dst").join(to("src"), F.col("src") == F.col("_src"), "left")
    moved = dealt(moved, rows, "dst").join(to("dst"), F.col("dst") == F.col("_dst"), "left")
    ends = moved.select(F.coalesce("_src_to", "src").alias("src"), F.coalesce("_dst_to", "dst").alias("dst")).filter("src <> dst")
    return dealt(ends, rows, "src", "dst").distinct()


def ancestors(parents: DataFrame, depth: int) -> DataFrame:
    """parents(node, parent): (node, ancestor, hops) for hops 0..depth."""
    up = parents.filter("parent IS NOT NULL AND parent <> node").select(F.col("node").alias("child"), F.col("parent").alias("above"))
    level = parents.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("hops")).distinct()
    out = level
    for hop in range(1, depth + 1):
        level = level.join(up, F.col("ancestor") == F.col("child")).select("node", F.col("above").alias("ancestor"), F.lit(hop).alias("hops"))
        out = out.unionByName(level)
    return out


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """nodes(kind, node): per kind the number of nodes, isolated ones, and degree figures."""
    ends = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node")))
    degree = nodes.join(ends.groupBy("node").agg(F.count("*").alias("degree")), "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    # Nodes of one degree are counted first, so the percentiles' buffer holds each degree once.
    counted = degree.groupBy("kind", "degree").agg(F.count("*").alias("n"))
    d, n = F.col("degree"), F.col("n")
    between = lambda low, high: F.sum(F.when(d.between(low, high), n).otherwise(0))
    out = counted.groupBy("kind").agg(
        F.sum(n).alias("nodes"), between(0, 0).alias("isolated"), F.min(d).alias("least"), F.max(d).alias("most"), S.rounded(F.sum(d * n) / F.sum(n), 4).alias("mean"),
        F.percentile(d, [0.5, 0.95], n).alias("_p"), between(1, 9).alias("d1_9"), between(10, 49).alias("d10_49"), between(50, 1 << 62).alias("d50"))
    return out.withColumns({"p50": S.rounded(F.col("_p")[0], 4), "p95": S.rounded(F.col("_p")[1], 4)}).drop("_p")


#: Classes of degrees as reports show them: name, least and most; fixed values.
DEGREE_CLASSES = (("isolated", 0, 0), ("d1", 1, 1), ("d2_5", 2, 5), ("d6_10", 6, 10), ("d11_50", 11, 50), ("d51_100", 51, 100), ("d101_500", 101, 500), ("d501", 501, 1 << 62))


def degree_classes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """nodes(kind, node): per kind the nodes in each of the eight classes of degree; both ends of an edge count."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    degree = F.coalesce("degree", F.lit(0))
    return nodes.join(ends, "node", "left").groupBy("kind").agg(F.count("*").alias("nodes"), *(F.count_if(degree.between(low, high)).alias(name) for name, low, high in DEGREE_CLASSES))


def typed_neighbourhood(edges: DataFrame, seeds: DataFrame, depth: int, kinds: list[str] | None = None, excluded: tuple[str, ...] = (), since: str | None = None, most: int = 500) -> tuple[DataFrame, DataFrame]:
    """edges(src, dst, kind, day), seeds(node): (nodes, edges) within depth of the seeds. Edges of other kinds than the wanted, of excluded kinds, and from before a day
    don't count. At most ``most`` nodes by (hops, node), and the edges between them. Each frontier is what the hop before added, so a hop reads the edges once."""
    used = edges.filter(~F.col("kind").isin(*excluded)) if excluded else edges
    used = used.filter(F.col("kind").isin(*kinds)) if kinds is not None else used
    used = used.filter(F.col("day") >= F.lit(since).cast("date")) if since else used
    both = undirected(used).select(F.col("src").alias("near"), F.col("dst").alias("far"))
    frontier = seeds.select("node").distinct().withColumn("hops", F.lit(0))
    seen = frontier
    for hop in range(1, depth + 1):
        step = frontier.join(both, F.col("node") == F.col("near")).select(F.col("far").alias("node")).distinct()
        frontier = step.join(seen, "node", "left_anti").withColumn("hops", F.lit(hop))
        seen = seen.unionByName(frontier)
    nodes = seen.orderBy("hops", "node").limit(most)
    keep = nodes.select("node")
    between = used.join(keep.withColumnRenamed("node", "src"), "src", "left_semi").join(keep.withColumnRenamed("node", "dst"), "dst", "left_semi")
    return nodes, between.select("src", "dst", "kind", "day").distinct()


def reaching(edges: DataFrame, targets: DataFrame, depth: int = 3) -> DataFrame:
    """Nodes with a path of 1 to depth edges to a target(node), in either direction; from the targets outwards, so the work is their reach and not all nodes'."""
    both = undirected(edges).select(F.col("src").alias("near"), F.col("dst").alias("far"))
    frontier = targets.select("node").distinct()
    out = None
    for _ in range(depth):
        frontier = frontier.join(both, F.col("node") == F.col("near")).select(F.col("far").alias("node")).distinct()
        out = frontier if out is None else out.unionByName(frontier).distinct()
    return out


def kind_of(wanted: DataFrame, tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """wanted(id), tables of ids with their kind's name: the first kind in the list's order that has the id, missing where none has."""
    known = None
    for place, (kind, ids) in enumerate(tables):
        part = ids.select(F.col(ids.columns[0]).alias("id")).distinct().select("id", F.lit(place).alias("place"), F.lit(kind).alias("kind"))
        known = part if known is None else known.unionByName(part)
    first = known.groupBy("id").agg(F.min_by("kind", "place").alias("kind"))
    return wanted.join(first, "id", "left")


def shown_nodes(nodes: DataFrame, labels: list[str], hidden: tuple[str, ...] = ("embedding",)) -> DataFrame:
    """nodes(id, props): props without missing, empty and hidden ones, and label: the first of the labels that is there, else the id."""
    props = F.map_filter("props", lambda k, v: v.isNotNull() & (v != "") & ~k.isin(*hidden))
    return nodes.withColumn("props", props).withColumn("label", F.coalesce(*(F.col("props")[x] for x in labels), F.col("id").cast("string")))


def roles(people: DataFrame, held: DataFrame, include_former: bool = False) -> DataFrame:
    """people(person, name), held(person, company, role, current, start): current roles, or all with the former ones behind, newest first; place is the role's rank in the company."""
    rows = held if include_former else held.filter("current")
    order = Window.partitionBy("company").orderBy(F.desc("current"), F.desc_nulls_last("start"), "person", "role")
    return rows.join(people, "person").withColumn("place", F.row_number().over(order)).select("company", "person", "name", "role", "current", "start", "place")


def linked_refs(items: DataFrame, links: DataFrame) -> DataFrame:
    """items(id, refs), links(id, kind, ref): per item its linked refs by kind, and the refs that nothing links to."""
    found = links.groupBy("id", "kind").agg(F.array_sort(F.collect_set("ref")).alias("refs")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("kind", "refs"))).alias("linked"), F.flatten(F.collect_list("refs")).alias("_all"))
    return items.join(found, "id", "left").withColumn("unresolved", F.array_sort(F.array_except(F.coalesce("refs", F.array().cast("array<string>")), F.coalesce("_all", F.array().cast("array<string>"))))).drop("_all")
