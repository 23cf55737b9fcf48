"""Best-fit packing of token sequences by hierarchical residual packing.

Round 1 packs the pieces of each input partition best-fit, longest first, and emits the bins that are nearly full. The
underfull bins, with their members, are the items of the next round on a quarter of the partitions, and so on up a tree until few partitions are
left; the last round emits all. Each round is written to the shared folder, so a retried task never mixes two packings.

No task packs more than ``MOST_ITEMS`` pieces at once: a longer input partition is packed in runs of so many, and the tree stops narrowing there. Items too long to pair (every
bin over half full) still take part once per round, as hosts for shorter ones.

Defined cases: a null or empty text is the end id alone; repeated rows (also with equal doc_id) are packed each on its own; a
null doc_id is kept; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.chunk_tokens import chunk_tokens
from tallyfold.llm.common import batches, materialise

CAPACITY = 2048
#: A bin with no more room than this is full enough to be emitted at once.
SLACK = 4
FAN_IN = 4
MOST_ITEMS = 200_000

MEMBER = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint>"
BIN_SCHEMA = f"sequence_id long, filled int, members array<{MEMBER}>"
_MEMBER_TYPE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BIN_TYPES = pa.schema([("sequence_id", pa.int64()), ("filled", pa.int32()), ("members", pa.list_(_MEMBER_TYPE))])


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the items of each bin. Bins are kept by free room, so an item costs a bisection over at most ``capacity`` rooms."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # free rooms in use, ascending
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = bisect_left(rooms, sizes[i])
        if k < len(rooms):
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[k]
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - sizes[i]
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(b)
    return bins


def _bins(items: list[tuple[int, list]], capacity: int, first_id: int) -> Iterator[pa.RecordBatch]:
    """items: (size, members); a member is a tuple of the fields but the offset, which follows from its place in the bin."""
    packed = best_fit([size for size, _ in items], capacity)

    def placed(b: list[int]) -> list[tuple]:
        members, offset = [], 0
        for i in b:
            for m in items[i][1]:
                members.append((*m, offset))
                offset += m[3]
        return members

    for at in range(0, len(packed), 2000):
        some = packed[at : at + 2000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([first_id + at + k for k in range(len(some))], type=pa.int64()),
                pa.array([sum(items[i][0] for i in b) for b in some], type=pa.int32()),
                pa.array([[dict(zip(_MEMBER_TYPE.names, m, strict=True)) for m in placed(b)] for b in some], type=_BIN_TYPES.field("members").type),
            ],
            schema=_BIN_TYPES,
        )


def _first_id(round_no: int) -> int:
    """Sequence numbers of a round and partition start here; a partition has under 2**32 bins."""
    from pyspark import TaskContext

    return (round_no << 54) | (TaskContext.get().partitionId() << 32)


def pack(docs: DataFrame, tokenizer: str, split: str = "whole", end_id: int = 0, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only documents over capacity are cut."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, items, at_bin = chunk_tokens(tokenizer, split), [], _first_id(0)
        for batch in parts:
            if len(items) >= MOST_ITEMS:
                yield from _bins(items, capacity, at_bin)
                items, at_bin = [], at_bin + len(items)
            flat, lengths = tokens.flat_ids(batch.column("text").to_pylist(), end_id)
            raw, done = memoryview(flat).cast("B"), 0
            for key, length in zip(batch.column("doc_id").to_pylist(), lengths.tolist(), strict=True):
                for piece, at in enumerate(range(0, length, capacity)):
                    size = min(capacity, length - at)
                    items.append((size, [(key, piece, at, size, zlib.crc32(raw[4 * (done + at) : 4 * (done + at + size)]))]))
                done += length
        yield from _bins(items, capacity, at_bin)

    def later(round_no: int):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = [(r["filled"], [tuple(m[n] for n in _MEMBER_TYPE.names[:-1]) for m in r["members"]]) for batch in parts for r in batch.to_pylist()]
            yield from _bins(items, capacity, _first_id(round_no))

        return run

    with batches(spark):
        packed = materialise(rows.mapInArrow(first, BIN_SCHEMA), "pack-0")
    full = F.col("filled") >= capacity - SLACK
    done, left, round_no = [packed.filter(full)], packed.filter(~full), 0
    parts = max(1, packed.rdd.getNumPartitions())
    while True:
        count, pieces = left.agg(F.count("*"), F.coalesce(F.sum(F.size("members")), F.lit(0))).first()
        if count <= 1:
            break
        parts = max(1, -(-pieces // MOST_ITEMS), -(-parts // FAN_IN))
        last = parts == max(1, -(-pieces // MOST_ITEMS))
        round_no += 1
        packed = materialise(left.repartition(parts).mapInArrow(later(round_no), BIN_SCHEMA), f"pack-{round_no}")
        if last:
            left = packed
            break
        done.append(packed.filter(full))
        left = packed.filter(~full)
    bins = left
    for d in done:
        bins = bins.unionByName(d)
    placed = bins.select("sequence_id", F.inline("members"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
