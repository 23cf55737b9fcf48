"""Line dedup: later copies of repeated line runs are deleted. DataFrame operations only.

A document is a sequence of line IDs (two XXH64 of its lines with different seeds, 128 bits; lines without words take no part). A run counts as repeated if it has
``min_words`` words or more and occurs earlier: in a document before it (by doc_id, then by the text's hash) or further up in the same one. The
first occurrence stays, every line of a later one is deleted.

1. Lines that occur once in the corpus end every run; a count by line ID leaves the repeated ones, cut into segments of neighbours. The IDs of repeated lines are sorted, and their
   places in that order are the ranks of one line.
2. Prefix doubling: the rank of the 2k lines from a place on is the place of (rank of the k lines from here, rank of the k lines behind them) among all such pairs that occur
   twice or more, sorted over range partitions. So ranks are exact, not hashes: two places have equal ranks where their 2k lines are equal, and ranks are in the order of those lines.
   Places whose lines are unique leave the array, which shrinks from round to round.
3. The suffix array is the places in the order of their ranks. Places with a longest common prefix of m lines or more are an interval of it, and have the same m lines: those
   with equal ranks of their first and of their last 2**k <= m lines. As every line has a word, a prefix of ``min_words`` words has at most that many lines, so
   log2(min_words) doublings do. Looked at are, from every line, the shortest run of min_words words that starts there and the shortest that ends there; every
   maximal repeated run is covered by such runs within it, so all later copies of maximal runs are found, whole, with two runs a line.
4. An interval's first place is its minimum (aggregated with partial sums); the run at each later place is deleted.

Defined cases: a null text stays null and an empty one empty; a text left without words becomes ''; identical rows (same doc_id and text) are one document given
twice: they are treated alike and are no copies of each other; a null doc_id comes before all others; tables may be empty; other columns pass through.
Columns named ``_tf_*`` in the input raise ValueError.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import materialise

MIN_WORDS = 50
_SPACED = r"trim(translate(x, '\t\r\u000b\u000c', '    '))"


def _lines(rows: DataFrame) -> DataFrame:
    """One row per line with words: row, doc_id, key, idx (from 0 among such lines), line and twin (its ID), words."""
    parts = F.expr(f"filter(transform(split(text, '\n', -1), x -> named_struct('x', x, 't', {_SPACED})), s -> s.t <> '')")
    exploded = rows.select("row", "doc_id", "key", F.posexplode(parts).alias("idx", "s")).select("row", "doc_id", "key", "idx", "s.x", "s.t")
    # Words: blanks and one, or where blanks stand together, the parts that aren't empty.
    words = F.expr("IF(instr(t, '  ') = 0, length(t) - length(replace(t, ' ', '')) + 1, size(filter(split(t, ' '), w -> w <> '')))")
    return exploded.select("row", "doc_id", "key", "idx", F.expr("xxhash64(x)").alias("line"), F.expr("xxhash64('twin', x)").alias("twin"), words.alias("words"))


def _places(keys: DataFrame, columns: list[str], name: str, rank: str) -> DataFrame:
    """The distinct rows of keys that occur twice or more, with their rank in sorted order: range partitions, each sorted, numbered upwards."""
    twice = keys.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").select(*columns)
    return materialise(twice.repartitionByRange(*columns).sortWithinPartitions(*columns).select(*columns, F.monotonically_increasing_id().alias(rank)), name)


def _ranks(segments: DataFrame, levels: int) -> DataFrame:
    """Adds r1..r<levels>: rank of the 2**k lines from each line on, null where the segment ends before or the lines are unique."""
    within = Window.partitionBy("row", "segment").orderBy("idx")
    out = segments
    for k in range(levels):
        paired = out.withColumn("behind", F.max(f"r{k}").over(within.rangeBetween(2**k, 2**k)))
        held = paired.filter(F.col(f"r{k}").isNotNull() & F.col("behind").isNotNull()).select(F.col(f"r{k}").alias("a"), F.col("behind").alias("b"))
        places = _places(held, ["a", "b"], "pairs", f"r{k + 1}")
        joined = paired.join(places, (F.col(f"r{k}") == F.col("a")) & (F.col("behind") == F.col("b")), "left").drop("a", "b", "behind")
        out = materialise(joined, "ranks")
    return out


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The later copies: doc_id, key (XXH64 of doc_id and text), first, last (numbers of lines with words, from 0)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    # row keeps identical rows apart while their lines are in one window; no result depends on its value.
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    lines = _lines(rows)
    # For the count the lines need neither places nor word counts.
    plain = rows.select(F.explode(F.split("text", "\n", -1)).alias("x")).filter(F.expr(f"{_SPACED} <> ''")).select(F.expr("xxhash64(x)").alias("line"), F.expr("xxhash64('twin', x)").alias("twin"))
    repeated = materialise(lines.join(_places(plain, ["line", "twin"], "lines", "r0"), ["line", "twin"]).select("row", "doc_id", "key", "idx", "words", "r0"), "repeated")

    by_row = Window.partitionBy("row").orderBy("idx")
    segments = repeated.withColumn("segment", F.col("idx") - F.row_number().over(by_row))
    levels = max(0, min_words.bit_length() - 1)
    within = Window.partitionBy("row", "segment").orderBy("idx")
    so_far = F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ranked = _ranks(segments, levels).withColumn("upto", so_far).withColumn("before", F.col("upto") - F.col("words"))
    ahead = F.collect_list("upto").over(within.rowsBetween(0, min_words - 1))
    back = F.collect_list("before").over(within.rowsBetween(-(min_words - 1), 0))
    ranked = ranked.withColumns({"ahead": ahead, "back": back})
    ranked = ranked.withColumns({
        "to_end": F.expr(f"size(filter(ahead, x -> x < before + {min_words})) + 1"),
        "from_start": F.expr(f"size(back) - size(filter(back, x -> x <= upto - {min_words})) + 1"),
        "reach": F.size("ahead"),
        "room": F.size("back"),
        "ranks": F.array(*(f"r{k}" for k in range(levels + 1))),
    }).drop("ahead", "back", *(f"r{k}" for k in range(levels + 1)))
    ranked = materialise(ranked.select("row", "doc_id", "key", "idx", "to_end", "from_start", "reach", "room", "ranks"), "ranks")
    # A run of m lines is known by m and the ranks of its first and its last 2**k lines, 2**k <= m.
    runs = ranked.select("row", "doc_id", "key", F.explode(F.array_distinct(F.expr("""array_compact(array(
        CASE WHEN to_end <= reach THEN struct(idx AS first, idx + to_end - 1 AS last) END,
        CASE WHEN from_start <= room THEN struct(idx - from_start + 1 AS first, idx AS last) END))"""))).alias("run"))
    runs = runs.select("row", "doc_id", "key", "run.first", "run.last").distinct()
    runs = runs.withColumn("level", F.length(F.bin(F.col("last") - F.col("first") + 1)) - 1)
    runs = runs.withColumn("tail", F.expr("last - cast(power(2, level) as int) + 1"))
    heads = ranked.select("row", F.col("idx").alias("first"), F.col("ranks").alias("head_ranks"))
    tails = ranked.select("row", F.col("idx").alias("tail"), F.col("ranks").alias("tail_ranks"))
    named = runs.join(heads, ["row", "first"]).join(tails, ["row", "tail"]).select(
        "doc_id", "key", "first", "last", F.expr("head_ranks[level]").alias("head"), F.expr("tail_ranks[level]").alias("end"), (F.col("last") - F.col("first")).alias("more"),
    ).filter("head IS NOT NULL AND end IS NOT NULL")
    named = materialise(named, "runs")
    place = F.struct("doc_id", "key", "first")
    intervals = named.groupBy("head", "end", "more").agg(F.count("*").alias("n"), F.min(place).alias("original")).filter("n > 1").select("head", "end", "more", "original")
    return named.join(materialise(intervals, "intervals"), ["head", "end", "more"]).filter(place > F.col("original")).select("doc_id", "key", "first", "last")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", doc_id: str = "doc_id", removed: str | None = None) -> DataFrame:
    """docs with the lines of later copies cut out of the text; removed: name of a column for their number, if wanted."""
    if clash := [c for c in docs.columns if c.lower().startswith("_tf_") or removed and c.lower() == removed.lower()]:
        raise ValueError(f"columns {clash} clash with those made here")
    runs = repeated_runs(docs, min_words, text, doc_id)
    gone = runs.select("doc_id", "key", F.explode(F.sequence("first", "last")).alias("idx")).groupBy("doc_id", "key").agg(F.collect_set("idx").alias("_tf_gone"))
    gone = gone.select(F.col("doc_id").alias("_tf_id"), F.col("key").alias("_tf_other"), "_tf_gone")
    keyed = docs.withColumn("_tf_key", F.xxhash64(F.col(doc_id), F.col(text)))
    joined = keyed.join(gone, (F.col("_tf_key") == F.col("_tf_other")) & F.col(doc_id).eqNullSafe(F.col("_tf_id")), "left")
    worded = f"filter(transform(_tf_lines, (x, i) -> IF({_SPACED} <> '', i, -1)), i -> i >= 0)"
    kept = "array_except(sequence(0, size(_tf_lines) - 1), transform(_tf_gone, i -> _tf_worded[i]))"
    cut = f"array_join(transform({kept}, i -> _tf_lines[i]), '\n')"
    cut = f"IF(size(_tf_gone) >= size(_tf_worded), '', {cut})"
    # Only rows with something to cut are split again.
    out = joined.withColumn("_tf_lines", F.when(F.col("_tf_gone").isNotNull(), F.split(F.col(text), "\n", -1)))
    out = out.withColumn("_tf_worded", F.when(F.col("_tf_gone").isNotNull(), F.expr(worded)))
    number = F.when(F.col("_tf_gone").isNull(), F.lit(0)).otherwise(F.size("_tf_gone"))
    out = out.withColumn("_tf_text", F.when(F.col("_tf_gone").isNull(), F.col(text)).otherwise(F.expr(cut)))
    columns = [F.col("_tf_text").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, *([number.alias(removed)] if removed else []))
