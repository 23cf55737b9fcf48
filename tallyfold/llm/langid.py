"""Language ID by compression: a text is in the language whose dictionary compresses it best.

Each language has a raw-content zstandard dictionary of training texts. The letters of a whole text are compressed, in blocks of ``BLOCK`` bytes, once
per language; the language with the smallest total wins (ties: the one with more training rows, then the smaller name). The score is the margin to
the second, (second - best) / second, from 0 to 1; ``reject`` tells texts whose margin is too narrow to decide.

Training reads a bounded sample of whole labelled rows, chosen by hash: about ``SAMPLE_DOCS`` of each language, fewer (``LEAST_DOCS`` at least) where over ``SAMPLE_ROWS /
SAMPLE_DOCS`` languages are learned. A text gives at most a fifth of a dictionary, a longer one by blocks spread evenly over the whole of it, so texts of any length
teach. A dictionary holds ``DICTIONARY_BYTES``, less where all of them would hold over ``ALL_BYTES``. Every language with a row that has a letter is learned, and the counts
that order them cover all labelled rows. More than ``MOST_LANGUAGES`` distinct labels are no languages and raise ValueError.

Defined cases: a null text or one without a letter is ``und`` with score 0; with one language only, it is given with score 0, and ``least_margin`` lets it
pass; with no training rows all is ``und``; repeated rows are each predicted; other columns pass through, and an output column that the input has already raises ValueError.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import materialise, slices

SAMPLE_DOCS = 150
LEAST_DOCS = 5
SAMPLE_ROWS = 6_000
DICTIONARY_BYTES = 100_000
ALL_BYTES = 64 << 20
MOST_LANGUAGES = 10_000
BLOCK = 4096
#: Levels below 6 miss short matches, which costs 6 % of the short texts.
LEVEL = 6
#: Narrower margins are rejected.
MARGIN = 0.002
UNKNOWN = "und"


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text's letters in lower case, words apart by single spaces: case, digits and signs tell no language."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8")


def excerpt(raw: bytes, room: int) -> bytes:
    """raw, or where it is longer than room, blocks spread evenly over the whole of it that fill the room."""
    if len(raw) <= room:
        return raw
    block = min(BLOCK, room)
    blocks = max(1, room // block)
    at = [i * (len(raw) - block) // max(1, blocks - 1) for i in range(blocks)]
    return b" ".join(raw[i : i + block] for i in at)[:room]


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """The dictionary of each language, most frequent language first; rows without text, letters or language teach nothing. Every language with a row that has a letter is learned: from its distinct
    texts with the smallest hashes, SAMPLE_DOCS of them at most (fewer where there are many languages), whatever ids, repeats and nulls the rows have."""
    labelled = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").withColumn("h", F.xxhash64("text"))
    texts = materialise(labelled.groupBy("lang", "h").agg(F.count("*").alias("n")), "labelled")
    counts = texts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if not counts:
        return {}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} distinct values of {lang}")
    docs, size = max(LEAST_DOCS, min(SAMPLE_DOCS, SAMPLE_ROWS // len(counts))), min(DICTIONARY_BYTES, ALL_BYTES // len(counts))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = materialise(texts.withColumn("place", place).filter(F.col("place") <= docs).select("lang", "h"), "chosen")
    # At most SAMPLE_ROWS rows of a label and a number, or LEAST_DOCS for each label.
    drawn = labelled.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw = [excerpt(letters(t) + b" ", size // 5) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(raw, pa.binary())], ["lang", "h", "raw"])

    sample = drawn.mapInArrow(run, "lang string, h long, raw binary").orderBy("h", "raw").collect()
    out = {r["lang"]: b"" for r in counts}
    for r in sample:
        if len(out[r["lang"]]) + len(r["raw"]) <= size:
            out[r["lang"]] += bytes(r["raw"])
    return {k: v for k, v in out.items() if v}


@functools.lru_cache(maxsize=2)
def _compressors(model: tuple[tuple[str, bytes], ...]):
    import zstandard

    out = []
    for name, raw in model:
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        out.append((name, zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)))
    return out


def classify(text: str | None, compressors) -> tuple[str, float]:
    if not text or not compressors or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    raw = letters(text)
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in compressors]
    best, second = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))[:2] if len(sizes) > 1 else (0, 0)
    return compressors[best][0], (sizes[second] - sizes[best]) / sizes[second]


def identify(df: DataFrame, model: dict[str, bytes], text: str = "text") -> DataFrame:
    """Adds lang_pred and score to every row."""
    if clash := {"lang_pred", "score"} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has {sorted(clash)}")
    items = tuple(model.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(items)
        for batch in slices(batches, text):
            got = [classify(t, compressors) for t in batch.column(text).to_pylist()]
            added = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "lang_pred", "score"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def least_margin(model: dict[str, bytes]) -> float:
    """The margin that texts must have: with one language there is no second to be ahead of, so only ``und`` goes."""
    return MARGIN if len(model) > 1 else 0.0


def reject(score: str = "score", lang_pred: str = "lang_pred", margin: float = MARGIN) -> F.Column:
    """True for texts whose language can't be told."""
    return (F.col(lang_pred) == UNKNOWN) | (F.col(score) < margin)
