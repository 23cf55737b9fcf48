"""Cleaning and packing a corpus: language ID, line dedup, SimHash near-dedup, best-fit packing.

Defined cases: a null text, an empty one and one without a letter have no language and go in the first stage; very long texts are read whole by every stage; of texts with a tie
between languages the one with more labelled rows is taken, if the margin lets it stay; repeated rows are no copies of each other for line dedup, but exactly one of them stays in
near-dedup; null doc_ids are kept, and give way to any known doc_id of their group; an empty table passes as empty; columns beyond those of documents, whatever their names, are
carried along up to packing, and n_chars follows the text where it is there.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import langid, line_dedup, packing, simhash
from tallyfold.llm.common import materialise
from tallyfold.llm.queries import WORD_BPE, tokenizer_file


OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _beside(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with all other columns under names that can't clash with its own, and back."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in OWN else f"extra{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).toDF(*docs.columns)

    return run_stage


@_beside
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID learns from all labelled documents; texts whose language can't be told go. Columns stay as they are."""
    model = langid.train(docs)
    return langid.identify(docs, model).filter(~langid.reject(margin=langid.least_margin(model))).select(*docs.columns)


@_beside
def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more go; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


@_beside
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (shingles of five words, each counted once; SimHash within two bits or Jaccard 0.8 and more) exactly one row stays, one with the smallest doc_id."""
    return simhash.one_of_each(docs, size=5)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in as few sequences as best-fit finds."""
    return packing.pack(docs, tokenizer_file(WORD_BPE), split="words")


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", cut_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("best-fit packing", pack_sequences),
]

#: SQL has no zstandard, tokenizer or SimHash; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each one's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
