"""An inverted index over the words of several fields, written once, and ranked search that reads only the postings of its words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import scalars as S
from tallyfold.operators.search import _ranked, tokens

#: Parts that a word's hash decides on, and parts of a word's postings in writing. Both are for a corpus of some gigabytes; with 100 TB take some thousands of buckets.
BUCKETS, SPREAD = 16, 2


def bucket_of(term, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(docs: DataFrame, path: str, fields: list[str], key: str, attributes: tuple[str, ...] = (), buckets: int = BUCKETS, spread: int = SPREAD) -> None:
    """Under path: postings(term, key, attributes, and per field its frequency and number of words), partitioned by the bucket of the term and sorted by term in each file, and
    terms(term, documents), partitioned alike. A row of docs is one document; null and empty fields have no words; the attributes are for filters.

    The texts are dealt by their key, so a text's words are counted where they are cut and only the counts are shuffled; the postings of a frequent word are dealt to several files, so no task
    gets all of them.
    """
    dealt_texts = docs.select(F.col(key).alias("key"), *attributes, *(F.col(f).alias(f"_text{i}") for i, f in enumerate(fields))).repartition("key")
    # The words are cut below the explosion; beside it they would be cut from the text anew for every word.
    cut = dealt_texts.select("key", *attributes, *(F.coalesce(tokens(f"_text{i}"), F.array()).alias(f"_cut{i}") for i in range(len(fields))))
    tagged = lambda i: F.transform(f"_cut{i}", lambda w: F.struct(F.lit(i).alias("_field"), F.size(f"_cut{i}").alias("_words"), w.alias("term")))
    each = cut.select("key", *attributes, F.explode(F.concat(*map(tagged, range(len(fields))))).alias("_w")).select("key", *attributes, "_w.*")
    counts = [F.count_if(F.col("_field") == i).cast("int").alias(f"tf{i}") for i in range(len(fields))]
    sizes = [F.max(F.when(F.col("_field") == i, F.col("_words"))).alias(f"n{i}") for i in range(len(fields))]
    postings = each.groupBy("term", "key", *attributes).agg(*counts, *sizes).withColumn("bucket", bucket_of("term", buckets))
    dealt = postings.repartition(F.col("bucket"), F.pmod(F.xxhash64("key"), F.lit(spread))).sortWithinPartitions("bucket", "term", "key")
    dealt.write.partitionBy("bucket").parquet(f"{path}/postings")
    again = docs.sparkSession.read.parquet(f"{path}/postings")
    again.groupBy("bucket", "term").agg(F.count_distinct("key").alias("documents")).repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")
    docs.sparkSession.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{path}/made")


def postings_of(spark: SparkSession, path: str, words: list[str], part: str = "postings") -> DataFrame:
    """Rows of the words alone: their buckets are folders, so other folders aren't opened, and the terms are pushed down to the files."""
    number = spark.read.schema("buckets int").parquet(f"{path}/made").first()["buckets"]
    buckets = sorted({r[0] for r in spark.createDataFrame([(w,) for w in words], "term string").select(bucket_of("term", number)).collect()})
    return spark.read.parquet(f"{path}/{part}").filter(F.col("bucket").isin(buckets) & F.col("term").isin(words))


def find(spark: SparkSession, path: str, words: list[str], fields: int, weights: list[float] | None = None, where: F.Column | None = None, limit: int = 100) -> DataFrame:
    """(key, score, rank) of documents that hold every word in some one field. A field's score is the words' share of its words, times its weight; the best field counts. where: an optional
    condition on the attributes.

    The rarest word's postings come first and are what each further word's are joined with, so an answer is never larger than the shortest list.
    """
    words = sorted({w.lower() for w in words})
    known = {r["term"]: r["documents"] for r in postings_of(spark, path, words, "terms").collect()}  # a row for each word asked
    postings = postings_of(spark, path, words)
    if where is not None:
        postings = postings.filter(where)
    tf = [f"tf{i}" for i in range(fields)]
    found = None
    for word in sorted(words, key=lambda w: (known.get(w, 0), w)):
        own = postings.filter(F.col("term") == word).select("key", *(F.col(c).alias(f"_{c}") for c in tf), *(F.col(f"n{i}").alias(f"_n{i}") for i in range(fields)))
        if found is None:
            found = own.select("key", *(F.when(F.col(f"_{c}") > 0, F.col(f"_{c}")).alias(c) for c in tf), *(F.col(f"_n{i}").alias(f"n{i}") for i in range(fields)))
        else:
            # A field stays in the running only as long as it holds each word.
            both = [F.when(F.col(f"_{c}") > 0, F.col(c) + F.col(f"_{c}")).alias(c) for c in tf]
            found = found.join(own, "key").select("key", *both, *(F.coalesce(f"n{i}", f"_n{i}").alias(f"n{i}") for i in range(fields)))
        found = found.filter(F.coalesce(*tf).isNotNull())
    weights = weights or [1.0] * fields
    shares = [F.lit(float(w)) * F.col(f"tf{i}") / F.col(f"n{i}") for i, w in enumerate(weights)]
    score = F.greatest(*shares) if fields > 1 else shares[0]
    return _ranked(found.select("key", S.rounded(score, 8).alias("score")), "key", F.desc("score"), limit)
