"""Null, equal and crowded keys: what reaches the driver, one task or the shuffle stays bounded."""

import random

from pyspark.sql import functions as F

from tallyfold.llm import blocks, langid, minhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_languages_are_learned_whatever_the_ids(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 20)
    words = {"en": "the cat and a dog in this house".split(), "fr": "le chat et un chien dans la maison".split()}
    rng = random.Random(1)
    text = lambda lang: " ".join(rng.choices(words[lang], k=12))
    for key in (None, 7):
        rows = [(key, text("en" if i % 2 else "fr"), "en" if i % 2 else "fr", "s", 0) for i in range(3_000)] + [(key, "ein einziger Satz", "de", "s", 0)] + [(key, "the same text", "en", "s", 0)] * 2_000
        model = langid.train(spark.createDataFrame(rows, DOCS))
        assert list(model) == ["en", "fr", "de"] and all(0 < len(v) <= 20 * 80 for v in model.values())
    many = [(7, f"wort{i} {i}", f"l{i:04d}", "s", 0) for i in range(800) for _ in range(3)]
    assert len(langid.train(spark.createDataFrame(many, DOCS))) == 800


def test_fingerprints_of_crowded_ids(spark):
    """A null and a repeated doc_id with most rows are dealt to many buckets, and the order stays right."""
    rng = random.Random(2)
    rows = [(None, f"null {rng.random()}") for _ in range(700)] + [(5, f"five {rng.random()} x") for _ in range(500)] + [(i, f"own {i}") for i in range(60)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    buckets = 16
    dealt = minhash.in_order(df, buckets)
    sizes = [r["n"] for r in dealt.groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 4 * len(rows) / buckets
    own = dealt.filter("borrowed = 0").select("bucket", "doc_id", "h", "text").collect()
    assert len(own) == len(rows)
    order = sorted(own, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    assert [r["bucket"] for r in order] == sorted(r["bucket"] for r in order)
    got = sorted((r["doc_id"] is None, -(r["doc_id"] or 0), r["n_chars"], r["edited"]) for r in minhash.fingerprint_with_edits(df, buckets).collect())
    texts = [r["text"] for r in order]
    want = sorted((r["doc_id"] is None, -(r["doc_id"] or 0), len(r["text"]), minhash.edited(t, n)) for r, t, n in zip(order, texts, [*texts[1:], texts[0]], strict=True))
    assert got == want


def test_a_hot_band_is_dealt_anew_not_squared(spark, monkeypatch):
    """Sets that share one band and nothing else part; near ones stay together; the rows that are compared grow with the rows."""
    monkeypatch.setattr(blocks, "ROWS", 8)
    monkeypatch.setattr(blocks, "HOT", 32)
    compared = {}
    for n in (200, 400):
        rows = [(i, [77, 1_000 + i, 2_000 + i // 2, 3_000 + i]) for i in range(n)]
        df = spark.createDataFrame(rows, "key long, bands array<long>")
        dealt = blocks.refined(df.select("key", F.explode("bands").alias("band")), df, "key")
        pairs = dealt.alias("x").join(dealt.alias("y"), "band").filter("x.key < y.key").select("x.key", F.col("y.key").alias("other")).distinct().collect()
        assert {(r["key"], r["other"]) for r in pairs} == {(i, i + 1) for i in range(0, n, 2)}
        compared[n] = dealt.count()
    assert compared[400] <= 2.1 * compared[200]
    # What agrees on every band can't be parted and stays whole.
    same = spark.createDataFrame([(i, [1, 2, 3, 4]) for i in range(50)], "key long, bands array<long>")
    whole = blocks.refined(same.select("key", F.explode("bands").alias("band")), same, "key")
    assert {r["n"] for r in whole.groupBy("band").agg(F.count_distinct("key").alias("n")).collect()} == {50}


def test_archive_buckets_go_by_bytes(spark, tmp_path, monkeypatch):
    from tallyfold.llm import warc

    monkeypatch.setattr(warc, "BUCKET_BYTES", 1_000)
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"{i:03d}" * 40) for i in range(200)], "page_id long, url string, html string")
    out = str(tmp_path / "a")
    warc.write_archive(pages, out)
    assert spark.read.parquet(f"{out}/layout").first()["buckets"] == 24  # 24,000 bytes
    assert warc.read_payloads(spark, out).count() == 200 and warc.read_index(spark, out).filter("record_type = 'response'").count() == 200
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" not in plan(warc.reconstruct(spark, out, with_payload_of_revisits=True)) and "ShuffledHashJoin" in plan(warc.reconstruct(spark, out))
    monkeypatch.setattr(warc, "BUCKET_ROWS", 5)
    warc.write_archive(pages, str(tmp_path / "b"))
    assert spark.read.parquet(f"{tmp_path}/b/layout").first()["buckets"] == 40  # 200 records


def test_a_hot_band_loses_no_likeness(spark, monkeypatch):
    """Texts whose only common band is one that all texts have still link, in likeness_links and in near_pairs' buckets."""
    from tallyfold.llm import simhash

    monkeypatch.setattr(blocks, "ROWS", 8)
    monkeypatch.setattr(blocks, "HOT", 16)
    rng = random.Random(5)
    texts = []
    for i in range(40):
        words = [f"w{rng.random()}" for _ in range(60)]
        texts += [" ".join(words), " ".join([*words[:-4], "x", "y", "z", f"end{i}"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(simhash.shingle_hashes(t, 5, False).tolist()) for t in texts]
    want = {(i, j) for i in range(len(sets)) for j in range(i) if 10 * len(sets[i] & sets[j]) >= simhash.LIKE * len(sets[i] | sets[j])}
    assert len(want) == 40
    prints = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("doc_id").alias("fp"), F.lit(56).cast("long").alias("shingles"), F.array(F.lit(7).cast("long")).alias("bands"))
    none = spark.createDataFrame([], "a long, b long")
    found = {(max(r), min(r)) for r in simhash.likeness_links(docs, prints, none, 5).collect()}
    assert found == want
    listed = spark.createDataFrame([(i, [x - (1 << 64) if x >> 63 else x for x in sorted(s)]) for i, s in enumerate(sets)], "key long, set array<long>")
    dealt = blocks.parted(listed.select("key", F.lit(7).cast("long").alias("band")), listed, "key", "set", 8)
    met = {(r["x"], r["y"]) for r in dealt.alias("x").join(dealt.alias("y"), "band").filter("x.key > y.key").select(F.col("x.key").alias("x"), F.col("y.key").alias("y")).collect()}
    assert want <= met and len(met) < len(sets) ** 2 / 8


def test_a_bucket_is_compared_once(spark, monkeypatch):
    """Pairs that the first text of a bucket has met, and buckets of the same texts, aren't compared again; texts that no bucket wants aren't shuffled."""
    from tallyfold.llm import simhash

    blocks_of, plans = [], []
    real, sets_of = simhash.compare_in_blocks, simhash.shingle_sets
    monkeypatch.setattr(simhash, "compare_in_blocks", lambda rows, *a: blocks_of.append(rows.count()) or real(rows, *a))
    monkeypatch.setattr(simhash, "shingle_sets", lambda *a: (got := sets_of(*a), plans.append(got._jdf.queryExecution().toString()))[0])
    rng = random.Random(6)
    words = [[f"w{rng.random()}" for _ in range(60)] for _ in range(3)]
    # A pair of little likeness in two bands; three texts in three bands, of which any two may be the alike ones.
    texts = [" ".join(w) for w in words[:2]] + [" ".join(words[2]), " ".join([*words[2][:-4], "x", "y", "z", "end"]), "other " + " ".join(words[0][::-1])]
    bands = [[1, 2], [1, 2], [3, 4, 5], [3, 4, 5], [3, 4, 5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    placed = spark.createDataFrame(list(enumerate(bands)), "doc_id long, bands array<long>")
    prints = docs.join(placed, "doc_id").select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("doc_id").alias("fp"), F.lit(56).cast("long").alias("shingles"), "bands")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {(max(r), min(r)) for r in simhash.likeness_links(docs, prints, spark.createDataFrame([], "a long, b long"), 5).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {(3, 2)} and blocks_of[0] in (0, 2) and "might_contain" in plans[0]
