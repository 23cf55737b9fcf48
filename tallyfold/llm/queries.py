"""The operators as queries over whole tables, with their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import align, ann, bpe, langid, lexical, line_dedup, minhash, ngram_join, packing, simhash, url_filter, warc, wavelet
from tallyfold.llm.common import batches, materialise, scratch_path, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A query's rows (ids, counts and digests), made while the batches to Python workers are bounded."""
    with batches(df.sparkSession):
        return materialise(df, name)


WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), removed="lines_removed")


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~_held_out() & F.col("doc_id").isNotNull()))
    got = langid.identify(docs.select("doc_id", "text"), model)
    return _kept(got.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score"), "languages")


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file(WORD_BPE)
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text"), path)
    digests = done.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    return _kept(digests, "tokens")


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    wavelet.write_shards(table(spark, sf_dir, "documents"), out, tokenizer_file(BYTE_BPE), split="leading_space")
    return _kept(wavelet.read_checksums(spark, out), "checksums")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE), split="words")


def ann_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), out)
    return warc.read_index(spark, out)


def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = minhash.fingerprint_with_edits(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        minhash.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        minhash.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


def lexical_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with batches(spark):
        return materialise(align.align(docs, tokenizer_file(BYTE_BPE), tokenizer_file(PIECES)), "alignments")


def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": line_dedup_query,
    "op2_url_filters": url_filter_query,
    "op3_language_id": language_id_query,
    "op4_bpe": bpe_query,
    "op5_simhash": simhash_query,
    "op6_token_files": token_files_query,
    "op7_packing": packing_query,
    "op8_ann": ann_query,
    "op9_warc": warc_query,
    "op10_minhash": fingerprint_query,
    "op11_lexical_search": lexical_query,
    "op12_alignment": alignment_query,
    "op13_ngram_join": ngram_join_query,
}

ORACLE_SQL = {
    "op2_url_filters": r"""
        WITH parts AS (
            SELECT page_id,
                CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        split AS (
            SELECT page_id,
                translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts),
        rules(rule_host, rule_path, action) AS (VALUES
            ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
            ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
        judged AS (
            SELECT page_id, host, path,
                (SELECT max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, action := action))
                 FROM rules
                 WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS won
            FROM split)
        SELECT page_id, host, path, won.rule AS rule, coalesce(won.action, 'allow') AS verdict FROM judged""",
    "op9_warc": r"""
        WITH digests AS (
            SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS content, sha1(coalesce(html, '')) AS hex FROM pages),
        digits AS (
            SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (five >> (5 * (3 - k)) & 31)::INT + 1, 1), '' ORDER BY g, k) AS payload_digest
            FROM (SELECT hex, g, ('0x' || substr(hex, 5 * g::INT + 1, 5))::BIGINT AS five FROM (SELECT DISTINCT hex FROM digests), range(8) AS r(g)), range(4) AS q(k)
            GROUP BY hex),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY content ORDER BY page_id NULLS LAST, coalesce(url, '')) AS place, first_value(page_id) OVER (PARTITION BY content ORDER BY page_id NULLS LAST, coalesce(url, '')) AS first
            FROM digests)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first END AS refers_to
        FROM placed JOIN digits USING (hex)""",
    "op11_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
        whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM sizes),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, whole WHERE term IN (SELECT term FROM asked) GROUP BY term),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * documents) // terms)))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id)
        SELECT item_id, rank::INT AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
}
