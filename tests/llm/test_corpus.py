"""The corpus operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import ann, bpe, chunk_tokens, langid, line_dedup, minhash, packing, queries, simhash, url_filter, warc, wavelet
from tallyfold.llm.chunk_tokens import ChunkTokens
from tallyfold.llm.common import scratch_path
from tallyfold.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def docs(spark, texts, first=1):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file(name))


ODD = [None, "", " ", "Hello  World's don't 123", "a\nb\n\nc", "<|endoftext|> x <|startoftext|>", "ΑΣ İ ß É", LONG, "x" * 3000, "same text", "same text", "tab\there\r\n end "]


# op1 ---------------------------------------------------------------------------------------------------------------

def brute_lines(rows, min_words):
    """Lines (numbers among lines with words) of each document that lie in a run of min_words words or more which occurs earlier."""
    lines = {k: [x for x in t.split("\n") if x.split()] for k, t in rows}
    gone = {k: set() for k in lines}
    places = [(k, i) for k in sorted(lines) for i in range(len(lines[k]))]
    for a, (k, i) in enumerate(places):
        for q, j in places[:a]:
            n = 0
            while i + n < len(lines[k]) and j + n < len(lines[q]) and lines[k][i + n] == lines[q][j + n]:
                n += 1
            if sum(len(x.split()) for x in lines[k][i : i + n]) >= min_words:
                gone[k] |= set(range(i, i + n))
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_like_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(6)]
    texts = ["\n".join(rng.choice(pool + ["", f"own {i} {rng.random()}"]) for _ in range(rng.randint(1, 14))) for i in range(14)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(spark, texts), min_words=6, removed="gone").collect()}
    want = brute_lines([(i + 1, t) for i, t in enumerate(texts)], 6)
    for k, t in enumerate(texts, 1):
        kept, n = [], 0
        for line in t.split("\n"):
            if line.split():
                n += 1
                if n - 1 in want[k]:
                    continue
            kept.append(line)
        expected = "\n".join(kept) if any(x.split() for x in kept) or not want[k] else ""
        assert (got[k]["text"], got[k]["gone"]) == (expected, len(want[k]))


def test_line_dedup_cases(spark):
    passage = "\n".join(" ".join(f"w{i}{j}" for j in range(13)) for i in range(5))
    df = docs(spark, [None, "", passage, "intro\n" + passage + "\nend", passage, "one line"])
    same = df.filter("doc_id = 3").union(df.filter("doc_id = 3"))  # one document given twice is no copy of itself
    got = line_dedup.dedup_lines(df.union(df.filter("doc_id = 4"))).orderBy("doc_id").select("doc_id", "text").collect()
    assert [tuple(r) for r in got] == [(1, None), (2, ""), (3, passage), (4, "intro\nend"), (4, "intro\nend"), (5, ""), (6, "one line")]
    assert [r["text"] for r in line_dedup.dedup_lines(same).collect()] == [passage, passage]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(df.withColumn("_tf_key", F.lit(1)))
    nulls = df.withColumn("doc_id", F.lit(None).cast("long")).filter("text IS NOT NULL")
    assert line_dedup.dedup_lines(nulls).count() == 5


def test_line_dedup_is_native(spark, sf):
    plan = queries.line_dedup_query(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# op2 ---------------------------------------------------------------------------------------------------------------

def test_url_filter_cases(spark):
    urls = [None, "no scheme", "http://", "HTTP://WWW.Example.COM/en/75?x#y", "https://example.com/en/8", "http://a.net/de/", "http://x.example.net/de/81", "http://org#/es/", "http://a.org/es/x", "http://com/en/", "http://notexample.com:80/fr", "http://example.com/en/7", "http://" + "a." * 400 + "com/en/" + "p" * 5000]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(3, urls[3], "clash")], "page_id long, url string, host string")
    got = url_filter.judge_urls(df, url_filter.rules_frame(spark, queries.URL_RULES)).collect()
    rule = {r["page_id"]: (r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(urls) + 1
    assert rule == {0: (None, "allow"), 1: (None, "allow"), 2: (None, "allow"), 3: ("example.com/en/7", "allow"), 4: ("com/en/", "block"), 5: ("net/de/", "allow"), 6: ("example.net/de/8", "block"), 7: (None, "allow"), 8: ("org/es/", "block"), 9: ("com/en/", "block"), 10: (None, "allow"), 11: ("example.com/en/7", "allow"), 12: ("com/en/", "block")}
    assert {r["page_id"]: r["host"] for r in got}[3] == "www.example.com"
    assert url_filter.judge_urls(df.limit(0), url_filter.rules_frame(spark, queries.URL_RULES)).count() == 0


def test_url_filter_is_native_and_joins_on_short_prefixes(spark, sf):
    plan = queries.url_filter_query(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    joins = re.findall(r"BroadcastHashJoin \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert joins and all("probe" in a and "prefix" in b and "digest" not in a + b for a, b in joins)


# op3 ---------------------------------------------------------------------------------------------------------------

def test_language_id(spark, sf):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.language_id_query(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_id_cases(spark):
    df = docs(spark, [None, "", "123 !?", "the cat", LONG])
    assert [r["lang_pred"] for r in langid.identify(df, {}).collect()] == ["und"] * 5
    got = langid.identify(df, {"en": b"the cat and the dog", "fr": b"le chat et le chien"}).collect()
    assert [r["lang_pred"] for r in got[:4]] == ["und", "und", "und", "en"]
    assert langid.identify(df.limit(0), {}).count() == 0 and langid.train(df.limit(0)) == {}
    with pytest.raises(ValueError):
        langid.identify(df.withColumn("score", F.lit(1)), {})


def test_one_language_keeps_its_documents(spark):
    import corpus_pipeline

    df = docs(spark, ["the cat and the dog", "a dog in the house", None, "12 !"])
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_known_languages(spark, df, "").collect()) == [1, 2]


def test_languages_with_long_texts_only_are_learned(spark):
    rng = random.Random(9)
    french = " ".join(rng.choice("le chat et le chien dans la maison avec une petite souris grise".split()) for _ in range(6_000))
    longest = " ".join(rng.choice("der hund und die katze in einem haus mit einer maus".split()) for _ in range(40_000))
    rows = [(1, "the cat and the dog in the house", "en", "s", 0), (2, french, "fr", "s", 0), (3, longest, "de", "s", 0)]
    model = langid.train(spark.createDataFrame(rows, DOCS))
    assert min(len(french), len(longest)) > langid.DICTIONARY_BYTES // 5 and sorted(model) == ["de", "en", "fr"]
    got = langid.identify(docs(spark, ["le chat et une souris grise avec le chien dans la maison et le chat", "die katze und der hund in einem haus mit einer maus und die katze", "the cat and the dog in the house"]), model).collect()
    assert [r["lang_pred"] for r in got] == ["fr", "de", "en"]


def test_excerpts_cover_a_whole_text():
    raw = bytes(range(250)) * 400
    got = langid.excerpt(raw, 20_000)
    assert len(got) <= 20_000 and got.startswith(raw[:4096]) and langid.excerpt(raw[:500], 500) == raw[:500]
    marked = b"a" * 50_000 + b"z" * 50_000
    assert set(langid.excerpt(marked, 20_000)) >= set(b"az") and len(langid.excerpt(marked, 10)) == 10


def test_every_language_is_learned(spark):
    """More languages than any sample per language would hold; a rare one has a single row."""
    names = [f"l{i:03d}" for i in range(230)]
    rows = [(i, " ".join(f"{n}{chr(97 + j)}" for j in range(9)), n, "s", 0) for i, n in enumerate(names * 3 + ["rare"])]
    model = langid.train(spark.createDataFrame(rows, DOCS))
    assert set(model) == {*names, "rare"}


def test_language_by_brute_force():
    """The smallest sum of compressed blocks over all dictionaries wins."""
    import zstandard

    model = {"en": b"the cat and the dog sat on the mat with a hat " * 20, "fr": b"le chat et le chien dans la maison avec une souris " * 20, "de": b"der hund und die katze in einem haus mit maus " * 20}
    texts = ["the dog and the cat", "Le chien ET la souris 12", "die Katze im Haus", "the " * 5000 + "chat " * 900, "xyz", "a"]
    for t in texts:
        raw = re.sub(r"[\W\d_]+", " ", t.lower()).encode()
        sizes = {}
        for k, v in model.items():
            d = zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[k] = sum(len(c.compress(raw[i : i + langid.BLOCK])) for i in range(0, len(raw), langid.BLOCK))
        first, second = sorted(sizes.values())[:2]
        got = langid.classify(t, langid._compressors(tuple(model.items())))
        assert got == (min(sizes, key=lambda k: (sizes[k], list(model).index(k))), (second - first) / second)


# op4, op6, op7 -----------------------------------------------------------------------------------------------------

def test_encoders_match_the_library():
    rng = random.Random(1)
    alphabet = ["a", "b", "Foo", " ", "  ", "\n", "\n\n", "\t", ".", ",", "<|endoftext|>", "<|startoftext|>", "<|", "É", "é", "Σ", "ß", "İ", "1", "23", "'s", "'LL", "\xa0", "\u3000", "漢字", "😀", "don't", "\x1c", "!?", "\r\n", "word"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)] + ["x" * 500, "abcdefgh" * 400, ""]
    word, byte = tokenizer(queries.WORD_BPE), tokenizer(queries.BYTE_BPE)
    ours, words, spaced = bpe.RankArrayBpe(queries.tokenizer_file(queries.WORD_BPE)), ChunkTokens(queries.tokenizer_file(queries.WORD_BPE), "words"), ChunkTokens(queries.tokenizer_file(queries.BYTE_BPE), "leading_space")
    ids = lambda raw: np.frombuffer(raw, "<u4").tolist()
    for t, w, b in zip(texts, word.encode_batch(texts, add_special_tokens=False), byte.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(ours.encode(t)) == w.ids == ids(words.one(t)), t
        assert ids(spaced.one(t)) == b.ids, t
    for path, split, want in ((queries.BYTE_BPE, "leading_space", byte), (queries.WORD_BPE, "words", word)):
        for at in range(0, len(texts), 1500):  # whole batches, as files are written
            some = texts[at : at + 1500]
            flat, lengths = ChunkTokens(queries.tokenizer_file(path), split).flat_ids(some, 7)
            each = [x.ids + [7] for x in want.encode_batch(some, add_special_tokens=False)]
            assert flat.tolist() == [i for x in each for i in x] and lengths.tolist() == [len(x) for x in each]
    for t, w in zip(texts[:500], word.encode_batch(texts[:500], add_special_tokens=False), strict=True):
        assert ours.decode(w.ids) == word.decode(w.ids, skip_special_tokens=False)


@pytest.mark.parametrize("name, split", [(queries.BYTE_BPE, "leading_space"), (queries.WORD_BPE, "words")])
def test_pieces_around_signs_and_line_feeds_are_not_asked_one_by_one(name, split, monkeypatch):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("aeioustnéß"), 9))
    texts = ["\n".join(f"{word()} {word()}{rng.choice(list('.,;:!?)'))} {word()}" for _ in range(50)) for _ in range(8)]
    texts += ["a.\n\nb", "\na", "\n\na", "a.\n", "a\n\n", "a\n\n\nb", " a.. 'b.'s c.'s", "a.", ".. b", "é. ×. ÷, ª!", None, "", "\0 a", "a=. b<|x", "x\u0338. .\u0338 a.\u0338"]
    calls = []
    monkeypatch.setattr(chunk_tokens._Known, "__missing__", lambda self, chunk, f=chunk_tokens._Known.__missing__: calls.append(chunk) or f(self, chunk))
    flat, lengths = ChunkTokens(queries.tokenizer_file(name), split).flat_ids(texts, 3)
    want = [tokenizer(name).encode(t or "", add_special_tokens=False).ids + [3] for t in texts]
    assert flat.tolist() == [i for x in want for i in x] and lengths.tolist() == [len(x) for x in want]
    assert len(calls) < 80  # of some 1,200 distinct words


def test_remembered_pieces_are_bounded():
    tokens = ChunkTokens(queries.tokenizer_file(queries.WORD_BPE), "words")
    words = ["".join("abcdefghij"[int(d)] for d in str(i)) for i in range(600_000)]
    for at in range(0, len(words), 50_000):
        tokens.flat_ids([" ".join(words[at : at + 50_000])], 0)
    assert len(tokens.plain) + len(getattr(tokens.plain, "older", ())) <= 2 * (150_000 + 50_000)
    assert tokens.flat_ids([words[77]], 0)[0].tolist()[:-1] == tokenizer(queries.WORD_BPE).encode(words[77], add_special_tokens=False).ids


def test_other_tokenizers_are_refused():
    for name, split in ((queries.WORD_BPE, "leading_space"), (queries.BYTE_BPE, "words"), (queries.BYTE_BPE, "other")):
        with pytest.raises(ValueError):
            ChunkTokens(queries.tokenizer_file(name), split)
    with pytest.raises((ValueError, KeyError, StopIteration)):
        bpe.RankArrayBpe(queries.tokenizer_file(queries.BYTE_BPE))


def test_bpe_cases(spark):
    library = tokenizer(queries.WORD_BPE)
    df, path = docs(spark, ODD), queries.tokenizer_file(queries.WORD_BPE)
    for r in bpe.decode(bpe.encode(df, path), path).collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(df.withColumn("token_ids", F.lit(1)), path)


def test_wavelet_matrix():
    a = np.random.default_rng(0).zipf(1.3, 20_000) % 50_257
    m = wavelet.WaveletMatrix.load(wavelet.WaveletMatrix.build(a).dump())
    assert (m.ids() == a).all()
    for i in (0, 1, 511, 512, 513, 19_999):
        assert m.access(i) == a[i]
    for v in (1, 2, 77, 50_256, 65_000, 70_000):
        at = np.flatnonzero(a == v)
        assert m.rank(v) == len(at) and m.rank(v, 1000) == (at < 1000).sum()
        assert [m.select(v, k) for k in range(len(at))][:50] == at[:50].tolist()
    assert wavelet.WaveletMatrix.load(wavelet.WaveletMatrix.build(np.zeros(0, int)).dump()).ids().tolist() == []


def test_token_files(spark):
    library, out = tokenizer(queries.BYTE_BPE), scratch_path(spark, "t")
    df = docs(spark, ODD).withColumn("doc_id", F.lit(100) - F.col("doc_id"))
    wavelet.write_shards(df, out, queries.tokenizer_file(queries.BYTE_BPE), split="leading_space", shard_tokens=5000)
    texts = dict(zip((100 - i for i in range(1, len(ODD) + 1)), ODD, strict=True))
    want, start = {}, 0
    for k in sorted(texts):
        ids = library.encode(texts[k] or "", add_special_tokens=False).ids + [0]
        want[k] = (start, ids)
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["token_ids"]) for r in wavelet.read_documents(spark, out).collect()}
    assert got == want
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in wavelet.read_checksums(spark, out).collect()} == {k: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, (_, ids) in want.items()}
    flat = [i for k in sorted(want) for i in want[k][1]]
    token = max(set(flat), key=flat.count)
    assert wavelet.count_token(spark, out, token).agg(F.sum("n")).first()[0] == flat.count(token)
    assert sorted(r[0] for r in wavelet.find_token(spark, out, 0).collect()) == [i for i, x in enumerate(flat) if x == 0]
    held = [spark.conf.get(f"spark.sql.execution.arrow.max{x}PerBatch") for x in ("Records", "Bytes")]
    wavelet.write_shards(df.union(df).withColumn("bucket", F.lit(1)), out + "r", queries.tokenizer_file(queries.BYTE_BPE), split="leading_space", shard_tokens=5000)
    twice = sorted((r["doc_id"], r["start"], len(r["token_ids"])) for r in wavelet.read_documents(spark, out + "r").collect())
    assert [k for k, _, _ in twice] == sorted(2 * list(texts)) and [s for _, s, _ in twice] == np.cumsum([0] + [n for _, _, n in twice])[:-1].tolist()
    assert held == [spark.conf.get(f"spark.sql.execution.arrow.max{x}PerBatch") for x in ("Records", "Bytes")]
    wavelet.write_shards(df.limit(0), out + "e", queries.tokenizer_file(queries.BYTE_BPE))
    assert wavelet.read_documents(spark, out + "e").count() == 0


def check_packing(rows, lengths, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, n in lengths.items():
        parts = sorted(by_doc[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-n // capacity))) and [r["start"] for r in parts] == [i * capacity for i in range(len(parts))]
        assert sum(r["length"] for r in parts) == n
    for placed in by_seq.values():
        end = 0
        for at, n in sorted(placed):
            assert at == end
            end += n
        assert end <= capacity
    return len(by_seq)


def test_packing(spark):
    library = tokenizer(queries.WORD_BPE)
    rng = random.Random(2)
    texts = ODD + [" ".join(["word"] * rng.randint(1, 900)) for _ in range(300)]
    rows = packing.pack(docs(spark, texts).repartition(7), queries.tokenizer_file(queries.WORD_BPE), split="words").collect()
    lengths = {i + 1: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    n = check_packing(rows, lengths, 2048)
    ids = {i + 1: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    assert n <= 1.02 * sum(lengths.values()) / 2048 + 1
    assert packing.pack(docs(spark, texts).limit(0), queries.tokenizer_file(queries.WORD_BPE)).count() == 0
    twice = docs(spark, ["a b c", "a b c"]).withColumn("doc_id", F.lit(None).cast("long"))
    assert packing.pack(twice, queries.tokenizer_file(queries.WORD_BPE)).count() == 2


# op5 ---------------------------------------------------------------------------------------------------------------

def union_find(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_anchors_cover_all_links(spark):
    """Random fingerprints with planted neighbours at 0 to 4 bits: the components are those of all pairs."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    near = [b ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k, dtype=np.uint64)) if k else b for b in base for k in rng.integers(0, 5, 4)]
    fps = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64), [np.uint64(0), np.uint64(1) << np.uint64(63)]]))
    pairs = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2) if j > i]
    want = union_find(len(fps), pairs)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    got = union_find(len(fps), [(place[r["x"]], place[r["y"]]) for r in simhash.links(df, 2).collect()])
    assert got == want


def test_fingerprint_is_the_majority_of_all_shingles(spark):
    import xxhash

    rng = random.Random(8)
    texts = [" ".join(rng.choices(["Aa", "b", "ccc", "D\t", "é", "f\n"], k=rng.randint(1, 700))) for _ in range(40)]
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
        shingles = [" ".join(words[j : j + 3]) for j in range(max(1, len(words) - 2))]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        assert got[i + 1] == f"{sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)):016x}"


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randint(0, 40), 100 + rng.randint(0, 40)) for _ in range(30)] + [(200, x) for x in range(201, 260)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find(300, links)
    assert got == {i: want[i] for i in range(300) if any(i in x and x[0] != x[1] for x in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_cases(spark):
    import xxhash

    df = docs(spark, [None, "", "ONE", "one", "a b", LONG, LONG, " \t"])
    got = {r["doc_id"]: r for r in simhash.near_duplicates(df.withColumn("fp", F.lit("clash"))).collect()}
    assert got[1]["fingerprint"] == got[2]["fingerprint"] == got[8]["fingerprint"] == "0" * 16
    assert {k: got[k]["component_id"] for k in got} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 1}
    assert got[3]["fingerprint"] == f"{xxhash.xxh64_intdigest(b'one', 42):016x}"
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.union(df)).count() == 16


def test_near_copies_link_like_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 100, 400]))]
        for _ in range(8):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randint(0, max(1, len(words) // 40))):
                words[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += ["one", "ONE", "", "a b c"]
    sets = [set(simhash.shingle_hashes(t, 5, False).tolist()) for t in texts]
    prints = [simhash.fingerprint(simhash.shingle_hashes(t, 5, False)) for t in texts]
    jaccard = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j]) if sets[i] | sets[j] else 1
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    like = [p for p in pairs if jaccard(*p) >= 0.8]
    near = [p for p in pairs if (prints[p[0]] ^ prints[p[1]]).bit_count() <= 2]
    assert len(set(like) - set(near)) > 20
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs(spark, texts, 0), size=5, repeats=False).collect()}
    want = union_find(len(texts), like + near)
    assert [got[i] for i in range(len(texts))] == [want[i] for i in range(len(texts))]


def test_one_row_of_each_group_stays(spark):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    # Rows repeated whole, the kept id 1 again in another group beside that group's own first row, and a null id.
    rows = [(1, a, "en", "s", 0)] * 50 + [(2, a, "en", "s", 0), (1, b, "en", "s", 0), (0, b, "en", "s", 0), (1, c, "en", "s", 0), (None, c, "en", "s", 0), (None, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    got = corpus_pipeline.keep_one_of_near_copies(spark, df, "")
    assert got.columns == df.columns
    assert sorted((r["text"], r["doc_id"]) for r in got.collect()) == [("", None), (a, 1), (b, 0), (c, 1)]


# op8 ---------------------------------------------------------------------------------------------------------------

def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16)) * 3
    x = (centres[rng.integers(0, 12, 20_000)] + rng.standard_normal((20_000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    x, hits = x.astype(float), 0
    for q in range(0, 20_000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(d)), d))[:10]
        hits += len(set(want.tolist()) & {v for v, _ in got[q]})
        assert len(got[q]) == 10 and all(s == pytest.approx(d[v], abs=1e-12) for v, s in got[q])
    assert hits / 2000 >= 0.9


def test_router_looks_into_some_partitions():
    """At 500 rows as at any other size there are several partitions; clustered vectors need few of them."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((8, 16))[rng.integers(0, 8, 3000)] * 6 + rng.standard_normal((3000, 16))
    router = ann.fit(x, 3000)
    assert 1 <= router.probes < len(router.b2) and len(ann.fit(x[:500], 500).b2) >= ann.LEAST_PARTITIONS
    assert ann.partitions(10**4, 8192) < ann.partitions(10**6, 8192) < ann.partitions(10**8, 8192) == ann.MOST_PARTITIONS


def test_nearest_neighbour_cases(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [0.0, 0.0]), (9, None), (200, [float("nan"), 1.0]), (300, [None, 1.0]), (4, [2.0, 0.0]), (3, [0.0, 0.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(df).orderBy("query_id", "rank").collect()]
    far = pytest.approx(2**0.5)  # (0, 0, 1) against (1, 0), which counts as (1, 0, 0)
    assert got == [(0, 1, 7, 0.0), (0, 2, 100, 0.0), (0, 3, 4, 1.0), (0, 4, 3, far), (100, 1, 0, 0.0), (100, 2, 7, 0.0), (100, 3, 4, 1.0), (100, 4, 3, far)]
    rows = [(0, [1.0, 0.0]), (0, [5.0, 0.0]), (5, [1.0, 1.0]), (7, [9.0, 0.0]), (7, [9.0, 0.0]), (5, [100.0, 0.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 5, 1.0), (0, 2, 7, 4.0)]
    assert ann.search(df.limit(0)).count() == 0


# op9 ---------------------------------------------------------------------------------------------------------------

def test_warc(spark):
    html = [None, "", "<p>a</p>", "<p>a</p>", "<p>é</p>", LONG]
    rows = [(i, f"http://x/{i}", h) for i, h in enumerate(html)] + [(2, "http://x/2", "<p>a</p>"), (None, None, "<p>é</p>")]
    df, out = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha256", F.lit("clash")), scratch_path(spark, "w")
    warc.write_archive(df, out)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_index(spark, out).collect()), key=repr)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    want = [(0, "response", None), (1, "revisit", 0), (2, "response", None), (2, "revisit", 2), (3, "revisit", 2), (4, "response", None), (None, "revisit", 4), (5, "response", None)]
    text = dict(enumerate(html)) | {None: "<p>é</p>"}
    assert got == sorted(((k, len((text[k] or "").encode()), digest(text[k]), kind, to) for k, kind, to in want), key=repr)
    assert warc.read_payloads(spark, out).count() == 4
    for r in warc.reconstruct(spark, out).collect():
        assert b"\r\nWARC-Date: " in bytes(r["record"])
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert len(body) == int(fields[b"Content-Length"]) + 4 and fields[b"WARC-Payload-Digest"].decode() == "sha1:" + digest(text[r["page_id"]])
        if fields[b"WARC-Type"] == b"response":
            assert body == (text[r["page_id"]] or "").encode() + warc.END
    ids = [re.search(rb"WARC-Record-ID: (\S+)", bytes(r["header"]))[1] for r in warc.read_headers(spark, out).collect()]
    assert len(set(ids)) == len(rows)
    warc.write_archive(df, out + "b", least_bytes=9)  # smaller payloads are all responses
    assert sorted((r["page_id"], r["record_type"]) for r in warc.read_index(spark, out + "b").collect() if r["payload_bytes"] < 9) == [(0, "response"), (1, "response"), (2, "response"), (2, "response"), (3, "response")]
    filled = warc.reconstruct(spark, out, with_payload_of_revisits=True).collect()
    assert len(filled) == len(rows) and all(bytes(r["record"]).split(warc.END, 1)[1] == (text[r["page_id"]] or "").encode() + warc.END for r in filled)
    broken = warc.read_payloads(spark, out).withColumn("payload", F.concat(F.col("payload"), F.lit(b"x")))
    with pytest.raises(Exception, match="damaged"):
        warc.check_responses(broken.join(warc.read_headers(spark, out).filter("response").select("sha256", "header"), "sha256").select("sha256", F.concat("header", "payload", F.lit(warc.END)).alias("record"))).collect()
    warc.write_archive(df.limit(0), out + "e")
    assert warc.read_index(spark, out + "e").count() == 0


# op10 --------------------------------------------------------------------------------------------------------------

def test_fingerprints(spark):
    texts = [None, "", "a", "abc def ghi jkl mno pqr", "abc def ghi jkl mno pqr", LONG, "ÄÖÜ äöü", "x y z"] + [f"text number {i} with some words in it {i * i}" for i in range(60)]
    df = docs(spark, texts)
    got = {r["doc_id"]: r for r in minhash.fingerprint_with_edits(df, buckets=5).collect()}
    assert len(got) == len(texts)
    order = sorted(got, reverse=True)
    plain = {i + 1: t or "" for i, t in enumerate(texts)}
    for i, k in enumerate(order):
        following = order[(i + 1) % len(order)]
        third = len(plain[k]) // 3
        assert got[k]["edited"] == plain[k][: len(plain[k]) - third] + plain[following][:third]
        assert got[k]["n_chars"] == len(plain[k]) and got[k]["next_fingerprint"] == got[following]["fingerprint"]
    assert got[4]["fingerprint"] == got[5]["fingerprint"] and got[1]["fingerprint"] == "f" * 512
    assert minhash.fingerprint_with_edits(df.limit(0)).count() == 0
    assert minhash.fingerprint_with_edits(df.limit(1)).count() == 1
    nulls = df.withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id")))
    assert minhash.fingerprint_with_edits(nulls.union(nulls)).count() == 2 * len(texts)


def test_likeness_estimates_jaccard():
    rng = random.Random(3)
    a = [f"w{rng.randint(0, 10**9)}" for _ in range(2000)]
    b = a[:1700] + [f"v{i}" for i in range(300)]
    sets = [minhash.shingles(" ".join(x)) for x in (a, b)]
    s = minhash.signatures(sets)
    true = len(set(sets[0]) & set(sets[1])) / len(set(sets[0]) | set(sets[1]))
    assert abs((s[0] == s[1]).mean() - true) < 0.15


def plain_minhash(text):
    """Least value of each universal hash over the shingles, one by one in Python integers."""
    import xxhash

    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    mask, prints = (1 << 64) - 1, []
    size = min(minhash.WORDS, len(words))
    for i in range(len(words) - size + 1 if words else 0):
        h = 0
        for w in words[i : i + size]:
            h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh64_intdigest(w.encode(), 7)) & mask
        h ^= h >> 32
        h = h * 0xD6E8FEB86659FD93 & mask
        prints.append(h ^ h >> 32)
    a, b = minhash.permutations()
    return "".join(f"{min(((x * int(p) + int(q)) & mask) >> 32 for x in prints) if prints else 0xFFFFFFFF:08x}" for p, q in zip(a, b, strict=True))


def test_fingerprint_query_by_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 1500").limit(40)
    path = scratch_path(spark, "sf")
    rows.write.parquet(f"{path}/documents.parquet")
    text = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    order, got = sorted(text, reverse=True), {r["doc_id"]: r for r in queries.fingerprint_query(spark, path).collect()}
    assert sorted(got) == sorted(text)
    same = lambda x, y: sum(x[8 * i : 8 * i + 8] == y[8 * i : 8 * i + 8] for i in range(64)) / 64
    for i, k in enumerate(order):
        following = text[order[(i + 1) % len(order)]]
        third = len(text[k]) // 3
        new = text[k][: len(text[k]) - third] + following[:third]
        own, changed, after = map(plain_minhash, (text[k], new, following))
        r = got[k]
        assert (r["fingerprint"], r["edited_fingerprint"], r["edited_sha256"]) == (own, changed, hashlib.sha256(new.encode()).hexdigest())
        assert (r["near_edited"], r["near_next"], r["n_chars"]) == (same(own, changed), same(own, after), len(text[k]))


def test_near_pairs_like_brute_force(spark, monkeypatch):
    from tallyfold.llm import blocks

    monkeypatch.setattr(blocks, "ROWS", 7)  # many blocks in a bucket
    rng, texts = random.Random(6), []
    for g in range(5):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(9):
            words = list(base)
            for at in rng.sample(range(120), rng.randint(0, 3)):
                words[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += [texts[0], texts[0].upper(), "", None, "one two", "ONE\ttwo"]
    df = docs(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") % 5 > 0, F.col("doc_id") % 20))  # ids repeat, some are null
    members, pairs = minhash.near_pairs(df)
    sets = {frozenset(minhash.shingles(t or "").tolist()) for t in texts}
    assert members.count() == len(texts) and members.select("class").distinct().count() == len(sets)
    listed = list(sets)
    like = [len(x & y) / len(x | y) for i, x in enumerate(listed) for y in listed[:i]]
    got = [r["jaccard"] for r in pairs.collect()]
    assert sorted(got) == pytest.approx(sorted(j for j in like if j >= 0.8)) and len(got) > 30
    assert pairs.select("a", "b").distinct().count() == len(got) and pairs.filter("a >= b").count() == 0
    assert minhash.near_pairs(df.limit(0))[1].count() == 0


# pipeline ----------------------------------------------------------------------------------------------------------

def test_pipeline(spark, sf):
    import corpus_pipeline

    df = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.keep_known_languages(spark, df, sf)
    assert kept.columns == df.columns and kept.count() >= 0.97 * df.count()
    cut = corpus_pipeline.cut_repeated_lines(spark, kept, sf)
    want = brute_lines([(r["doc_id"], r["text"]) for r in kept.collect()], line_dedup.MIN_WORDS)
    lines = lambda t: sum(1 for x in t.split("\n") if x.split())
    before = {r["doc_id"]: lines(r["text"]) for r in kept.collect()}
    assert {r["doc_id"]: before[r["doc_id"]] - lines(r["text"]) for r in cut.collect()} == {k: len(v) for k, v in want.items()}
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()}
    grouped = simhash.near_duplicates(cut, size=5, repeats=False).collect()
    assert ids == {r["component_id"] for r in grouped}


def test_pipeline_cases(spark):
    """Nulls, empty and long texts, repeated rows, ties, clashing and missing columns, and an empty table, through all stages."""
    import corpus_pipeline

    en, fr = "the cat and the dog in the house with the mouse ", "le chat et le chien dans la maison avec la souris "
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "en"), (4, en * 3, "en"), (4, en * 3, "en"), (5, fr * 3, "fr"), (None, fr * 3, "fr"), (6, " ".join(random.Random(1).choices(en.split(), k=30_000)), "en"), (7, "\n".join([fr * 6] * 2), None), (None, "the dog sat near a hat", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("score", "lang_pred", "_tf_key", "_row", "fp", "component", "shingles", "extra0")})
    docs_ = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_ = stage(spark, docs_, "")
        assert docs_.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in docs_.collect()]
    assert len(kept) == len(set(kept)) and {k for k, _ in kept} <= {4, 5, 6, 7, None} and {4, 5, 6} <= {k for k, _ in kept}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs_, "")
    assert packed.select("doc_id").distinct().count() == len({k for k, _ in kept})
    empty = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0
