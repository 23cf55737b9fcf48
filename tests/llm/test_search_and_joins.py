"""Ranked lexical search, cross-tokenizer alignment and the n-gram join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyfold.llm import align, lexical, mph, ngram_join, queries

DOCS = "doc_id long, text string, lang string, n string, part long"
LONG = " ".join(f"word{i % 977}" for i in range(20_000))
ODD = [None, "", " ", "Hello  World's don't 123", "a\nb\n\nc", "<|endoftext|> x </s>", "ΑΣ İ ß É ²", LONG, "x" * 3000, "same text here", "same text here", "tab\there\r\n end ", "▁ low line", "🙂🙂 naïve é"]


def docs(spark, texts, first=1):
    return spark.createDataFrame([(first + i, t, "en", "s", i) for i, t in enumerate(texts)], DOCS)


# op11 --------------------------------------------------------------------------------------------------------------

def brute_ranking(texts, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    counts = {i: Counter(split(t)) for i, t in texts.items()}
    sizes = {i: sum(c.values()) for i, c in counts.items() if c}
    whole, length = len(sizes), sum(sizes.values())
    df = Counter(w for c in counts.values() for w in c)
    out = set()
    for item, text in items.items():
        rows = []
        for i, n in sizes.items():
            m = 100 - 90 + (90 * n * whole) // length
            s = sum(int(np.floor(1000 * np.log((2 * whole + 2) / (2 * df[w] + 1)))) * ((10**9 * counts[i][w]) // (1000 * counts[i][w] + 8 * m)) for w in set(split(text)) if counts[i][w])
            if s > 0:
                rows.append((-s, i))
        out |= {(item, r, i, -s) for r, (s, i) in enumerate(sorted(rows)[:k], 1)}
    return out


@pytest.mark.parametrize(("block", "short", "shard"), [(64, 16, 1 << 10), (4, 1, 64), (2, 0, 1 << 10)])
def test_search_like_brute_force(spark, monkeypatch, block, short, shard):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "SHORT", short)
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(60)]
    topic = lambda: [rng.choice(words[10 * (g := rng.randrange(6)) : 10 * g + 14]) for _ in range(rng.randint(1, 40))]
    texts = {i: " ".join(topic()) for i in range(1, 400)} | {400 + i: t for i, t in enumerate(ODD)}
    items = {i: " ".join(topic()[:12]) for i in range(12)} | {90: None, 91: "", 92: "nowhere", 93: "SAME text", 94: "word1 word2 X", 95: "İ é ²"}
    given = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(k, v, 1) for k, v in items.items()], "item_id long, text string, score int")
    got = lexical.search(given, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute_ranking(texts, items)


def test_search_in_groups_and_edges(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 3)
    texts = {i: f"one two {'three ' * (i % 4)}" for i in range(1, 40)}
    items = {i: w for i, w in enumerate(["one", "two three", "three", "one two three", "two", "four one", "three three"])}
    given = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    asked = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute_ranking(texts, items)
    assert {tuple(r) for r in lexical.search(given, asked).collect()} == want
    # Repeated items are answered twice, a null doc_id is ranked last among equals, and empty tables give nothing.
    twice = lexical.search(given, asked.filter("item_id = 1").union(asked.filter("item_id = 1"))).collect()
    assert len(twice) == 2 * sum(x[0] == 1 for x in want)
    nulls = spark.createDataFrame([(None, "q z"), (7, "q z"), (7, "q z"), (3, "y")], "doc_id long, text string")
    got = lexical.search(nulls, spark.createDataFrame([(None, "q")], "item_id long, text string")).orderBy("rank").collect()
    assert [(r["item_id"], r["doc_id"]) for r in got] == [(None, 7), (None, 7), (None, None)] and len({r["score"] for r in got}) == 1
    assert lexical.search(given.limit(0), asked).count() == 0 and lexical.search(given, asked.limit(0)).count() == 0


def test_bounds_hold_and_blocks_are_skipped():
    """No document scores more than its block's bound, and some blocks of clustered lists are left out."""
    rng = np.random.default_rng(4)
    width, n = 40, 600
    owner, term = np.nonzero(rng.random((n, width)) < np.where((np.arange(width)[None, :] // 10) == (np.arange(n)[:, None] % 4), 0.7, 0.03))
    impact = rng.integers(1, lexical.FULL, len(owner))
    lexical_block, lexical.BLOCK = lexical.BLOCK, 32
    try:
        batch = lexical._shard(list(range(n)), owner, term, impact, width)
    finally:
        lexical.BLOCK = lexical_block
    shard = lexical.Shard(batch, 0, width)
    terms, weights = np.arange(0, 20, 2), rng.integers(1, 5000, 10)
    weight_of = np.zeros(width, dtype=np.int64)
    weight_of[terms] = weights
    blocks = np.arange(len(shard.block_lists))
    bounds = shard.bounds(blocks, terms, weights)
    for b in blocks.tolist():
        own = np.sort(shard.docs[shard.block_starts[b] : shard.block_ends[b]])
        assert shard.scores(own, weight_of).max() <= bounds[b]
    best = lexical.Best(10, 0)
    lexical.look_up(shard, terms, weights, weight_of, best, True)
    everything = np.sort(shard.scores(np.arange(n), weight_of))[::-1][:10]
    assert [-s for s, _, _ in best.rows] == everything.tolist() and (bounds < best.beat()).mean() > 0.2


# op12 --------------------------------------------------------------------------------------------------------------

def test_minimal_perfect_hash():
    for n in (0, 1, 2, 65, 5000):
        keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
        place = mph.Function(mph.build(keys))(keys)
        assert sorted(place.tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        mph.build(np.array([5, 5]))


def brute_alignment(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text, by plain loops over whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer_file(queries.BYTE_BPE))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.tokenizer_file(queries.PIECES))
    back = {c: k for k, c in enumerate(align.byte_alphabet())}
    linked, count = [], Counter()
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        xs = [bytes(back[c] for c in a.id_to_token(i)) for i in x]
        pieces = [b.id_to_piece(i) for i in y]
        ys = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, pieces, strict=True)]
        whole = (" " + t).encode() if t else b""
        if not t or b"".join(xs) != whole or b"".join(ys) != whole:
            linked.append(None)
            continue
        ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
        xe, ye = ends(xs), ends(ys)
        cuts = sorted(set(xe) & set(ye))
        of = lambda e: next(k for k, c in enumerate(cuts) if e <= c)
        groups = defaultdict(lambda: ([], []))
        for i, e in zip(x, xe, strict=True):
            groups[of(e)][0].append(i)
        for i, e in zip(y, ye, strict=True):
            groups[of(e)][1].append(i)
        groups = [groups[k] for k in range(len(cuts))]
        pairs = [(p, q) for left, right in groups for p in left for q in right]
        linked.append((len(x), len(y), groups, pairs))
        count.update(set(pairs))
    most = defaultdict(int)
    for (p, _), n in count.items():
        most[p] = max(most[p], n)
    out = []
    for x in linked:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        raw = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in x[2])
        out.append((x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == most[p[0]] for p in x[3]), sum(count[p] for p in x[3]), hashlib.sha256(raw.encode()).hexdigest()))
    return out


POOL = ["word", "hello,", "don't", "naïve", "Ünder", "x.y", "a\nb", "end.\nNext", "foo(bar)", "[x]", "12", "3.5", "ΑΣ", "漢字", "🙂🙂", "é", "<s>", "<|endoftext|>", "▁", "tab\tx", "\n\n", "²a.", "Ĥ", "I'm", "\x00", "q\n", "aaaaaaaaaaaa", "unbelievable!!"]


@pytest.mark.parametrize("slice_pairs", [align.SLICE, 1])
def test_alignment_like_brute_force(spark, monkeypatch, slice_pairs):
    monkeypatch.setattr(align, "KEYS", 64 if slice_pairs == 1 else align.KEYS)
    monkeypatch.setattr(align, "PART", 200)
    rng = random.Random(9)
    texts = [rng.choice([" ", " ", "  "]).join(rng.choices(POOL, k=rng.randint(1, 12))) for _ in range(60)] + [t for t in ODD if t != LONG] + [" ".join(LONG.split()[:800])]
    given = docs(spark, texts).repartition(3)
    got = align.align(given, queries.tokenizer_file(queries.BYTE_BPE), queries.tokenizer_file(queries.PIECES), slice_pairs=64 * slice_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] or set(got.columns) >= {"doc_id", "n_a"}
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {tuple(r) for r in got.select(order).collect()} == {(i, *x) for i, x in enumerate(brute_alignment(texts), 1)}


def test_alignment_edges(spark):
    files = queries.tokenizer_file(queries.BYTE_BPE), queries.tokenizer_file(queries.PIECES)
    assert align.align(docs(spark, ["x"]).limit(0), *files).count() == 0
    only = align.align(docs(spark, [None, ""]), *files).collect()
    assert [(r["n_a"], r["count_sum"], r["groups_sha256"]) for r in only] == [(0, 0, "")] * 2
    twice = spark.createDataFrame([(None, "two words"), (5, "two words"), (5, "two words")], "doc_id long, text string")
    got = align.align(twice, *files).collect()
    assert len(got) == 3 and len({(r["count_sum"], r["n_links"]) for r in got}) == 1 and got[0]["count_sum"] == 3 * got[0]["n_links"]


# op13 --------------------------------------------------------------------------------------------------------------

def brute_join(rows, percent=90, size=3):
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    sets = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if (w := split(t)) else set() for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)].append(k)
    return sorted(((k, len(sets[i]), min(least[root(i)], default=None) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=repr)


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("rows_per_shard", "seed"), [(1024, 1), (4, 2), (2, 3)])
def test_join_like_brute_force(spark, monkeypatch, rows_per_shard, seed):
    monkeypatch.setattr(ngram_join, "SHARD_ROWS", rows_per_shard)
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(50))
    bases = [" ".join(f"b{b}x{i}" for i in range(rng.choice([2, 5, 12, 22, 40, 90, 200]))) for b in range(12)]
    texts = [edited(rng, rng.choice(bases), rng.randint(0, 3)) for _ in range(110)] + [f"{passage} own{i} {rng.random()}" for i in range(12)] + [t for t in ODD if t != LONG]
    # A chain: each is like the next, the ends aren't alike.
    chain = [f"c{i}" for i in range(60)]
    for i in range(6):
        texts.append(" ".join(chain))
        chain[10 * i % 60] = f"d{i}"
    rows = list(enumerate(texts, 1)) + [(None, "a lone text of null"), (None, texts[0]), (3, texts[2])]
    rng.shuffle(rows)
    got = ngram_join.similar(spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, component_id int").repartition(3))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_join(rows)


def test_no_link_is_lost_by_the_parts_nor_by_the_search():
    rng, tried = random.Random(8), 0
    for _ in range(3000):
        base = [rng.getrandbits(64) for _ in range(rng.choice([9, 10, 11, 12, 18, 19, 20, 27, 28, 40, 60, 100, 300]))]
        other = list(base)
        for _ in range(rng.randint(0, max(1, len(base) // 8))):
            step = rng.random()
            if step < 0.4 and len(other) > 1:
                other.pop(rng.randrange(len(other)))
            elif step < 0.8:
                other.append(rng.getrandbits(64))
            else:
                other[rng.randrange(len(other))] = rng.getrandbits(64)
        a, b = (np.unique(np.array(x, dtype=np.uint64)) for x in (base, other))
        both = len(np.intersect1d(a, b))
        link = 100 * both >= 90 * (len(a) + len(b) - both)
        assert (0 in ngram_join.Index([b.view(np.int64), np.array([1])]).search(a.view(np.int64), 90)) == link
        if link and both < max(len(a), len(b)):
            tried += 1
            assert set(ngram_join.part_hashes(a, 90).tolist()) & set(ngram_join.part_hashes(b, 90).tolist())
    assert tried > 500


def test_join_of_a_hot_group_stays_linear(spark, monkeypatch):
    """Near copies of one text: what the index is asked grows with the rows, not with their square."""
    monkeypatch.setattr(ngram_join, "SHARD_ROWS", 32)
    asked = []
    ask = ngram_join._ask

    def counting(groups, sets, percent, name):
        asked.append(groups.filter("asks").count())
        return ask(groups, sets, percent, name)

    monkeypatch.setattr(ngram_join, "_ask", counting)
    rng = random.Random(4)
    base = " ".join(f"w{i}" for i in range(120))
    got = ngram_join.similar(docs(spark, [edited(rng, base, 1) for _ in range(400)])).collect()
    assert {r["component_id"] for r in got} == {1}
    assert asked[0] + asked[1] < 2 * 400
    assert ngram_join.similar(docs(spark, ["x"]).limit(0)).count() == 0


def test_a_head_is_not_asked_twice(spark, monkeypatch):
    """Of two texts that share a part and aren't alike, the first round settles all: the second has no rows."""
    rounds = []
    ask = ngram_join._ask
    monkeypatch.setattr(ngram_join, "_ask", lambda groups, *a: rounds.append(groups.count()) or ask(groups, *a))
    words = [f"w{i}" for i in range(60)]
    got = ngram_join.similar(docs(spark, [" ".join(words), " ".join([*words[:-4], "x", "y", "z", "end"])])).collect()
    assert {r["component_id"] for r in got} == {1, 2} and rounds == [2, 0]


def test_searches_by_probes_and_counts_agree(monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.choice(1 << 40, 300, replace=False)
    sets = [np.unique(np.where(rng.random(300) < rng.choice([0.01, 0.04, 0.06, 0.2]), rng.choice(1 << 40, 300), base)[: rng.integers(250, 301)]) for _ in range(80)]
    index, among = ngram_join.Index(sets), rng.random(80) < 0.7
    for probe in (0, 30, 10_000):
        monkeypatch.setattr(ngram_join, "PROBE", probe)
        for x in sets[:40]:
            alike = [i for i, s in enumerate(sets) if 100 * len(both := np.intersect1d(x, s)) >= 90 * (len(x) + len(s) - len(both))]
            assert index.search(x, 90).tolist() == alike
            assert index.search(x, 90, among).tolist() == [i for i in alike if among[i]]


def test_known_pieces_are_few_and_whole(monkeypatch):
    """Pieces go when many others have been met since, and are aligned anew where they come again."""
    files = [queries.tokenizer_file(x) for x in (queries.BYTE_BPE, queries.PIECES)]
    texts = [f"word{chr(97 + i)} thing, {'x' * i}\nlast. a▁b" if i % 7 == 3 else f"the {'yz' * (i % 9)} over{chr(97 + i % 20)}, and\nmore" for i in range(26)] * 2
    # Of each text: sums, digest, and the counts of its pairs.
    read = lambda tools, t: (lambda x: ([x.per_text(c).tolist() for c in x.sums.T], x.digests(), [c.tolist() for c in x.document_counts()]))(align.Batch(tools, t))
    tools = align.Aligner(*files)
    want = [read(tools, [t]) for t in texts]
    monkeypatch.setattr(align, "REMEMBERED", 6)
    tools = align.Aligner(*files)
    got, most = [], 0
    for t in texts:
        got.append(read(tools, [t]))
        most = max(most, len(tools.number))
        assert len(tools.number) == len(tools.known.valid) == len(tools.met) == len(tools.known.groups)
    assert got == want and most <= 2 * 6 + 12
