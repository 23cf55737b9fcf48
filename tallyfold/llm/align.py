"""Cross-tokenizer alignment: which tokens of a byte-level tokenizer (A) and of a sentencepiece one (B) cover the same bytes, and in how many documents each pair meets.

A encodes a space and the text, B the text, to which it adds that space; both without special tokens, whose strings are plain text. Byte offsets where tokens of both end cut them into
groups, and every A token of a group is linked with every B token of it.

A first pass aligns the documents and counts, per task, the documents of each linked pair of ids. The distinct pairs are dealt to buckets of about ``KEYS`` keys, each with a minimal perfect
hash function; the tasks' counts become dense vectors indexed by that hash, after a comparison with the key kept there, and are summed in a tree: tasks, parts of a bucket, bucket.
A second pass aligns the documents again and looks the counts up, likewise verified. Function, keys and counts of at most ``SLICE`` pairs (and the highest count of each id of A, as many as its
vocabulary) go to the workers at once; with more pairs the second pass runs once for each slice and the sums of a document are added.

Texts whose only white space is single spaces and line feeds are cut at spaces, and there where a word of letters ends: neither tokenizer has a token across, which is checked on B's pieces when
it is loaded, so each distinct piece of text is aligned once. Other texts are aligned whole.

Defined cases: a text that is null or empty, or whose tokens don't spell its bytes (B reads U+2581 as a space), has no tokens: zeros and an empty digest. Repeated rows count as
documents of their own; a null doc_id is kept; an empty table gives no rows; other columns are left out; special strings and very long texts are read whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice, pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.bpe import byte_alphabet
from tallyfold.llm.chunk_tokens import _lone
from tallyfold.llm.common import batches as bounded
from tallyfold.llm.common import materialise, slices
from tallyfold.llm.mph import Function, build, mixed

#: Keys of a bucket, about; pairs that a worker looks up at once; pairs that a task counts before it passes them on.
KEYS, SLICE, HELD = 1 << 16, 1 << 21, 1 << 20
#: Rows of a bucket that one task turns into a vector.
PART = 1 << 20
#: Aligned pieces that a worker keeps when it has twice as many.
REMEMBERED = 200_000
#: Bits of an id of B in a pair; links of a group that are written out one by one.
B_BITS, LARGE = 24, 4_096
#: How byte-level tokenizers of this kind cut a text; a fixed value, as the tokenizers library has it.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_TAILS = ".,;:!?*%$#&|-()[]"
_LINE = rf"[^\W\d_]+[{re.escape(_TAILS)}]*"
_WORDS = re.compile(rf"{_LINE}(?:\n{_LINE})*")
_UNITS = re.compile(rf"[^\W\d_]+|[{re.escape(_TAILS)}]+|\n")


class Pieces(NamedTuple):
    """What pieces of text add to their documents. sums: tokens of A, of B, groups, links; piece i has the distinct linked pairs (A << B_BITS | B) pairs[starts[i] : starts[i + 1]], met ``times``
    times; groups: in writing. All zero and empty where the tokens don't spell the piece."""

    valid: np.ndarray
    sums: np.ndarray
    starts: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    groups: list[str]

    @classmethod
    def joined(cls, parts: list[Pieces]) -> Pieces:
        valid, sums, pairs, times = (np.concatenate([getattr(p, c) for p in parts]) for c in ("valid", "sums", "pairs", "times"))
        starts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.starts) for p in parts]))])
        return cls(valid, sums, starts, pairs, times, list(chain.from_iterable(p.groups for p in parts)))

    def taken(self, rows: np.ndarray, written: bool = True) -> Pieces:
        n = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.starts[rows] - starts[:-1], n) + np.arange(starts[-1])
        return Pieces(self.valid[rows], self.sums[rows], starts, self.pairs[at], self.times[at], [self.groups[i] for i in rows.tolist()] if written else [])

    def among(self, n: int, rows: np.ndarray) -> Pieces:
        """These as the rows of n pieces, the others being empty."""
        valid, sums, each, groups = np.zeros(n, bool), np.zeros((n, 4), np.int64), np.zeros(n, np.int64), [""] * n
        valid[rows], sums[rows], each[rows] = self.valid, self.sums, np.diff(self.starts)
        for i, g in zip(rows.tolist(), self.groups, strict=True):
            groups[i] = g
        return Pieces(valid, sums, np.concatenate([[0], np.cumsum(each)]), self.pairs, self.times, groups)


def no_pieces(n: int = 0) -> Pieces:
    none = np.zeros(0, np.int64)
    return Pieces(np.zeros(n, bool), np.zeros((n, 4), np.int64), np.zeros(n + 1, np.int64), none, none.astype(np.int32), [""] * n)


class Tokens:
    """Tokens of several texts one after the other, with their bytes."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, raw: np.ndarray, starts: np.ndarray):
        """raw and starts: the bytes of all ids, and where each id's begin."""
        self.ids, self.sizes = ids, sizes
        self.lengths = (starts[1:] - starts[:-1])[ids]
        self.ends = np.cumsum(self.lengths)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.spelled = raw[np.repeat(starts[ids] - (self.ends - self.lengths), self.lengths) + np.arange(self.ends[-1] if len(ids) else 0)]
        self.totals = np.bincount(self.owner, weights=self.lengths, minlength=len(sizes)).astype(np.int64)

    def wrong(self, texts: list[bytes]) -> set[int]:
        """Texts that these tokens don't spell."""
        wanted = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        if (self.totals == wanted).all():
            at = np.flatnonzero(self.spelled != np.frombuffer(b"".join(texts), dtype=np.uint8))
            return set(np.searchsorted(np.cumsum(wanted), at, side="right").tolist())
        ends = np.cumsum(self.totals)
        return {i for i, t in enumerate(texts) if self.spelled[ends[i] - self.totals[i] : ends[i]].tobytes() != t}

    def without(self, gone: set[int], raw: np.ndarray, starts: np.ndarray) -> Tokens:
        keep = np.ones(len(self.sizes), dtype=bool)
        keep[list(gone)] = False
        return Tokens(self.ids[keep[self.owner]], self.sizes[keep], raw, starts)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        self.b = SentencePieceProcessor(model_file=b_path)
        back = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        names = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            a_bytes[i] = b"".join(back[c] for c in token) if all(c in back for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.of_a, self.of_b = ((np.frombuffer(b"".join(x), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in x])])) for x in (a_bytes, b_bytes))
        self.vocabulary = len(a_bytes)
        written = lambda n, sign: np.array([f"{i}{sign}" for i in range(n)], dtype=object)
        self.signs_a = [written(len(a_bytes), s) for s in ",|"]
        self.signs_b = [written(len(b_bytes), s) for s in (",", ";", "\n")]
        # Where no token reaches across, a text may be cut.
        own = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        kinds, model = spec["pre_tokenizer"] or {}, spec["model"]
        beside = lambda x, y: x.isalpha() and y in _TAILS
        self.cuts = not spec["normalizer"] and kinds.get("type") == "ByteLevel" and kinds.get("use_regex") and not kinds.get("add_prefix_space")
        self.cuts = self.cuts and not any("▁" in p.lstrip("▁") or "\n" in p or any(beside(x, y) or beside(y, x) for x, y in pairwise(p)) for p in own)
        self.cuts = self.cuts and self.b.encode("a  b") == [*self.b.encode("a "), self.b.piece_to_id("▁b")]
        # A vocabulary whose ids rank the merges can be asked in bulk by ranks.
        self.ranked = None
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        if self.cuts and [model["vocab"].get(m.replace(" ", "")) for m in merges] == list(range(256, 256 + len(merges))):
            import tiktoken

            ranks = {a_bytes[i]: i for i in model["vocab"].values() if i < 256 + len(merges)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        """The pieces that are known, by number, and the turn in which each was met last."""
        self.number: dict[str, int] = {}
        self.known, self.met, self.turn = no_pieces(), np.zeros(0, np.int64), 0

    def align(self, texts: list[bytes], a: Tokens, b: Tokens) -> Pieces:
        """The texts' alignments."""
        if gone := a.wrong(texts) | b.wrong(texts):
            rows = np.array([i for i in range(len(texts)) if i not in gone], dtype=np.int64)
            return self.align([texts[i] for i in rows], a.without(gone, *self.of_a), b.without(gone, *self.of_b)).among(len(texts), rows)
        if not texts:
            return no_pieces()
        in_a, in_b = (np.isin(x.ends, y.ends, assume_unique=True) for x, y in ((a, b), (b, a)))
        of_a, of_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b  # the group of each token
        n, m = np.bincount(of_a), np.bincount(of_b)
        first_a, first_b = np.cumsum(n) - n, np.cumsum(m) - m
        unit = a.owner[in_a]
        # Every token of A with all of B in its group; large groups by their distinct ids.
        times = np.where((n * m)[of_a] <= LARGE, m[of_a], 0)
        at = np.repeat(first_b[of_a] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        keys = np.repeat(a.owner << 41 | a.ids << B_BITS, times) | b.ids[at]
        keys, met = np.unique(keys, return_counts=True)
        for g in np.flatnonzero(n * m > LARGE).tolist():
            (p, k), (q, l) = (np.unique(x.ids[f[g] : f[g] + c[g]], return_counts=True) for x, f, c in ((a, first_a, n), (b, first_b, m)))
            keys = np.append(keys, ((unit[g] << 41 | p << B_BITS)[:, None] | q[None, :]).ravel())
            met = np.append(met, (k[:, None] * l[None, :]).ravel())
            keys, place = np.unique(keys, return_inverse=True)
            met = np.bincount(place, weights=met).astype(np.int64)
        count = lambda owner, weights=None: np.bincount(owner, weights=weights, minlength=len(texts)).astype(np.int64)
        sums = np.stack([count(a.owner), count(b.owner), count(unit), count(unit, n * m)], axis=1)
        # In writing, A's tokens of a group stand before B's.
        parts = np.empty(len(a.ids) + len(b.ids), dtype=object)
        parts[np.arange(len(a.ids)) + first_b[of_a]] = np.where(in_a, self.signs_a[1][a.ids], self.signs_a[0][a.ids])
        last = np.append(b.owner[1:] != b.owner[:-1], True)
        parts[np.arange(len(b.ids)) + (first_a + n)[of_b]] = np.where(last, self.signs_b[2][b.ids], np.where(in_b, self.signs_b[1][b.ids], self.signs_b[0][b.ids]))
        written = "".join(parts.tolist()).split("\n")
        starts = np.searchsorted(keys >> 41, np.arange(len(texts) + 1))
        return Pieces(np.ones(len(texts), bool), sums, starts, keys & ((1 << 41) - 1), met.astype(np.int32), written[: len(texts)])

    def tokens(self, lists: list[list[int]], of: tuple[np.ndarray, np.ndarray], skip: np.ndarray | None = None) -> Tokens:
        """skip: how many tokens at the start of each list don't count."""
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum()))
        if skip is not None:
            flat = flat[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) >= np.repeat(skip, sizes)]
            sizes = sizes - skip
        return Tokens(flat, sizes, *of)

    def whole(self, text: str) -> Pieces:
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        return self.align([b" " + text.encode()], self.tokens([a], self.of_a), self.tokens([self.b.encode(text, num_threads=1)], self.of_b))

    def learn(self, units: list[str]) -> Pieces:
        """New pieces aligned; one that stands behind a space begins with it."""
        lines = np.fromiter(("\n" in u for u in units), dtype=bool, count=len(units))
        order = np.argsort(lines, kind="stable")
        units = [units[i] for i in order.tolist()]
        plain = len(units) - int(lines.sum())
        lists = []
        if self.ranked and plain:
            ids = np.array(self.ranked.encode_ordinary("\n".join(units[:plain])), dtype=np.int64)
            stops = np.flatnonzero(ids == self.a.token_to_id(byte_alphabet()[10]))
            if len(stops) == plain - 1:
                lists = [x.tolist() for x in np.split(ids[ids != ids[stops[0]]], stops - np.arange(len(stops)))] if len(stops) else [ids.tolist()]
        lists += [x.ids for x in self.a.encode_batch_fast(units[len(lists) :], add_special_tokens=False)]
        behind = np.array([u[0] == " " for u in units])
        heard = self.b.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        skip = np.where(behind, 0, len(self.b.encode("\n")))  # the space that B adds, and the line feed
        made = self.align([u.encode() for u in units], self.tokens(lists, self.of_a), self.tokens(heard, self.of_b, skip))
        return made.taken(np.argsort(order))

    def units(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The known pieces that chunks are made of, by number, their places in these chunk by chunk, and how many each chunk has. A chunk stands behind a space and holds no other.

        With more than twice REMEMBERED pieces, as many as were met last are kept.
        """
        if len(self.number) > 2 * REMEMBERED:
            keep = np.sort(np.argsort(self.met, kind="stable")[-REMEMBERED:])
            names = list(self.number)
            self.number = {names[i]: n for n, i in enumerate(keep.tolist())}
            self.known, self.met = self.known.taken(keep), self.met[keep]
        number = self.number
        before = len(number)
        flat, sizes = [], []
        for text in chunks:
            if not text.isalpha() and _WORDS.fullmatch(text):
                first, *more = _UNITS.findall(text)
                if all(u.isalpha() or u[0] in _TAILS or u == "\n" for u in (first, *more)):
                    flat.append(number.setdefault(" " + first, len(number)))
                    for u in more:
                        flat.append(number.setdefault(u, len(number)))
                    sizes.append(1 + len(more))
                    continue
            flat.append(number.setdefault(" " + text, len(number)))
            sizes.append(1)
        if new := len(number) - before:
            try:
                self.known = Pieces.joined([self.known, self.learn(list(islice(reversed(number), new))[::-1])])
            except BaseException:
                self.forget()  # else pieces would have numbers and no alignment
                raise
            self.met = np.concatenate([self.met, np.zeros(new, np.int64)])
        used, place = np.unique(np.array(flat, dtype=np.int64), return_inverse=True)
        self.turn += 1
        self.met[used] = self.turn
        return used, place, np.array(sizes, dtype=np.int64)


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    return Aligner(a_path, b_path)


class Batch:
    """The texts of a batch as numbers. place: the piece of each occurrence, text by text (ends); a piece's pairs are pairs[starts[c] : starts[c + 1]], met ``times`` times."""

    def __init__(self, tools: Aligner, texts: list[str | None], written: bool = True):
        """written: with the groups in writing."""
        self.n = len(texts)
        cut = [bool(t) and tools.cuts and t[0] not in " \n" and _lone(t) for t in texts]
        split = pc.split_pattern(pa.array([t if c else "" for c, t in zip(cut, texts, strict=True)], pa.large_string()), " ")
        coded = pc.dictionary_encode(split.values)
        chunk, ends = coded.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()
        used, flat, sizes = tools.units(coded.dictionary.to_pylist())
        # A text that isn't cut is a piece of its own, behind the distinct ones.
        odd = [i for i, c in enumerate(cut) if not c]
        chunk[ends[odd]] = len(sizes) + np.arange(len(odd))
        flat = np.concatenate([flat, len(used) + np.arange(len(odd))])
        sizes = np.concatenate([sizes, np.ones(len(odd), np.int64)])
        made = Pieces.joined([tools.known.taken(used, written), *(tools.whole(texts[i]) if texts[i] else no_pieces(1) for i in odd)])
        per = sizes[chunk]
        upto = np.concatenate([[0], np.cumsum(per)])
        self.place = flat[np.repeat((np.cumsum(sizes) - sizes)[chunk] - upto[:-1], per) + np.arange(upto[-1])]
        self.ends = upto[ends]
        self.valid, self.sums, self.groups, self.starts = made.valid, made.sums, made.groups, made.starts
        self.pairs, self.times = made.pairs, made.times.astype(np.int64)
        wrong = np.concatenate([[0], np.cumsum(~self.valid[self.place])])
        self.text_valid = wrong[self.ends[1:]] == wrong[self.ends[:-1]]

    def per_text(self, of_chunk: np.ndarray) -> np.ndarray:
        """Sums over each text's chunks; zero for texts without tokens."""
        upto = np.concatenate([[0], np.cumsum(of_chunk[self.place])])
        return np.where(self.text_valid, upto[self.ends[1:]] - upto[self.ends[:-1]], 0)

    def per_chunk(self, of_pair: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(of_pair)])
        return upto[self.starts[1:]] - upto[self.starts[:-1]]

    def document_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and in how many texts each is."""
        names, code = np.unique(self.pairs, return_inverse=True)
        found = np.zeros(len(names), dtype=np.int64)
        owner = np.repeat(np.arange(self.n), np.diff(self.ends))
        met = np.unique((owner * len(self.valid) + self.place)[self.text_valid[owner]])
        text, chunk = met // max(1, len(self.valid)), met % max(1, len(self.valid))
        bounds = np.searchsorted(text, np.arange(self.n + 1))
        for low in range(0, self.n, 64):  # so many texts' pairs at once
            some = slice(bounds[low], bounds[min(self.n, low + 64)])
            n = np.diff(self.starts)[chunk[some]]
            at = np.repeat(self.starts[chunk[some]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            each = np.unique(np.repeat(text[some], n) * max(1, len(names)) + code[at])
            found += np.bincount(each % max(1, len(names)), minlength=len(names))
        return names[found > 0], found[found > 0]

    def digests(self) -> list[str]:
        out = []
        for i in range(self.n):
            raw = ";".join([self.groups[c] for c in self.place[self.ends[i] : self.ends[i + 1]].tolist()]) if self.text_valid[i] else ""
            out.append(hashlib.sha256(raw.encode()).hexdigest() if raw else "")
        return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    names, place = np.unique(np.concatenate(keys), return_inverse=True)
    return names, np.bincount(place, weights=np.concatenate(counts), minlength=len(names)).astype(np.int64)


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """A row per bucket of the distinct pairs: bucket, hash (the function), keys (pair at each place), counts (documents that hold it linked)."""

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(a_path, b_path)
        keys, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            k, n = _summed(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array((mixed(k.view(np.uint64), 99) >> np.uint64(33)).astype(np.int64)), pa.array(n)], ["pair", "mix", "n"])

        for batch in slices(batches, "text"):
            k, n = Batch(tools, batch.column("text").to_pylist(), written=False).document_counts()
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held > HELD:
                k, n = _summed(keys, counts)
                keys, counts, held = [k], [n], len(k)
                if held > HELD // 2:
                    yield out()
                    keys, counts, held = [], [], 0
        if keys:
            yield out()

    with bounded(docs.sparkSession):
        partial = materialise(docs.select(F.col(text).alias("text")).mapInArrow(first_pass, "pair long, mix long, n long"), "pair-counts")
    distinct = partial.groupBy("pair").agg(F.first("mix").alias("mix"))
    number = max(1, -(-distinct.count() // KEYS))
    bucket = (F.col("mix") % number).alias("bucket")

    def function_of(f: pd.DataFrame) -> pd.DataFrame:
        keys = f["pair"].to_numpy(dtype=np.int64)
        raw = build(keys)
        ordered = np.empty_like(keys)
        ordered[Function(raw)(keys)] = keys
        return pd.DataFrame({"bucket": f["bucket"].iloc[:1], "hash": [raw], "keys": [ordered]})

    functions = materialise(distinct.select(bucket, "pair").groupBy("bucket").applyInPandas(function_of, "bucket long, hash binary, keys array<long>"), "hashes")
    parts = max(1, -(-partial.count() // (number * PART)))
    dealt = partial.select(bucket, (F.spark_partition_id() % parts).alias("part"), "pair", "n")
    copies = functions.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def vector_of(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"bucket": [], "counts": []}).astype({"bucket": "int64", "counts": object})
        keys, asked = np.asarray(right["keys"].iloc[0]), left["pair"].to_numpy(dtype=np.int64)
        place = Function(right["hash"].iloc[0])(asked)
        if (place < 0).any() or (keys[place] != asked).any():
            raise ValueError("a counted pair has no place")
        return pd.DataFrame({"bucket": left["bucket"].iloc[:1], "counts": [np.bincount(place, weights=left["n"], minlength=len(keys)).astype(np.int64)]})

    vectors = dealt.groupBy("bucket", "part").cogroup(copies.groupBy("bucket", "part")).applyInPandas(vector_of, "bucket long, counts array<long>")
    total = vectors.groupBy("bucket").applyInPandas(lambda f: pd.DataFrame({"bucket": f["bucket"].iloc[:1], "counts": [np.sum(np.stack(f["counts"].to_list()), axis=0)]}), "bucket long, counts array<long>")
    return materialise(functions.join(total, "bucket"), "pair-vectors")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", slice_pairs: int = SLICE) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    counted = pair_counts(docs, a_path, b_path, text)
    number = counted.count()
    best = counted.select(F.explode(F.arrays_zip("keys", "counts")).alias("p")).groupBy(F.shiftright("p.keys", B_BITS).alias("a")).agg(F.max("p.counts").alias("most"))
    highest = np.zeros(aligner(a_path, b_path).vocabulary, dtype=np.int64)
    for r in best.toLocalIterator():  # a row for each id of A at most
        highest[r["a"]] = r["most"]
    width = max(1, slice_pairs // KEYS)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = [range(low, min(number, low + width)) for low in range(0, number, width)] or [range(0)]
    numbered = rows.withColumn("row", F.lit(0).cast("long")) if len(parts) == 1 else materialise(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = [_looked_up(numbered, a_path, b_path, counted.filter(F.col("bucket").between(p.start, p.stop - 1)), p, number, highest) for p in parts]
    if len(found) == 1:
        return found[0].drop("row")
    all_parts = functools.reduce(DataFrame.unionByName, found)
    same = [F.first(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
    return all_parts.groupBy("row").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")).drop("row")


def _looked_up(rows: DataFrame, a_path: str, b_path: str, counted: DataFrame, part: range, number: int, highest: np.ndarray) -> DataFrame:
    """The second pass against the buckets of ``part``: at most a slice of pairs goes through the driver to the workers."""
    table = {r["bucket"]: (r["hash"], np.array(r["keys"], dtype=np.int64), np.array(r["counts"], dtype=np.int64)) for r in counted.toLocalIterator()}
    sent = rows.sparkSession.sparkContext.broadcast((table, highest))
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def counts_of(functions: dict[int, Function], table: dict, pairs: np.ndarray) -> np.ndarray:
        bucket = ((mixed(pairs.view(np.uint64), 99) >> np.uint64(33)) % np.uint64(number)).astype(np.int64)
        out = np.zeros(len(pairs), dtype=np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(number + 1))
        for b, (_, keys, counts) in table.items():
            at = order[bounds[b] : bounds[b + 1]]
            if len(at):
                place = functions[b](pairs[at])
                if (place < 0).any() or (keys[place] != pairs[at]).any():
                    raise ValueError("a linked pair wasn't counted")
                out[at] = counts[place]
        return out

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, (table, highest) = aligner(a_path, b_path), sent.value
        functions = {b: Function(raw) for b, (raw, _, _) in table.items()}
        for batch in slices(batches, "text"):
            x = Batch(tools, batch.column("text").to_pylist())
            used = np.repeat(np.bincount(x.place[np.repeat(x.text_valid, np.diff(x.ends))], minlength=len(x.valid)) > 0, np.diff(x.starts))
            names_, code = np.unique(x.pairs[used], return_inverse=True)
            count = np.zeros(len(x.pairs), dtype=np.int64)
            count[used] = counts_of(functions, table, names_)[code]
            top = (count > 0) & (count == highest[x.pairs >> B_BITS])
            columns = [x.per_text(c) for c in (*x.sums.T, x.per_chunk(np.where(top, x.times, 0)), x.per_chunk(count * x.times))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *map(pa.array, columns), pa.array(x.digests(), pa.string())], names)

    return rows.mapInArrow(second_pass, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names))
