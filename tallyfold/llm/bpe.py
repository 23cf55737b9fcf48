"""BPE encoding and decoding with a contiguous rank array.

A short word is an array of parts (their bounds are the places between them) beside an array with the merge rank of each adjacent pair. The encoder scans
for the smallest rank, deletes that boundary and refreshes the two neighbouring ranks until no pair can merge. Words of more than
``SHORT`` parts take a heap over the same pairs, so a 100,000-character word costs n log n; results are equal.

The tokenizer file must be of the kind in the tests: NFC and lower-casing, a split pattern that drops white space, byte-level
alphabet, BPE with an end-of-word suffix, no decoder (tokens are joined by a space). Special tokens in a text are
recognised before anything else, as the file's added tokens say.

Defined cases: a null or empty text has no ids and decodes to ''; rows, repeated ones too, are handled one by one; other columns pass
through unchanged; an output column must not have the name of an input column (ValueError).
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyfold.llm.common import slices

SHORT = 64
REMEMBERED = 300_000
NONE = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class RankArrayBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        # A pair of ids as one integer, with its rank; and the id that a rank makes.
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = [self.vocab[a + b] for a, b in model["merges"]]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.specials.items()]}
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        if not (model["type"] == "BPE" and self.suffix and spec["decoder"] is None and all("<" in x for x in self.specials)):
            raise ValueError("not a tokenizer of the kind that this encoder knows")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        alphabet = byte_alphabet()
        self.bytes = [self.vocab[c] for c in alphabet]
        self.last_bytes = [self.vocab[c + self.suffix] for c in alphabet]
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.words_known: dict[str, list[int]] = {}

    def merge(self, parts: list[int]) -> list[int]:
        """The ids of one word after all merges; parts: the ids of its bytes."""
        return self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank, made = self.ranks.get, self.made
        near = [rank(a << 32 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while near:
            least = min(near)
            if least == NONE:
                break
            i = near.index(least)  # the boundary between parts i and i + 1 goes
            parts[i] = made[least]
            del parts[i + 1], near[i]
            if i:
                near[i - 1] = rank(parts[i - 1] << 32 | parts[i], NONE)
            if i < len(near):
                near[i] = rank(parts[i] << 32 | parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, after, before = len(parts), list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        rank, heap = self.ranks.get, []
        for i in range(n - 1):
            if (r := rank(parts[i] << 32 | parts[i + 1])) is not None:
                heap.append((r, i))
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or rank(parts[i] << 32 | parts[j]) != r:
                continue  # one of the two has merged meanwhile
            parts[i], parts[j], after[i] = self.made[r], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank(parts[a] << 32 | parts[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p >= 0]

    def _word(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        parts = [self.bytes[b] for b in raw]
        parts[-1] = self.last_bytes[raw[-1]]
        return self.merge(parts)

    def _plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        if text.isascii():
            text = text.lower()
        else:
            text = "".join([c.lower() for c in unicodedata.normalize("NFC", text)])
        known, out = self.words_known, []
        for word in self.words.findall(text):
            got = known.get(word)
            if got is None:
                got = self._word(word)
                if len(word) < 50:
                    known[word] = got
            out += got
        return out

    def _chunk(self, chunk: str) -> list[int]:
        if self.special is None or "<" not in chunk:
            return self._plain(chunk)
        return [i for piece in self.special.split(chunk) if piece for i in ([self.specials[piece]] if piece in self.specials else self._plain(piece))]

    def decode(self, ids) -> str:
        """The tokens' strings, special ones included, joined by a space."""
        return " ".join([self.strings[i] for i in ids])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. White space ends every word, so a text is cut at spaces and line
        feeds and each distinct chunk is merged once while the worker remembers it."""
        if not text:
            return b""
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        if len(self.words_known) > self.remembered:
            self.words_known.clear()
        chunks = text.replace("\n", " ").split(" ")
        for chunk in set(chunks).difference(known):
            known[chunk] = array("I", self._chunk(chunk)).tobytes()
        out = b"".join(map(known.__getitem__, chunks))
        if len(chunks) == 1 and len(text) > 100:
            known.pop(chunks[0])
        return out


@functools.lru_cache(maxsize=2)
def rank_array_bpe(path: str) -> RankArrayBpe:
    """One per worker process."""
    return RankArrayBpe(path)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def _new_name(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the input already has a column {name}")


def encode(df: DataFrame, path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Adds out: array<int>, the ids of each whole text."""
    _new_name(df, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_array_bpe(path)
        for batch in slices(batches, text):
            ids = [bpe.encode(t) for t in batch.column(text).to_pylist()]
            ends = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), type=pa.int32())
            yield _with_column(batch, out, pa.ListArray.from_arrays(pa.array(ends), flat))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds out: string, the decoded text of each id array; null ids count as none."""
    _new_name(df, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = rank_array_bpe(path).strings
        names = np.array([strings[i] for i in range(len(strings))], dtype=object)
        for batch in batches:
            column = batch.column(ids)
            flat = names[column.flatten().to_numpy(zero_copy_only=False)].tolist()
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(int).tolist()
            yield _with_column(batch, out, pa.array([" ".join(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)], type=pa.string()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))
