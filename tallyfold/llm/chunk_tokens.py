"""Token ids of whole texts by the tokenizers library, one distinct piece at a time.

Texts repeat their words, so a worker keeps the ids of the pieces it has met and asks the library only for new ones. A batch of texts is cut into pieces in
numpy, looked up once per distinct piece of the batch, and put together again.
``split`` says where a text may be cut without changing its ids:

- ``words``: the tokenizer lower-cases and drops white space, so every space or line feed separates chunks;
- ``leading_space``: byte-level tokenizers join one space to the word behind it, so a text whose only white space is single spaces and line
  feeds may be cut before each space, and around line feeds; any other text goes to the library whole;
- ``whole``: never (any tokenizer).

A text that holds ``<|`` may hold a special token, beside which white space and case count differently; it goes to the library whole.
A chunk is cut further where a token always ends: at signs behind the last letter.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from array import array

import numpy as np
import pyarrow as pa

from tallyfold.llm.bpe import byte_alphabet

#: Pieces that a worker remembers in each of two generations of each kind; the older one is dropped when the newer is full. All of them hold some 140 MB at most.
REMEMBERED = 150_000
#: New words that the library's model is asked for in one piece, where a line feed between them stays a token of its own.
TOGETHER = 32
#: Signs that form one token match behind a letter; the apostrophe, which may begin a contraction, isn't one of them.
_TAILS = ".,;:!?*%$#&|-()[]"
_IS_TAIL, _IS_LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_IS_TAIL[list(_TAILS.encode())] = True
_IS_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


class _Known(dict):
    """Ids (little-endian unsigned 32-bit integers) of chunks; ``before`` is put before a chunk that the library is asked for.

    A chunk of letters only is one match of the split pattern, so the library's model is asked directly, in the byte-level alphabet.
    """

    def __init__(self, library, before: str, ending: np.ndarray | None, together: int):
        self.encode, self.model, self.before = library.encode, library.model, before
        self.together = together
        self.stops: dict = self  # where signs behind a word are looked up
        self.older: dict[str, bytes] = {}
        self.alphabet = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        from tokenizers import Tokenizer

        self.bare = Tokenizer(self.model)  # the same model without cutting
        self.line_feed, self.ending = byte_alphabet()[10], ending

    def forget(self, most: int) -> None:
        """Begin a new generation if this one is over ``most``."""
        if len(self) > most:
            self.older = dict(self)
            self.clear()

    def learn(self, words: list[str]) -> None:
        """Add the ids of new words of letters. The model gets thousands in one call; the ids in ``ending`` part them."""
        if self.ending is None:
            return
        new = [w for w in words if w not in self]
        if self.older:
            found = list(map(self.older.get, new))
            self.update((w, x) for w, x in zip(new, found, strict=True) if x is not None)
            new = [w for w, x in zip(new, found, strict=True) if x is None]
        new = [w for w in new if len(w) < 100 and w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w))]
        for at in range(0, len(new), 8000):
            some = new[at : at + 8000]
            seen = ("\n".join([self.before + w for w in some]) + "\n").encode("utf-8").decode("latin-1").translate(self.alphabet).split(self.line_feed)[:-1]
            feed = self.line_feed if self.together > 1 else ""
            asked = [feed.join(seen[i : i + self.together]) + feed for i in range(0, len(seen), self.together)]
            ids = np.array(self.bare.encode_batch_fast([asked], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype="<u4")
            ends, raw = np.flatnonzero(self.ending[ids]) + 1, ids.tobytes()
            begins = np.append(0, ends[:-1])
            self.update((w, raw[begin:end]) for w, begin, end in zip(some, (4 * begins).tolist(), (4 * (ends - bool(feed))).tolist(), strict=True))

    def __missing__(self, chunk: str) -> bytes:
        got = self.older.get(chunk)
        if got is None and chunk.isalpha() and (chunk.isascii() or unicodedata.is_normalized("NFC", chunk)):
            seen = (self.before + chunk).encode("utf-8").decode("latin-1").translate(self.alphabet)
            got = array("I", [t.id for t in self.model.tokenize(seen)]).tobytes()
        elif got is None and chunk:
            if "\n" in chunk and self.before:
                lines = chunk.split("\n")
                if all(lines) and not any(x[-1].isspace() for x in lines[:-1]) and not any(x[0].isspace() for x in lines[1:]):
                    got = self[lines[0]] + b"".join([self.stops["\n"] + self.stops[x] for x in lines[1:]])
            else:
                stem = chunk.rstrip(_TAILS)
                if len(stem) < len(chunk) and stem[-1:].lower()[-1:].isalpha() and "\n" not in chunk:
                    got = self[stem] + self.stops[chunk[len(stem) :]]
        if got is None:
            got = array("I", self.encode(self.before + chunk, add_special_tokens=False).ids).tobytes() if self.before + chunk else b""
        if len(chunk) < 100 and "\n" not in chunk:  # words around a line feed hardly meet again
            self[chunk] = got
        return got


def word_ends(model: dict) -> tuple[np.ndarray | None, int]:
    """Which ids end a word of letters when the model is asked for many, and how many may stand in one piece: with a suffix for a word's end those that have it, one word a piece; else that of a
    line feed put between words, if no merge joins one with what a word, or a space and a word, begins or ends with. None where neither holds."""
    suffix, alphabet, vocab = model.get("end_of_word_suffix"), byte_alphabet(), model["vocab"]
    ending = np.zeros(max(vocab.values()) + 1, dtype=bool)
    if model.get("continuing_subword_prefix") or model.get("ignore_merges") or not all(c in vocab for c in alphabet):
        return None, 1
    if suffix:
        if not all(c + suffix in vocab for c in alphabet):
            return None, 1
        ending[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        return ending, 1
    back, feed = {c: b for b, c in enumerate(alphabet)}, alphabet[10]
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        if left[-1] == feed or right[0] == feed:
            for part in (left, right):
                try:
                    text = bytes(back[c] for c in part.strip(feed)).decode("utf-8")
                except UnicodeDecodeError:
                    return None, 1
                if any(x.isalpha() or x in " \n" for x in text):
                    return None, 1
    ending[vocab[feed]] = True
    return ending, TOGETHER


def check_kind(spec: dict, split: str) -> None:
    """Refuse a tokenizer file that ``split`` doesn't hold for: ids would be wrong without a word."""
    kinds = lambda part: {x["type"] for x in (part or {}).get("normalizers", (part or {}).get("pretokenizers", [part] if part else []))}
    before, cut, model = kinds(spec["normalizer"]), kinds(spec["pre_tokenizer"]), spec["model"]
    suits = model["type"] == "BPE" and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
    if split == "words":
        suits = suits and "Lowercase" in before and {"Split", "ByteLevel"} <= cut and bool(model.get("end_of_word_suffix"))
    elif split == "leading_space":
        suits = suits and not before and cut == {"ByteLevel"} and not spec["pre_tokenizer"]["add_prefix_space"] and spec["pre_tokenizer"]["use_regex"] and not model.get("end_of_word_suffix")
    if split not in ("whole", "words", "leading_space") or split != "whole" and not suits:
        raise ValueError(f"split={split!r} doesn't suit this tokenizer; split='whole' does")


class ChunkTokens:
    def __init__(self, path: str, split: str = "whole", remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_kind(spec, split)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.split, self.remembered = split, remembered
        bulk = word_ends(spec["model"]) if split != "whole" else (None, 1)
        self.plain = _Known(self.library, "", *bulk)  # chunks as they are
        self.spaced = _Known(self.library, " ", *bulk)  # chunks behind a space
        self.spaced.stops = self.plain

    def one(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        if self.split == "words" and "<|" not in text and "Σ" not in text:
            # The tokenizer lower-cases character by character; only a final sigma differs in Python.
            return b"".join(map(self.plain.__getitem__, text.lower().replace("\n", " ").split(" ")))
        if self.split != "leading_space" or "<|" in text:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if _lone(text):
            first, *chunks = text.split(" ")
            return self.plain[first] + b"".join(map(self.spaced.__getitem__, chunks))
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _forget(self) -> None:
        for known in (self.plain, self.spaced):
            known.forget(self.remembered)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        self._forget()
        return [self.one(t) for t in texts]

    def _may_cut(self, text: str | None) -> bool:
        """Whether ``_cuts`` knows where the tokens of a text end."""
        if not text or "<|" in text:
            return False
        if self.split == "words":
            return "Σ" not in text
        # Of line feeds within a text the last is a token of its own, and so is a single one before it; at a text's end two are one token.
        return self.split == "leading_space" and "\n\n\n" not in text and text[-2:] != "\n\n" and _lone(text)

    def flat_ids(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with end_id behind it, and how many each text has."""
        end = array("I", [end_id]).tobytes()
        self._forget()
        cut = list(map(self._may_cut, texts))
        if not any(cut):
            raw = [self.one(t) + end for t in texts]
            return np.frombuffer(b"".join(raw), dtype="<u4"), np.array([len(x) // 4 for x in raw], dtype=np.int64)
        # A text that isn't cut stands as one piece, to which its ids are given afterwards.
        words = self.split == "words"
        held = [b"\0" if not c else (" " + t.lower().replace("\n", " ") if words else t).encode("utf-8") for c, t in zip(cut, texts, strict=True)]
        upto = np.cumsum([0, *map(len, held)])
        joined = b"".join(held)
        del held
        starts = _cuts(np.frombuffer(joined, dtype=np.uint8), upto[:-1], around_feeds=not words)
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(joined))), pa.py_buffer(joined)).dictionary_encode()
        pieces, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        behind, alone = self.plain if words else self.spaced, self.plain
        behind.learn([p[1:] for p in pieces if p[0] == " "])
        alone.learn([p for p in pieces if p[0] != " "])
        found = [behind[p[1:]] if p[0] == " " else alone[p] for p in pieces]
        first = np.searchsorted(starts, upto[:-1])
        whole = [i for i, c in enumerate(cut) if not c]
        place = place.astype(np.int64)
        place[first[whole]] = len(found) + np.arange(len(whole))
        found += [self.one(texts[i]) for i in whole]
        # The end id stands behind each text as a piece of its own.
        place = np.insert(place, np.append(first[1:], len(place)), len(found))
        found.append(end)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        lengths = np.add.reduceat(sizes[place], first + np.arange(len(first)))
        of_piece = np.empty(len(found), dtype=object)
        of_piece[:] = found
        return np.frombuffer(b"".join(of_piece[place].tolist()), dtype="<u4"), lengths


def _cuts(raw: np.ndarray, texts: np.ndarray, around_feeds: bool) -> np.ndarray:
    """Where the pieces begin in the UTF-8 bytes of texts that begin at ``texts``: at spaces, around line feeds if wanted, and at a word's last signs behind a letter (A to Z or of Latin-1)."""
    feeds = raw == 10
    cut = raw == 32
    if around_feeds:
        cut |= feeds
        cut[1:] |= feeds[:-1]
    tail = _IS_TAIL[raw]
    begins = np.flatnonzero(tail & ~np.concatenate([[False], tail[:-1]]))
    ends = np.flatnonzero(tail & ~np.concatenate([tail[1:], [False]])) + 1
    last = raw[begins - 1]
    lettered = _IS_LETTER[last] | ((last >= 0x80) & (last < 0xC0) & (last != 0x97) & (last != 0xB7) & (raw[begins - 2] == 0xC3))
    follows = np.append(raw, np.uint8(32))[ends]
    cut[begins[lettered & (begins > 0) & ((follows == 32) | (follows == 10))]] = True
    cut[texts] = True
    return np.flatnonzero(cut)


def _lone(text: str) -> bool:
    """No white space but single spaces, each before a word, and line feeds."""
    return "  " not in text and " \n" not in text and "\n " not in text and text[-1] != " " and text.replace("\n", "x").isprintable()


@functools.lru_cache(maxsize=4)
def chunk_tokens(path: str, split: str) -> ChunkTokens:
    """One per worker process."""
    return ChunkTokens(path, split)
