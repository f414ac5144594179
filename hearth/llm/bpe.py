"""Byte-pair encoding of whole texts, and decoding.

A word's symbols form a doubly linked list. A priority queue holds each adjacent
pair that may merge, by merge rank and then position; an entry whose pair has
changed since it was queued is stale and is skipped. A merge joins two symbols in
place and queues the pairs on both sides, so a word of n symbols takes O(n log n).

The vocabulary file is one of the tokenizers library's JSON files with a BPE model
that marks word ends; its path is a parameter. Texts are normalised as it says (NFC,
white space, lower case by character), special tokens in a text are their own ids.
White space separates, so a text is encoded chunk by chunk and a chunk word by word, and a bounded cache keeps
the ids of recent chunks and words. Null texts count as empty and have no ids. Texts of any length are encoded whole.
Repeated rows and other columns stay; a column named like the new one is replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hearth.llm.common import fields, map_batches

#: Chunks of each of the two generations whose ids a worker keeps for its tasks.
CACHE_CHUNKS = 200_000

# The split of the vocabulary file's pre-tokenizer and the byte alphabet of byte-level BPE.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: White space as the library's patterns see it; unlike str.split() it leaves out U+001C to U+001F.
SPACES = regex.compile("[\t-\r \x85\xa0  -     　]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printed, else the next one from U+0100 on."""
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in PRINTED else chr(next(spare)) for b in range(256)]


def chunks(text: str) -> list[str]:
    """The text cut at white space."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in SPACES.split(text) if c]
    return text.split()


def parts(chunk: str) -> tuple[str, ...]:
    """Commoner chunks whose ids, one after the other, are the chunk's: its words in lower case.

    Only within the Latin letters, where lower case does not depend on the neighbours.
    """
    if "<|" in chunk or len(chunk) > 64 or not (chunk.isascii() or max(chunk) < "\u0250"):
        return (chunk,)
    low = chunk.lower()
    return (low,) if low.isalpha() else tuple(WORDS.findall(low))


class Cache(dict):
    """Ids by chunk, as bytes of 32-bit numbers; a chunk that is not there is encoded.

    When it holds ``size`` chunks they become the older generation, from which those that come again are taken over.
    """

    def __init__(self, encode: Callable[[str], bytes], size: int):
        super().__init__()
        self.encode, self.size = encode, size
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            found = parts(chunk)
            if found == (chunk,):
                ids = self.encode(chunk)
            else:
                seen = not found or found[0] in self or found[0] in self.older
                ids = b"".join(map(self.__getitem__, found))
                if not seen:
                    return ids  # only forms of a word that comes back are worth keeping
        if len(chunk) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.joined = [self.vocab[a + b] for a, b in merges]
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: i for i, (a, b) in enumerate(merges)}  # the two ids in one number
        marks, end = byte_alphabet(), model["end_of_word_suffix"] or ""
        self.first, self.final = [self.vocab[m] for m in marks], [self.vocab[m + end] for m in marks]
        strings = self.vocab | self.special
        self.strings = [""] * (max(strings.values()) + 1)
        for s, i in strings.items():
            self.strings[i] = s
        self.cache = Cache(lambda chunk: np.array(self.chunk(chunk), "<i4").tobytes(), CACHE_CHUNKS)
        self.library = Tokenizer.from_file(path)

    def word(self, word: str) -> list[int]:
        """Ids of one word: merges by rank over a linked list of symbols."""
        data = word.encode("utf-8", "surrogatepass")
        ids = list(map(self.first.__getitem__, data))
        ids[-1] = self.final[data[-1]]
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, joined = self.ranks.get, self.joined
        live = [rank(a << 20 | b) for a, b in pairwise(ids)]  # ranks of the pairs as they are now, by the place of the left symbol
        # an entry is a rank and that place in one number
        queue = [r << 32 | i for i, r in enumerate(live) if r is not None]
        live.append(None)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            r, i = entry >> 32, entry & 0xFFFFFFFF
            if live[i] != r:
                continue  # stale
            j = after[i]
            ids[i] = new = joined[r]
            ids[j], live[j] = -1, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                live[i] = r = rank(new << 20 | ids[k])
                if r is not None:
                    heappush(queue, r << 32 | i)
            else:
                live[i] = None
            if (h := before[i]) >= 0:
                live[h] = r = rank(ids[h] << 20 | new)
                if r is not None:
                    heappush(queue, r << 32 | h)
        return [x for x in ids if x >= 0]

    def _plain(self, part: str) -> list[int]:
        if max(part, default="") < "\u0530":
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()  # a capital sigma lowers alike everywhere
            words = WORDS.findall(part)
        else:  # which characters are letters depends on the Unicode version; the library's own split decides
            part = self.library.normalizer.normalize_str(part)
            words = [part[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return [i for w in words for i in self.word(w)]

    def chunk(self, chunk: str) -> list[int]:
        """Ids of a text without white space."""
        if chunk.isascii() and chunk.isalpha():
            return self.word(chunk.lower())
        out, at = [], 0
        for m in self.special_re.finditer(chunk) if self.special_re else ():
            out += self._plain(chunk[at : m.start()]) + [self.special[m[0]]]
            at = m.end()
        return out + self._plain(chunk[at:])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as bytes of 32-bit numbers."""
        return b"".join(map(self.cache.__getitem__, chunks(text or "")))

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings, joined by a space as the library joins them without a decoder."""
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)  # for all tasks of a worker


@lru_cache(1)
def _strings(path: str) -> pa.Array:
    """The vocabulary's strings by id, all that decoding needs."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    strings = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [""] * (max(strings.values()) + 1)
    for s, i in strings.items():
        out[i] = s
    return pa.array(out, pa.string())


def _encoded(e: Encoder, texts: pa.Array) -> pa.Array:
    packed = [e.packed(x) for x in texts.to_pylist()]
    offsets = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _decoded(strings: pa.Array, ids: pa.Array) -> pa.Array:
    ends = np.cumsum([0, *ids.value_lengths().fill_null(0).to_pylist()], dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), strings.take(ids.flatten()))
    return pc.binary_join(lists, " ")  # as the library joins them without a decoder


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with an array column of the ids of each whole text."""
    return _with(docs, path, text_col, ids_col, "array<int>", _encoder, _encoded)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with a column of the text of each array of ids; null ids give an empty text."""
    return _with(df, path, ids_col, text_col, "string", _strings, _decoded)


def _with(df: DataFrame, path: str, src: str, new: str, kind: str, load, f) -> DataFrame:
    names = [c for c in df.columns if c != new]
    at = df.columns.index(src)

    def make():
        e = load(path)

        def step(b: pa.RecordBatch):
            for i in range(0, b.num_rows, 256):  # ids take more room than texts
                part = b.slice(i, 256)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), f(e, part.column(at))], names=[*names, new])

        return step

    return map_batches(df, make, fields(*[x for x in df.schema if x.name != new], f"`{new}` {kind}"))
