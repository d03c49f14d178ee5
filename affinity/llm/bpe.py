"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary (hash and displace: ``n`` tokens in exactly
``n`` slots) resolves a whole pre-token that is itself a token, checked against the slot's
bytes. Tier 2: any other pre-token starts as linked single bytes; a heap of neighbouring pairs
by (rank, place) merges the lowest rank first, leftmost on ties.

The ranks file is read once on the driver and shipped with the function (a vocabulary is a
bounded table, whatever the corpus), so executors need no copy. Encoding and decoding are
map-side: no shuffle. Each worker keeps the ids of recent pieces in a bounded table.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from array import array

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white space of the Unicode standard, as the split pattern's \s means it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Common characters of the pattern's other classes: Latin letters, digits, ASCII punctuation.
LETTER, DIGIT, MARK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9", r"!-/:-@\[-`{-~"
#: A first cut with the standard library, several times faster than the full pattern: contractions, runs of
#: one common class, white space, and else the rest of the word, whose pieces the full pattern finds.
#: A run ends only before a common character or white space, so the full pattern would end it there too.
CUT = re.compile(
    "'(?:s|t|re|ve|m|ll|d)"
    f"| ?[{LETTER}]++(?![^{DIGIT}{MARK}{SPACE}])"
    f"| ?[{DIGIT}]++(?![^{LETTER}{MARK}{SPACE}])"
    f"| ?[{MARK}]++(?![^{LETTER}{DIGIT}{SPACE}])"
    f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"
)
#: Letters and numbers that Unicode 16, the tokenizer library's version, has and Python's tables (15.1) lack.
LETTERS_16 = (
    "\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85\U00010ec2-\U00010ec4"
    "\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3\U00011bc0-\U00011be0"
    "\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff\U0001e5d0-\U0001e5ed\U0001e5f0"
)
NUMBERS_16 = (
    "\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79\U0001ccf0-\U0001ccf9"
    "\U0001e5f1-\U0001e5fa"
)
#: Entries of a generation of a worker's table of recent pieces; two generations are kept.
MEMO_PIECES = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def _ranges(kind: str) -> str:
    """The code points of a general category, from Python's tables, as the inside of a character class."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind]
    runs = np.split(np.array(points), np.flatnonzero(np.diff(points) > 1) + 1)
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


def pinned(pattern: str) -> str:
    """``pattern`` with \\p{L} and \\p{N} spelt out as the tokenizer library's Unicode version has them: the installed
    ``regex`` may be newer and take more code points for letters."""
    inside = {r"\p{L}": _ranges("L") + LETTERS_16, r"\p{N}": _ranges("N") + NUMBERS_16}

    def spelt(found) -> str:  # a class of its own, or a part of one
        return re.sub(r"\\p\{[LN]\}", lambda m: inside[m[0]] if found[0][0] == "[" else f"[{inside[m[0]]}]", found[0])

    return re.sub(r"\[(?:[^\]\\]|\\.)*\]|\\p\{[LN]\}", spelt, pattern)


class PerfectHash:
    """Minimal perfect hash of the vocabulary: bytes -> id, or None for other bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        n = self.n = len(ranks)
        self.buckets = max(1, n // 4)
        by_bucket: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for token in ranks:
            by_bucket[xxhash.xxh32_intdigest(token) % self.buckets].append(token)
        displace = [0] * self.buckets
        self.token: list[bytes | None] = [None] * n
        for k in sorted(range(self.buckets), key=lambda k: -len(by_bucket[k])):
            tokens = by_bucket[k]
            if len(tokens) < 2:
                break
            seed = 1
            while True:
                slots = {xxhash.xxh32_intdigest(t, seed) % n: t for t in tokens}
                if len(slots) == len(tokens) and all(self.token[s] is None for s in slots):
                    break
                seed += 1
            displace[k] = seed
            for s, t in slots.items():
                self.token[s] = t
        free = iter([s for s in range(n) if self.token[s] is None])
        for k, tokens in enumerate(by_bucket):  # a bucket of one names its slot outright
            if len(tokens) == 1:
                s = next(free)
                displace[k], self.token[s] = -s - 1, tokens[0]
        self.displace = displace
        self.id = [ranks[t] for t in self.token]

    def get(self, piece: bytes) -> int | None:
        d = self.displace[xxhash.xxh32_intdigest(piece) % self.buckets]
        s = -d - 1 if d < 0 else xxhash.xxh32_intdigest(piece, d) % self.n
        return self.id[s] if self.token[s] == piece else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no token itself: heap-ordered merges over linked bytes.

    A part is named by where it begins. ``pair[i]`` is the heap entry of part i with its right
    neighbour (the rank, then i, in one integer), -1 without one; an entry that is no longer
    its part's is stale.
    """
    n = len(piece)
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    bits = n.bit_length()
    low = (1 << bits) - 1
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    pair = [-1 if (r := get(piece[i:i + 2])) is None else r << bits | i for i in range(n - 1)]
    pair.append(-1)
    heap = [e for e in pair if e >= 0]
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        i = entry & low
        if pair[i] != entry:
            continue
        j = end[i]
        end[i] = stop = end[j]
        pair[j] = pair[i] = -1
        before[stop] = i
        if stop < n and (r := get(piece[i:end[stop]])) is not None:
            pair[i] = r = r << bits | i
            push(heap, r)
        if i:
            b = before[i]
            if (r := get(piece[b:stop])) is None:
                pair[b] = -1
            else:
                pair[b] = r = r << bits | b
                push(heap, r)
    ids, i = [], 0
    while i < n:
        stop = end[i]
        ids.append(ranks[piece[i:stop]])
        i = stop
    return ids


class Memo(dict):
    """Key -> what ``make(key)`` gives. When ``trim`` finds more than ``limit`` entries they become the older
    generation, whose entries are taken over again on use, and the one before that goes."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Text -> ids and ids -> bytes for one vocabulary; built on the driver, shipped to the workers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        lost = [b for b in range(256) if bytes([b]) not in ranks]
        if lost:
            raise ValueError(f"the vocabulary lacks single bytes: {lost[:5]}")
        self.ranks, self.pattern = ranks, regex.compile(pinned(pattern))
        self.whole = PerfectHash(ranks)
        self.bytes = sorted(ranks, key=ranks.get)
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must count from 0 without gaps")
        self.recent = Memo(self._cut, MEMO_PIECES)

    def _cut(self, text: str) -> bytes:
        ids: list[int] = []
        # one word, by far the most common kind, is left whole by the pattern
        for piece in (text,) if text[text[0] == " ":].isalpha() else self.pattern.findall(text):
            raw = piece.encode("utf-8")
            found = self.whole.get(raw)
            if found is None:
                ids += merge(raw, self.ranks)
            else:
                ids.append(found)
        return array("i", ids).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """int32 ids of the whole text; null and empty texts give none."""
        ids = np.frombuffer(b"".join(map(self.recent.__getitem__, CUT.findall(text or ""))), np.int32)
        self.recent.trim()
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def load(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encode(docs: DataFrame, encoder: Encoder, text: str = "text", name: str = "ids", checked: bool = False) -> DataFrame:
    """``docs`` with ``name``, the array of ids of the whole text (null and empty: an empty array). A column
    of that name is replaced. ``checked``: each text is decoded again too, an error if it doesn't come back."""

    def one(body: str | None) -> np.ndarray:
        ids = encoder.encode(body)
        if checked and encoder.decode(ids.tolist()) != (body or "").encode("utf-8"):
            raise ValueError(f"a text of {len(body or '')} characters doesn't come back from its {len(ids)} ids")
        return ids

    @F.pandas_udf(T.ArrayType(T.IntegerType(), False))
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in texts], dtype=object)

    return docs.withColumn(name, encoded(F.col(text)))


def decode(ids: Column, encoder: Encoder) -> Column:
    """The bytes that an array of ids stands for; a null array gives empty bytes, an unknown id an error."""

    @F.pandas_udf("binary")
    def decoded(rows: pd.Series) -> pd.Series:
        return pd.Series([b"" if r is None else encoder.decode(r.tolist()) for r in rows], dtype=object)

    return decoded(ids)


def public_encoder(name: str) -> Encoder:
    """The encoder of one of the public rank files of the machine that plans the job."""
    import public_tokenizers

    return load(public_tokenizers.path(name), public_tokenizers.PATTERN)
