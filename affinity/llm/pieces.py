"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is escaped as the model says (a leading mark, spaces as marks) and cut into words before every run of
marks. No piece of the vocabulary continues over such a cut (checked when a model is read; a vocabulary that has
such a piece is encoded without cuts), so words are merged apart and equal words once.

Words that a worker hasn't met lately lie in flat numpy arrays of symbols (``MergeRounds``). A round takes the
smallest pair rank of every word (a segmented minimum), merges all its leftmost, not overlapping occurrences at once,
and looks up the pairs around them. Dead symbols and finished words are compacted away until no word has a pair.
Ranks order pieces by falling score. A new pair may rank before the pair just merged; the library, which merges
one pair at a time, would then take it first, so a word keeps its merges of a round only up to the first that
makes such a pair. The result is the library's for every vocabulary.

The model file is read once on the driver and shipped with the function (its size doesn't depend on the corpus).
Encoding and decoding are map-side. Memory is bounded by the longest text and ``BLOCK_CHARS``.

Null and empty texts give the end id only (or nothing, without it); repeated rows and ids are kept.
Models with other algorithms than BPE, with user-defined or unused pieces, a normalisation table or without
byte fallback are refused.
"""

from __future__ import annotations

import re
import struct
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.llm.bpe import Memo

#: Fixed values of the format: the mark that stands for a space, kinds of pieces, the model type BPE.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
#: Texts are cut and looked up in blocks of about so many characters; words merged together hold about so many symbols.
BLOCK_CHARS, ROUND_SYMBOLS = 1 << 21, 1 << 17
#: A word of more symbols than this is merged alone.
LONG_WORD = 8_192
#: Entries of a generation of a worker's table of recent words (two are kept), and the longest word it takes.
MEMO_WORDS, MEMO_CHARS = 200_000, 64
NONE = np.iinfo(np.int32).max


def fields(raw: bytes):
    """(number, value) of the fields of a protocol buffer message; numbers as int, the rest as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, raw[at:at + size]
        at += size


class MergeRounds:
    """The pair table of a vocabulary and the merging of many words by rounds.

    Symbols are piece ids; a character that is no piece is ``n + code point``, with n pieces.
    """

    def __init__(self, pieces: list[str], scores: np.ndarray, mergeable: np.ndarray):
        n = self.n = len(pieces)
        self.width = n + 0x110000
        ids = {p: i for i, p in enumerate(pieces) if mergeable[i]}
        rank = np.unique(-scores, return_inverse=True)[1]
        pairs = {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = (ids.get(s, n + ord(s) if len(s) == 1 else None) for s in (p[:k], p[k:]))
                if a is not None and b is not None:
                    pairs[a * self.width + b] = i
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.merged = np.append(np.array([pairs[k] for k in keys.tolist()], dtype=np.int32), np.int32(-1))
        self.rank = np.append(rank[self.merged[:-1]].astype(np.int32), np.int32(NONE))
        self.chars = {ord(p): i for p, i in ids.items() if len(p) == 1}
        self.of_char = None

    def symbols(self, words: list[str]) -> np.ndarray:
        if self.of_char is None:
            self.of_char = np.arange(self.n, self.width, dtype=np.int32)
            self.of_char[list(self.chars)] = list(self.chars.values())
        return self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair of symbols; NONE and -1 for pairs that make no piece. Symbol -1 makes none."""
        key = np.where((a >= 0) & (b >= 0), a.astype(np.int64) * self.width + b, np.int64(-1))
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = len(self.keys) - 1
        return self.rank[at], self.merged[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all words one after the other, number of symbols of each word)."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(size, kind="stable")
        total = np.cumsum(size[order])
        block = np.where(size[order] > LONG_WORD, len(words) + np.arange(len(words)), total // ROUND_SYMBOLS)
        parts = [np.zeros((2, 0), dtype=np.int64)]
        for numbers in np.split(order, np.flatnonzero(np.diff(block)) + 1):
            parts.append(self._rounds(self.symbols([words[i] for i in numbers]), numbers, size[numbers]))
        word, symbol = np.concatenate(parts, axis=1)
        place = np.argsort(word, kind="stable")
        return symbol[place], np.bincount(word, minlength=len(words))

    def _rounds(self, symbol: np.ndarray, number: np.ndarray, size: np.ndarray) -> np.ndarray:
        """(word, symbol) rows of the words with these numbers and sizes, merged until no pair is left."""
        done = []
        while len(symbol):
            # flat, compacted arrays; place n is no symbol. The links run inside a word.
            n = len(symbol)
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            sym = np.append(symbol, np.int32(-1))
            after = np.arange(1, n + 2)
            after[np.append(start[1:], n) - 1] = n
            after[n] = n
            before = np.arange(-1, n)
            before[np.append(start, n)] = n
            rank, piece = self.look_up(sym, sym[after])
            word = np.repeat(np.arange(len(size)), size)
            live = n
            while True:
                low = np.minimum.reduceat(rank[:n], start)
                hit = np.flatnonzero((rank[:n] == (low[0] if len(low) == 1 else low[word])) & (rank[:n] != NONE))
                if not len(hit):
                    break
                # every other place of a run of overlapping pairs, from its left end
                fresh = np.append(True, after[hit[:-1]] != hit[1:])
                place = np.arange(len(hit))
                hit = hit[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
                hit = self._before_better(hit, sym, after, before, rank, piece, word)
                second = after[hit]
                third = after[second]
                sym[hit] = piece[hit]
                sym[second] = -1
                rank[second] = NONE
                after[hit] = third
                before[third] = hit
                around = np.concatenate([hit, before[hit]])
                rank[around], piece[around] = self.look_up(sym[around], sym[after[around]])
                live -= len(hit)
                if 4 * live < 3 * n:
                    break
            low = np.minimum.reduceat(rank[:n], start)
            here = sym[:n] >= 0
            finished = (low == NONE)[word]
            out = np.flatnonzero(here & finished)
            done.append(np.stack([number[word[out]], sym[out]]))
            stay = here & ~finished
            symbol, size = sym[:n][stay], np.bincount(word[stay], minlength=len(size))
            number, size = number[size > 0], size[size > 0]
        return np.concatenate(done, axis=1) if done else np.zeros((2, 0), dtype=np.int64)

    def _before_better(self, hit, sym, after, before, rank, piece, word) -> np.ndarray:
        """The merges of each word up to the first that makes a pair of the same or a better rank."""
        if len(hit) < 2 or not (word[hit[1:]] == word[hit[:-1]]).any():
            return hit
        new = piece[hit]
        left = sym[before[hit]]
        joined = np.flatnonzero(before[hit[1:]] == after[hit[:-1]]) + 1  # the merge before is the left neighbour
        left[joined] = new[joined - 1]
        best = np.minimum(self.look_up(left, new)[0], self.look_up(new, sym[after[after[hit]]])[0])
        better = best <= rank[hit]
        if not better.any():
            return hit
        of_word = word[hit]
        earlier = np.cumsum(better) - better
        first = np.append(True, of_word[1:] != of_word[:-1])
        return hit[earlier == earlier[first][np.cumsum(first) - 1]]


class Encoder:
    """Text -> ids and ids -> text for one model; built on the driver, shipped to the workers."""

    def __init__(self, model: bytes):
        pieces, trainer, normal = [], {}, {}
        for number, value in fields(model):
            if number == 1:
                pieces.append(dict(fields(value)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        self.pieces = [p[1].decode("utf-8") for p in pieces]
        kind = self.kind = np.array([p.get(3, NORMAL) for p in pieces])
        if trainer.get(3, 1) != BPE or not trainer.get(35, 0) or normal.get(2) or trainer.get(24, 0):
            raise ValueError("not a BPE model with byte fallback, without normalisation table, with marks before words")
        if normal.get(4, 1) or not normal.get(5, 1) or not np.isin(kind, (NORMAL, UNKNOWN, CONTROL, BYTE)).all():
            raise ValueError("models that drop or keep white space, and user-defined or unused pieces, are not supported")
        self.prefix = MARK if normal.get(3, 1) else ""
        self.end = trainer.get(42, 2)
        scores = np.array([struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces])
        self.rounds = MergeRounds(self.pieces, scores, kind == NORMAL)
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p, k in zip(self.pieces, kind) if k == NORMAL)
        self.cut = re.compile("(?s).+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.byte_id = np.zeros(256, dtype=np.int32)
        self.raw = []  # what an id stands for, as bytes
        unknown = trainer.get(44, " ⁇ ".encode())
        for i, (p, k) in enumerate(zip(self.pieces, kind)):
            if k == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
            self.raw.append({BYTE: lambda: bytes([int(p[3:5], 16)]), CONTROL: lambda: b"", UNKNOWN: lambda: unknown}.get(
                k, lambda: p.replace(MARK, " ").encode("utf-8"))())
        self.recent = Memo(None, MEMO_WORDS)

    def _ids(self, words: list[str]) -> list[bytes]:
        """The int32 ids of each word, as bytes."""
        symbol, count = self.rounds.merge(words)
        n = self.rounds.n
        point = symbol - n  # characters without a piece become the ids of their UTF-8 bytes
        width = np.where(point < 0, 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        ids = np.repeat(symbol, width).astype(np.int32)
        odd = np.flatnonzero(point >= 0)
        if len(odd):
            text = "".join(map(chr, point[odd].tolist())).encode("utf-8")
            spread = np.repeat(point >= 0, width)
            ids[spread] = self.byte_id[np.frombuffer(text, dtype=np.uint8)]
        ends = np.concatenate([[0], np.cumsum(width)])[np.cumsum(count)] * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]

    def encode(self, texts, end: bool = True) -> list[np.ndarray]:
        """int32 ids of each whole text, with the end id last if ``end``."""
        out = []
        tail = np.array([self.end] if end else [], dtype=np.int32).tobytes()
        block, chars = [], 0
        texts = list(texts)
        for k, text in enumerate(texts):
            body = text or ""
            block.append(self.cut.findall(self.prefix + body.replace(" ", MARK)) if body else [])
            chars += len(body)
            if chars >= BLOCK_CHARS or k == len(texts) - 1:
                self.recent.trim()
                known, older = self.recent, self.recent.older
                new = []
                for w in set(chain.from_iterable(block)):
                    if w not in known:
                        if w in older:
                            known[w] = older[w]
                        else:
                            new.append(w)
                known.update(zip(new, self._ids(new) if new else ()))
                out += [np.frombuffer(b"".join(map(known.__getitem__, words)) + tail, np.int32) for words in block]
                for w in new:
                    if len(w) > MEMO_CHARS:
                        del known[w]
                block, chars = [], 0
        return out

    def decode(self, ids) -> str:
        """The text that the ids stand for, without the mark that begins it; bytes that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.pieces):
            raise ValueError("an id outside the vocabulary")
        skip = ""
        if self.prefix:
            shown = ids[self.kind[ids] != CONTROL]
            if len(shown) and self.kind[shown[0]] == NORMAL and self.pieces[shown[0]].startswith(MARK):
                skip = " "
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        try:
            text = self._by_runs(ids) if (self.kind[ids[:-1]] == CONTROL).any() else raw.decode("utf-8")
        except UnicodeDecodeError:
            text = self._by_runs(ids)
        return text[len(skip):]

    def _by_runs(self, ids: np.ndarray) -> str:
        """Runs of byte pieces decoded apart; other ids, control ids too, end a run."""
        out = []
        kind = self.kind[ids] == BYTE
        for run in np.split(ids, np.flatnonzero(np.diff(kind)) + 1):
            raw = b"".join(self.raw[i] for i in run)
            while raw:
                try:
                    out.append(raw.decode("utf-8"))
                    break
                except UnicodeDecodeError as bad:  # one mark for each byte
                    out.append(raw[:bad.start].decode("utf-8") + "�")
                    raw = raw[bad.start + 1:]
        return "".join(out)


def load(path: str) -> Encoder:
    with open(path, "rb") as f:
        return Encoder(f.read())


def encode(docs: DataFrame, encoder: Encoder, text: str = "text", name: str = "ids", end: bool = True) -> DataFrame:
    """``docs`` with ``name``, the array of ids of the whole text. A column of that name is replaced."""

    @F.pandas_udf(T.ArrayType(T.IntegerType(), False))
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series(encoder.encode(texts, end), dtype=object)

    return docs.withColumn(name, encoded(F.col(text)))


def decode(ids: Column, encoder: Encoder) -> Column:
    """The text that an array of ids stands for; null and empty arrays give the empty text, an unknown id an error."""

    @F.pandas_udf("string")
    def decoded(rows: pd.Series) -> pd.Series:
        return pd.Series(["" if r is None else encoder.decode(r) for r in rows], dtype=object)

    return decoded(ids)


def public_encoder(name: str) -> Encoder:
    """The encoder of one of the public models of the machine that plans the job."""
    import public_tokenizers

    return load(public_tokenizers.path(name))
