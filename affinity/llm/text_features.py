"""Hashed word and word-pair indicators of whole texts, for the two text classifiers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import materialize

#: Bytes by kind: 0 blank, 1 word (ASCII letters, digits, underscore and all bytes above ASCII), 2 punctuation.
KIND = np.array(
    [0 if b <= 32 or b == 127 else 1 if b > 127 or chr(b).isalnum() or b == 95 else 2 for b in range(256)], np.uint8
)
#: A random number per byte and an odd one per place in a token: a token's hash is the sum of the products.
_rng = np.random.default_rng(20)
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
PLACE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Stands for a token equal to the one before it.
SAME = np.uint64(1)
#: Bytes hashed at a time; longer texts are cut between tokens.
BLOCK = 1 << 22
#: Bytes of gram ids (4 an id) of each label that reach the driver at most, two labels under its result limit of 1 GB.
FIT_BYTES = 200_000_000


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's tokens in order: runs of word bytes and runs of punctuation, lower case."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    out, lo = [np.empty(0, np.uint64)], 0
    while lo < len(data):
        block = data[lo:lo + BLOCK]
        kind = KIND[block]
        start = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
        if lo + BLOCK < len(data) and len(start) > 1:  # the last token may go on: leave it to the next block
            block, kind, start = block[:start[-1]], kind[:start[-1]], start[:-1]
        length = np.diff(np.append(start, len(block)))
        place = np.minimum(np.arange(len(block)) - np.repeat(start, length), 255)
        hashes = np.add.reduceat(BYTE[block] * PLACE[place], start)
        out.append(hashes[kind[start] != 0])
        lo += len(block)
    return np.concatenate(out)


def gram_ids(text: str | None, bits: int, pairs: bool) -> np.ndarray:
    """Sorted distinct hashed ids (uint32, below ``2 ** bits``) of a text's tokens, and of its pairs of
    neighbouring tokens if asked for. Null and blank texts give none."""
    ids = token_hashes(text)
    if pairs:
        ids[1:][ids[1:] == ids[:-1]] = SAME
        both = ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:]
        ids = np.concatenate([ids, both])
    ids = (ids ^ (ids >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((ids >> np.uint64(64 - bits)).astype(np.uint32))


def labelled_grams(docs: DataFrame, ids: DataFrame, bits: int, pairs: bool, max_chars: int, max_bytes: int = FIT_BYTES):
    """Documents, gram ids and labels of a bounded sample, gathered for a fit on the driver.

    ``ids(doc_id, label)`` holds a bounded number of rows, so it is broadcast. Documents of more
    than ``max_chars`` characters aren't used to fit (every document is scored whole). An id that many
    rows share counts once, by its smallest grams. Of each label, documents are taken in the order of a hash of their
    id as long as their gram ids fit in ``max_bytes``, so the driver gets twice that at most, however long the texts.
    Returns (list of doc_ids, list of id arrays, array of labels), in order of (doc_id, label).
    """

    @F.pandas_udf("binary")
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series([gram_ids(t, bits, pairs).tobytes() for t in texts], dtype=object)

    sample = materialize(
        docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
        .join(F.broadcast(ids), "doc_id").select("doc_id", "label", grams("text").alias("grams"))
        .groupBy("doc_id", "label").agg(F.min("grams").alias("grams")),
        "fit-grams",
    )
    place = F.xxhash64("doc_id")
    sizes = sample.select("label", place.alias("place"), F.octet_length("grams").alias("size")).collect()  # at most a row for each of ``ids``
    fits = F.lit(False)
    for value in {r.label for r in sizes}:
        mine = sorted((r.place, r.size) for r in sizes if r.label == value)
        over = [p for (p, _), total in zip(mine, np.cumsum([s for _, s in mine])) if total > max_bytes]
        fits |= (F.col("label") == value) & ((place < over[0]) if over else F.lit(True))
    rows = sample.where(fits).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label))
    grams_of = [np.frombuffer(bytes(r.grams), dtype=np.uint32) for r in rows]
    return [r.doc_id for r in rows], grams_of, np.array([r.label for r in rows], dtype=int)


class Rows:
    """Sparse indicator rows over the features of non-zero ``value``, numbered as in ``np.flatnonzero(value)``.

    An entry is ``value / sqrt(floor + squares of the row)``, or ``value`` itself without a floor.
    """

    def __init__(self, grams: list[np.ndarray], value: np.ndarray, floor: float | None):
        used = np.flatnonzero(value)
        slot = np.full(len(value), -1, dtype=np.int64)
        slot[used] = np.arange(len(used))
        kept = [c[c >= 0] for c in (slot[g] for g in grams)]
        self.n, self.dim = len(kept), len(used)
        self.at = np.concatenate([[0], np.cumsum([len(c) for c in kept])]).astype(np.int64)
        self.col = np.concatenate([*kept, np.empty(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), np.diff(self.at))
        self.val = value[used][self.col].astype(float)
        if floor is not None:
            squares = np.bincount(self.row, self.val * self.val, minlength=self.n)
            self.val = self.val / np.sqrt(floor + squares)[self.row]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col] * self.val, minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row] * self.val, minlength=self.dim)


def spread_out(w: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Weights by compact number -> weights by hashed id."""
    out = np.zeros(len(value))
    out[np.flatnonzero(value)] = w
    return out


def sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, dtype=float)))


def platt(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b): sigmoid(a * margin + b) fitted to labels by Newton steps, with smoothed targets."""
    n1, n0 = label.sum(), (1 - label).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)])
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        h = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        da, db = np.linalg.solve(h, x @ (p - target))
        scale = min(1.0, 2.0 / max(abs(da), abs(db), 1e-12))
        a, b = a - scale * da, b - scale * db
    return float(a), float(b)


def score_column(bits: int, pairs: bool, value: np.ndarray, weight: np.ndarray, floor: float | None,
                 bias: float, a: float, b: float):
    """A pandas UDF text -> score in 0..1 for a linear model over the indicators of ``Rows``."""
    square, product = (value * value).astype(np.float32), (value * weight).astype(np.float32)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for k, t in enumerate(texts):
            g = gram_ids(t, bits, pairs)
            norm = 1.0 if floor is None else np.sqrt(floor + square[g].sum(dtype=float))
            out[k] = bias + product[g].sum(dtype=float) / norm
        return pd.Series(sigmoid(a * out + b))

    return scored
