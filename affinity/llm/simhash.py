"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints.

1. ``fingerprints``: lower-case A-Z, cut words at ASCII white space, hash every run of
   ``shingle`` words (repeats included) with XXH64 and set each bit that is 1 in more than
   half of the hashes.
2. Equal fingerprints collapse to one row (a grouped aggregate, so a text copied into a third
   of the corpus is one point of the search).
3. A vantage-point tree, built on the driver from a sample of fingerprints (``LEAF_SAMPLE`` of every ``SHARD_POINTS``, as
   whole numbers: 8 bytes of the driver's memory for 500 fingerprints), cuts the Hamming space into shards of about
   ``SHARD_POINTS`` however many there are. A point lives in exactly one shard (``d <= radius``
   goes inside). As a query it visits each shard its ball of ``max_bits`` can reach: by the
   triangle inequality no link crosses a boundary further than that. A shard's visitors are dealt to blocks, each with a copy
   of the shard's own points, so a task holds about three times ``SHARD_POINTS`` (with the sample's error, up to about twice that).
4. Each shard searches its points against its visitors with a local vantage-point tree by
   the same bounds and checks surviving pairs exactly.
5. A shard reports the connected sets it found as (fingerprint, hub) rows, at most one per
   point, never the pairs; ``components.component_roots`` unions them across shards.

Nothing is sampled away: the sample only places the boundaries; any placement is exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import free_names, materialize
from affinity.llm.components import component_roots

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: Points aimed at per shard, and how many of them are in the sample that places the boundaries.
SHARD_POINTS = 8_000
LEAF_SAMPLE = 16
#: Centres tried for each boundary; points of the sample that the driver routes at a time; spreads visitors over blocks.
CENTRES, ROUTE_POINTS, MIX = 5, 1 << 16, 0x9E3779B97F4A7C15
#: A local tree stops splitting at this many points; pair blocks hold at most this many cells.
LEAF_POINTS = 192
BLOCK_CELLS = 1 << 21


def simhash(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of one UTF-8 text; null, empty and blank texts give 0."""
    words = (text or b"").lower().split()  # bytes.lower touches A-Z only; split cuts at \\x20 and \\x09-\\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    join = b" ".join
    for lo in range(0, n, 1 << 16):  # blocks bound the memory of very long texts
        hi = min(n, lo + (1 << 16))
        hashes = np.array([digest(join(words[i:i + shingle]), SEED) for i in range(lo, hi)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS, name: str = "fp") -> DataFrame:
    """``docs`` with a bigint column ``name``; a column of that name is replaced."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(name, hashed(F.col(text).cast("binary")))


def _distance(points: np.ndarray, centre) -> np.ndarray:
    return np.bitwise_count(points ^ centre)


def build_tree(sample: np.ndarray, leaf_points: int) -> list:
    """Nodes [centre, radius, inside, outside] of a vantage-point tree, the root first, whose leaves hold at most ``leaf_points``
    of the sample; children are node numbers, or -1 - leaf number. Of a few centres the one that splits best is taken, so points at one
    distance from a centre are told apart by another."""
    nodes, n_leaves = [], 0
    todo = [(sample, None, 0)]
    while todo:
        part, parent, side = todo.pop()
        best = None
        if len(part) > leaf_points:
            for centre in part[:: max(1, len(part) // CENTRES)][:CENTRES]:
                d = _distance(part, centre)
                ranked = np.bincount(d, minlength=65).cumsum()
                radius = int(np.abs(2 * ranked[:-1] - len(part)).argmin())
                balance = min(ranked[radius], len(part) - ranked[radius])
                if best is None or balance > best[0]:
                    best = balance, int(centre), radius, d <= radius
        if best is None or not best[0]:
            number = -1 - n_leaves
            n_leaves += 1
        else:
            number = len(nodes)
            nodes.append([best[1], best[2], 0, 0])
            todo += [(part[~best[3]], number, 3), (part[best[3]], number, 2)]
        if parent is not None:
            nodes[parent][side] = number
    return nodes


def route(points: np.ndarray, tree: list, reach: int):
    """Yield (leaf number, row numbers): the leaves that balls of ``reach`` bits around the points meet."""
    todo = [(0 if tree else -1, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node < 0:
            yield -1 - node, rows
            continue
        centre, radius, inside, outside = tree[node]
        d = _distance(points[rows], np.uint64(centre)).astype(np.int64)
        todo += [(inside, rows[d <= radius + reach]), (outside, rows[d > radius - reach])]


class Sets:
    """Union of linked points, on arrays: ``label`` leads every point to its set's smallest number."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            ra, rb = label[a], label[b]
            apart = ra != rb
            if not apart.any():
                return
            np.minimum.at(label, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def search(points: np.ndarray, home: np.ndarray, queries: np.ndarray, max_bits: int, sets: Sets) -> None:
    """Union every (home, query) pair of points within ``max_bits``; both are row numbers of ``points``."""
    if not len(home) or not len(queries):
        return
    if len(home) > LEAF_POINTS:
        centre = points[home[len(home) // 2]]
        dh = _distance(points[home], centre).astype(np.int64)
        radius = int(np.median(dh))
        if radius == dh.max():
            radius -= 1
        inside = dh <= radius
        if len(home) < 16 * inside.sum() < 15 * len(home):  # a lopsided split would recurse once a point
            dq = _distance(points[queries], centre).astype(np.int64)
            search(points, home[inside], queries[dq <= radius + max_bits], max_bits, sets)
            search(points, home[~inside], queries[dq > radius - max_bits], max_bits, sets)
            return
    step = max(1, BLOCK_CELLS // len(home))
    for lo in range(0, len(queries), step):
        part = queries[lo:lo + step]
        near = _distance(points[part][:, None], points[home][None, :]) <= max_bits
        q, h = np.nonzero(near)
        sets.union(part[q], home[h])


def plan_shards(sample: np.ndarray, leaf_points: int, max_bits: int) -> tuple[list, np.ndarray]:
    """(tree, blocks of each leaf): a leaf's visitors are dealt to as many blocks as give each about twice a leaf's points."""
    tree = build_tree(sample, leaf_points)
    visits = np.zeros(len(tree) + 1, dtype=np.int64)
    for lo in range(0, len(sample), ROUTE_POINTS):
        for leaf, rows in route(sample[lo:lo + ROUTE_POINTS], tree, max_bits):
            visits[leaf] += len(rows)
    return tree, np.maximum(1, -(-visits // (2 * leaf_points)))


def linked_sets(fps: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS,
                leaf_sample: int = LEAF_SAMPLE) -> DataFrame:
    """``fps(fp bigint, distinct)`` -> ``(node, hub)`` rows of points linked with another point."""
    n = fps.count()
    sample = np.zeros(0, dtype=np.uint64)
    if n > shard_points:
        share = min(1.0, leaf_sample / shard_points)
        chosen = F.pmod(F.xxhash64(F.lit(SEED), "fp"), F.lit(1 << 31)) < int(share * (1 << 31))
        sample = np.sort(fps.where(chosen).select("fp").toPandas()["fp"].to_numpy(np.int64).view(np.uint64))
        sample = np.random.default_rng(SEED).permutation(sample)
    tree, blocks = plan_shards(sample, leaf_sample, max_bits)

    def spread(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            points = fp.view(np.uint64)
            for leaf, rows in route(points, tree, 0):  # a leaf's own points go to all its blocks
                for block in range(blocks[leaf]):
                    yield pd.DataFrame({"shard": leaf, "block": block, "fp": fp[rows], "home": True})
            for leaf, rows in route(points, tree, max_bits):
                block = (points[rows] * np.uint64(MIX) >> np.uint64(33)).astype(np.int64) % blocks[leaf]
                yield pd.DataFrame({"shard": leaf, "block": block, "fp": fp[rows], "home": False})

    def shard_links(key, group):
        # all blocks together have the shard's own points among their visitors
        fp, home = group["fp"].to_numpy(np.int64).view(np.uint64), group["home"].to_numpy(bool)
        points = np.unique(fp)
        sets = Sets(len(points))
        search(points, np.searchsorted(points, np.sort(fp[home])), np.searchsorted(points, fp[~home]), max_bits, sets)
        sizes = np.bincount(sets.label, minlength=len(points))
        linked = sizes[sets.label] > 1
        return pd.DataFrame({
            "node": points[linked].view(np.int64), "shard": key[0], "block": key[1], "root": points[sets.label[linked]].view(np.int64),
        })

    spread_rows = fps.select("fp").mapInPandas(spread, "shard int, block int, fp long, home boolean")
    linked = spread_rows.groupBy("shard", "block").applyInPandas(shard_links, "node long, shard int, block int, root long")
    return linked.select("node", F.concat_ws(":", "shard", "block", "root").alias("hub"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id): one row per document.

    ``root`` identifies the component (its smallest fingerprint), ``component_id`` is the
    smallest id in it, ``text_hash`` tells repeated ids with other texts apart. Null, empty
    and blank texts have fingerprint 0 and link like any other; null ids take part but are
    never the smallest (a component of null ids alone has a null id); repeated rows stay.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marks = materialize(
        fingerprints(slim.withColumn("text_hash", F.xxhash64("text")), "text", shingle).drop("text"),
        "simhash-fp",
    )
    points = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-points")
    roots = component_roots(linked_sets(points.select("fp"), max_bits, shard_points))
    of_point = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = of_point.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_point = of_point.join(smallest, "root").select("fp", "root", "component_id")
    # a fingerprint shared by very many documents makes one hot key: adaptive execution splits it
    return marks.join(by_point, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest id (ties: smallest text hash).

    Columns are those of ``docs``; a table of null ids alone keeps one row per group too.
    """
    keep_id, keep_hash, text_hash = free_names(docs, "keep_id", "keep_hash", "text_hash")
    groups = near_duplicates(docs, **options)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = groups.groupBy("root").agg(F.min(first).alias("best")).select(
        F.col("best.doc_id").alias(keep_id), F.col("best.text_hash").alias(keep_hash)
    )
    marked = docs.withColumn(text_hash, F.xxhash64("text"))
    kept = marked.join(
        best,
        F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(text_hash) == F.col(keep_hash)),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", text_hash]).drop(text_hash)
