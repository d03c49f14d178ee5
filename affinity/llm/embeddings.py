"""Embedding near-duplicates: a navigable small-world graph per shard.

1. Rows that can link (label not null; components all finite and not all zero) collapse to distinct
   (label, vector) points with a count, so a vector copied into a third of all rows is
   one point.
2. The points of a label are cut into shards of about ``SHARD_POINTS`` by a hash. Each shard builds a
   graph, links its own points, and audits itself, with work that doesn't depend on how rare links are:
   ``AUDIT_PLANTED`` points drawn at random each get a planted link, a query just above the threshold from it in a random
   direction, and the number that misses its point must prove a recall of ``AUDIT_FLOOR`` by an exact binomial bound;
   ``AUDIT_DRAWS`` points are compared with all others, and those with a link must find ``AUDIT_RECALL`` of
   their links on average. Points of other shards are audited like the latter: every point visits one other shard, chosen by a
   hash, so a shard tests its beam on visitors too. The beam doubles until the audit passes; where it fails until a
   walk would look at as many vectors as the shard holds, all pairs are compared instead. What an audit finds
   isn't added to the result. The graph is written to the checkpoint folder.
3. Every point queries every shard of its label, in blocks of ``BLOCK_POINTS`` queries a task. A hit
   brings in the whole set of points that the shard found linked with it; every such pair is
   checked by its cosine in double precision, so no link below the threshold is reported.
4. A task reports a point's number of links and the linked sets it meets as (point, hub) rows, never the
   pairs; components are unioned by ``components.component_roots``.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import materialize
from affinity.llm.components import component_roots
from affinity.llm.hnsw import BATCH, LINKS, Graph
from affinity.llm.simhash import BLOCK_CELLS, Sets

THRESHOLD = 0.93
SHARD_POINTS = 20_000
BLOCK_POINTS = 20_000
BUILD_BEAM = 32
FIRST_BEAM = 24
AUDIT_DRAWS = 2_000
AUDIT_RECALL = 0.99
AUDIT_PLANTED = 1_000
#: Recall of planted links that an audit proves, but for a chance of ``AUDIT_RISK`` a beam (a shard tries at most 8).
AUDIT_FLOOR = 0.98
AUDIT_RISK = 0.05 / 8
#: The beam of a shard whose graph fails its audit: its points are compared one by one.
ALL = -1
SEED = 7


def unit_rows(vectors) -> np.ndarray:
    out = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    out = out / np.abs(out).max(axis=1, keepdims=True)  # keeps squares of very small or large components in range
    return out / np.sqrt(np.einsum("id,id->i", out, out))[:, None]


def true_links(unit: np.ndarray, queries: np.ndarray, threshold: float, seed: int) -> list:
    """Blocks (queries, their links as packed bits, number of links) by brute force, of those of ``AUDIT_DRAWS`` queries
    drawn that have a link. If the queries are the points of the shard (``unit`` itself), a point is no link of itself."""
    order = np.random.default_rng(seed).permutation(len(queries))[:AUDIT_DRAWS]
    step = max(1, BLOCK_CELLS // len(unit))
    blocks = []
    for lo in range(0, len(order), step):
        rows = order[lo:lo + step]
        linked = queries[rows] @ unit.T >= threshold
        if queries is unit:
            linked[np.arange(len(rows)), rows] = False
        n_links = linked.sum(axis=1)
        some = n_links > 0
        blocks.append((rows[some], np.packbits(linked[some], axis=1), n_links[some]))
    return blocks


def planted_links(unit: np.ndarray, threshold: float, seed: int):
    """(points drawn with replacement, a unit query for each with a cosine just above ``threshold``)."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, len(unit), AUDIT_PLANTED)
    at = unit[rows]
    aside = rng.normal(size=at.shape)
    aside -= np.einsum("id,id->i", aside, at)[:, None] * at
    length = np.sqrt(np.einsum("id,id->i", aside, aside))[:, None]
    cosine = threshold + 1e-3 * (1 - threshold)
    out = cosine * at + math.sqrt(1 - cosine * cosine) * aside / np.maximum(length, 1e-300)
    return rows, np.where(length > 1e-9, out, at)  # in one dimension nothing lies aside


def allowed_misses(n: int, floor: float = AUDIT_FLOOR, risk: float = AUDIT_RISK) -> int:
    """Most misses among ``n`` that still prove a recall above ``floor``: fewer or as many have a chance of at most
    ``risk`` at that recall. -1 if none do."""
    chance, misses = floor ** n, -1
    while chance <= risk:
        misses += 1
        chance += math.comb(n, misses + 1) * (1 - floor) ** (misses + 1) * floor ** (n - misses - 1)
    return misses


def audit_passes(blocks: list, n: int, met) -> bool:
    """Whether the drawn queries with a link find ``AUDIT_RECALL`` of their links, on average over them and on
    average with a query weighed by one over its links, so that a large cluster counts about once.

    ``met(rows)``: which of the ``n`` points of the shard each of these queries is brought together with.
    """
    shares = [(np.unpackbits(bits, axis=1, count=n).astype(bool) & met(rows)).sum(axis=1) / n_links for rows, bits, n_links in blocks]
    share, n_links = np.concatenate([[], *shares]), np.concatenate([[], *[b[2] for b in blocks]])
    return not len(share) or min(share.mean(), np.average(share, weights=1 / n_links)) >= AUDIT_RECALL


def hit_sets(unit: np.ndarray, graph: Graph, sets: np.ndarray, queries: np.ndarray, beam: int, threshold: float):
    """(query, set) of the points near each query that its search meets; with beam ALL, of all points near it."""
    if beam == ALL:
        step = max(1, BLOCK_CELLS // len(unit))
        met = [np.zeros((2, 0), dtype=np.int64)]
        for lo in range(0, len(queries), step):
            q, p = np.nonzero(queries[lo:lo + step] @ unit.T >= threshold)
            met.append(np.unique(np.stack([lo + q, sets[p]]), axis=1))
        return np.concatenate(met, axis=1)
    ids, sims = graph.search(queries.astype(np.float32), beam)
    q, c = np.nonzero((ids >= 0) & (sims >= threshold - 1e-4))
    return q, sets[ids[q, c]]


def link_shard(unit: np.ndarray, graph: Graph, threshold: float, visitors: np.ndarray, seed: int = SEED):
    """(set label of every point, beam that passed the audit of planted links, the points and ``visitors`` from other shards).

    A walk can miss a point at any beam, as it only follows links from one start. If the audit fails until
    a wider walk would look at as many vectors as there are points, all pairs are compared, and the beam is ALL: queries
    are to be compared with all points.
    """
    n = len(unit)
    small = unit.astype(np.float32)
    own, foreign = true_links(unit, unit, threshold, seed), true_links(unit, visitors, threshold, seed)
    targets, planted = planted_links(unit, threshold, seed)

    def planted_pass():
        found = np.zeros(len(targets), dtype=bool)
        for lo in range(0, len(targets), BATCH):
            q, s = hit_sets(unit, graph, sets.label, planted[lo:lo + BATCH], beam, threshold)
            found[lo + q[s == sets.label[targets[lo + q]]]] = True
        return (~found).sum() <= allowed_misses(len(found))

    def visited(rows):
        met = np.zeros((len(rows), n), dtype=bool)
        for lo in range(0, len(rows), BATCH):
            q, s = hit_sets(unit, graph, sets.label, visitors[rows[lo:lo + BATCH]], beam, threshold)
            met[lo + q, s] = True
        return met[:, sets.label]

    beam = FIRST_BEAM
    while True:
        sets = Sets(n)
        for lo in range(0, n, BATCH):
            ids, sims = graph.search(small[lo:lo + BATCH], beam)
            q, c = np.nonzero((ids >= 0) & (sims >= threshold - 1e-4))
            a, b = lo + q, ids[q, c]
            real = np.einsum("id,id->i", unit[a], unit[b]) >= threshold
            sets.union(a[real], b[real])
        passed = planted_pass() and audit_passes(own, n, lambda rows: sets.label[rows][:, None] == sets.label)
        if passed and audit_passes(foreign, n, visited):
            break
        beam *= 2
        if 2 * LINKS * beam >= n:
            beam = ALL
            step = max(1, BLOCK_CELLS // n)
            for lo in range(0, n, step):
                a, b = np.nonzero(unit[lo:lo + step] @ unit.T >= threshold)
                sets.union(lo + a, b)
            break
    return sets.label, beam


def count_links(unit, weight, sets, queries, hits, threshold: float):
    """For each query the links among the members of the sets it hits: (weights linked, [(query, set)])."""
    q, s = hits
    total = np.zeros(len(queries))
    pairs = []
    order = np.argsort(sets, kind="stable")
    begin = np.searchsorted(sets[order], np.arange(len(sets) + 1))
    by_set = np.lexsort((q, s))
    q, s = q[by_set], s[by_set]
    cuts = np.flatnonzero(np.diff(s)) + 1
    for qs, label in zip(np.split(q, cuts), s[np.concatenate([[0], cuts])] if len(s) else []):
        members = order[begin[label]:begin[label + 1]]
        step = max(1, (1 << 21) // len(members))
        for lo in range(0, len(qs), step):
            part = qs[lo:lo + step]
            linked = queries[part] @ unit[members].T >= threshold
            total[part] += linked @ weight[members]
            pairs += [(int(i), int(label)) for i in part[linked.any(axis=1)]]
    return total, pairs


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label", shard_points: int = SHARD_POINTS, block_points: int = BLOCK_POINTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``rows``.

    Rows with a null label or a vector that is null, empty, zero or holds null or non-finite
    components link with nothing: n_links 0, their own component. Vectors of different length
    don't link. Equal vectors link with each other; repeated ids count as rows. A null id is never the
    smallest of a component.
    """
    slim = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    points = (
        slim.where(usable).groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
        .select(F.monotonically_increasing_id().alias("point"), "*", F.size("vector").alias("dim"))
    )
    points = materialize(points, "hnsw-points")  # written once: a point keeps its number
    sizes = points.groupBy("label", "dim").agg(F.count("*").alias("n")).select(
        "label", "dim",
        F.ceil(F.col("n") / shard_points).cast("int").alias("shards"), F.ceil(F.col("n") / block_points).cast("int").alias("blocks"),
    )
    sized = points.join(sizes, ["label", "dim"])
    homes = sized.withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "point"), F.col("shards")).cast("int"))
    step = F.pmod(F.xxhash64(F.lit(SEED + 2), "point"), F.greatest(F.col("shards") - 1, F.lit(1)))
    other = (F.col("shard") + 1 + step) % F.col("shards")
    visits = homes.where("shards > 1").withColumn("shard", other.cast("int"))

    def build(key, group):
        group, others = group[group["home"]], group[~group["home"]]
        if not len(group):  # a shard without points of its own
            return pd.DataFrame({c: [] for c in ("label", "dim", "shard", "blocks", "n_points", "beam", "graph")}, dtype=object)
        unit, visitors = unit_rows(group["vector"]), unit_rows(others["vector"]) if len(others) else np.zeros((0, key[1]))
        graph = Graph(unit.astype(np.float32), BUILD_BEAM)
        sets, beam = link_shard(unit, graph, threshold, visitors)
        blob = pickle.dumps((group["point"].to_numpy(), unit, group["weight"].to_numpy(float), graph.order, graph.level, graph.layers, sets, beam))
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "shard": [key[2]], "blocks": [int(group["blocks"].iloc[0])],
                             "n_points": [len(unit)], "beam": [beam], "graph": [blob]})

    kind = points.schema["label"].dataType.simpleString()
    graphs = materialize(
        homes.withColumn("home", F.lit(True)).unionByName(visits.withColumn("home", F.lit(False)))
        .groupBy("label", "dim", "shard").applyInPandas(
            build, f"label {kind}, dim int, shard int, blocks int, n_points int, beam int, graph binary"
        ),
        "hnsw-graphs",
    )

    def query(key, graph_rows, group):
        if not len(graph_rows) or not len(group):
            return pd.DataFrame({"point": [], "links": [], "hub": []}, dtype=object)
        home, unit, weight, order, level, layers, sets, beam = pickle.loads(graph_rows["graph"].iloc[0])
        graph = Graph.__new__(Graph)
        graph.order, graph.level, graph.layers = order, level, layers
        graph.vectors, graph.row = unit.astype(np.float32)[order], np.arange(len(unit))
        ids_out, links_out, hubs_out = [], [], []
        at = pd.Series(np.arange(len(home)), index=home)
        for lo in range(0, len(group), BATCH):
            part = group.iloc[lo:lo + BATCH]
            mine = unit_rows(part["vector"])
            q, s = hit_sets(unit, graph, sets, mine, beam, threshold)
            own = at.reindex(part["point"]).to_numpy()
            here = np.flatnonzero(~np.isnan(own))  # points of this shard always meet their own set
            hit = np.unique(np.stack([np.concatenate([q, here]), np.concatenate([s, sets[own[here].astype(int)]])]), axis=1)
            total, pairs = count_links(unit, weight, sets, mine, hit, threshold)
            # a point's cosine with itself may round below the threshold's neighbourhood: count it apart
            total[here] -= 1.0
            points_here = part["point"].to_numpy()
            ids_out += list(points_here)
            links_out += list(total)
            hubs_out += [None] * len(part)
            for i, s in pairs:
                ids_out.append(points_here[i])
                links_out.append(0.0)
                hubs_out.append(f"{key[0]}:{key[1]}:{key[2]}:{s}")
        return pd.DataFrame({"point": ids_out, "links": links_out, "hub": pd.Series(hubs_out, dtype=object)})

    asks = sized.select(
        "label", "dim", "point", "vector", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64(F.lit(SEED + 1), "point"), F.col("blocks")).cast("int").alias("block"),
    )
    served = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["label", "dim", "shard", "block"]
    found = materialize(
        served.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(query, "point long, links double, hub string"),
        "hnsw-links",
    )
    links = found.groupBy("point").agg(F.sum("links").cast("long").alias("n_links"))
    roots = component_roots(found.where("hub IS NOT NULL").select(F.col("point").alias("node"), "hub"))
    rooted = points.join(roots.withColumnRenamed("node", "point"), "point", "left").withColumn("root", F.coalesce("root", "point"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_vector = rooted.join(smallest, "root").join(links, "point").select("label", "vector", "n_links", "component_id")
    known = slim.withColumn("usable", usable).join(by_vector.withColumn("usable", F.lit(True)), ["usable", "label", "vector"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return known.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
