"""Sharding by consistent hashing with bounded loads, in DataFrame expressions only.

Each shard has ``points`` virtual nodes on a ring of 32-bit positions; a key belongs to the
arc that ends at the next node clockwise. Every shard has a capacity (a sixteenth of the
rows, rounded so that the capacities add up to the rows); keys that overflow a full shard
continue to the next shard clockwise. Shards therefore hold counts at most one apart (law
``rows``), and only keys on arcs of full shards move from where plain consistent hashing
puts them.

Who overflows depends on counts alone: the arcs (shards x points of them, whatever the input)
are counted by a grouped aggregate, the driver lets the arcs' counts overflow clockwise, and the result
is a table of rank ranges (arc, from, to) -> shard. A row's rank in its arc is its rank by a hash of (id, text
checksum, size), so that who overflows follows the keys and not the files. It is taken in one of ``lanes`` equal ranges of
the hash (more for more rows), plus the rows of the lanes before it; the rows of a key that alone would fill a lane are
split by their row number, so that an arc (or a key that a third of all rows share) is ranked by many tasks.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.llm.common import materialize

SHARDS = 16
POINTS = 64
#: An arc is ranked in at least LANES parts, of at most about LANE_ROWS rows each even if it holds every row.
LANES = 32
LANE_ROWS = 1_000_000
#: The ring in equal cells, for the lookup of a position's arc.
CELL_BITS = 20


def ring(shards: int, points: int) -> list[tuple[int, int]]:
    """Sorted (position, shard) of all virtual nodes."""
    def place(s: int, k: int) -> int:
        return int.from_bytes(hashlib.md5(f"shard {s} point {k}".encode()).digest()[:4], "big")

    return sorted((place(s, k), s) for s in range(shards) for k in range(points))


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of the given rows, from one JSON literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def arc_cells(nodes: list[tuple[int, int]]) -> list[dict]:
    """Arc ``k`` covers the positions above node k-1 up to node k; arc 0 also those above the last node.
    One row per arc and ring cell that it meets."""
    rows = []
    for k, (position, _) in enumerate(nodes):
        low = nodes[k - 1][0] + 1 if k else 0
        spans = [(low, position)] if k else [(0, position), (nodes[-1][0] + 1, (1 << 32) - 1)]
        rows += [
            {"cell": c, "lo": lo, "hi": hi, "arc": k}
            for lo, hi in spans if lo <= hi for c in range(lo >> CELL_BITS, (hi >> CELL_BITS) + 1)
        ]
    return rows


def overflow(nodes: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[dict]:
    """Rank ranges of every arc by shard: each arc offers its rows to the shards clockwise from it, nearest
    first; a shard takes what it has room for. ``slot``: where the range begins in its shard."""
    n = sum(counts.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    filled = [0] * shards
    given = {k: 0 for k in counts}
    order = {}
    for k in counts:
        order[k] = list(dict.fromkeys(nodes[(k + i) % len(nodes)][1] for i in range(len(nodes))))
    out = []
    for step in range(shards):
        for k in sorted(counts):
            s = order[k][step]
            take = min(counts[k] - given[k], room[s] - filled[s])
            if take > 0:
                out.append({"arc": k, "from": given[k], "to": given[k] + take, "shard": s, "slot": filled[s]})
                given[k] += take
                filled[s] += take
    return out


def assign(docs: DataFrame, shards: int = SHARDS, points: int = POINTS, lanes: int = LANES, lane_rows: int = LANE_ROWS,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): one row per row of ``docs``; slots count from 0 in each shard.

    ``size`` is the UTF-8 length of the text (null: 0) plus 1. Null ids hash like the empty text; repeated
    ids and rows share an arc and may overflow to different shards. An empty table gives none. Apart from which of
    the rows that agree in id, checksum and size is which, the result does not depend on the order or split of the rows.
    """
    spark = docs.sparkSession
    nodes = ring(shards, points)
    cells = literal_table(spark, arc_cells(nodes), "cell:long,lo:long,hi:long,arc:int")
    body = F.coalesce(F.col(text), F.lit(""))
    position = F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        position.alias("position"),
        F.xxhash64(F.monotonically_increasing_id()).alias("spread"),
    )
    on_arc = (
        slim.withColumn("cell", F.shiftright("position", CELL_BITS)).join(F.broadcast(cells), "cell")
        .where("position BETWEEN lo AND hi").select("doc_id", "size", "text_crc32", "arc", "spread")
        .withColumn("place", F.xxhash64("doc_id", "text_crc32", "size"))
    )
    rows = materialize(on_arc, "ring-rows")  # written once: a row keeps its lane however often it is read
    total = rows.count()
    lanes = max(lanes, -(-total // lane_rows))
    rows = rows.withColumn("lane", F.shiftright((F.shiftright("place", 33) + (1 << 30)) * lanes, 31).cast("int"))
    # keys with more rows than an equal share of a lane: fewer than ``lanes``, and only in lanes above that share
    above = F.col("n") * lanes > total
    full = rows.groupBy("arc", "lane").agg(F.count("*").alias("n")).where(above).select("arc", "lane")
    heavy = rows.join(F.broadcast(full), ["arc", "lane"], "left_semi").groupBy("arc", "lane", "place").agg(F.count("*").alias("n")).where(above)
    parts = F.ceil(F.col("n") * lanes / F.lit(max(total, 1))).alias("parts")
    heavy = materialize(heavy.groupBy("arc", "lane").agg(F.collect_list(F.struct("place", parts)).alias("heavy")), "ring-heavy")
    rows = rows.join(F.broadcast(heavy), ["arc", "lane"], "left").withColumn("heavy", F.coalesce("heavy", F.array()))
    own = F.get(F.filter("heavy", lambda x: x["place"] == F.col("place")), F.lit(0))["parts"]
    # a lane's rows in order: those before its first heavy key (0), that key (1), those up to the next (2), ...
    before = F.size(F.filter("heavy", lambda x: x["place"] < F.col("place")))
    rows = rows.withColumn("stretch", 2 * before + own.isNotNull().cast("int"))
    rows = rows.withColumn("part", F.pmod("spread", F.coalesce(own, F.lit(1)))).drop("heavy")
    lane = ["arc", "lane", "stretch", "part"]
    by_lane = rows.groupBy(*lane).agg(F.count("*").alias("n"))  # at most shards * points * lanes rows, and a few times lanes
    ahead = Window.partitionBy("arc").orderBy(*lane[1:]).rowsBetween(Window.unboundedPreceding, -1)
    by_lane = materialize(by_lane.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "ring-lanes")
    counts = {r.arc: r.n for r in by_lane.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    ranges = literal_table(spark, overflow(nodes, counts, shards), "arc:int,`from`:long,to:long,shard:int,slot:long")
    in_lane = Window.partitionBy(*lane).orderBy("place", "doc_id", "text_crc32", "size")
    ranked = (
        rows.withColumn("rank", F.row_number().over(in_lane) - 1)
        .join(by_lane.select(*lane, "before"), lane)  # partitioned as the ranks are, if not small
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    placed = ranked.join(F.broadcast(ranges), "arc").where("rank >= `from` AND rank < `to`")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("rank") - F.col("from")).alias("slot"))
