"""Conversation prefix trie: padded turn-id matrices in range shards, with their boundary nodes recombined.

1. ``sequences`` names every turn by a digest of (role, text) with the text's length, ``RECORD`` bytes, and strings
   a conversation's names together in turn order. One is a prefix of another as the turns are, and the byte order
   of sequences is the order in which a walk of the trie meets them.
2. ``trie`` range-partitions the conversations by (sequence, conv_id), so a shard is a stretch of that walk, and
   equal conversations, however many, are dealt over as many shards as they need.
3. A shard numbers its turns densely and sorts padded matrices of turn numbers with numpy's lexsort, ``COLUMNS``
   columns at a time (only rows that go on take part in the next block, so padding stays below a block a row).
   Masks of the columns that differ from the row above, OR-accumulated from left to right, mark where
   nodes start at each depth; from the deepest depth up ``reduceat`` adds up members, leaves and saved tokens.
4. Nodes that hold a shard's first or last row may go on in other shards: their partial figures, keyed by a
   digest of the path, are added up by grouped aggregates. What boundary nodes themselves add to
   their ancestors is summed along each shard's two outer paths, each node being counted on one path only. All
   other nodes leave the shard finished; those whose parent is a boundary node take its id by a join.
5. The ids of conversations that end at a boundary node leave the shards as joined blocks of ``ENDS_BLOCK`` ids,
   already in order; the digest of a node reads its blocks one after the other. (SHA-256 is sequential: that pass
   over a hot group's bytes is the one thing that can't be split.)

Defined results: rows with a null conv_id are left out (they name no conversation); null roles and texts count
as empty; turns of the same number are ordered by their digest, repeated rows are turns of their own; an empty
table gives no nodes, a table of turnless conversations the root. A conversation's names lie in one row
(24 bytes a turn), so a conversation must fit in a worker's memory; a shard holds about ``SHARD_TURNS`` turns
beside its longest conversation.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import materialize

#: Bytes of a turn's name: 16 of the SHA-256 of role and text, then the text's length in UTF-8, big-endian.
RECORD, DIGEST = 20, 16
SHARD_TURNS = 250_000
COLUMNS = 32
ENDS_BLOCK = 512
#: Rows that a shard gives at a time.
FRAME_ROWS = 20_000
#: Kinds of rows that a shard gives: finished nodes, boundary nodes by path, blocks of ids that end at a boundary node.
NODE, PATH, ENDS = 0, 1, 2
SHARD_ROWS = (
    "kind int, shard int, side int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, shared boolean, ends binary"
)
NO_ENDS = sha256(b"").hexdigest()


def turn_name(role, text):
    """A turn's name in hexadecimal digits; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id long, seq binary): the turns' names of each conversation in turn order (a null turn first)."""
    named = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("turn"),
        turn_name(F.col(role), F.col(text)).alias("name"),
    ).where(F.col("conv_id").isNotNull())
    place = F.struct("numbered", F.col("turn"), F.col("name"))
    listed = named.groupBy("conv_id").agg(F.sort_array(F.collect_list(place)).alias("turns"))
    return listed.select("conv_id", F.unhex(F.array_join(F.col("turns.name"), "")).alias("seq"))


def grafted(convs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c of (conv_id, seq) rebuilt: the first h turns of conversation c - c % ``group``
    (all if it has fewer, none if it is absent), then its own after its first h; h = crc32(c) % ``most``.
    Remainders are those of floor division, so a negative c goes to the multiple below it."""
    c = F.col("conv_id")
    size = (F.crc32(c.cast("string").cast("binary")) % most).cast("int") * RECORD
    base = convs.where(F.pmod(c, F.lit(group)) == 0).select(
        c.alias("base"), F.substring("seq", 1, most * RECORD).alias("head")
    )
    joined = convs.withColumn("base", c - F.pmod(c, F.lit(group))).join(base, "base", "left").withColumn("size", size)
    head = F.coalesce(F.substr("head", F.lit(1), F.col("size")), F.unhex(F.lit("")))
    own = F.substr("seq", F.col("size") + 1, F.octet_length("seq"))
    return joined.select("conv_id", F.concat(head, own).alias("seq"))


def _blocks(ids: np.ndarray, offset: np.ndarray, rows: np.ndarray, lo: int) -> np.ndarray:
    """The padded matrix of columns lo .. lo + COLUMNS of these rows; -1 beyond a row's end."""
    column = lo + np.arange(COLUMNS)
    size = offset[rows + 1] - offset[rows]
    inside = column < size[:, None]
    out = np.full(inside.shape, -1, dtype=np.int64)
    out[inside] = ids[(offset[rows][:, None] + column)[inside]]
    return out


def sorted_rows(ids: np.ndarray, offset: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by sequence and conv_id, turns that each sorted row has in common with the one above).

    ``ids``: turn numbers of all rows one after the other, row r at offset[r]:offset[r + 1].
    """
    size = np.diff(offset)
    rank = np.zeros(len(size), dtype=np.int64)
    rows, lo = np.flatnonzero(size > 0), 0
    while len(rows):
        block = _blocks(ids, offset, rows, lo)
        order = np.lexsort([*block.T[::-1], rank[rows]])
        block, of_rank = block[order], rank[rows[order]]
        new = np.append(True, (block[1:] != block[:-1]).any(axis=1) | (of_rank[1:] != of_rank[:-1]))
        finer = np.zeros(len(size), dtype=np.int64)  # rows that ended before come before their continuations
        finer[rows[order]] = np.cumsum(new)
        rank = np.unique(rank * (len(size) + 1) + finer, return_inverse=True)[1]
        lo += COLUMNS
        rows = rows[size[rows] > lo]
    order = np.lexsort([conv, rank])
    common = np.zeros(len(size), dtype=np.int64)
    same, lo = np.arange(1, len(size)), 0  # sorted rows that agree with the one above so far
    while len(same):
        a, b = _blocks(ids, offset, order[same - 1], lo), _blocks(ids, offset, order[same], lo)
        changed = np.logical_or.accumulate((a != b) | (b < 0), axis=1)
        common[same] += (~changed).sum(axis=1)
        lo += COLUMNS
        same = same[~changed[:, -1]]
    return order, common


def _joined(conv: np.ndarray) -> bytes:
    return ",".join(map(str, conv.tolist())).encode()


def _path_keys(names: np.ndarray) -> list[bytes]:
    """Keys of the nodes from the root along one row's turns."""
    keys = [bytes(DIGEST)]
    for name in names:
        keys.append(sha256(keys[-1] + name.tobytes()).digest()[:DIGEST])
    return keys


def shard_rows(conv: np.ndarray, seqs: list[bytes], shard: int):
    """Yield frames of ``SHARD_ROWS`` for the conversations of one shard."""
    size = np.array([len(s) // RECORD for s in seqs], dtype=np.int64)
    offset = np.concatenate([[0], np.cumsum(size)])
    records = np.frombuffer(b"".join(seqs), dtype=np.dtype([("name", f"V{DIGEST}"), ("bytes", ">u4")]))
    names, lengths = records["name"], records["bytes"].astype(np.int64)
    # numbers in byte order, so that the shard's order is the one it was dealt by
    halves = np.frombuffer(names.tobytes(), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    by_name = np.lexsort([halves[:, 1], halves[:, 0]])
    new = (halves[by_name][1:] != halves[by_name][:-1]).any(axis=1)
    ids = np.empty(len(names), dtype=np.int64)
    ids[by_name] = np.concatenate([[0], np.cumsum(new)])[:len(names)]
    order, common = sorted_rows(ids, offset, conv)
    conv, size, begin = conv[order], size[order], offset[:-1][order]
    last = len(conv) - 1
    keys = [_path_keys(names[begin[r]:begin[r] + size[r]]) for r in (0, last)]
    stem = common[1:].min() if last else size[0]  # depth of the last node that holds the whole shard

    at_depth = [np.arange(len(conv))]  # rows with as many turns at least
    while len(rows := at_depth[-1][size[at_depth[-1]] >= len(at_depth)]):
        at_depth.append(rows)
    cost, leaf = np.zeros(len(conv), dtype=np.int64), np.zeros(len(conv), dtype=np.int64)  # of nodes that start in a row
    out = _Frames(shard)
    below = None  # the nodes one deeper: their first rows, which are boundary nodes, their columns
    for depth in range(len(at_depth) - 1, -1, -1):
        rows = at_depth[depth]
        start = np.flatnonzero((common[rows] < depth) | (np.arange(len(rows)) == 0)) if depth else np.array([0])
        first = rows[start]
        count = np.diff(np.append(start, len(rows)))
        end = rows[np.append(start[1:], len(rows)) - 1]  # a node's last row
        smallest = np.minimum.reduceat(conv[rows], start)
        length = lengths[begin[first] + depth - 1] if depth else np.zeros(1, dtype=np.int64)
        outer = [first == 0, end == last]
        edge = outer[0] | outer[1]
        children = np.zeros(len(first), dtype=np.int64)
        if below is not None:
            parent = np.searchsorted(first, below[0], side="right") - 1
            inner = ~below[1]
            np.add.at(children, parent, inner)  # boundary children are counted when they are recombined
            parent = parent[inner]
            out.add(**{c: v[inner] for c, v in below[2].items()}, parent_conv_id=smallest[parent], parent_key=[
                None if not e else keys[0][depth] if f else keys[1][depth] for e, f in zip(edge[parent].tolist(), outer[0][parent].tolist())
            ])
        cost[first] += np.where(edge, 0, (count - 1) * length)
        leaf[first] += ~edge & (children == 0)
        ending = np.add.reduceat((size[rows] == depth).astype(np.int64), start)  # they come first in their node
        digests = np.full(len(first), NO_ENDS.encode(), dtype=object)
        for k in np.flatnonzero((ending > 0) & ~edge):
            digests[k] = sha256(_joined(conv[first[k]:first[k] + ending[k]])).hexdigest().encode()
        nodes = {
            "depth": np.full(len(first), depth), "conv_id": smallest, "n_convs": count, "n_children": children, "n_leaves": np.add.reduceat(leaf[rows], start),
            "saved_tokens": np.add.reduceat(cost[rows], start), "bytes": length, "ends": digests,
        }
        for side in (0, 1):
            for k in np.flatnonzero(outer[side]):
                shared = bool(side and depth <= stem)
                key = {"key": [keys[side][depth]], "parent_key": [keys[side][depth - 1] if depth else None]}
                out.add(**{c: v[[k]] for c, v in nodes.items() if c != "ends"}, **key, kind=[PATH], side=[side], shared=[shared])
                if not shared:
                    ids_here = conv[first[k]:first[k] + ending[k]]
                    blocks = [_joined(ids_here[lo:lo + ENDS_BLOCK]) for lo in range(0, len(ids_here), ENDS_BLOCK)]
                    out.add(kind=[ENDS] * len(blocks), side=list(range(len(blocks))), key=key["key"] * len(blocks), ends=blocks)
        below = first, edge, nodes
        if out.size >= FRAME_ROWS:
            yield out.frame()
    yield out.frame()


class _Frames:
    """Rows of ``SHARD_ROWS`` gathered column by column; a column that isn't given is null, ``kind`` then is NODE."""

    def __init__(self, shard: int):
        self.shard, self.size, self.parts = shard, 0, []

    def add(self, **columns) -> None:
        n = len(next(iter(columns.values())))
        if n:
            self.parts.append((n, {"kind": [NODE] * n} | columns))
            self.size += n

    def frame(self) -> pd.DataFrame:
        names = [c.split()[0] for c in SHARD_ROWS.split(", ")]
        cells = {c: [v for n, part in self.parts for v in (part[c] if c in part else [None] * n)] for c in names if c != "shard"}
        kinds = {"int": "Int32", "long": "Int64", "boolean": "boolean"}
        frame = pd.DataFrame({
            c: pd.array([self.shard] * self.size if c == "shard" else cells[c], dtype=kinds.get(kind, object))
            for c, kind in (field.split() for field in SHARD_ROWS.split(", "))
        })
        self.size, self.parts = 0, []
        return frame


def _shard(batches):
    conv, seqs = [], []
    for batch in batches:
        conv.append(batch["conv_id"].to_numpy(np.int64))
        seqs += batch["seq"].tolist()
    if seqs:
        yield from shard_rows(np.concatenate(conv), seqs, TaskContext.get().partitionId())


def _digests(batches):
    """Digests of nodes whose blocks of ids come one after the other."""
    key = state = None
    for batch in batches:
        out = []
        for k, ends in zip(batch["key"], batch["ends"]):
            if k != key:
                if key is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, sha256(ends)
            else:
                state.update(b"," + ends)
        yield pd.DataFrame(out, columns=["key", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])


def recombined(shards: DataFrame) -> DataFrame:
    """One row per boundary node, from the PATH rows of all shards."""
    path = shards.where(F.col("kind") == PATH)
    place = F.struct("shard", "side")
    own = path.where(~F.col("shared")).groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("bytes").alias("bytes"), F.min(place).alias("owner"),
    )
    own = materialize(own, "trie-own")
    edges = own.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("edges"))
    own = own.join(edges, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("edges", F.lit(0)))
    own = materialize(
        own.withColumn("cost", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("leaf", (F.col("n_children") == 0).cast("long")),
        "trie-counted",
    )
    # every node's own figures on one path, summed from the deepest node up, then over the paths through a node
    along = Window.partitionBy("shard", "side").orderBy(F.col("depth").desc())
    mine = F.col("owner") == place
    on_path = path.select("key", "shard", "side").join(own.select("key", "depth", "owner", "cost", "leaf"), "key").select(
        "key", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(along).alias(c) for c in ("cost", "leaf")]
    )
    deeper = on_path.groupBy("key").agg(F.sum("cost").alias("more_cost"), F.sum("leaf").alias("more_leaves"))
    parents = own.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return own.join(deeper, "key").join(parents, "parent_key", "left").select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("saved_tokens") + F.col("more_cost")).alias("saved_tokens"),
    )


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the prefix trie of ``convs`` (conv_id long, unique; seq binary): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = convs.sparkSession
    convs = materialize(convs, "trie-sequences")
    turns = convs.agg(F.sum(F.octet_length("seq") / RECORD).alias("n")).first().n or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(turns // shard_turns) + 1)
    dealt = convs.repartitionByRange(shards, "seq", "conv_id")
    rows = materialize(dealt.mapInPandas(_shard, SHARD_ROWS), "trie-shards")
    edge = materialize(recombined(rows), "trie-boundary")

    blocks = rows.where(F.col("kind") == ENDS).select("key", "shard", F.col("side").alias("block"), "ends")
    ordered = blocks.repartition("key").sortWithinPartitions("key", "shard", "block").select("key", "ends")
    digests = ordered.mapInPandas(_digests, "key binary, ends_sha256 string")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    boundary = edge.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select(*out)
    nodes = rows.where(F.col("kind") == NODE).withColumn("ends_sha256", F.col("ends").cast("string"))
    inner = nodes.where(F.col("parent_key").isNull()).select(*out)
    hung = nodes.where(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(
        edge.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key"
    ).select(*out)
    return inner.unionByName(hung).unionByName(boundary)
