"""Connected components over (node, hub) membership rows.

Near-duplicate operators don't hand out all pairs of a group: each task reports which nodes
it found connected, as rows (node, hub), where a hub stands for one connected set of one task.
Two nodes are connected when a chain of shared hubs leads from one to the other.

Every round orders nodes by a hash of its own, gives each node the first node that shares a hub with it, and contracts
the graph to those. As the order is new each round, whatever the numbers of the nodes, a round is expected to leave at most
about half of the nodes that are still open (a chain in falling or rising order loses as many as a shuffled one), so
the rounds grow with the logarithm of the longest chain. In the end each component takes its smallest node.

A hub may hold a third of all nodes. Its rows are dealt by (hub, salt): what a hub's nodes say is
reduced per salt first, then per hub, and goes back to the rows over (hub, salt), so no join has a key with more than
a salt's share. Rounds are written to the checkpoint folder, and no component is ever gathered in one row or on the
driver: the loop reads only whether a row is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import materialize

#: Salts of a hub: so many at least, and enough that a hub of all rows has about SALT_ROWS a salt.
SALTS, SALT_ROWS = 64, 1_000_000


def _of_hub(rows: DataFrame, **aggs) -> DataFrame:
    """``rows(node, hub, salt, ...)`` with what the aggregates (each mergeable with itself) say about the row's hub."""
    part = materialize(rows.groupBy("hub", "salt").agg(*[agg(c).alias(c) for c, agg in aggs.items()]), "cc-part")
    whole = part.groupBy("hub").agg(*[agg(c).alias(c) for c, agg in aggs.items()])
    return rows.drop(*aggs).join(part.select("hub", "salt").join(whole, "hub"), ["hub", "salt"])


def component_roots(members: DataFrame, salts: int | None = None) -> DataFrame:
    """``members(node, hub)`` -> ``(node, root)``, one row per node; root = the component's smallest node.

    Repeated rows are harmless; an empty table gives an empty table; rows with a null node or
    hub are left out.
    """
    edges = materialize(members.select("node", "hub").dropna().distinct(), "cc-members")
    salts = salts or SALTS + edges.count() // SALT_ROWS
    salt = F.pmod(F.xxhash64(F.lit(-1), "node"), F.lit(salts)).cast("int")
    mapping, turn = None, 0
    while True:
        first = F.struct(F.xxhash64(F.lit(turn), "node").alias("place"), F.col("node").alias("root"))
        turn += 1
        heard = _of_hub(edges.withColumn("salt", salt).withColumn("first", first), first=F.min)
        step = materialize(heard.groupBy("node").agg(F.min("first").alias("first")).select("node", "first.root"), "cc-step")
        if mapping is None:
            mapping = step
        else:
            nxt = step.select(F.col("node").alias("root"), F.col("root").alias("nxt"))
            mapping = materialize(
                mapping.join(nxt, "root", "left").select("node", F.coalesce("nxt", "root").alias("root")),
                "cc-map",
            )
        contracted = materialize(edges.join(step, "node").select(F.col("root").alias("node"), "hub").distinct(), "cc-contracted")
        ends = contracted.withColumn("salt", salt).withColumn("lo", F.col("node")).withColumn("hi", F.col("node"))
        edges = materialize(_of_hub(ends, lo=F.min, hi=F.max).where("lo < hi").select("node", "hub"), "cc-members")
        if edges.isEmpty():
            break
    smallest = mapping.groupBy("root").agg(F.min("node").alias("least"))
    return mapping.join(smallest, "root").select("node", F.col("least").alias("root"))
