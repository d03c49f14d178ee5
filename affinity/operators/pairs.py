"""Pairs of members inside a group, without a hot group landing in one task.

The similarity and co-occurrence formulas sum a product over every pair of members that share
a group (users of an item, items of a user, positions of a user's log). The sum is symmetric,
so only unordered pairs are formed and the caller mirrors them after aggregation.

Skew: one group may hold a large share of all rows and its pair count grows with the square of
its size. Each group of ``n`` members is therefore cut into ``s = ceil(n / block_rows)`` blocks
by a hash of the member, and the join key is (group, block_a, block_b) with block_a <= block_b:
a left row of block ``a`` is copied to the ``s - a`` keys (a, b >= a) and a right row of block
``b`` to the ``b + 1`` keys (a <= b, b). Every unordered pair meets in exactly one key and no
key holds many more than ``block_rows`` members per side (a hash deals them, so blocks vary a little),
which spreads a hot group over ``s * (s + 1) / 2`` keys. Groups smaller than ``block_rows`` keep one key (s = 1) and are
joined as a plain equi-join. Rows are never dropped or capped.

Sums per pair (``pair_sums``) go by lists instead: every group's members are gathered in blocks of about ``block_rows``, each member
is sent its group's blocks as packed arrays, and both orders of a pair are unfolded and summed where the member's row lies. No pair
row is shuffled, spilled or mirrored; the shuffle holds a few bytes per pair. Members with very many pairs (``HEAVY_ROW_PAIRS``) are
summed apart, by both members of the pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators import lists
from affinity.session import materialize

DEFAULT_BLOCK_ROWS = 2048
# Pairs that one partition is dealt: about 200 MB of sums.
PARTITION_PAIRS = 2_000_000
# Members of more pairs don't have their row in one partition.
HEAVY_ROW_PAIRS = 16_000_000
# Narrow kinds of one column, and of a high byte and a low part of so many bits.
_ONE = {"whole1": "tinyint", "whole4": "int"}
_LOW_BITS = {"whole2": (8, "tinyint"), "whole3": (16, "smallint")}


def with_group_size(rows: DataFrame, group: str, name: str = "group_n") -> DataFrame:
    """Attach the member count of each group (an aggregate joined back, not a window).

    The count table has one row per group; Spark's adaptive planner broadcasts it when it is
    small at run time and shuffles it otherwise.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias(name))
    return rows.join(sizes, on=group, how="inner")


def block_pairs(
    rows: DataFrame,
    group: str,
    member: str,
    carry: list[str],
    group_size: str = "group_n",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    order: Column | None = None,
) -> DataFrame:
    """Every unordered pair of distinct rows inside each group, once.

    ``rows`` holds ``group``, ``member``, ``group_size`` and the ``carry`` columns. The result
    has ``group``, ``group_size`` and ``l_<c>``, ``r_<c>`` for ``member`` and each carried
    column, with the left row strictly before the right row in ``member`` order (or in the
    order of the ``order`` column expression when given, which must be unique in a group).
    """
    cols = [member] + [c for c in carry if c != member]
    s = F.greatest(F.lit(1), F.ceil(F.col(group_size) / F.lit(block_rows)).cast("int"))
    base = rows.select(
        group,
        group_size,
        *cols,
        *([order.alias("_ord")] if order is not None else []),
        s.alias("_s"),
    )
    spread = F.col("_ord") if order is not None else F.col(member)
    base = base.withColumn("_blk", F.pmod(F.xxhash64(spread), F.col("_s")).cast("int"))

    left = base.select(
        F.col(group),
        F.col(group_size),
        F.col("_blk").alias("_a"),
        F.explode(F.sequence(F.col("_blk"), F.col("_s") - 1)).alias("_b"),
        *[F.col(c).alias(f"l_{c}") for c in cols],
        *([F.col("_ord").alias("l__ord")] if order is not None else []),
    )
    right = base.select(
        F.col(group).alias("_g"),
        F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_ra"),
        F.col("_blk").alias("_rb"),
        *[F.col(c).alias(f"r_{c}") for c in cols],
        *([F.col("_ord").alias("r__ord")] if order is not None else []),
    )
    lk = F.col("l__ord") if order is not None else F.col(f"l_{member}")
    rk = F.col("r__ord") if order is not None else F.col(f"r_{member}")
    # Both sides are dealt to a named number of partitions: rows meet in pairs, so a partition's work isn't its size, and Spark
    # would otherwise merge partitions by size until a few tasks make all the pairs.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(n, group, "_a", "_b")
    right = right.repartition(n, "_g", "_ra", "_rb")
    joined = left.join(
        right.hint("merge"),  # a sorted side spills where a hash table could not
        (F.col(group) == F.col("_g")) & (F.col("_a") == F.col("_ra")) & (F.col("_b") == F.col("_rb")),
        "inner",
    )
    # Inside one block both orders of a pair meet: keep left < right. Across two blocks each
    # pair meets once in one orientation: normalise it so the smaller key is on the left.
    same = F.col("_a") == F.col("_b")
    kept = joined.where(~same | (lk < rk))
    swap = ~same & (lk > rk)
    out = [F.col(group), F.col(group_size)]
    for c in cols:
        out.append(F.when(swap, F.col(f"r_{c}")).otherwise(F.col(f"l_{c}")).alias(f"l_{c}"))
        out.append(F.when(swap, F.col(f"l_{c}")).otherwise(F.col(f"r_{c}")).alias(f"r_{c}"))
    return kept.select(*out)


def narrowest(rows: DataFrame, cols: list[str]) -> tuple[list[Column], Callable[[list], dict[str, str]]]:
    """Aggregates of the values of ``cols``, and what makes {column: kind} of the results, the kinds being the narrowest that hold every value exactly.

    ``whole<n>`` holds whole numbers of n bytes (of a ``sim``: of millionths). Columns that don't fit are left out and travel in halves.
    """
    types = dict(rows.dtypes)
    tried = [c for c in cols if types[c] in ("bigint", "double")]
    checks = []
    for c in tried:
        v, whole = F.col(c), _millionths(c)
        fits = (whole / F.lit(1e6) if c == "sim" else F.rint(v)) == v if types[c] == "double" else F.lit(True)
        checks += [F.min(whole), F.max(whole), F.bool_and(fits)]

    def kinds(found: list) -> dict[str, str]:
        out = {}
        for i, c in enumerate(tried):
            low, high, fits = found[3 * i:3 * i + 3]
            sizes = [n for n in (1, 2, 3, 4) if low is None or (fits is not False and low >= -(1 << (8 * n - 1)) and high < 1 << (8 * n - 1))]
            if sizes:
                out[c] = f"whole{sizes[0]}"
        return out

    return checks, kinds


def _millionths(name: str) -> Column:
    return F.round(F.col(name) * 1_000_000) if name == "sim" else F.col(name)


def pack(name: str, kind: str) -> list[Column]:
    """The columns a long or double travels in: halves, one of which is nearly always 0 and so compresses to nothing; bytes of a narrow kind."""
    c = F.col(name)
    if kind in _LOW_BITS:
        bits, low = _LOW_BITS[kind]
        whole = _millionths(name).cast("int")
        last = F.shiftright(F.shiftleft(whole, 32 - bits), 32 - bits).cast(low)
        return [F.shiftright(whole, bits).cast("tinyint").alias(f"{name}_0"), last.alias(f"{name}_1")]
    if kind in _ONE:
        return [_millionths(name).cast(_ONE[kind]).alias(f"{name}_0")]
    if kind == "bigint":
        low = F.shiftright(F.shiftleft(c, 32), 32)
        return [F.shiftright(c, 32).cast("int").alias(f"{name}_0"), low.cast("int").alias(f"{name}_1")]
    if kind == "double" and name == "sim":  # rounded to 6 places, as a rule: a whole number of millionths
        rough = F.when(F.abs(c) < 2000, F.round(c * 1_000_000).cast("int"))
        rough = F.when(rough / F.lit(1e6) == c, rough).when(c.isNotNull(), F.lit(0))
        return [rough.alias(f"{name}_0"), F.when(rough / F.lit(1e6) == c, F.lit(0.0)).otherwise(c).alias(f"{name}_1")]
    if kind == "double":
        rough = F.when(F.abs(c) < 1e30, c.cast("float")).when(c.isNotNull(), F.lit(0).cast("float"))
        return [rough.alias(f"{name}_0"), (c - rough.cast("double")).alias(f"{name}_1")]
    return [c.alias(f"{name}_0")]


def unpack(parts: list[Column], kind: str, name: str = "") -> Column:
    """The very value that ``pack`` split, or in its narrow kind."""
    if kind in _LOW_BITS or kind in _ONE:
        whole = parts[0].cast("int")
        if kind in _LOW_BITS:
            bits = _LOW_BITS[kind][0]
            whole = F.shiftleft(whole, bits).bitwiseOR(parts[1].cast("int").bitwiseAND(F.lit((1 << bits) - 1)))
        return whole / F.lit(1e6) if name == "sim" else whole
    if kind == "bigint":
        return F.shiftleft(parts[0].cast("bigint"), 32).bitwiseOR(parts[1].cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
    if kind == "double" and name == "sim":
        return parts[0] / F.lit(1e6) + parts[1]
    if kind == "double":
        return parts[0].cast("double") + parts[1]
    return parts[0]


def pack_lists(rows: DataFrame, by: list[str], cols: list[str], carry: list[str] = (), narrow: dict | None = None) -> DataFrame:
    """One row per ``by`` with an array ``_l`` of structs of the ``carry`` columns and arrays ``<c>_<i>`` of the packed ``cols``, in one order.

    ``narrow``: kinds that some columns travel in, from ``narrowest``.
    """
    kinds = dict(rows.dtypes) | (narrow or {})
    packed = [p for c in cols for p in pack(c, kinds[c])]
    names = [f"{c}_{i}" for c in cols for i in range(len(pack(c, kinds[c])))]
    entry = F.struct(*packed, F.struct(*carry).alias("_c")) if carry else F.struct(*packed)
    lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list(entry)).alias("_e"))  # equal values lie together, which compresses them
    own = [F.col("_e._c").alias("_l")] if carry else []
    return lists.select(*by, *own, *[F.col(f"_e.{n}").alias(n) for n in names])


def unpack_lists(df: DataFrame, keep: list, cols: list[str], kinds: dict, names: dict) -> DataFrame:
    """One row per entry: ``keep``, the place ``_at`` in the list and the columns ``cols``, named by ``names``."""
    first, *rest = [f"{c}_{i}" for c in cols for i in range(len(pack(c, kinds[c])))]
    flat = df.select(*keep, *rest, F.posexplode(first).alias("_at", "_first"))
    value = {first: F.col("_first")} | {n: F.get(F.col(n), F.col("_at")) for n in rest}
    out = [unpack([value[f"{c}_{i}"] for i in range(len(pack(c, kinds[c])))], kinds[c], c).alias(names[c]) for c in cols]
    return flat.select(*keep, "_at", *out)


def pair_sums(rows: DataFrame, group: str, member: str, mine: list[str] | dict[str, Column], theirs: list[str], aggs: list[Column], finish,
              group_size: str = "group_n", block_rows: int = DEFAULT_BLOCK_ROWS, by_place: bool = False, by_list=None) -> DataFrame:
    """``finish(sums, heavy)`` of the sums over all groups per ordered pair (a, b) of members.

    ``rows`` (written; read several times) holds ``group``, ``member``, ``group_size``, ``mine`` and ``theirs``; of a dict, ``mine`` is made where the
    rows are gathered. ``aggs`` are made of ``l_<c>`` for c in ``mine`` and ``r_<c>`` for c in ``theirs``. A pair has two different members, or with ``by_place`` two
    different rows. In ``finish``, all pairs of an ``a`` lie in one partition, so windows over ``a`` need no shuffle, except in
    a call with ``heavy`` set, for the members of more than ``HEAVY_ROW_PAIRS`` pairs. Where it is given and there are more than
    ``lists.FEW_ENTRIES`` pairs of long ids, ``by_list(sent, n)`` takes the place of the sums and ``finish`` for members of up to ``lists.KEY_ENTRIES`` pairs: rows
    of arrays ``a`` and ``l_<c>`` (with ``by_place`` ``own_place`` too) and the packed lists of ``theirs`` and the member that each ``a`` of the row gets, to
    be dealt by ``a`` to ``n`` tasks.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col(group).isNotNull() & F.col(member).isNotNull())
    kinds = dict(rows.dtypes)
    checks, narrow_kinds = narrowest(rows, [*theirs, member] if by_list is not None else [])
    total, largest, *found = rows.agg(F.sum(group_size), F.max(group_size), *checks).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # numbers of partitions go by the pairs, which no size in bytes tells; a list unfolds later than it is dealt
    n = max(least, -(-int(total or 0) // PARTITION_PAIRS))
    n_lists = max(least, -(-int(total or 0) // (2 * PARTITION_PAIRS)))
    by_list = by_list if kinds[member] == "bigint" and int(total or 0) > lists.FEW_ENTRIES else None
    most = HEAVY_ROW_PAIRS if by_list is None else min(HEAVY_ROW_PAIRS, lists.KEY_ENTRIES)
    block_rows = block_rows if by_list is None else min(block_rows, lists.LIST_ROWS)
    narrow = narrow_kinds(found) if by_list is not None else {}
    held = kinds | narrow
    blocked = (largest or 0) > block_rows
    if blocked:
        s = F.greatest(F.lit(1), F.ceil(F.col(group_size) / F.lit(block_rows)).cast("int"))
        spread = F.monotonically_increasing_id() if by_place else F.col(member)
        rows_b = rows.withColumn("_s", s).withColumn("_blk", F.pmod(F.xxhash64(spread), F.col("_s")).cast("int"))
        if by_place:
            rows_b = materialize(rows_b, "pair-blocks")  # a row's block is drawn once
    else:
        rows_b = rows.withColumn("_s", F.lit(1)).withColumn("_blk", F.lit(0))

    own = F.posexplode("_l").alias("_own", "_m")

    def gathered(df: DataFrame, deal: list[str], by: list[str]) -> DataFrame:
        # dealt by no constant column: Spark drops those from ``by`` and would deal the rows once more, to a number of partitions
        # by their size, of which each sends many times that
        dealt = df.repartition(n_lists, *deal)
        return pack_lists(dealt.withColumns(mine) if isinstance(mine, dict) else dealt, by, [*theirs, member], [member, *mine], narrow)

    packed = [f"{c}_{i}" for c in [*theirs, member] for i in range(len(pack(c, held[c])))]
    sent = gathered(rows_b.where("_s = 1"), [group], [group]).select(*packed, "_l")
    if blocked:
        parts = gathered(rows_b.where("_s > 1"), [group, "_blk"], [group, "_s", "_blk"])
        left = parts.select(group, F.col("_blk").alias("_from"), "_l", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_blk"))
        met = left.repartition(n, group, "_blk").join(parts.drop("_s", "_l").repartition(n, group, "_blk").hint("merge"), [group, "_blk"])
        # the place of a row in its own list, as the rows of another block have none
        sent = sent.withColumn("_same", F.lit(True)).unionByName(met.select(*packed, "_l", (F.col("_blk") == F.col("_from")).alias("_same")))
    whole = sent
    same = F.col("_same") if blocked else F.lit(True)
    sent = sent.select(*packed, same.alias("_same"), own)
    sent = sent.select(F.col(f"_m.{member}").alias("a"), *[F.col(f"_m.{c}").alias(f"l_{c}") for c in mine],
                       F.when(F.col("_same"), F.col("_own")).otherwise(-1).alias("_own"), *packed)

    def summed(df: DataFrame) -> DataFrame:
        names = {c: f"r_{c}" for c in theirs} | {member: "b"}
        flat = unpack_lists(df, ["a", *[f"l_{c}" for c in mine], "_own"], [*theirs, member], held, names)
        flat = flat.withColumns({names[c]: F.col(names[c]).cast(kinds[c]) for c in narrow})
        other = (F.col("_own") != F.col("_at")) if by_place else (F.col("a") != F.col("b"))
        return flat.where(other).groupBy("a", "b").agg(*aggs)

    def of_light(heavy: DataFrame | None) -> DataFrame:
        df = sent if heavy is None else sent.join(heavy, "a", "left_anti")
        if by_list is None:
            return finish(summed(df.repartition(n, "a")), False)
        if heavy is None:  # a list goes to Python once, not once per member
            place = F.transform("_l", lambda m, i: F.when(same, i).otherwise(-1)).alias("own_place")
            df = whole.select(F.col(f"_l.{member}").alias("a"), *[F.col(f"_l.{c}").alias(f"l_{c}") for c in mine], *([place] if by_place else []), *packed)
        else:
            place = F.array("_own").alias("own_place")
            df = df.select(F.array("a").alias("a"), *[F.array(f"l_{c}").alias(f"l_{c}") for c in mine], *([place] if by_place else []), *packed)
        return by_list(df, max(least, -(-int(total) // lists.TASK_ENTRIES)))

    if int(total or 0) <= most:
        return of_light(None)
    heavy = materialize(rows.groupBy(F.col(member).alias("a")).agg(F.sum(group_size).alias("_w"))
                        .where(F.col("_w") > most).select("a"), "heavy-rows")
    if heavy.isEmpty():
        return of_light(None)
    few = F.broadcast(heavy)  # at most one per ``most`` pairs
    light = of_light(few)
    return light.unionByName(finish(summed(sent.join(few, "a", "left_semi")), True))
