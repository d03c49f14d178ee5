"""User-user and item-item similarity by a pair self-join.

Formula (both directions of the reference): for entities a, b sharing context groups g,

    sim(a, b) = sum_g r_ga * r_gb / log1p(n_g)^p  /  (||a|| * ||b||)

with n_g the size of group g in train, ||a|| = sqrt(sum of a's squared ratings) over all of a's
train rows (groups of one included, behaviour B2), and 0 when a norm is 0. p is 2 in the
Spark scripts and 1 in the pandas ones; p = 0 is the undamped variant. Item similarity is then
divided by the largest similarity of its row (W2) before the top-K cut.

Plan: group sizes by aggregate + join, singleton groups dropped (P10), norms and damping divided
into the ratings, each entity sent the packed lists of its groups (see ``pairs.pair_sums``), both orders
of a pair summed and ranked where the entity's row lies. Scores are
rounded before any ranking so that ties break on the id, not on float summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.columns import damping, safe_div
from affinity.operators import lists
from affinity.operators.pairs import DEFAULT_BLOCK_ROWS, block_pairs, pair_sums, with_group_size
from affinity.session import materialize

SCORE_DIGITS = 6
RANK_DIGITS = 10  # for similarities that are ranked before they are normalized


def norms(ratings: DataFrame, entity: str, rating: str = "rating") -> DataFrame:
    """||entity|| = sqrt(sum(r^2)) over all of its rows."""
    r = F.col(rating).cast("double")
    return ratings.groupBy(entity).agg(F.sqrt(F.sum(r * r)).alias("norm"))


def pair_products(
    ratings: DataFrame,
    entity: str,
    context: str,
    damping_power: float = 2,
    rating: str = "rating",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """(a, b, dot, n_common) for a < b sharing at least one context group."""
    rows = ratings.select(context, entity, F.col(rating).cast("double").alias("r"))
    rows = with_group_size(rows, context).where(F.col("group_n") > 1)
    pairs = block_pairs(rows, group=context, member=entity, carry=["r"], block_rows=block_rows)
    prod = (F.col("l_r") * F.col("r_r")) / damping("group_n", damping_power)
    return pairs.groupBy(F.col(f"l_{entity}").alias("a"), F.col(f"r_{entity}").alias("b")).agg(
        F.sum(prod).alias("dot"), F.count(F.lit(1)).alias("n_common")
    )


def cosine_pairs(
    ratings: DataFrame,
    entity: str,
    context: str,
    damping_power: float = 2,
    rating: str = "rating",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    finish=lambda cos, heavy: cos,
    by_list=None,
) -> DataFrame:
    """``finish(cos, heavy)`` of (a, b, sim, n_common), both orders of each pair: its damped cosine (see ``pairs.pair_sums``).

    A rating is divided by its entity's norm, and on one side by the damping, before it is multiplied, so the cosine is
    the plain sum of the products: nothing is joined to the pair table. An entity of norm 0 has 0.
    """
    r = F.col(rating).cast("double")
    rows = ratings.select(context, entity, r.alias("r"))
    squares = ratings.groupBy(entity).agg(F.sum(r * r).alias("sq"))
    rows = with_group_size(rows, context).where(F.col("group_n") > 1).join(squares, entity)
    x = safe_div(F.col("r"), F.sqrt("sq") * damping("group_n", damping_power))  # no two alike: made where it is used, not written or dealt
    # the groups' sizes and their lists read these rows: written once
    rows = materialize(rows.select(context, entity, "group_n", "r", "sq"), "cosine-rows")
    product = F.col("l_x") * safe_div(F.col("r_r"), F.sqrt("r_sq"))
    aggs = [F.sum(product).alias("sim"), F.count(F.lit(1)).alias("n_common")]
    return pair_sums(rows, context, entity, {"x": x}, ["r", "sq"], aggs, finish, block_rows=block_rows, by_list=by_list)


def similarity(
    ratings: DataFrame,
    entity: str,
    context: str,
    damping_power: float = 2,
    normalize: bool = False,
    rating: str = "rating",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """All ordered pairs (entity, neighbor_id, sim, n_common); sim rounded to 6 places."""

    def finish(cos: DataFrame, heavy: bool) -> DataFrame:
        if normalize:
            # Divide by the row maximum (0 when it is 0). A row lies in one partition, where a window needs no shuffle; a
            # heavy row has its maximum joined, from an aggregate with map-side partial maxima
            if heavy:
                cos = materialize(cos, "pair-cosine")
                cos = cos.join(cos.groupBy("a").agg(F.max("sim").alias("largest")), "a")
            else:
                cos = cos.withColumn("largest", F.max("sim").over(Window.partitionBy("a")))
            cos = cos.withColumn("sim", safe_div(F.col("sim"), F.col("largest")))
        return cos.select(F.col("a").alias(entity), F.col("b").alias("neighbor_id"), F.round("sim", SCORE_DIGITS).alias("sim"), "n_common")

    def by_list(sent: DataFrame, n: int) -> DataFrame:
        """The same from lists (see ``lists.list_sums``), which know the largest of a row."""
        cos = lists.list_sums(_cosine_rows(sent), ["r", "sq"], entity, lists.normed_value, n=n, flat=True)
        sim = safe_div(F.col("sum"), F.col("best")) if normalize else F.col("sum")
        return cos.select(F.col("key").alias(entity), F.col("member").alias("neighbor_id"), F.round(sim, SCORE_DIGITS).alias("sim"),
                          F.col("count").alias("n_common"))

    return cosine_pairs(ratings, entity, context, damping_power, rating, block_rows, finish, by_list)


def _cosine_rows(sent: DataFrame) -> DataFrame:
    """``pairs.pair_sums``'s rows of ``cosine_pairs`` for ``lists.list_sums``."""
    return sent.select(F.col("a").alias("key"), F.col("l_x").alias("weight"), F.lit(False).alias("all_out"), *[c for c in sent.columns if c not in ("a", "l_x")])


def neighbors(
    ratings: DataFrame,
    entity: str,
    context: str,
    k: int,
    damping_power: float = 2,
    normalize: bool = False,
    rating: str = "rating",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """The k best neighbors per entity (W1, W2): (entity, neighbor_id, sim, n_common, rank).

    Dividing a row by its maximum keeps its order, so rows are cut to k first and only the k
    survivors are divided (by the largest of the list, which is the row's): nothing the size of
    the pair table is written, joined or normalized. Order: similarity (10 places when it is
    normalized afterwards, else the 6 of the result) descending, then neighbor id ascending.
    """

    def finish(cos: DataFrame, heavy: bool) -> DataFrame:
        cos = cos.select(F.col("a").alias(entity), F.col("b").alias("neighbor_id"), "sim", "n_common")
        if not normalize:
            return top_k(cos.withColumn("sim", F.round("sim", SCORE_DIGITS)), entity, k).select(entity, "neighbor_id", "sim", "n_common", "rank")
        best = top_k(cos.withColumn("_order", F.round("sim", RANK_DIGITS)), entity, k, score="_order")
        largest = F.max("sim").over(Window.partitionBy(entity))  # at most k rows per entity
        return best.select(entity, "neighbor_id",
                           F.round(safe_div(F.col("sim"), largest), SCORE_DIGITS).alias("sim"), "n_common", "rank")

    digits = RANK_DIGITS if normalize else SCORE_DIGITS

    def by_list(sent: DataFrame, n: int) -> DataFrame:
        """The same from lists (see ``lists.list_sums``), a row's pairs summed and cut to about k in one go."""
        summed = lists.list_sums(_cosine_rows(sent), ["r", "sq"], entity, lists.normed_value, k, digits, n)
        best = lists.best_of(summed, entity, "neighbor_id", lambda s: F.round(s, digits), lambda s, m: [s, F.bitwise_not(m)], k,
                             {"score": "_order", "sum": "sim", "count": "n_common"})
        sim = F.round(safe_div(F.col("sim"), F.col("best")), SCORE_DIGITS) if normalize else F.col("_order")
        return best.select(entity, "neighbor_id", sim.alias("sim"), "n_common", "rank")

    return cosine_pairs(ratings, entity, context, damping_power, rating, block_rows, finish, by_list)


def user_neighbors(train: DataFrame, k: int, damping_power: float = 2, **kw) -> DataFrame:
    """R1 + W1: the k most similar users of each user."""
    return neighbors(train, "user_id", "item_id", k, damping_power, normalize=False, **kw)


def item_neighbors(train: DataFrame, k: int, damping_power: float = 2, normalize: bool = True, **kw) -> DataFrame:
    """R2 + W2: the k most similar items of each item, divided by the row's largest similarity."""
    return neighbors(train, "item_id", "user_id", k, damping_power, normalize=normalize, **kw)


def user_similarity(train: DataFrame, damping_power: float = 2, **kw) -> DataFrame:
    """Users are similar when they rate the same items; items damp by their popularity."""
    return similarity(train, "user_id", "item_id", damping_power, normalize=False, **kw)


def item_similarity(train: DataFrame, damping_power: float = 2, normalize: bool = True, **kw) -> DataFrame:
    """R2: items are similar when the same users rate them; users damp by their activity."""
    return similarity(train, "item_id", "user_id", damping_power, normalize=normalize, **kw)


def top_k(sims: DataFrame, entity: str, k: int, score: str = "sim", neighbor: str = "neighbor_id") -> DataFrame:
    """The k best neighbors per entity, score descending then neighbor id ascending.

    ``row_number() <= k`` is planned as a WindowGroupLimit, which trims each map task to k rows
    per entity before the shuffle, so a heavy entity never ships its whole candidate list.
    """
    w = Window.partitionBy(entity).orderBy(F.col(score).desc(), F.col(neighbor).asc())
    return sims.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def common_item_similarity(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
                           rating: str = "rating", min_common: int = 1, digits: int = 5,
                           block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Cosine over common items only, norms restricted to those items, self-pairs kept.

    Every ordered pair of users with at least ``min_common`` common items, rounded half-even
    to ``digits`` places as numpy does. A user paired with itself scores 1 (0 if all its
    ratings are 0).
    """
    rows = ratings.select(F.col(item).alias("g"), F.col(user).alias("u"), F.col(rating).cast("double").alias("r"))
    # read by the pairs and by the self-pairs: write once
    rows = materialize(with_group_size(rows, "g"), "common-item-rows")
    aggs = [
        F.sum(F.col("l_r") * F.col("r_r")).alias("xy"),
        F.sum(F.col("l_r") * F.col("l_r")).alias("xx"),
        F.sum(F.col("r_r") * F.col("r_r")).alias("yy"),
        F.count(F.lit(1)).alias("n_common"),
    ]

    def finish(sums: DataFrame, heavy: bool) -> DataFrame:
        cos = F.bround(safe_div(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))), digits)
        return sums.where(F.col("n_common") >= min_common).select(
            F.col("a").alias(user), F.col("b").alias("neighbor_id"), cos.alias("sim"), "n_common")

    both = pair_sums(rows, "g", "u", ["r"], ["r"], aggs, finish, block_rows=block_rows)
    selfs = rows.groupBy(F.col("u").alias(user)).agg(
        F.sum(F.col("r") * F.col("r")).alias("xx"), F.count(F.lit(1)).alias("n_common")
    ).where(F.col("n_common") >= min_common).select(
        user, F.col(user).alias("neighbor_id"),
        F.bround(safe_div(F.col("xx"), F.col("xx")), digits).alias("sim"), "n_common",
    )
    return both.unionByName(selfs)


def invert(sims: DataFrame, entity: str = "user_id", neighbor: str = "neighbor_id") -> DataFrame:
    """Re-key each similarity row on the neighbor: (neighbor -> (entity, sim))."""
    return sims.select(F.col(neighbor).alias("key_id"), F.col(entity).alias("source_id"), "sim")


def neighbor_ratings(sims: DataFrame, ratings: DataFrame, entity: str = "user_id",
                     neighbor: str = "neighbor_id", item: str = "item_id", rating: str = "rating") -> DataFrame:
    """The inverted similarity joined with the neighbor's own ratings."""
    inv = invert(sims, entity, neighbor)
    r = ratings.select(F.col(entity).alias("key_id"), item, rating)
    return inv.join(r, "key_id")
