"""Top-N recommendation from neighbor tables.

UserCF (R7): score(u, i) = sum over u's top-K neighbors v that rated i of sim(u, v) * r_vi.
ItemCF (R9): score(u, j) = sum over u's items i having j among their top-K of sim(i, j) * r_ui.
Items the user already has in train are never recommended (J8). Lists keep N items per user.

Plan: restrict to eligible users first (semi-join, J7), expand (J9/J10), aggregate per
(user, item) with the seen items as marker rows of the same aggregate (J8), round, then a per-user
``row_number() <= N`` (WindowGroupLimit trims before the shuffle). A sweep over K cuts each list to the
rows above a floor before anything is sorted (``sweep_top_n``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.columns import prefixed_key
from affinity.operators import lists
from affinity.operators.pairs import DEFAULT_BLOCK_ROWS, HEAVY_ROW_PAIRS, PARTITION_PAIRS, narrowest, pack, pack_lists, unpack_lists
from affinity.session import materialize

SCORE_DIGITS = 6
# Neighbor lists are broadcast up to this many entries (about 40 bytes each, so 160 MB).
MAX_BROADCAST_ENTRIES = 4_000_000
# Users of more rows are not gathered by user: their candidates are dealt by (user, item).
HEAVY_USER_ROWS = 50_000
# Candidates of one user that are gathered in one row to find the user's floors.
LIST_ENTRIES = 1_000_000
# Groups per list entry that place a list's floor; more make it tighter.
FLOOR_GROUPS = 3


def eligible_users_ucf(topk: DataFrame, test: DataFrame) -> DataFrame:
    """Spark UserCF: test users that have at least one neighbor."""
    return test.select("user_id").distinct().join(topk.select("user_id").distinct(), "user_id", "left_semi")


def eligible_users_icf(train: DataFrame, test: DataFrame) -> DataFrame:
    """Spark ItemCF: test users that also have train rows."""
    return test.select("user_id").distinct().join(train.select("user_id").distinct(), "user_id", "left_semi")


def _unseen_sums(contributions: DataFrame, aggs: list, by: list) -> DataFrame:
    """Aggregates per (by, user_id, item_id) of the items a user hasn't seen.

    Seen items come as rows of their own with ``seen`` set, so that the aggregate drops them: an anti-join
    would sort the candidates, the largest table of the plan, once more.
    """
    sums = contributions.groupBy(*by, "user_id", "item_id").agg(*aggs, F.max("seen").alias("_seen"))
    return sums.where(F.col("_seen").isNull()).drop("_seen")


def _partitions(spark, contributions: int) -> int:
    """A number of partitions by the rows that lists unfold to, which no size in bytes tells."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-contributions // PARTITION_PAIRS))


def _user_contributions(train: DataFrame, topk: DataFrame, users: DataFrame | None, extra: list, most: int = HEAVY_ROW_PAIRS) -> list[DataFrame]:
    """(extra, user_id, item_id, sim, r, seen): the ratings of each user's neighbors and the user's own rows, from ``_user_lists``."""
    parts, kinds, _ = _user_lists(train, topk, users, extra, most)
    return [_user_unfolded(p, train, kinds, extra) for p in parts]


def _user_unfolded(part: DataFrame, train: DataFrame, kinds: dict, extra: list) -> DataFrame:
    flat = unpack_lists(part, [*extra, "user_id", "sim", "seen"], ["r", "item_id"], kinds, {"r": "r", "item_id": "item_id"}).drop("_at")
    return flat.withColumns({"r": F.col("r").cast("double"), "item_id": F.col("item_id").cast(dict(train.dtypes)["item_id"])})


def _user_lists(train: DataFrame, topk: DataFrame, users: DataFrame | None, extra: list, most: int = HEAVY_ROW_PAIRS,
                summed: bool = False) -> tuple[list[DataFrame], dict, int | None]:
    """(extra, user_id, sim, seen) with the packed ratings of each user's neighbors and of the user; the kinds they are packed in; and, where ``summed``
    lets it and there are many, the number of tasks to which ``lists.list_sums`` shall deal the first part, which it may sum.

    The neighbors' ratings travel as packed lists (in blocks of about ``DEFAULT_BLOCK_ROWS``) and are unfolded where the user's rows
    lie, so they are summed there and not shuffled one by one. Users who get more than ``most`` ratings stay apart and
    are dealt by (user, item).
    """
    spark = train.sparkSession
    nb = topk.select(*extra, "user_id", "neighbor_id", "sim")
    if users is not None:
        nb = nb.join(users, "user_id", "left_semi")
    nb = nb.select("*", F.lit(None).cast("int").alias("seen"))
    sizes = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rows"))
    # everyone is sent its own list as well, as the items seen
    kinds = {f.name: f.dataType for f in nb.schema.fields}
    itself = sizes.select(*[F.lit(None).cast(kinds[c]).alias(c) for c in extra], "user_id", F.col("user_id").alias("neighbor_id"),
                          F.lit(None).cast("double").alias("sim"), F.lit(1).alias("seen"))
    sent = materialize(nb.unionByName(itself).join(sizes.withColumnRenamed("user_id", "neighbor_id"), "neighbor_id"), "sent-lists")
    total = sent.agg(F.sum("_rows")).first()[0] or 0
    n = _partitions(spark, total)
    summed = summed and total > lists.FEW_ENTRIES and _long_ids(train)
    most = min(most, lists.KEY_ENTRIES) if summed else most
    block = F.pmod(F.xxhash64("item_id"), F.ceil(F.col("_rows") / (lists.LIST_ROWS if summed else DEFAULT_BLOCK_ROWS))).alias("_blk")
    theirs = train.join(sizes, "user_id").select(F.col("user_id").alias("neighbor_id"), block, "item_id", F.col("rating").cast("double").alias("r"))
    narrow = {}
    if summed:
        checks, narrow_kinds = narrowest(theirs, ["r", "item_id"])
        narrow = narrow_kinds(list(train.select("item_id", F.col("rating").cast("double").alias("r")).agg(*checks).first()))
    packed = pack_lists(theirs, ["neighbor_id", "_blk"], ["r", "item_id"], narrow=narrow).drop("_blk")
    met = sent.drop("_rows").repartition(n, "neighbor_id").join(packed.repartition(n, "neighbor_id"), "neighbor_id").drop("neighbor_id")
    tasks = max(_partitions(spark, 0), -(-total // lists.TASK_ENTRIES)) if summed else None

    def dealt(rows: DataFrame) -> DataFrame:
        return rows if summed else rows.repartition(n, "user_id")

    parts = [dealt(met)]
    if total > most:
        heavy = materialize(sent.groupBy("user_id").agg(F.sum("_rows").alias("_n")).where(F.col("_n") > most).select("user_id"), "heavy-users")
        if not heavy.isEmpty():
            few = F.broadcast(heavy)  # at most one per ``most`` ratings sent
            parts = [dealt(met.join(few, "user_id", "left_anti")), met.join(few, "user_id", "left_semi")]
    return parts, {"r": "double", "item_id": dict(train.dtypes)["item_id"]} | narrow, tasks


def _user_rows(part: DataFrame, extra: list) -> DataFrame:
    """The first part of ``_user_lists`` for ``lists.list_sums``."""
    return part.select(F.col("user_id").alias("key"), F.col("sim").alias("weight"), F.lit(None).cast("bigint").alias("mark_out"), F.col("seen").isNotNull().alias("all_out"),
                       *extra, *[c for c in part.columns if c.startswith(("r_", "item_id_"))])


def _long_ids(train: DataFrame) -> bool:
    kinds = dict(train.dtypes)
    return kinds["user_id"] == kinds["item_id"] == "bigint"


def _item_contributions(train: DataFrame, topk: DataFrame, users: DataFrame | None, extra: list, most: int | None = None) -> list[DataFrame]:
    """(user_id, item_id, sim, r, extra, seen) of every rated item's neighbors and of the rated items themselves.

    The neighbor lists (at most K entries an item) are joined whole to the rating rows and unfolded afterwards. Lists of
    ``MAX_BROADCAST_ENTRIES`` entries in all are broadcast to rating rows that were dealt by user; larger ones are packed, joined
    by item and dealt by user with the rows. Either way the unfolded rows, K times the ratings, are summed where they arise and
    never shuffled. Users of more than ``HEAVY_USER_ROWS`` rows (or ``most``, if that is
    less) stay apart: their rows are dealt by (user, item).
    """
    return _item_parts(*_item_inputs(train, topk, users, extra), extra, HEAVY_USER_ROWS if most is None else min(HEAVY_USER_ROWS, most))


def _item_inputs(train: DataFrame, topk: DataFrame, users: DataFrame | None, extra: list) -> tuple[DataFrame, DataFrame]:
    """The rating rows of the users with the number of each user's, and the neighbor lists, each written once."""
    mine = train.select("user_id", F.col("item_id").alias("src_id"), F.col("rating").cast("double").alias("r"))
    if users is not None:
        mine = mine.join(users, "user_id", "left_semi")
    sizes = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rows"))
    mine = materialize(mine.join(sizes, "user_id"), "rated-rows")
    return mine, materialize(topk.select("item_id", "neighbor_id", "sim", *extra), "item-neighbors")


def _item_parts(mine: DataFrame, topk: DataFrame, extra: list, bound: int) -> list[DataFrame]:
    spark = mine.sparkSession
    kinds = {f.name: f.dataType for f in topk.schema.fields}
    light, heavy = mine.where(F.col("_rows") <= bound), mine.where(F.col("_rows") > bound)
    entries = topk.count()  # the row counts of the written files
    out = []
    if entries <= MAX_BROADCAST_ENTRIES:
        entry = F.struct(F.col("neighbor_id").alias("item_id"), "sim", *extra, F.lit(None).cast("int").alias("seen"))
        lists = topk.groupBy(F.col("item_id").alias("src_id")).agg(F.collect_list(entry).alias("near"))
        itself = F.struct(F.col("src_id").alias("item_id"), *[F.lit(None).cast(kinds[c]).alias(c) for c in ("sim", *extra)], F.lit(1).alias("seen"))
        near = F.concat(F.array(itself), F.coalesce("near", F.array().cast(lists.schema["near"].dataType)))
        # a number of partitions is named, as these rows unfold: without one Spark would merge partitions by the size they have now
        for part in (light.repartition(_partitions(spark, 0), "user_id"), heavy):
            unfolded = part.join(F.broadcast(lists), "src_id", "left").select("user_id", "r", F.explode(near).alias("_n"))
            out.append(unfolded.select("user_id", "_n.*", "r"))
        return out
    cols = ["sim", *extra, "item_id"]
    near = topk.select(F.col("item_id").alias("src_id"), F.col("neighbor_id").alias("item_id"), "sim", *extra)
    types = dict(near.dtypes)
    lists = materialize(pack_lists(near, ["src_id"], cols), "packed-neighbors")
    n = _partitions(spark, mine.count() * (1 + -(-entries // max(1, lists.count()))))
    packed = [c for c in lists.columns if c != "src_id"]
    own = dict(zip([c for c in packed if c.startswith("item_id_")], pack("src_id", types["item_id"])))
    whole = []
    for c in packed:
        kind = lists.schema[c].dataType
        first = own[c] if c in own else F.lit(None).cast(kind.elementType)  # the rated item itself comes first
        whole.append(F.concat(F.array(first), F.coalesce(c, F.array().cast(kind))).alias(c))
    for part, dealt in ((light, True), (heavy, False)):
        met = part.repartition(n, "src_id").join(lists, "src_id", "left").select("user_id", "r", *whole)
        met = met.repartition(n, "user_id") if dealt else met
        flat = unpack_lists(met, ["user_id", "r"], cols, types, {c: c for c in cols})
        out.append(flat.withColumn("seen", F.when(F.col("_at") == 0, F.lit(1))).drop("_at"))
    return out


def _scores(contributions: list[DataFrame], aggs: list) -> DataFrame:
    """The sums of each part, dealt by user where the part is."""
    return reduce(DataFrame.unionByName, [_unseen_sums(c, aggs, []) for c in contributions])


def user_cf_scores(train: DataFrame, topk: DataFrame, users: DataFrame | None = None, normalize: bool = False) -> DataFrame:
    """(user_id, item_id, score) before the top-N cut; seen items removed.

    ``normalize`` divides by the summed similarity of the contributing neighbors (1e-10 when
    that sum is 0), the variant the reference computes and leaves commented out.
    """
    total, weight = F.sum(F.col("sim") * F.col("r")).alias("total"), F.sum("sim").alias("sim_sum")
    sums = _scores(_user_contributions(train, topk, users, []), [total, weight] if normalize else [total])
    return sums.select("user_id", "item_id", F.round(_score("total", "sim_sum", normalize), SCORE_DIGITS).alias("score")).where(
        F.col("score").isNotNull())


def item_cf_scores(train: DataFrame, topk: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, score) before the top-N cut; seen items removed."""
    sums = _scores(_item_contributions(train, topk, users, []), [F.sum(F.col("sim") * F.col("r")).alias("total")])
    return sums.select("user_id", "item_id", F.round("total", SCORE_DIGITS).alias("score"))


def _score(total: str, weight: str, normalize: bool):
    if not normalize:
        return F.col(total)
    return F.col(total) / F.when(F.col(weight) == 0, F.lit(1e-10)).otherwise(F.col(weight))


def _list_order(tie: str) -> list:
    if tie == "key_desc":
        return [F.col("score").desc(), prefixed_key("item_", "item_id").desc()]
    return [F.col("score").desc(), F.col("item_id").asc()]


def top_n(scores: DataFrame, n: int = 50, tie: str = "item_asc", by: tuple = ()) -> DataFrame:
    """Keep n items per user with their 1-based ``rank``.

    ``tie='item_asc'`` breaks equal scores by item id; ``tie='key_desc'`` by the string key
    'item_<id>' descending, as the UserCF script sorts (score, key) tuples in reverse (B8).
    ``row_number() <= n`` is planned as a WindowGroupLimit: every map task keeps n rows per
    user before the shuffle.
    """
    w = Window.partitionBy(*by, "user_id").orderBy(*_list_order(tie))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _list_keys(tie: str):
    """``_list_order`` as the fields of a struct that is sorted descending; a null item comes first by id."""
    if tie == "key_desc":
        return lambda score, item: [score, prefixed_key("item_", item)]
    return lambda score, item: [score, item.isNull(), F.bitwise_not(item)]


def _best_items(rows: DataFrame, cols: list[str], n: int, tie: str, tasks: int | None = None) -> DataFrame:
    """(user_id, item_id, score, rank) of the n best sums of each user, from rows for ``lists.list_sums``, which deals them to ``tasks`` if given."""
    best = lists.best_of(lists.list_sums(rows, cols, "item_id", k=n, digits=SCORE_DIGITS, n=tasks), "user_id", "item_id",
                         lambda total: F.round(total, SCORE_DIGITS), _list_keys(tie), n, {"score": "score"})
    return best.select("user_id", "item_id", "score", "rank")


def recommend_user_cf(train: DataFrame, topk: DataFrame, users: DataFrame | None = None, n: int = 50,
                      normalize: bool = False, tie: str = "key_desc") -> DataFrame:
    """R7 + W4. The candidates of users with up to ``lists.KEY_ENTRIES`` are summed and cut from lists, unless a score is a quotient of two sums."""
    if normalize:
        return top_n(user_cf_scores(train, topk, users, normalize), n, tie)
    parts, kinds, tasks = _user_lists(train, topk, users, [], summed=True)
    heavy = [_user_unfolded(p, train, kinds, []) for p in (parts[1:] if tasks else parts)]
    out = []
    if tasks:
        out.append(_best_items(_user_rows(parts[0], []), ["r"], n, tie, tasks).where(F.col("score").isNotNull()))
    if heavy:
        sums = _scores(heavy, [F.sum(F.col("sim") * F.col("r")).alias("total")])
        scores = sums.select("user_id", "item_id", F.round("total", SCORE_DIGITS).alias("score")).where(F.col("score").isNotNull())
        out.append(top_n(scores, n, tie))
    return reduce(DataFrame.unionByName, out)


def recommend_item_cf(train: DataFrame, topk: DataFrame, users: DataFrame | None = None, n: int = 50,
                      tie: str = "item_asc") -> DataFrame:
    """R9 + W3. The candidates of users with up to ``lists.KEY_ENTRIES`` are summed and cut from lists, where there are many of them."""
    mine, topk = _item_inputs(train, topk, users, [])
    total = [F.sum(F.col("sim") * F.col("r")).alias("total")]

    def plain(rows: DataFrame, bound: int) -> DataFrame:
        sums = _scores(_item_parts(rows, topk, [], bound), total)
        return top_n(sums.select("user_id", "item_id", F.round("total", SCORE_DIGITS).alias("score")), n, tie)

    listed = _item_lists(train, mine, topk, [])
    if listed is None:
        return plain(mine, HEAVY_USER_ROWS)
    rows, tasks, heavy = listed
    out = _best_items(rows, ["sim"], n, tie, tasks)
    return out if heavy.isEmpty() else out.unionByName(plain(heavy, 0))


def _item_lists(train: DataFrame, mine: DataFrame, topk: DataFrame, extra: list) -> tuple[DataFrame, int | None, DataFrame] | None:
    """J10 for ``lists.list_sums``: the rows of users with up to ``lists.KEY_ENTRIES`` candidates, the tasks they are yet to be dealt to (None: they lie by
    user) and the rating rows of the other users; None where there are few candidates."""
    rated = mine.count()  # the row count of the written file
    near = topk.select(F.col("item_id").alias("src_id"), F.col("neighbor_id").alias("item_id"), "sim", *extra)
    checks, narrow_kinds = narrowest(near, ["sim", "item_id"])
    entries, *found = near.agg(F.count(F.lit(1)), *checks).first()
    cols = ["sim", *extra, "item_id"]
    packed = materialize(pack_lists(near, ["src_id"], cols, narrow=narrow_kinds(found)), "packed-neighbors") if _long_ids(train) else None
    each = 1 + -(-entries // max(1, packed.count())) if packed is not None else 0
    if rated * each <= lists.FEW_ENTRIES:
        return None
    bound = min(HEAVY_USER_ROWS, lists.KEY_ENTRIES // (1 + (packed.agg(F.max(F.size("sim_0"))).first()[0] or 0)))
    light, heavy = mine.where(F.col("_rows") <= bound), mine.where(F.col("_rows") > bound)
    parts = _partitions(mine.sparkSession, rated * each)
    tasks = None
    if entries <= MAX_BROADCAST_ENTRIES:
        met = light.repartition(parts, "user_id").join(F.broadcast(packed), "src_id", "left")
    else:
        met = light.repartition(parts, "src_id").join(packed, "src_id", "left")
        tasks = max(_partitions(mine.sparkSession, 0), -(-rated * each // lists.TASK_ENTRIES))
    rows = met.select(F.col("user_id").alias("key"), F.col("r").alias("weight"), F.col("src_id").alias("mark_out"), F.lit(False).alias("all_out"),
                      *[c for c in packed.columns if c != "src_id"])
    return rows, tasks, heavy


def _k_bucket(ks: list[int]) -> F.Column:
    """The smallest k of the sweep that a neighbor of this rank belongs to."""
    ks = sorted(ks)
    expr = F.lit(None).cast("int")
    for k in reversed(ks):
        expr = F.when(F.col("rank") <= k, F.lit(k)).otherwise(expr)
    return expr


def sweep_scores(train: DataFrame, topk: DataFrame, ks: list[int], users: DataFrame | None = None,
                 mode: str = "item", normalize: bool = False) -> DataFrame:
    """(user_id, item_id, score_<k> ...), one score for every k of a sweep, from one top-max(k) table.

    Each candidate contribution is tagged with the smallest k its neighbor rank falls in and
    aggregated once per (user, item) with one conditional sum per k (scores for a larger k
    include the contributions of the smaller ones). Nothing is copied per k. A score is null where the
    pair has no contribution for that k.
    """
    return reduce(DataFrame.unionByName, _sweep_parts(train, topk, ks, users, mode, normalize))


def _sweep_parts(train: DataFrame, topk: DataFrame, ks: list[int], users: DataFrame | None, mode: str, normalize: bool = False,
                 most: int | None = None) -> list[DataFrame]:
    """The wide scores in parts: the first lies by user, a user in one partition; others have the heavy users. ``most``: candidates of a light one."""
    ks = sorted(ks)
    nb = topk.where(F.col("rank") <= max(ks)).withColumn("_kb", _k_bucket(ks))
    if mode == "item":
        parts = _item_contributions(train, nb, users, ["_kb"], *([most // max(ks)] if most else []))
    else:
        parts = _user_contributions(train, nb, users, ["_kb"], *([most] if most else []))
    return _sweep_sums(parts, ks, normalize)


def _sweep_sums(parts: list[DataFrame], ks: list[int], normalize: bool = False) -> list[DataFrame]:
    """The wide scores of each part of contributions."""
    aggs = []
    for k in ks:
        inside = F.col("_kb") <= k
        aggs.append(F.sum(F.when(inside, F.col("sim") * F.col("r"))).alias(f"_t{k}"))
        if normalize:
            aggs.append(F.sum(F.when(inside, F.col("sim"))).alias(f"_s{k}"))
    scores = [F.round(_score(f"_t{k}", f"_s{k}", normalize), SCORE_DIGITS).alias(f"score_{k}") for k in ks]
    sums = [_unseen_sums(p, aggs, []) for p in parts]
    return [wide.where(F.col(f"_t{max(ks)}").isNotNull()).select("user_id", "item_id", *scores) for wide in sums]


def sweep_lists(train: DataFrame, topk: DataFrame, ks: list[int], users: DataFrame | None = None, n: int = 50,
                tie: str = "item_asc", mode: str = "item") -> DataFrame:
    """``sweep_top_n`` of ``sweep_scores`` without writing the wide scores of users with up to ``LIST_ENTRIES`` candidates.

    Such a user's candidates are gathered where they were summed, which gives the floors at once; only rows at or above
    them leave the task. Heavier users go by written scores.
    """
    if mode == "item" and _long_ids(train):
        return _item_sweep(train, topk, sorted(ks), users, n, tie)
    if mode == "user" and _long_ids(train):
        return _user_sweep(train, topk, sorted(ks), users, n, tie)
    return _plain_sweep(_sweep_parts(train, topk, ks, users, mode, most=LIST_ENTRIES), ks, n, tie)


def _item_sweep(train: DataFrame, topk: DataFrame, ks: list[int], users: DataFrame | None, n: int, tie: str) -> DataFrame:
    """``sweep_lists`` of ItemCF. The candidates of users with up to ``lists.KEY_ENTRIES`` are summed for every k and cut from lists, where there are many."""
    nb = _stepped(topk, ks)
    mine, nb = _item_inputs(train, nb, users, ["_kb", "step"])

    def plain(rows: DataFrame, bound: int) -> DataFrame:
        return _plain_sweep(_sweep_sums(_item_parts(rows, nb.drop("step"), ["_kb"], bound), ks), ks, n, tie)

    listed = _item_lists(train, mine, nb, ["step"])
    if listed is None:
        return plain(mine, min(HEAVY_USER_ROWS, LIST_ENTRIES // max(ks)))
    rows, tasks, heavy = listed
    out = _step_lists(rows, ["sim"], ks, n, tie, tasks)
    return out if heavy.isEmpty() else out.unionByName(plain(heavy, 0))


def _user_sweep(train: DataFrame, topk: DataFrame, ks: list[int], users: DataFrame | None, n: int, tie: str) -> DataFrame:
    """``sweep_lists`` of UserCF, in the same way."""
    parts, kinds, tasks = _user_lists(train, _stepped(topk, ks), users, ["_kb", "step"], LIST_ENTRIES, summed=True)
    wide = _sweep_sums([_user_unfolded(p, train, kinds, ["_kb"]) for p in (parts[1:] if tasks else parts)], ks)
    if not tasks:
        return _plain_sweep(wide, ks, n, tie)
    out = _step_lists(_user_rows(parts[0], ["step"]), ["r"], ks, n, tie, tasks)
    return reduce(DataFrame.unionByName, [sweep_top_n(h, ks, n, tie) for h in wide], out)


def _stepped(topk: DataFrame, ks: list[int]) -> DataFrame:
    """The neighbors of the sweep with the smallest k that each belongs to, ``_kb``, and its place among the ``ks``, ``step``."""
    step = reduce(lambda e, i: F.when(F.col("rank") <= ks[i], F.lit(i)).otherwise(e), reversed(range(len(ks))), F.lit(None))
    return topk.where(F.col("rank") <= max(ks)).withColumns({"_kb": _k_bucket(ks), "step": step.cast("tinyint")})


def _step_lists(rows: DataFrame, cols: list[str], ks: list[int], n: int, tie: str, tasks: int | None) -> DataFrame:
    """(k, user_id, item_id, score, rank) of the n best sums of each user for every k, from rows for ``lists.list_sums``."""
    sums = lists.list_sums(rows, cols, "item_id", k=n, digits=SCORE_DIGITS, n=tasks, steps=len(ks))
    best = lists.best_of(sums, "user_id", "item_id", lambda total: F.round(total, SCORE_DIGITS), _list_keys(tie), n, {"score": "score"}, by=("step",))
    k = F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("step") + 1)
    return best.select(k.alias("k"), "user_id", "item_id", "score", "rank")


def _plain_sweep(parts: list[DataFrame], ks: list[int], n: int, tie: str) -> DataFrame:
    """The lists from wide scores, of which the first part lies by user."""
    light, *heavy = parts
    cols = [f"score_{k}" for k in sorted(ks)]
    lists = light.groupBy("user_id").agg(F.collect_list(F.struct("item_id", *cols)).alias("_rows"))
    floors = [F.get(F.sort_array(F.col(f"_rows.{c}"), asc=False), F.lit(n - 1)).alias(f"_floor_{c}") for c in cols]
    placed = lists.select("user_id", "_rows", *floors).select("user_id", *[f"_floor_{c}" for c in cols], F.inline("_rows"))
    out = top_n(_reached(placed, ks), n, tie, by=("k",))
    return reduce(DataFrame.unionByName, [sweep_top_n(h, ks, n, tie) for h in heavy], out)


def list_floors(wide: DataFrame, cols: list[str], n: int) -> DataFrame:
    """(user_id, one floor per column): no row of a user's n best has less than the floor (null: fewer rows may be known).

    The items of a user are dealt to ``FLOOR_GROUPS`` times n groups by a hash. The n-th largest of the groups' maxima
    is reached by n different items, so it bounds the n-th best score from below. Maxima combine before
    their shuffle and a user has a bounded number of them, so no user's rows are gathered or sorted.
    """
    group = F.pmod(F.xxhash64("item_id"), F.lit(FLOOR_GROUPS * n)).alias("_g")
    maxima = wide.groupBy("user_id", group).agg(*[F.max(c).alias(c) for c in cols])
    largest = [F.get(F.sort_array(F.collect_list(c), asc=False), F.lit(n - 1)).alias(f"_floor_{c}") for c in cols]  # nulls aren't collected
    return maxima.groupBy("user_id").agg(*largest)


def sweep_top_n(wide: DataFrame, ks: list[int], n: int = 50, tie: str = "item_asc") -> DataFrame:
    """(k, user_id, item_id, score, rank), the n best items of every user for every k, from the wide scores.

    The wide rows are written once and read twice: for the floors, and for the rows at or above their list's floor. Only these are
    unfolded to (k, user, item) and sorted; a few more than n a list, however many candidates there are.
    """
    ks = sorted(ks)
    wide = materialize(wide, "sweep-scores")
    cols = [f"score_{k}" for k in ks]
    floors = list_floors(wide, cols, n)
    return top_n(_reached(wide.join(floors, "user_id"), ks), n, tie, by=("k",))


def _reached(placed: DataFrame, ks: list[int]) -> DataFrame:
    """(k, user_id, item_id, score) of the wide rows at or above their list's floor."""
    reached = [
        F.when(F.col(f"score_{k}") >= F.coalesce(f"_floor_score_{k}", f"score_{k}"), F.struct(F.lit(k).alias("k"), F.col(f"score_{k}").alias("score")))
        for k in sorted(ks)
    ]
    kept = placed.select("user_id", "item_id", F.explode(F.array_compact(F.array(*reached))).alias("_ks"))
    return kept.select("_ks.k", "user_id", "item_id", "_ks.score")


def with_hits(recs: DataFrame, test: DataFrame) -> DataFrame:
    """Recommendation rows with ``hit`` (1 if the item is in the user's test set) and the
    test rating (0 when absent), for the metrics."""
    t = test.select("user_id", "item_id", F.col("rating").cast("double").alias("test_rating"))
    return (
        recs.join(t, ["user_id", "item_id"], "left")
        .withColumn("hit", F.col("test_rating").isNotNull().cast("int"))
        .withColumn("test_rating", F.coalesce("test_rating", F.lit(0.0)))
    )


__all__ = [
    "eligible_users_ucf", "eligible_users_icf", "user_cf_scores", "item_cf_scores", "top_n",
    "recommend_user_cf", "recommend_item_cf", "sweep_scores", "list_floors", "sweep_top_n", "sweep_lists", "with_hits",
]
