"""List metrics.

* precision@N = hits / (N * users)  - N stays fixed even for shorter lists (E1)
* recall@N    = hits / test rows of the evaluated users (E2)
* coverage    = distinct recommended items / distinct catalog items (E3); catalog = train items
                of the evaluated users (Spark scripts) or test items of train users (pandas)
* popularity  = mean ln(1 + pop(item)) over all recommended slots (E4)
* AP / MAP    = mean over hits of (hits so far / rank); 0 for a user without hits (E6, E7)
* DCG         = sum (2^rating - 1) / log2(rank + 1) with the item's test rating, 0 when absent;
                the reference's "ndcg" is the mean DCG without an ideal normaliser (E8, E9)

All four list metrics come out of one global aggregate over a tagged union of the inputs (no
join of one-row results, no driver loop). A user with an empty list still counts in the
denominators because the user set is its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.columns import safe_div

DIGITS = 6


def item_popularity(train: DataFrame, distinct_users: bool = True) -> DataFrame:
    """A7 (distinct users per item, Spark scripts) or A8 (rows per item, pandas scripts)."""
    n = F.countDistinct("user_id") if distinct_users else F.count(F.lit(1))
    return train.groupBy("item_id").agg(n.alias("popularity"))


def _catalog(train: DataFrame, test: DataFrame, users: DataFrame, catalog: str) -> DataFrame:
    if catalog == "train":
        return train.join(users, "user_id", "left_semi").select("item_id")
    # pandas scripts: test items of users that have train rows
    return test.join(train.select("user_id"), "user_id", "left_semi").select("item_id")


def _scored_recs(recs: DataFrame, train: DataFrame, test: DataFrame, users: DataFrame,
                 pop_distinct: bool, by: list[str]) -> DataFrame:
    """(by, item_id, n, hit, lp): how often each item is recommended, its hits and its summed log popularity.

    The lists are counted per item, by tasks before they are dealt, so the popularity meets one row per item (and group).
    """
    pop = item_popularity(train, pop_distinct)
    tst = test.join(users, "user_id", "left_semi").select("user_id", "item_id", F.lit(1).alias("_t"))
    counted = recs.select(*by, "user_id", "item_id").join(tst, ["user_id", "item_id"], "left").groupBy(*by, "item_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("_t").alias("hit"))
    lp = F.col("n") * F.log1p(F.coalesce("popularity", F.lit(0)).cast("double"))
    return counted.join(pop, "item_id", "left").select(*by, "item_id", "n", "hit", lp.alias("lp"))


def _fixed_inputs(train: DataFrame, test: DataFrame, users: DataFrame, catalog: str) -> DataFrame:
    """(kind, items, n): one row each for the test rows (t), the catalog (c) and the users (u)."""
    t = test.join(users, "user_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    c = _catalog(train, test, users, catalog).distinct().agg(F.count("item_id").alias("items"), F.count(F.lit(1)).alias("n"))  # a null item is none
    u = users.agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint").alias("items")
    return (t.select(F.lit("t").alias("kind"), none, "n").unionByName(c.select(F.lit("c").alias("kind"), "items", "n"))
            .unionByName(u.select(F.lit("u").alias("kind"), none, "n")))


def metric_inputs(recs: DataFrame, train: DataFrame, test: DataFrame, users: DataFrame,
                  catalog: str = "train", pop_distinct: bool = True) -> DataFrame:
    """The tagged union the metrics aggregate over. ``recs`` has user_id, item_id. Null items count as rows, not as items."""
    r = _scored_recs(recs, train, test, users, pop_distinct, []).select(
        F.lit("r").alias("kind"), F.col("item_id").isNotNull().cast("bigint").alias("items"), "n", "hit", "lp")
    others = _fixed_inputs(train, test, users, catalog)
    return r.unionByName(others.select("*", F.lit(None).cast("bigint").alias("hit"), F.lit(None).cast("double").alias("lp")))


def list_metrics(recs: DataFrame, train: DataFrame, test: DataFrame, users: DataFrame, n: int = 50,
                 catalog: str = "train", pop_distinct: bool = True) -> DataFrame:
    """One row: precision, recall, coverage, popularity (E5)."""
    return metric_inputs(recs, train, test, users, catalog, pop_distinct).agg(*_metric_columns(n))


def _metric_columns(n: int):
    kind = F.col("kind")
    hits = F.sum(F.when(kind == "r", F.col("hit")))
    n_users, n_test, n_rec = (F.coalesce(F.sum(F.when(kind == k, F.col("n"))), F.lit(0)) for k in "utr")
    rec_items, cat_items = (F.coalesce(F.sum(F.when(kind == k, F.col("items"))), F.lit(0)) for k in "rc")
    pop = F.sum(F.when(kind == "r", F.col("lp")))
    return [
        F.round(safe_div(F.coalesce(hits, F.lit(0)).cast("double"), n_users * F.lit(n)), DIGITS).alias("precision"),
        F.round(safe_div(F.coalesce(hits, F.lit(0)).cast("double"), n_test), DIGITS).alias("recall"),
        F.round(safe_div(rec_items.cast("double"), cat_items), DIGITS).alias("coverage"),
        F.round(safe_div(F.coalesce(pop, F.lit(0.0)), n_rec), DIGITS).alias("popularity"),
    ]


def sweep_metrics(recs_by_k: DataFrame, train: DataFrame, test: DataFrame, users: DataFrame, ks: list[int],
                  n: int = 50, catalog: str = "train", pop_distinct: bool = True) -> DataFrame:
    """One metric row per ``k`` of ``recs_by_k(k, user_id, item_id, ...)``.

    The recommendation part is grouped by k. The k-independent parts (test rows, catalog,
    user count) are aggregated once into one row, which is exploded over the k values of the
    sweep and merged with the per-k row by a final ``groupBy(k)``: no join, no copy of the
    input rows per k.
    """
    per_k = (
        _scored_recs(recs_by_k, train, test, users, pop_distinct, ["k"])
        .groupBy("k")
        .agg(
            F.sum("hit").alias("hits"),
            F.sum("n").alias("n_rec"),
            F.count("item_id").alias("rec_items"),
            F.sum("lp").alias("pop"),
        )
    )
    fixed = (
        _fixed_inputs(train, test, users, catalog)
        .agg(
            F.sum(F.when(F.col("kind") == "u", F.col("n"))).alias("n_users"),
            F.sum(F.when(F.col("kind") == "t", F.col("n"))).alias("n_test"),
            F.sum(F.when(F.col("kind") == "c", F.col("items"))).alias("cat_items"),
        )
        .select(F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k"), "n_users", "n_test", "cat_items")
    )
    none = F.lit(None).cast("bigint")
    a = per_k.select("k", "hits", "n_rec", "rec_items", "pop", none.alias("n_users"), none.alias("n_test"),
                     none.alias("cat_items"))
    b = fixed.select("k", none.alias("hits"), none.alias("n_rec"), none.alias("rec_items"),
                     F.lit(None).cast("double").alias("pop"), "n_users", "n_test", "cat_items")
    merged = a.unionByName(b).groupBy("k").agg(*[F.max(c).alias(c) for c in
                                                 ["hits", "n_rec", "rec_items", "pop", "n_users", "n_test", "cat_items"]])
    # a k without any recommendation scores 0
    out = merged.select("k", *[F.coalesce(c, F.lit(0)).alias(c) for c in merged.columns if c != "k"])
    return out.select(
        "k",
        F.round(safe_div(F.col("hits").cast("double"), F.col("n_users") * F.lit(n)), DIGITS).alias("precision"),
        F.round(safe_div(F.col("hits").cast("double"), F.col("n_test")), DIGITS).alias("recall"),
        F.round(safe_div(F.col("rec_items").cast("double"), F.col("cat_items")), DIGITS).alias("coverage"),
        F.round(safe_div(F.col("pop"), F.col("n_rec")), DIGITS).alias("popularity"),
    )


def average_precision(recs_hits: DataFrame, users: DataFrame) -> DataFrame:
    """E6 per user: recs_hits(user_id, rank, hit). Users without a list or a hit get 0.

    A hit's running count is its place among the user's hits, so only hits (at most N a user) are dealt by user and sorted.
    """
    run = recs_hits.where(F.col("hit") == 1).withColumn("_cum", F.row_number().over(Window.partitionBy("user_id").orderBy("rank")))
    per = run.groupBy("user_id").agg(F.sum(F.col("_cum") / F.col("rank")).alias("_s"), F.sum("hit").alias("_h"))
    return users.join(per, "user_id", "left").select(
        "user_id", F.round(safe_div(F.coalesce("_s", F.lit(0.0)), F.coalesce("_h", F.lit(0))), DIGITS).alias("ap")
    )


def dcg(recs_rated: DataFrame, users: DataFrame) -> DataFrame:
    """E8 per user: recs_rated(user_id, rank, test_rating); users without a list get 0."""
    g = (F.pow(F.lit(2.0), F.col("test_rating")) - 1) / F.log2(F.col("rank") + 1)
    # a rating of 0 adds 0: such rows are not dealt by user
    per = recs_rated.where(F.col("test_rating") != 0).groupBy("user_id").agg(F.sum(g).alias("_d"))
    return users.join(per, "user_id", "left").select(
        "user_id", F.round(F.coalesce("_d", F.lit(0.0)), DIGITS).alias("dcg")
    )


def mean_of(per_user: DataFrame, col: str, name: str) -> DataFrame:
    """The mean of a per-user value, one row."""
    return per_user.agg(F.round(F.avg(col), DIGITS).alias(name), F.count(F.lit(1)).alias("n_users"))
