"""Properties of the operators on the sf0.001 tables (and on skewed inputs)."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import pairs, recommend, similarity, split
from affinity.operators.ranking import global_rank
from affinity.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inter(spark):
    return tables.interactions(spark, SF).cache()


def test_split_partitions_rows(inter):
    train, test = split.split_hash(inter, ["user_id", "item_id"])
    n, a, b = inter.count(), train.count(), test.count()
    assert a + b == n and a > 0 and b > 0
    assert train.join(test, ["user_id", "item_id"]).count() == 0


def test_blocked_pairs_equal_plain_self_join(spark):
    """A hot group split into many blocks yields every unordered pair exactly once."""
    rows = [("g", i) for i in range(300)] + [("h", i) for i in range(5)] + [("k", 1)]
    df = spark.createDataFrame(rows, "g string, m long")
    df = pairs.with_group_size(df, "g")
    out = pairs.block_pairs(df, "g", "m", carry=[], block_rows=16)
    got = sorted((r["g"], r["l_m"], r["r_m"]) for r in out.collect())
    want = sorted([("g", i, j) for i in range(300) for j in range(i + 1, 300)]
                  + [("h", i, j) for i in range(5) for j in range(i + 1, 5)])
    assert got == want


def test_similarity_independent_of_blocking(spark, inter):
    train, _ = split.split_hash(inter, ["user_id", "item_id"])
    a = similarity.user_similarity(train, 2, block_rows=4).orderBy("user_id", "neighbor_id").collect()
    b = similarity.user_similarity(train, 2).orderBy("user_id", "neighbor_id").collect()
    assert a == b


def test_item_similarity_row_max_is_one(inter):
    train, _ = split.split_hash(inter, ["user_id", "item_id"])
    sims = similarity.item_similarity(train, 2)
    mx = sims.groupBy("item_id").agg(F.max("sim").alias("m"))
    assert mx.where((F.col("m") != 1.0) & (F.col("m") != 0.0)).count() == 0
    assert sims.where(F.col("sim") < 0).count() == 0


def test_recommendations_unseen_and_bounded(inter):
    train, test = split.split_hash(inter, ["user_id", "item_id"])
    topk = similarity.top_k(similarity.item_similarity(train, 2), "item_id", 10)
    users = recommend.eligible_users_icf(train, test)
    recs = recommend.recommend_item_cf(train, topk, users, n=7)
    assert recs.join(train, ["user_id", "item_id"]).count() == 0
    assert recs.groupBy("user_id").count().where(F.col("count") > 7).count() == 0
    ranks = recs.groupBy("user_id").agg(F.max("rank").alias("m"), F.count("*").alias("c"))
    assert ranks.where(F.col("m") != F.col("c")).count() == 0


def test_global_rank_matches_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    ranked = global_rank(df, [F.col("v")], by=["g"], name="r", partitions=7)
    w = Window.partitionBy("g").orderBy("v")
    want = df.withColumn("r", F.row_number().over(w))
    assert sorted(map(tuple, ranked.select("g", "v", "r").collect())) == sorted(map(tuple, want.select("g", "v", "r").collect()))


def test_first_n_by_hash_counts(spark, inter):
    flagged = split.split_positional(inter.select("user_id", "item_id"), ["user_id", "item_id"], 1234)
    assert flagged.where("is_train").count() == 1234
    assert flagged.count() == inter.count()


def test_sweep_scores_match_per_k(inter):
    train, test = split.split_hash(inter, ["user_id", "item_id"])
    topk = similarity.top_k(similarity.item_similarity(train, 2), "item_id", 20)
    users = recommend.eligible_users_icf(train, test)
    sweep = recommend.sweep_scores(train, topk, [5, 20], users, mode="item")
    for k in (5, 20):
        one = recommend.item_cf_scores(train, topk.where(F.col("rank") <= k), users)
        got = sweep.select("user_id", "item_id", F.col(f"score_{k}").alias("score")).where("score IS NOT NULL")
        assert got.exceptAll(one).count() == 0 and one.exceptAll(got).count() == 0


@pytest.mark.parametrize("mode, heavy, entries", [("item", 50_000, 4_000_000), ("item", 3, 4_000_000), ("item", 50_000, 0), ("user", 50_000, 4_000_000)])
def test_pruned_sweep_lists_equal_a_plain_ranking(spark, inter, monkeypatch, mode, heavy, entries):
    """Floors cut no list short, whichever way the candidates are dealt; lists shorter than n keep all their rows."""
    monkeypatch.setattr(recommend, "HEAVY_USER_ROWS", heavy)
    monkeypatch.setattr(recommend, "MAX_BROADCAST_ENTRIES", entries)
    train, test = split.split_hash(inter, ["user_id", "item_id"])
    entity = "item_id" if mode == "item" else "user_id"
    topk = similarity.neighbors(train, entity, "user_id" if mode == "item" else "item_id", 20)
    users = recommend.eligible_users_icf(train, test)
    ks, tie = [2, 5, 20], "item_asc" if mode == "item" else "key_desc"
    wide = recommend.sweep_scores(train, topk.checkpoint(), ks, users, mode=mode).checkpoint()
    long = wide.selectExpr("user_id", "item_id", "stack(3, 2, score_2, 5, score_5, 20, score_20) AS (k, score)").where("score IS NOT NULL")
    for n in (3, 50, 2000):
        cols = ["k", "user_id", "item_id", "score", "rank"]
        want = {tuple(r) for r in recommend.top_n(long, n, tie, by=("k",)).select(*cols).collect()}
        got = [tuple(r) for r in recommend.sweep_top_n(wide, ks, n, tie).select(*cols).collect()]
        assert set(got) == want and len(got) == len(want)


def test_floors_with_ties(spark):
    rows = [("u", i, 1.0, None if i else 5.0) for i in range(400)] + [("v", 1, 2.0, None)]
    wide = spark.createDataFrame(rows, "user_id string, item_id long, score_1 double, score_2 double")
    floors = {r.user_id: r for r in recommend.list_floors(wide, ["score_1", "score_2"], 10).collect()}
    assert floors["u"]["_floor_score_1"] == 1.0 and floors["u"]["_floor_score_2"] is None and floors["v"]["_floor_score_1"] is None
    lists = recommend.sweep_top_n(wide, [1, 2], 10).collect()
    assert sorted((r.k, r.item_id) for r in lists if r.user_id == "u") == [(1, i) for i in range(10)] + [(2, 0)]


def test_global_rank_without_groups_and_with_run_time_partitions(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3000).alias("v"), (F.col("id") % 4).alias("g"))
    assert all(r["r"] == r["v"] + 1 for r in global_rank(df, [F.col("v")], name="r").collect())
    ranked = global_rank(df, [F.col("v")], by=["g"], name="r").collect()
    values = {g: sorted(r["v"] for r in ranked if r["g"] == g) for g in range(4)}
    assert len(ranked) == 3000 and all(values[r["g"]][r["r"] - 1] == r["v"] for r in ranked)


def test_cooccurrence_independent_of_blocking(spark):
    from affinity.operators import cooccur
    logs = tables.logs(spark, SF)
    a = cooccur.weighted_cooccurrence(logs, block_rows=4)
    b = cooccur.weighted_cooccurrence(logs)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_common_item_similarity_independent_of_blocking(spark, inter):
    a = similarity.common_item_similarity(inter, block_rows=3)
    b = similarity.common_item_similarity(inter)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
