"""Recommender queries: splits, histories, similarity, recommendation, metrics, co-occurrence."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from affinity.functions.columns import prefixed_key
from affinity.operators import cooccur, evaluate, features, history, recommend, similarity, split
from affinity.plans import sql as S
from affinity.plans.registry import query
from affinity.session import materialize
from affinity.sources import tables

KEY = ["user_id", "item_id"]
K_NEIGHBORS = 10
N_LIST = 50
ICF_SWEEP = [5, 10, 20, 40, 80, 160]
UCF_SWEEP = [5, 10, 20, 40, 80]
P1_SWEEP = [5, 10, 20, 30, 40, 50]  # the single-machine scripts


def _split(spark: SparkSession, sf: str):
    """Interactions with their split bucket, written once; train and test are filters of it."""
    inter = tables.interactions(spark, sf).drop("ts")  # no reader wants the time, and nothing is pruned past a write
    flagged = materialize(split.with_split_flag(inter, KEY), "interactions")
    train = flagged.where(F.col("is_train")).select("user_id", "item_id", "rating")
    test = flagged.where(~F.col("is_train")).select("user_id", "item_id", "rating")
    return flagged, train, test


def _icf(spark: SparkSession, sf: str, k: int = K_NEIGHBORS, p: float = 2):
    _, train, test = _split(spark, sf)
    topk = similarity.item_neighbors(train, k, p)
    users = recommend.eligible_users_icf(train, test)
    return train, test, topk, users


def _ucf(spark: SparkSession, sf: str, k: int = K_NEIGHBORS, p: float = 2):
    _, train, test = _split(spark, sf)
    # read twice, for the eligible users and for their candidates; without this the pair join ran once for each
    topk = materialize(similarity.user_neighbors(train, k, p), "user-neighbors")
    users = recommend.eligible_users_ucf(topk, test)
    return train, test, topk, users


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ splits and projections

@query("split_hash", _with(S.INTER) + f"""SELECT user_id, item_id, rating, {S.bucket('user_id, item_id')} < 7 AS is_train
FROM interactions""")
def q_split_hash(spark, sf):
    return split.with_split_flag(tables.interactions(spark, sf), KEY).select("user_id", "item_id", "rating", "is_train")


@query("sample_hash", _with(S.INTER) + f"""SELECT user_id, item_id, rating FROM interactions
WHERE {S.bucket('user_id, item_id', 1000)} < 500""")
def q_sample_hash(spark, sf):
    return split.sample_hash(tables.interactions(spark, sf), KEY, 0.5).select("user_id", "item_id", "rating")


_HU32 = "('0x' || substr(md5(concat_ws('-', user_id, item_id)), 1, 8))::BIGINT"


@query("split_positional", _with(S.INTER) + f"""SELECT user_id, item_id, rating,
       row_number() OVER (ORDER BY {_HU32}, user_id, item_id) <= 3500 AS is_train
FROM interactions""")
def q_split_positional(spark, sf):
    inter = tables.interactions(spark, sf).select("user_id", "item_id", "rating")
    return split.split_positional(inter, KEY, 3500).select("user_id", "item_id", "rating", "is_train")


@query("split_stratified", _with(S.INTER) + f"""SELECT user_id, item_id, label,
       row_number() OVER (PARTITION BY label ORDER BY {_HU32}, user_id, item_id)
         <= cnt - ceil(cnt * 0.3) AS is_train
FROM (SELECT user_id, item_id, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label,
             count(*) OVER (PARTITION BY CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS cnt
      FROM interactions)""")
def q_split_stratified(spark, sf):
    inter = tables.interactions(spark, sf).select("user_id", "item_id", features.threshold_label())
    return split.split_stratified(inter, KEY, "label", 0.3).select("user_id", "item_id", "label", "is_train")


@query("project_cast", """SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(trunc(l_quantity / 10) AS INTEGER) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def q_project_cast(spark, sf):
    from affinity.sources.readers import truncated_int
    li = tables.load(spark, sf, "lineitem")
    od = tables.load(spark, sf, "orders")
    raw = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        (F.col("l_quantity") / 10).cast("string").alias("rating_text"))
    return raw.select("user_id", "item_id", truncated_int("rating_text").alias("rating"))


@query("project_prefix_key", _with(S.INTER) + """SELECT 'user_' || user_id AS user_key, 'item_' || item_id AS item_key, rating
FROM interactions""")
def q_project_prefix_key(spark, sf):
    inter = tables.interactions(spark, sf)
    return inter.select(prefixed_key("user_", "user_id").alias("user_key"),
                        prefixed_key("item_", "item_id").alias("item_key"), "rating")


@query("label_threshold", _with(S.INTER) + """SELECT user_id, item_id, rating, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label
FROM interactions""")
def q_label_threshold(spark, sf):
    inter = tables.interactions(spark, sf)
    return inter.select("user_id", "item_id", "rating", features.threshold_label())


@query("join_left_dim", _with(S.INTER) + """SELECT i.user_id, i.item_id, i.rating, p.p_type AS genres
FROM interactions i LEFT JOIN part p ON p.p_partkey = i.item_id""")
def q_join_left_dim(spark, sf):
    inter = tables.interactions(spark, sf).select("user_id", "item_id", "rating")
    return inter.join(tables.items(spark, sf), "item_id", "left").select("user_id", "item_id", "rating", "genres")


@query("enc_label", _with(S.INTER) + """SELECT user_id, item_id,
       CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_code,
       CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_code
FROM interactions""")
def q_enc_label(spark, sf):
    inter = materialize(tables.interactions(spark, sf).select("user_id", "item_id"), "interactions")
    out = features.label_encode(inter, "user_id", "user_code")
    out = features.label_encode(out, "item_id", "item_code")
    return out.select("user_id", "item_id", "user_code", "item_code")


@query("feat_training_table", _with(S.INTER) + """SELECT CAST(dense_rank() OVER (ORDER BY i.user_id) - 1 AS INTEGER) AS user_code,
       CAST(dense_rank() OVER (ORDER BY i.item_id) - 1 AS INTEGER) AS item_code,
       i.ts, CASE WHEN i.rating >= 4 THEN 1 ELSE 0 END AS label, p.p_type AS genres
FROM interactions i LEFT JOIN part p ON p.p_partkey = i.item_id""")
def q_feat_training_table(spark, sf):
    """label (P4) + item dimension (J1) + encoded ids."""
    inter = materialize(tables.interactions(spark, sf), "interactions")
    t = inter.select("user_id", "item_id", "ts", features.threshold_label())
    t = t.join(tables.items(spark, sf), "item_id", "left")
    t = features.label_encode(t, "user_id", "user_code")
    t = features.label_encode(t, "item_id", "item_code")
    return t.select("user_code", "item_code", "ts", "label", "genres")


# ------------------------------------------------------------------ histories and aggregates

@query("agg_user_history", _with(S.INTER) + """SELECT user_id, pos // 1024 AS chunk,
       string_agg(item_id || ':' || rating, ' ' ORDER BY item_id) AS history
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS pos FROM interactions)
GROUP BY user_id, pos // 1024""")
def q_agg_user_history(spark, sf):
    h = history.dump(history.user_history(tables.interactions(spark, sf)), "user-history")
    return h.select("user_id", "chunk", history.history_text("history", "item_id").alias("history"))


@query("agg_item_history", _with(S.SPLIT) + """SELECT item_id, pos // 1024 AS chunk,
       string_agg(user_id || ':' || rating, ' ' ORDER BY user_id) AS history
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY user_id) - 1 AS pos FROM train)
GROUP BY item_id, pos // 1024""")
def q_agg_item_history(spark, sf):
    _, train, _ = _split(spark, sf)
    h = history.item_history(train)
    return h.select("item_id", "chunk", history.history_text("history", "user_id").alias("history"))


@query("agg_distinct_users", _with(S.SPLIT) + "SELECT DISTINCT user_id FROM train")
def q_agg_distinct_users(spark, sf):
    _, train, _ = _split(spark, sf)
    return history.distinct_users(train)


@query("agg_nunique", _with(S.INTER) + "SELECT count(DISTINCT item_id) AS n_item_id FROM interactions")
def q_agg_nunique(spark, sf):
    return history.n_unique(tables.interactions(spark, sf), "item_id")


@query("agg_norms", _with(S.SPLIT) + """SELECT user_id, round(sqrt(sum(CAST(rating AS DOUBLE) * rating)), 6) AS norm
FROM train GROUP BY user_id""")
def q_agg_norms(spark, sf):
    _, train, _ = _split(spark, sf)
    return similarity.norms(train, "user_id").select("user_id", F.round("norm", 6).alias("norm"))


@query("agg_item_popularity", _with(S.SPLIT) + """SELECT item_id, count(DISTINCT user_id) AS popularity
FROM train GROUP BY item_id""")
def q_agg_item_popularity(spark, sf):
    _, train, _ = _split(spark, sf)
    return evaluate.item_popularity(train, distinct_users=True)


@query("agg_item_popularity_rows", _with(S.SPLIT) + """SELECT item_id, count(*) AS popularity
FROM train GROUP BY item_id""")
def q_agg_item_popularity_rows(spark, sf):
    _, train, _ = _split(spark, sf)
    return evaluate.item_popularity(train, distinct_users=False)


@query("filter_min_group", _with(S.SPLIT) + """SELECT user_id, item_id, rating FROM train
WHERE item_id IN (SELECT item_id FROM train GROUP BY item_id HAVING count(*) > 1)""")
def q_filter_min_group(spark, sf):
    _, train, _ = _split(spark, sf)
    return history.keep_multi_member_groups(train, "item_id", 2)


@query("tag_triple_count", """SELECT o_custkey AS user_id, l_partkey AS item_id, p_brand AS tag, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY o_custkey, l_partkey, p_brand""")
def q_tag_triple_count(spark, sf):
    return cooccur.tag_triple_count(tables.tag_rows(spark, sf))


@query("enc_string_index", """WITH tags AS (SELECT o_custkey AS user_id, l_partkey AS item_id, p_brand AS tag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
idx AS (SELECT tag, CAST(row_number() OVER (ORDER BY count(*) DESC, tag ASC) - 1 AS INTEGER) AS tagid
        FROM tags GROUP BY tag)
SELECT t.user_id, t.item_id, t.tag, i.tagid FROM tags t JOIN idx i USING (tag)""")
def q_enc_string_index(spark, sf):
    tags = tables.tag_rows(spark, sf)
    return features.string_index(tags, "tag", "tagid").select("user_id", "item_id", "tag", "tagid")


# ------------------------------------------------------------------ similarity

def _sim_query(name: str, entity: str, context: str, p: float, normalize: bool):
    sql = _with(S.SPLIT, S.sims(entity, context, p, normalize)) + f"SELECT {entity}, neighbor_id, sim, n_common FROM sims"

    @query(name, sql)
    def q(spark, sf):
        _, train, _ = _split(spark, sf)
        return similarity.similarity(train, entity, context, p, normalize).select(entity, "neighbor_id", "sim", "n_common")

    return q


_sim_query("sim_user_damp2", "user_id", "item_id", 2, False)
_sim_query("sim_user_damp1", "user_id", "item_id", 1, False)
_sim_query("sim_item_damp2", "item_id", "user_id", 2, True)
_sim_query("sim_item_damp1", "item_id", "user_id", 1, True)
_sim_query("sim_item_damp0", "item_id", "user_id", 0, True)


@query("sim_user_topk", _with(S.SPLIT, S.sims("user_id", "item_id", 2, False), S.topk("user_id", K_NEIGHBORS))
       + "SELECT user_id, neighbor_id, sim, n_common, rank FROM topk")
def q_sim_user_topk(spark, sf):
    _, train, _ = _split(spark, sf)
    t = similarity.user_neighbors(train, K_NEIGHBORS, 2)
    return t.select("user_id", "neighbor_id", "sim", "n_common", "rank")


@query("sim_item_topk", _with(S.SPLIT, S.sims("item_id", "user_id", 2, True), S.topk("item_id", K_NEIGHBORS))
       + "SELECT item_id, neighbor_id, sim, n_common, rank FROM topk")
def q_sim_item_topk(spark, sf):
    _, train, _ = _split(spark, sf)
    t = similarity.item_neighbors(train, K_NEIGHBORS, 2)
    return t.select("item_id", "neighbor_id", "sim", "n_common", "rank")


@query("pairs_cooccurrence", _with(S.SPLIT, S.sims("item_id", "user_id", 2, True))
       + "SELECT a AS item_id, b AS neighbor_id, round(dot, 6) AS dot, n_common FROM sims_pp")
def q_pairs_cooccurrence(spark, sf):
    _, train, _ = _split(spark, sf)
    pp = similarity.pair_products(train, "item_id", "user_id", 2)
    return pp.select(F.col("a").alias("item_id"), F.col("b").alias("neighbor_id"), F.round("dot", 6).alias("dot"), "n_common")


@query("sim_common_items", _with(S.INTER) + """SELECT a.user_id, b.user_id AS neighbor_id,
       round_even(CASE WHEN sum(CAST(a.rating AS DOUBLE) * a.rating) * sum(CAST(b.rating AS DOUBLE) * b.rating) = 0 THEN 0.0
             ELSE sum(CAST(a.rating AS DOUBLE) * b.rating)
                  / sqrt(sum(CAST(a.rating AS DOUBLE) * a.rating) * sum(CAST(b.rating AS DOUBLE) * b.rating)) END, 5) AS sim,
       count(*) AS n_common
FROM interactions a JOIN interactions b ON a.item_id = b.item_id
GROUP BY a.user_id, b.user_id HAVING count(*) >= 1""")
def q_sim_common_items(spark, sf):
    return similarity.common_item_similarity(tables.interactions(spark, sf))


@query("sim_invert", _with(S.SPLIT, S.sims("user_id", "item_id", 2, False), S.topk("user_id", K_NEIGHBORS))
       + "SELECT neighbor_id AS key_id, user_id AS source_id, sim FROM topk")
def q_sim_invert(spark, sf):
    _, train, _ = _split(spark, sf)
    t = similarity.user_neighbors(train, K_NEIGHBORS, 2)
    return similarity.invert(t)


@query("sim_neighbor_ratings", _with(S.SPLIT, S.sims("user_id", "item_id", 2, False), S.topk("user_id", K_NEIGHBORS))
       + """SELECT k.neighbor_id AS key_id, k.user_id AS source_id, k.sim, t.item_id, t.rating
FROM topk k JOIN train t ON t.user_id = k.neighbor_id""")
def q_sim_neighbor_ratings(spark, sf):
    _, train, _ = _split(spark, sf)
    t = similarity.user_neighbors(train, K_NEIGHBORS, 2)
    return similarity.neighbor_ratings(t, train).select("key_id", "source_id", "sim", "item_id", "rating")


# ------------------------------------------------------------------ recommendation

@query("join_semi_eligible", _with(S.SPLIT) + """SELECT user_id, item_id, rating FROM train
WHERE user_id IN (SELECT user_id FROM test)""")
def q_join_semi_eligible(spark, sf):
    _, train, test = _split(spark, sf)
    return train.join(test.select("user_id"), "user_id", "left_semi").select("user_id", "item_id", "rating")


@query("join_anti_seen", _with(S.SPLIT, S.sims("user_id", "item_id", 2, False), S.topk("user_id", K_NEIGHBORS))
       + """SELECT DISTINCT k.user_id, t.item_id FROM topk k JOIN train t ON t.user_id = k.neighbor_id
WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = k.user_id AND s.item_id = t.item_id)""")
def q_join_anti_seen(spark, sf):
    _, train, _ = _split(spark, sf)
    t = similarity.user_neighbors(train, K_NEIGHBORS, 2)
    cand = t.select("user_id", F.col("neighbor_id")).join(
        train.select(F.col("user_id").alias("neighbor_id"), "item_id"), "neighbor_id").select("user_id", "item_id").distinct()
    return cand.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


_ICF = S.icf_pipeline(K_NEIGHBORS, N_LIST)
_UCF = S.ucf_pipeline(K_NEIGHBORS, N_LIST)


@query("rec_itemcf_scores", "WITH " + _ICF + "\nSELECT user_id, item_id, score FROM scores")
def q_rec_itemcf_scores(spark, sf):
    train, test, topk, users = _icf(spark, sf)
    return recommend.item_cf_scores(train, topk, users)


@query("rec_usercf_scores", "WITH " + _UCF + "\nSELECT user_id, item_id, score FROM scores")
def q_rec_usercf_scores(spark, sf):
    train, test, topk, users = _ucf(spark, sf)
    return recommend.user_cf_scores(train, topk, users)


def _icf_recs(spark, sf):
    train, test, topk, users = _icf(spark, sf)
    recs = recommend.with_hits(recommend.recommend_item_cf(train, topk, users, N_LIST), test)
    return train, test, users, recs


def _ucf_recs(spark, sf, normalize=False):
    train, test, topk, users = _ucf(spark, sf)
    recs = recommend.with_hits(recommend.recommend_user_cf(train, topk, users, N_LIST, normalize), test)
    return train, test, users, recs


@query("rec_itemcf_topn", "WITH " + _ICF + "\nSELECT user_id, item_id, score, rank, hit FROM hits")
def q_rec_itemcf_topn(spark, sf):
    return _icf_recs(spark, sf)[3].select("user_id", "item_id", "score", "rank", "hit")


@query("rec_usercf_topn", "WITH " + _UCF + "\nSELECT user_id, item_id, score, rank, hit FROM hits")
def q_rec_usercf_topn(spark, sf):
    return _ucf_recs(spark, sf)[3].select("user_id", "item_id", "score", "rank", "hit")


@query("rec_usercf_normalized", "WITH " + S.ucf_pipeline(K_NEIGHBORS, N_LIST, normalize=True)
       + "\nSELECT user_id, item_id, score, rank, hit FROM hits")
def q_rec_usercf_normalized(spark, sf):
    return _ucf_recs(spark, sf, normalize=True)[3].select("user_id", "item_id", "score", "rank", "hit")


# ------------------------------------------------------------------ evaluation

def _metric_query(name: str, cols: list[str], ucf: bool = False, catalog: str = "train"):
    pipe = _UCF if ucf else _ICF
    sql = "WITH " + pipe + ",\n" + S.metrics(N_LIST, catalog) + "\nSELECT " + ", ".join(cols) + " FROM metrics"

    @query(name, sql)
    def q(spark, sf):
        train, test, topk, users = (_ucf if ucf else _icf)(spark, sf)
        # the metrics find the hits themselves: lists without ``with_hits`` are joined with the test rows once
        recs = (recommend.recommend_user_cf if ucf else recommend.recommend_item_cf)(train, topk, users, N_LIST)
        return evaluate.list_metrics(recs, train, test, users, N_LIST, catalog).select(*cols)

    return q


_metric_query("eval_precision_recall", ["precision", "recall"])
_metric_query("eval_coverage", ["coverage"])
_metric_query("eval_coverage_test", ["coverage"], catalog="test")
_metric_query("eval_popularity", ["popularity"])
_metric_query("eval_all_icf", ["precision", "recall", "coverage", "popularity"])
_metric_query("eval_all_ucf", ["precision", "recall", "coverage", "popularity"], ucf=True)


def _p1_query(ucf: bool):
    """The single-machine scripts: damping 1, all test users with train rows, test catalog, popularity in rows."""
    pipe = S.ucf_pipeline(K_NEIGHBORS, N_LIST, 1, elig=S.ELIG_ICF) if ucf else S.icf_pipeline(K_NEIGHBORS, N_LIST, 1)
    sql = f"WITH {pipe},\n{S.metrics(N_LIST, 'test', False)}\nSELECT precision, recall, coverage, popularity FROM metrics"

    @query("eval_all_ucf_p1" if ucf else "eval_all_icf_p1", sql)
    def q(spark, sf):
        train, test, topk, _ = (_ucf if ucf else _icf)(spark, sf, K_NEIGHBORS, 1)
        users = recommend.eligible_users_icf(train, test)
        recs = (recommend.recommend_user_cf if ucf else recommend.recommend_item_cf)(train, topk, users, N_LIST)
        return evaluate.list_metrics(recs, train, test, users, N_LIST, "test", pop_distinct=False)

    return q


_p1_query(False)
_p1_query(True)

_AP_SQL = """ap_run AS (SELECT user_id, rank, hit, sum(hit) OVER (PARTITION BY user_id ORDER BY rank
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM hits),
ap_user AS (SELECT e.user_id,
                   round(CASE WHEN coalesce(sum(a.hit), 0) = 0 THEN 0.0
                              ELSE sum(CASE WHEN a.hit = 1 THEN a.cum / a.rank END) / sum(a.hit) END, 6) AS ap
            FROM elig e LEFT JOIN ap_run a ON a.user_id = e.user_id GROUP BY e.user_id)"""
_DCG_SQL = """dcg_user AS (SELECT e.user_id, round(coalesce(sum((power(2.0, h.test_rating) - 1) / log2(h.rank + 1)), 0.0), 6) AS dcg
             FROM elig e LEFT JOIN hits h ON h.user_id = e.user_id GROUP BY e.user_id)"""


@query("eval_ap_per_user", "WITH " + _ICF + ",\n" + _AP_SQL + "\nSELECT user_id, ap FROM ap_user")
def q_eval_ap_per_user(spark, sf):
    _, _, users, recs = _icf_recs(spark, sf)
    return evaluate.average_precision(recs, users)


@query("eval_map", "WITH " + _ICF + ",\n" + _AP_SQL + "\nSELECT round(avg(ap), 6) AS map, count(*) AS n_users FROM ap_user")
def q_eval_map(spark, sf):
    _, _, users, recs = _icf_recs(spark, sf)
    return evaluate.mean_of(evaluate.average_precision(recs, users), "ap", "map")


@query("eval_dcg_per_user", "WITH " + _ICF + ",\n" + _DCG_SQL + "\nSELECT user_id, dcg FROM dcg_user")
def q_eval_dcg_per_user(spark, sf):
    _, _, users, recs = _icf_recs(spark, sf)
    return evaluate.dcg(recs, users)


@query("eval_dcg", "WITH " + _ICF + ",\n" + _DCG_SQL + "\nSELECT round(avg(dcg), 6) AS mean_dcg, count(*) AS n_users FROM dcg_user")
def q_eval_dcg(spark, sf):
    _, _, users, recs = _icf_recs(spark, sf)
    return evaluate.mean_of(evaluate.dcg(recs, users), "dcg", "mean_dcg")


def _sweep_sql(ucf: bool, ks: list[int], scripts: bool) -> str:
    kmax = max(ks)
    p = 1 if scripts else 2
    entity, context, norm = ("user_id", "item_id", False) if ucf else ("item_id", "user_id", True)
    kv = ", ".join(f"({k})" for k in ks)
    scores = S.ucf_scores(src="topk_k", by="k") if ucf else S.icf_scores(src="topk_k", by="k")
    ctes = [S.SPLIT, S.sims(entity, context, p, norm), S.topk(entity, kmax),
            f"topk_k AS (SELECT ks.k, t.* FROM topk t JOIN (VALUES {kv}) ks(k) ON t.rank <= ks.k)",
            S.ELIG_UCF if ucf and not scripts else S.ELIG_ICF, scores,
            S.topn(N_LIST, "key_desc" if ucf else "item_asc", by="k"),
            S.popularity(distinct=not scripts),
            """per_k AS (SELECT r.k, sum(CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END) AS hits, count(*) AS n_rec,
                       count(DISTINCT r.item_id) AS rec_items, sum(ln(1 + coalesce(p.popularity, 0))) AS pop
                FROM recs r LEFT JOIN test t ON t.user_id = r.user_id AND t.item_id = r.item_id
                LEFT JOIN pop p ON p.item_id = r.item_id GROUP BY r.k)""",
            f"""fx AS (SELECT (SELECT count(*) FROM elig) AS n_users,
                    (SELECT count(*) FROM test WHERE user_id IN (SELECT user_id FROM elig)) AS n_test,
                    (SELECT count(*) FROM ({S.catalog_items("test" if scripts else "train")})) AS cat_items)"""]
    return _with(*ctes) + f"""SELECT ks.k,
       round(CASE WHEN n_users = 0 THEN 0.0 ELSE coalesce(hits, 0) / (n_users * {N_LIST}.0) END, 6) AS precision,
       round(CASE WHEN n_test = 0 THEN 0.0 ELSE coalesce(hits, 0) / CAST(n_test AS DOUBLE) END, 6) AS recall,
       round(CASE WHEN cat_items = 0 THEN 0.0 ELSE coalesce(rec_items, 0) / CAST(cat_items AS DOUBLE) END, 6) AS coverage,
       round(coalesce(pop / n_rec, 0.0), 6) AS popularity
FROM (VALUES {kv}) ks(k) LEFT JOIN per_k ON per_k.k = ks.k CROSS JOIN fx"""


def _sweep_query(name: str, ucf: bool, ks: list[int], scripts: bool = False):
    """List metrics for every k, as the Spark scripts or (``scripts``) the single-machine ones define them."""

    @query(name, _sweep_sql(ucf, ks, scripts))
    def q(spark, sf):
        train, test, topk, users = (_ucf if ucf else _icf)(spark, sf, max(ks), 1 if scripts else 2)
        if scripts:
            users = recommend.eligible_users_icf(train, test)
        recs = recommend.sweep_lists(train, topk, ks, users, N_LIST, "key_desc" if ucf else "item_asc", "user" if ucf else "item")
        return evaluate.sweep_metrics(recs, train, test, users, ks, N_LIST, "test" if scripts else "train",
                                      pop_distinct=not scripts)

    return q


_sweep_query("eval_k_sweep_icf", False, ICF_SWEEP)
_sweep_query("eval_k_sweep_ucf", True, UCF_SWEEP)
_sweep_query("eval_k_sweep_icf_p1", False, P1_SWEEP, scripts=True)
_sweep_query("eval_k_sweep_ucf_p1", True, P1_SWEEP, scripts=True)


# ------------------------------------------------------------------ co-occurrence

@query("cooc_weighted", """WITH logs AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, row_number() OVER () AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ut AS (SELECT user_id, count(*) AS user_n FROM logs GROUP BY user_id),
it AS (SELECT item_id, count(*) AS item_n FROM logs GROUP BY item_id),
r AS (SELECT logs.*, user_n, item_n FROM logs JOIN ut USING (user_id) JOIN it USING (item_id)),
pr AS (SELECT a.item_id AS i, b.item_id AS j,
              1.0 / (ln(1 + a.user_n) * CAST(a.item_n * b.item_n AS DOUBLE)) AS w
       FROM r a JOIN r b ON a.user_id = b.user_id AND a.pos < b.pos),
both_dirs AS (SELECT i, j, w FROM pr UNION ALL SELECT j, i, w FROM pr)
SELECT i AS item_id, j AS other_id, round(sum(w), 6) AS weight FROM both_dirs GROUP BY i, j""")
def q_cooc_weighted(spark, sf):
    return cooccur.weighted_cooccurrence(tables.logs(spark, sf))
