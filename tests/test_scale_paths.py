"""Paths that only large or unusual inputs take, against the plain ones."""

import collections
import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinity.functions.columns import fixed16
from affinity.operators import cooccur, embed, evaluate, features, history, pairs, recommend, similarity, split
from affinity.sources import readers, tables
from affinity.sources import writers

SF = "/root/testdata/sf0.001"


def test_head_and_tail_of_a_vocabulary_give_the_same_codes(spark):
    clicks = tables.clicks(spark, SF)
    cols = tables.CLICK_CATEGORY
    vocab = features.written_vocab(clicks, cols, 2)
    shuffled = clicks.repartition(16)  # computed lazily, in another order by each reader
    pick = ["row_key", *[f"{c}_code" for c in cols]]
    total = vocab.agg(F.sum(F.octet_length("value") + features.ENTRY_BYTES)).first()[0]
    want = None
    for head_bytes in (total, total // 2, total // 20, 0):
        least, whole = features.head_cut(vocab, head_bytes)
        head = 0 if least is None else vocab.where(F.col("count") >= least).agg(F.sum(F.octet_length("value") + features.ENTRY_BYTES)).first()[0]
        assert head <= head_bytes and whole == (head_bytes == total)
        got = collections.Counter(map(tuple, features.apply_vocab(shuffled, cols, vocab, head_bytes=head_bytes).select(*pick).collect()))
        want = want or got
        assert got == want
    assert features.apply_vocab(shuffled, cols, vocab.limit(0)).where(" + ".join(pick[1:]) + " > 0").count() == 0


def test_exact_decimal_text(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 2.08, 0.5, 1e-16, 5e-17, 4.9e-17, 2**-54, 2**-53, 2**-55, 5e-324, 1.7976931348623157e308, -1.5, 1e15 + 0.3, 2.0**52 + 0.5,
              2.0**53, 2.0**53 - 1, 2.0**62, 2.0**62 - 512, 2.0**63, 1e22, 1e23, 1 - 2**-53, float("nan"), float("inf"), -float("inf"), 3.5e-17]
    values += [k + 0.5**j for k in (0, 1, 7) for j in range(1, 60)]  # ties and their neighbors
    values += [rng.random() for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(3000)] + [rng.random() * 10**rng.randint(-20, 20) for _ in range(3000)]
    values += [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]  # any double
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    assert all(r.text == "%.16f" % r.v for r in df.select("v", fixed16("v").alias("text")).collect())


@pytest.mark.parametrize("ranked", [1, 40, 100_000])
def test_quantiles_by_selection(spark, ranked):
    """Against numpy, however few values are left to rank: ties, one value, nulls and NaN, few rows, extremes."""
    rng = np.random.default_rng(1)
    n = 20_000
    data = {
        "spread": rng.normal(size=n), "ties": rng.integers(0, 9, n).astype(float), "one": np.full(n, 3.5), "huge": np.exp(rng.normal(size=n) * 50),
        "mostly": np.where(rng.random(n) < 0.96, 1.0, rng.random(n)), "few": np.where(np.arange(n) < 3, rng.random(n), np.nan), "none": np.full(n, np.nan),
    }
    df = spark.createDataFrame(pd.DataFrame(data)).repartition(7)
    for q in (0.0, 0.95) if ranked > 1 else (0.5, 1.0):
        got = {r.field: r["quantile"] for r in features.quantile_points(df, list(data), q, ranked).collect()}
        assert set(got) == set(data) - {"none"}
        for c, v in got.items():
            assert v == pytest.approx(np.quantile(data[c][~np.isnan(data[c])], q), rel=1e-12)
    assert features.quantile_points(df.limit(0), ["spread"]).count() == 0


def test_consecutive_shards(spark, tmp_path):
    df = spark.range(0, 1003).select((F.col("id") * 7919 % 1003).alias("k"), F.lit("v").alias("v")).repartition(6)
    for n in (1, 7, 1003, 2000):
        rows = writers.consecutive_shards(df, n, ["k"]).collect()
        sizes = collections.Counter(r.shard for r in rows)
        assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == min(n, 1003)
        assert [r.k for r in sorted(rows, key=lambda r: (r.shard, r.place))] == list(range(1003))
    writers.write_consecutive_shards(df, str(tmp_path / "s"), 5, ["k"])
    files = sorted((tmp_path / "s").glob("part-*"))
    lines = [f.read_text().splitlines() for f in files]
    assert len(files) == 5 and all(part[0] == "k,v" for part in lines)
    assert [int(line.split(",")[0]) for part in lines for line in part[1:]] == list(range(1003))


def test_rejected_lines_keep_their_reason(spark, tmp_path):
    lines = ["1\ta\t2.5", "2\t\t", "x\ta\t1", "3\ta", "4\ta\t1\tmore", "5\tb\t1.5.1", "", "6\tc\t-1"]
    path = str(tmp_path / "t")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    good, rejects = readers.read_csv_checked(spark, path, "k int, s string, v double")
    assert sorted(map(tuple, good.collect())) == [(1, "a", 2.5), (2, None, None), (6, "c", -1.0)]
    assert {r.line: r.reason for r in rejects.collect()} == {
        "x\ta\t1": "value: k", "3\ta": "fields: 2 of 3", "4\ta\t1\tmore": "fields: 4 of 3", "5\tb\t1.5.1": "value: v"}
    assert good.select("k").count() == 3 and good.agg(F.sum("v")).first()[0] == 1.5  # pruned columns find the same faults
    pairs = ["1 0:2.5 3:1", "1", "one 0:1", "0 a:1", "0 1:2 7", "0 1:2 7:", "0 1:1:1", "", None]
    df = spark.createDataFrame([(k, line) for k, line in enumerate(pairs)], "n int, line string")
    good, rejects = readers.parse_pairs_checked(df, "line")
    assert {r.n: (r.label, [tuple(p) for p in r.pairs]) for r in good.collect()} == {0: (1, [(0, 2.5), (3, 1.0)]), 1: (1, [])}
    assert {r.n: r.reason for r in rejects.collect()} == {2: "label", 3: "pair 1", 4: "pair 2", 5: "pair 2", 6: "pair 1", 7: "label", 8: "label"}


def test_coverage_by_bitmaps(spark):
    ids = [0, 1, 32_767, 32_768, 32_769, 1 << 40, 1, 1, 0]
    recs = spark.createDataFrame([(k, "u", i) for k in (5, 10) for i in ids[:len(ids) - (k == 10)]], "k int, user_id string, item_id long")
    train = spark.createDataFrame([("u", i, 1.0) for i in (2, 3, 4, 5, 6, 7)], "user_id string, item_id long, rating double")
    users = spark.createDataFrame([("u",)], "user_id string")
    got = {r.k: r.coverage for r in evaluate.sweep_metrics(recs, train, train, users, [5, 10, 20]).collect()}
    assert got == {5: 1.0, 10: 1.0, 20: 0.0}
    assert evaluate.list_metrics(recs, train, train, users).first().coverage == 1.0


def test_bag_sum_of_long_and_uneven_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = {k: rng.random(int(size)).tolist() for k, size in enumerate([1, 3, 64, 65, 200, 64, 0], start=1)}
    table = spark.createDataFrame([(k, v) for k, v in vectors.items()], "vec_id int, embedding array<double>")
    pairs = [("a", 1), ("a", 1), ("a", 4), ("a", 0), ("b", 5), ("b", 2), ("c", 7), ("d", 99), ("e", None)]
    got = {(r.user_id, r.dim): r.value for r in embed.bag_sum(spark.createDataFrame(pairs, "user_id string, k int"), table).collect()}
    want = collections.defaultdict(float)
    for user, k in pairs:
        for d, x in enumerate(vectors.get(k, []) if k else []):
            want[user, d] += x
    assert got.keys() == want.keys() and all(abs(got[c] - v) < 2e-6 for c, v in want.items())


def test_cooccurrence_counts_every_pair_of_equal_rows(spark):
    logs = spark.createDataFrame([("u", "a")] * 3 + [("u", "b")], "user_id string, item_id string")
    got = {(r.item_id, r.other_id): r.weight for r in cooccur.weighted_cooccurrence(logs).collect()}
    per = 1 / math.log1p(4)
    assert got[("a", "a")] == round(2 * 3 * per / 9, 6)  # three pairs of positions, counted both ways
    assert got[("a", "b")] == got[("b", "a")] == round(3 * per / 3, 6)


def test_cooccurrence_of_the_given_tables(spark):
    """A user bought one item twice in the same order line position: both rows count."""
    logs = tables.logs(spark, SF)
    got = cooccur.weighted_cooccurrence(logs).where("item_id = 123 AND other_id = 123").first().weight
    n_item = logs.where("item_id = 123").count()
    want = sum(
        n * (n - 1) / math.log1p(logs.where(F.col("user_id") == u).count()) / n_item**2
        for u, n in [(r.user_id, r["count"]) for r in logs.where("item_id = 123").groupBy("user_id").count().collect()] if n > 1
    )
    assert abs(got - want) < 2e-6


def test_sweep_lists_take_any_id(spark):
    for one, two in ((1 << 62, 5), ("x", "y")):
        scores = spark.createDataFrame([(k, u, i, float(i)) for k in (5, 10) for u in (one, two) for i in range(4)],
                                       f"k int, user_id {'long' if isinstance(one, int) else 'string'}, item_id long, score double")
        rows = recommend.top_n(scores, 2, by=("k",)).collect()
        assert {(r.k, r.user_id, r.item_id, r["rank"]) for r in rows} == {
            (k, u, i, n) for k in (5, 10) for u in (one, two) for i, n in ((3, 1), (2, 2))}


def test_random_columns_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    a = readers.with_random_columns(df.repartition(3), ["key"]).collect()
    b = readers.with_random_columns(df.repartition(11), ["key"]).collect()
    assert {tuple(r) for r in a} == {tuple(r) for r in b}
    assert abs(sum(r.u for r in a) / 2000 - 0.5) < 0.03 and abs(sum(r.z for r in a) / 2000) < 0.1


def test_thirteen_numeric_and_twenty_six_category_columns(spark):
    num, cat = [f"i{k}" for k in range(1, 14)], [f"c{k}" for k in range(1, 27)]
    rows = spark.createDataFrame([(1, *[float(k) for k in range(13)], *[f"v{k % 2}" for k in range(26)])] * 12,
                                 ["label", *num, *cat])
    vocab = features.written_vocab(rows, cat, 10)
    offsets = features.collect_offsets(features.vocab_offsets(spark, vocab, cat))
    coded = features.apply_vocab(rows, cat, vocab)
    coded = coded.select("*", *features.global_index_columns(cat, offsets, base=13))
    line = coded.select(writers.fm_line(num, [f"{c}_idx" for c in cat], "label").alias("line")).first().line.split(" ")
    assert len(line) == 40 and line[0] == "1" and line[14] == "14:1" and line[-1] == f"{13 + 25 * 2 + 1}:1"


def test_history_chunks_are_full_but_the_last(spark):
    rows = spark.range(0, 500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 7 + 2).alias("user_id"),
                                      (F.col("id") * 1_000_003).alias("item_id"), F.lit(3).alias("rating"))
    got = {(r["user_id"], r["chunk"]): [e["item_id"] for e in r["history"]]
           for r in history.user_history(rows, chunk=7).collect()}
    for user in {u for u, _ in got}:
        chunks = [got[user, c] for c in sorted(c for u, c in got if u == user)]
        assert all(len(c) == 7 for c in chunks[:-1]) and 0 < len(chunks[-1]) <= 7
        flat = [i for c in chunks for i in c]
        assert flat == sorted(r["item_id"] for r in rows.where(F.col("user_id") == user).collect())


def test_sweep_reports_a_k_without_recommendations(spark):
    recs = spark.createDataFrame([(5, 1, 10)], "k int, user_id long, item_id long")
    train = spark.createDataFrame([(1, 9, 3)], "user_id long, item_id long, rating int")
    test = spark.createDataFrame([(1, 10, 3)], "user_id long, item_id long, rating int")
    got = {r["k"]: r for r in evaluate.sweep_metrics(recs, train, test, train.select("user_id"), [5, 7], 50).collect()}
    assert got[5]["recall"] == 1.0 and tuple(got[7])[1:] == (0.0, 0.0, 0.0, 0.0)


def test_svmlight_values_read_back_as_the_same_doubles(spark):
    values = [0.9795975134490658, 1e-7, 0.1, 1 / 3, 1e-4, 9.999e-5, 5e-324, 1.7976931348623157e308, 1e16, 12345678.9,
              9007199254740993.0, 0.001, 2.0, -0.25, -3e-9, 100.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    lines = df.select("i", writers.svmlight_line(F.lit(1), ["v"]).alias("line")).collect()
    assert [float(r["line"].split(":")[1]) for r in sorted(lines)] == values
    assert {r["i"]: r["line"] for r in lines}[15] == "1 0:100"
    assert df.select(writers.svmlight_line(F.lit(1), [F.lit(0.0)]).alias("l")).first()["l"] == "1"


def test_cut_with_a_null_stratum_and_tied_keys(spark):
    df = spark.range(0, 2000).select(F.floor(F.col("id") / 2).alias("k"), F.when(F.col("id") % 5 > 0, F.lit("a")).alias("g"))
    got = split.first_n_by_hash(df, ["k"], 100, by=["g"])
    assert got.count() == 2000
    for r in got.where("is_first").groupBy("g").count().collect():
        assert 100 <= r["count"] <= 101  # rows with the cut's own key stay together
    assert split.first_n_by_hash(df, ["k"], 0).where("is_first").count() == 0
    assert split.first_n_by_hash(df, ["k"], 5000).where("is_first").count() == 2000


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block_rows,heavy", [(2048, 1 << 40), (3, 1 << 40), (3, 40), (2048, 0)])
def test_pair_sums_by_lists_equal_a_plain_sum(spark, monkeypatch, block_rows, heavy):
    """Blocks, heavy members, ids of any size, ratings that are null, repeated, infinite or not exact in a float."""
    monkeypatch.setattr(pairs, "HEAVY_ROW_PAIRS", heavy)
    rng = random.Random(7)
    ids = [0, 1, -1, 2**31, -(2**31), 2**32 - 1, 2**63 - 1, -(2**63), 5, 6, 7]
    rows = [(rng.randrange(5), rng.choice(ids), rng.choice([None, 0.1, 1.0, 3.0, -2.5, 1e300, 16777217.0])) for _ in range(60)] + [(9, 5, 1.0), (None, 5, 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "g long, m long, v double")
    sized = pairs.with_group_size(df, "g")
    for by_place in (False, True):
        got = pairs.pair_sums(sized.checkpoint(), "g", "m", ["v"], ["v"], [F.count(F.lit(1)).alias("n"), F.sum(F.col("l_v") + 2 * F.col("r_v")).alias("s")],
                              lambda sums, heavy: sums, block_rows=block_rows, by_place=by_place)
        want = collections.defaultdict(lambda: [0, None])
        full = [r for r in rows if r[0] is not None and r[1] is not None]
        for i, a in enumerate(full):
            for j, b in enumerate(full):
                if a[0] == b[0] and (i != j if by_place else a[1] != b[1]):
                    w = want[a[1], b[1]]
                    w[0] += 1
                    if a[2] is not None and b[2] is not None:
                        w[1] = (w[1] or 0.0) + a[2] + 2 * b[2]
        found = {(r.a, r.b): (r.n, r.s) for r in got.collect()}
        assert found.keys() == want.keys()
        for k, (n, s) in want.items():
            assert found[k][0] == n and (found[k][1] is None if s is None else found[k][1] == pytest.approx(s, rel=1e-12))


def test_pairs_are_summed_and_ranked_without_a_shuffle_of_pairs(spark):
    """After a row's lists have arrived (dealt by ``a``) nothing of the size of the pair table is exchanged or written."""
    inter = tables.interactions(spark, SF)
    for df in (similarity.item_similarity(inter), similarity.item_neighbors(inter, 10), cooccur.weighted_cooccurrence(tables.logs(spark, SF))):
        plan = _planned(df)
        above = plan[plan.index("HashAggregate"):plan.index("Generate")]
        assert "Exchange" not in above and plan[:plan.index("HashAggregate")].count("Exchange") == 0
        assert "SortMergeJoin" not in plan and "cosine" not in plan.split("Generate")[0]


def test_contributions_are_summed_without_a_shuffle_of_them(spark, monkeypatch):
    """F5 and others: lists too large for a broadcast, and the ratings of neighbors, unfold where the user's rows lie."""
    monkeypatch.setattr(recommend, "MAX_BROADCAST_ENTRIES", 0)
    inter = tables.interactions(spark, SF)
    for df in (recommend.item_cf_scores(inter, similarity.item_neighbors(inter, 10).checkpoint()), recommend.user_cf_scores(inter, similarity.user_neighbors(inter, 10).checkpoint())):
        plan = _planned(df)
        assert "Exchange" not in plan[:plan.index("Generate")]


def test_packed_values_come_back_whole(spark):
    values = [0.0, 0.1, 1e-6, 0.123457, 1 / 3, -2.5, 1999.999999, 2000.5, 1e300, 5e-324, float("inf"), -float("inf"), float("nan"), None]
    for name in ("sim", "r"):
        df = spark.createDataFrame([(1, k, v) for k, v in enumerate(values)], f"g int, k int, {name} double")
        flat = pairs.unpack_lists(pairs.pack_lists(df, ["g"], [name, "k"]), ["g"], [name, "k"], dict(df.dtypes), {name: "v", "k": "k"})
        got = {r.k: r.v for r in flat.collect()}
        assert all(repr(got[k]) == repr(v) for k, v in enumerate(values))


@pytest.mark.parametrize("mode,most,entries", [("item", 1 << 30, 0), ("item", 120, 0), ("item", 120, 1 << 30), ("user", 1 << 30, 0), ("user", 300, 0)])
def test_sweep_lists_equal_the_written_path(spark, monkeypatch, mode, most, entries):
    """Light users' wide scores aren't written; heavy users' are. The same lists in every mix of both."""
    monkeypatch.setattr(recommend, "MAX_BROADCAST_ENTRIES", entries)
    monkeypatch.setattr(recommend, "LIST_ENTRIES", most)
    inter = tables.interactions(spark, SF).checkpoint()
    topk = (similarity.item_neighbors if mode == "item" else similarity.user_neighbors)(inter, 6).checkpoint()
    written = []
    plain = recommend.materialize
    monkeypatch.setattr(recommend, "materialize", lambda df, name: written.append(name) or plain(df, name))
    got = recommend.sweep_lists(inter, topk, [2, 6], n=5, mode=mode)
    assert most < 1 << 30 or mode == "item" or "sweep-scores" not in written
    want = recommend.sweep_top_n(recommend.sweep_scores(inter, topk, [2, 6], mode=mode), [2, 6], 5)
    cols = ["k", "user_id", "item_id", "score", "rank"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_click_rows_are_dealt_by_no_customer(spark, tmp_path):
    """the customer is joined to the orders, so the wide click rows are dealt by order and part only; repeats and nulls give the same rows."""
    from affinity.sources import tables

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("lineitem", [(1, 1, 7, 3, 4.5, 99.9, "R"), (1, 7, 7, 3, 4.5, None, "N"), (2, 6, 8, 3, None, -1.5, None), (2, 1, None, 3, 1.0, 1.0, "R"), (None, 1, 7, 3, 1.0, 1.0, "R")],
          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string")
    write("orders", [(1, 5, 10.7, "1-URGENT"), (1, 6, 20.2, None), (2, 5, None, "2-HIGH"), (3, 9, 1.0, "x"), (None, 5, 1.0, "x")],
          "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string")
    write("part", [(7, 3, "b7", "t7", "n7"), (8, None, "b8", "t8", None), (8, 4, "b8", "t8", "n8")], "p_partkey long, p_size int, p_brand string, p_type string, p_name string")
    write("customer", [(5, "m5"), (5, "m5"), (6, None)], "c_custkey long, c_mktsegment string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clicks = tables.clicks(spark, str(tmp_path))
        plan = clicks._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 6 and sum("l_partkey" in line for line in dealt) == 1 and sum("o_custkey" in line for line in dealt) == 1
    at = plan.index("Exchange hashpartitioning(o_custkey")  # below it orders are read, no line rows
    assert "l_orderkey" not in plan[at:plan.index("Exchange hashpartitioning(c_custkey")]
    first = [("1-1-7-3", 1, 4, 99, n, 3, "b7", "t7", "n7", o, m) for n, o, m in ((10, "1-URGENT", "m5"), (10, "1-URGENT", "m5"), (20, None, None))]
    second = [("1-7-7-3", 0, None, None, *r[4:]) for r in first]
    third = [("2-6-8-3", None, None, -2, None, n, None, "t8", p, "2-HIGH", "m5") for n, p in ((None, None), (4, "n8")) for _ in range(2)]
    assert sorted(map(repr, map(tuple, clicks.collect()))) == sorted(map(repr, first + second + third))
