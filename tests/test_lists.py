"""Sums by lists inside the tasks, and lines parsed once, against the plain paths."""

import math
import random

import pytest
from pyspark.sql import functions as F

from affinity.functions.columns import trim_decimal
from affinity.operators import cooccur, evaluate, lists, pairs, recommend, similarity
from affinity.sources import readers

IDS = [0, 1, -1, 2**31, -(2**31), 2**32 - 1, 2**63 - 1, -(2**62), 5, 6, 7, 8, 9]
# (entries a chunk has, entries of a key that is summed apart, broadcast bound)
MIXES = [(250_000, 1 << 40, 0), (5, 1 << 40, 1 << 40), (5, 12, 0)]


def _rows(spark, seed):
    """Null and repeated keys; ratings that are null, 0, negative or not exact in a float."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, *IDS]), rng.choice([None, *IDS]), rng.choice([None, 0.0, 0.1, 1.0, 3.0, 5.0, -2.5, 16777217.0])) for _ in range(100)]
    return spark.createDataFrame(rows + [(9, 5, 1.0), (9, 5, 1.0)], "user_id long, item_id long, rating double").checkpoint()


def _set(monkeypatch, few, chunk=1, key=0, broadcast=0):
    monkeypatch.setattr(lists, "FEW_ENTRIES", few)
    monkeypatch.setattr(lists, "CHUNK_ENTRIES", chunk)
    monkeypatch.setattr(lists, "KEY_ENTRIES", key)
    monkeypatch.setattr(recommend, "MAX_BROADCAST_ENTRIES", broadcast)


def _sorted(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("find", [similarity.item_neighbors, similarity.user_neighbors])
def test_neighbors_by_lists_equal_the_plain_ones(spark, monkeypatch, find):
    """No window sorts the pairs; the same neighbors, similarities and ranks."""
    df = _rows(spark, 3)
    _set(monkeypatch, 1 << 60)
    want = _sorted(find(df, 3))
    for chunk, key, _ in MIXES:
        _set(monkeypatch, 0, chunk, key)
        got = find(df, 3, block_rows=4)
        assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
        assert _sorted(got) == want and len(want) > 20


@pytest.mark.parametrize("mode", ["item", "user"])
@pytest.mark.parametrize("tie", ["item_asc", "key_desc"])
def test_lists_of_recommendations_equal_the_plain_ones(spark, monkeypatch, mode, tie):
    """Candidates summed and cut from lists; the same items, scores and ranks, heavy users included."""
    df = _rows(spark, 5)
    _set(monkeypatch, 1 << 60)
    topk = (similarity.item_neighbors if mode == "item" else similarity.user_neighbors)(df, 4).checkpoint()
    recs = recommend.recommend_item_cf if mode == "item" else recommend.recommend_user_cf
    want = _sorted(recs(df, topk, None, 3, tie=tie))
    for chunk, key, broadcast in MIXES:
        _set(monkeypatch, 0, chunk, key, broadcast)
        got = recs(df, topk, None, 3, tie=tie)
        assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
        assert _sorted(got) == want and len(want) > 20


def test_lines_are_parsed_once(spark):
    """neither result parses the lines again, and a filter on what was parsed doesn't either."""
    df = spark.createDataFrame([(1, "1 0:0.5 7:1"), (2, "x 0:1"), (3, "1 0:a"), (4, None), (5, "0"), (6, "1 0:1:1"), (7, "1  3:2")], "k int, line string")
    good, rejects = readers.parse_pairs_checked(df, "line")
    for part in (good, rejects):
        assert "split(" not in part._jdf.queryExecution().executedPlan().toString()
    found = {r.k: (r.label, [(p.idx, p.val) for p in r.pairs]) for r in good.collect()}
    assert found == {1: (1, [(0, 0.5), (7, 1.0)]), 5: (0, []), 7: (1, [(3, 2.0)])}
    assert {r.k: r.reason for r in rejects.collect()} == {2: "label", 3: "pair 1", 4: "label", 6: "pair 1"}


def test_trimmed_decimals(spark):
    """zeros trimmed without a pattern give the pattern's text."""
    values = [0.0, -0.0, 10.0, 100.5, 0.1, 1e-7, -3.25, 123456.789012, 1200.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    plain = F.regexp_replace(F.col("x").cast("decimal(38,6)").cast("string"), r"\.?0+$", "")
    assert all(r.t == r.p for r in df.select(trim_decimal("x").alias("t"), plain.alias("p")).collect())
    assert "regexp_replace" not in df.select(trim_decimal("x"))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values, kind", [
    ([-128.0, 127.0, None], "whole1"), ([128.0, -1.0], "whole2"), ([-32768.0, 32767.0, 0.0], "whole2"), ([32768.0, -5.0], "whole3"),
    ([-8388608.0, 8388607.0], "whole3"), ([8388608.0], "whole4"), ([2.0**31], None), ([0.1], None), ([float("nan")], None), ([float("inf")], None)])
def test_whole_numbers_travel_narrow(spark, values, kind):
    """The narrowest kind that holds every value, and the very values back."""
    for name, kinds in (("r", "double"), ("b", "bigint"), ("sim", "double")):
        if kinds == "bigint" and kind is None and values != [2.0**31]:
            continue
        given = [v if v is None else int(v) if kinds == "bigint" else v / 1e6 if name == "sim" else v for v in values]
        df = spark.createDataFrame([(1, v) for v in given], f"g int, {name} {kinds}")
        checks, found = pairs.narrowest(df, [name])
        narrow = found(df.agg(*checks).first())
        want = "whole1" if name == "sim" and values == [0.1] else kind  # 0.1 millionths are not whole
        assert narrow == ({name: kind} if kind else {}) or (name == "sim" and want is None)
        packed = pairs.pack_lists(df, ["g"], [name], narrow=narrow)
        back = pairs.unpack_lists(packed, ["g"], [name], dict(df.dtypes) | narrow, {name: "v"})
        assert sorted(map(repr, given)) == sorted(repr(r.v) for r in back.select(F.col("v").cast(kinds)).collect())


@pytest.mark.parametrize("size", [100, 9_000_000])
def test_narrow_lists_equal_the_plain_ones(spark, monkeypatch, size):
    """Whole ratings and small ids; the pairs' lists are dealt once and sent by as many tasks as the pairs ask for."""
    rng = random.Random(size)
    rows = [(rng.choice([None, *range(9)]), rng.choice([None, 0, 3, -7, size, size - 1, 50, 51]), rng.choice([None, 0.0, 1.0, 3.0, 5.0, -2.0])) for _ in range(90)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double").checkpoint()
    _set(monkeypatch, 1 << 60)
    near = similarity.item_neighbors(df, 3)
    want, lists_of = _sorted(near), _sorted(recommend.recommend_item_cf(df, near, None, 3))
    for chunk, key, broadcast in MIXES:
        _set(monkeypatch, 0, chunk, key, broadcast)
        got = similarity.item_neighbors(df, 3)
        assert _sorted(got) == want and len(want) > 10
        assert _sorted(recommend.recommend_item_cf(df, got, None, 3)) == lists_of and len(lists_of) > 10
    _set(monkeypatch, 0, 5, 1 << 40)
    plan = similarity.item_neighbors(df, 3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert below.count("Exchange") == below.count("REPARTITION_BY_NUM") == 2
    assert "cast(rating" not in below and "tinyint" in below


@pytest.mark.parametrize("entries", [1, 40, 4_000_000])
@pytest.mark.parametrize("listed", [True, False])
def test_rows_travel_in_blocks(spark, monkeypatch, entries, listed):
    """Rows cut to blocks anywhere arrive whole, each key's in one task, null and empty lists and null values too."""
    monkeypatch.setattr(lists, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(lists, "CHUNK_ENTRIES", 50)
    rng = random.Random(entries)
    lines = []
    for _ in range(60):
        m = [rng.choice([None, 1, 2, 3, 2**40, -5]) for _ in range(rng.randrange(6))]
        keys = [rng.choice([1, 2, 3, -(2**62)]) for _ in range(rng.randrange(1, 4) if listed else 1)]
        weights = [rng.choice([None, 0.5, 2.0]) for _ in keys]
        lines.append((keys, weights, None if not m and rng.random() < 0.5 else [rng.choice([None, 1.0, 3.0]) for _ in m], m or None))
    df = spark.createDataFrame(lines, "ks array<bigint>, ws array<double>, x_0 array<double>, m_0 array<bigint>").repartition(3)
    df = df.select("*", F.lit(False).alias("all_out"), F.transform("x_0", lambda x: x.cast("float")).alias("r_0"), F.transform("x_0", lambda x: x * 0).alias("r_1"),
                   F.transform("m_0", lambda m: F.shiftright(m, 32).cast("int")).alias("b_0"),
                   F.transform("m_0", lambda m: F.shiftright(F.shiftleft(m, 32), 32).cast("int")).alias("b_1")).checkpoint()
    own = [F.col("ks").alias("key"), F.col("ws").alias("weight")] if listed else [F.col("ks")[0].alias("key"), F.col("ws")[0].alias("weight")]
    sent = lists.list_sums(df.select(*own, "all_out", "r_0", "r_1", "b_0", "b_1"), ["r"], "b", n=4)
    want = {}
    for keys, weights, xs, ms in lines:
        for k, w in zip(keys, weights):
            for x, m in zip(xs or [], ms or []):
                if m != k:
                    want.setdefault((k, m), []).append(None if w is None or x is None else w * x)
    found = [(r.key, m, s, c) for r in sent.collect() for m, s, c in zip(r.members, r.sums, r.counts)]
    summed = {a: (sum(p for p in ps if p is not None) if any(p is not None for p in ps) else None, len(ps)) for a, ps in want.items()}
    assert {(k, m): (s, c) for k, m, s, c in found} == summed and len(found) == len(summed) > 10


def test_users_lists_are_computed_once(spark):
    """null items are counted in the same aggregate, so the lists aren't computed a second time for them."""
    recs = spark.createDataFrame([(1, 5), (1, 40_000), (2, 5), (2, None)], "user_id long, item_id long").checkpoint()
    marked = lists.list_sums(recs.select(F.col("user_id").alias("key"), F.lit(1.0).alias("weight"), F.lit(None).cast("bigint").alias("mark_out"),
                                         F.lit(False).alias("all_out"), F.array(F.lit(1.0).cast("float")).alias("r_0"), F.array(F.lit(0.0)).alias("r_1"),
                                         F.array(F.lit(0)).alias("b_0"), F.array(F.col("item_id").cast("int")).alias("b_1")), ["r"], "b")
    recs = marked.select(F.col("key").alias("user_id"), F.explode("members").alias("item_id"))
    train = spark.createDataFrame([(1, 7), (2, 5), (2, None)], "user_id long, item_id long").checkpoint()
    test = spark.createDataFrame([(1, 5), (2, 9), (2, None)], "user_id long, item_id long").checkpoint()
    users = spark.createDataFrame([(1,), (2,)], "user_id long").checkpoint()
    out = evaluate.list_metrics(recs, train, test, users, 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "SortAggregate" not in plan  # no list row is sorted to be counted
    assert tuple(out.first()) == (0.25, round(1 / 3, 6), 1.0, round(2 * math.log(2) / 4, 6))


def test_only_hits_are_dealt_by_user(spark):
    """Precision and gain of a user come from the hits; rows of the others are not sorted or dealt."""
    rows = [(1, 1, 0, 0.0), (1, 2, 1, 3.0), (1, 3, 0, 0.0), (1, 4, 1, 0.0), (2, 1, 0, 0.0)]
    recs = spark.createDataFrame(rows, "user_id long, rank int, hit int, test_rating double").checkpoint()
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long").checkpoint()
    ap, gain = evaluate.average_precision(recs, users), evaluate.dcg(recs, users)
    assert {tuple(r) for r in ap.collect()} == {(1, 0.5), (2, 0.0), (3, 0.0)}
    assert {tuple(r) for r in gain.collect()} == {(1, round(7 / math.log2(3), 6)), (2, 0.0), (3, 0.0)}
    for df, cond in ((ap, "(hit"), (gain, "(test_rating")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter" in plan and cond in plan


def test_blocks_are_freed(spark):
    """A Python worker keeps nothing of the blocks it made; before, it kept all of every task's."""
    import pyarrow as pa

    rows = spark.range(0, 40_000, numPartitions=40).select(
        F.col("id").alias("key"), F.lit(1.0).alias("weight"), F.transform(F.sequence(F.lit(1), F.lit(200)), lambda x: F.xxhash64("id", x)).alias("item_id_0"))
    sent = lists.in_blocks(rows, "item_id", 4)
    assert sent.agg(F.sum(F.length("block"))).first()[0] > 50_000_000  # 1.6 MB a task, which doesn't compress

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pa.total_allocated_bytes()])], ["n"])

    assert spark.range(0, 80, numPartitions=80).mapInArrow(held, "n long").agg(F.max("n")).first()[0] < 500_000


@pytest.mark.parametrize("find", [
    lambda df, b: similarity.item_similarity(df, block_rows=b), lambda df, b: similarity.user_similarity(df, block_rows=b),
    lambda df, b: similarity.item_similarity(df, 1, block_rows=b), lambda df, b: cooccur.weighted_cooccurrence(df, block_rows=b)])
def test_whole_tables_by_lists_equal_the_plain_ones(spark, monkeypatch, find):
    """Whole similarity rows and co-occurrences summed from blocks; repeated rows, nulls, heavy and blocked groups as before."""
    df = _rows(spark, 7)
    _set(monkeypatch, 1 << 60)
    want = _sorted(find(df, 2048))
    for rows, (chunk, key, _) in zip((2048, 4, 4), MIXES):
        _set(monkeypatch, 0, chunk, key)
        monkeypatch.setattr(lists, "FLAT_ROWS", 7)
        got = find(df, rows)
        assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
        assert _sorted(got) == want and len(want) > 20


@pytest.mark.parametrize("mode, tie", [("item", "item_asc"), ("item", "key_desc"), ("user", "key_desc")])
def test_sweeps_by_lists_equal_the_plain_ones(spark, monkeypatch, mode, tie):
    """the candidates of every k summed and cut in the tasks; the same lists, heavy users, nulls and repeats included."""
    df = _rows(spark, 11).withColumn("rating", F.rint("rating"))  # so no score lies halfway between two of 6 places
    ks = [3, 1, 6]
    _set(monkeypatch, 1 << 60)
    topk = (similarity.item_neighbors if mode == "item" else similarity.user_neighbors)(df, 6).checkpoint()
    want = _sorted(recommend.sweep_lists(df, topk, ks, None, 3, tie, mode).select("k", "user_id", "item_id", "score", "rank"))
    assert {k for k in ks for row in want if row.startswith(f"({k},")} == set(ks)
    for chunk, key, broadcast in MIXES:
        _set(monkeypatch, 0, chunk, key, broadcast)
        got = recommend.sweep_lists(df, topk, ks, None, 3, tie, mode)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and got.columns == ["k", "user_id", "item_id", "score", "rank"]
        assert _sorted(got) == want and len(want) > 20
