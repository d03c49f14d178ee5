"""Click-log feature engineering.

Numeric fields are clipped while fitting (F1) and min-max scaled (F2); category fields get a
frequency vocabulary per field (F3: count >= cutoff, codes from 1 by count descending then
value ascending, ``<unk>`` = 0), applied with unseen or missing -> 0 (F4), and offset into one
global one-hot index space (F5). Fitted statistics small by construction (two numbers per
numeric field, one size per field) are brought to the driver like any ML ``fit``; a
vocabulary, which grows with the data, stays a DataFrame and is joined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.functions.columns import log_odds

from affinity.operators.ranking import global_rank
from affinity.session import materialize

UNK = "<unk>"
# Bytes of vocabulary entries that are broadcast to the scan, and what an entry takes besides its value.
HEAD_BYTES = 128 << 20
ENTRY_BYTES = 96
# Quantiles: rows of a field that are ranked in the end, the share by which a sketch's rank may be off.
RANKED_VALUES = 100_000
SKETCH_MARGIN = 0.02
SKETCH_STEPS = 400  # of the ranks that a sketch is asked for


# ---------------------------------------------------------------- numeric fields

def clipped_minmax(df: DataFrame, cols: Sequence[str], clips: Sequence[float]) -> DataFrame:
    """(field, min_value, max_value) of least(x, clip), NULLs ignored, one scan."""
    aggs = []
    for c, clip in zip(cols, clips):
        v = F.least(F.col(c), F.lit(clip))
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (field, min_value, max_value)")


def fit_minmax(df: DataFrame, cols: Sequence[str], clips: Sequence[float]) -> dict[str, tuple]:
    """Fitted (min, max) per field; one row per field reaches the driver."""
    return {r["field"]: (r["min_value"], r["max_value"]) for r in clipped_minmax(df, cols, clips).collect()}


def minmax_column(c: str, lo, hi, clip=None) -> Column:
    """F2: (x - min) / (max - min); missing -> 0.0; max == min -> 0.0.

    The value is not clipped at apply time unless ``clip`` is given, so results may exceed 1,
    as in the reference.
    """
    x = F.col(c).cast("double")
    if clip is not None:
        x = F.least(x, F.lit(float(clip)))
    if lo is None or hi is None or hi == lo:
        return F.when(x.isNull(), F.lit(0.0)).otherwise(F.lit(0.0))
    return F.when(x.isNull(), F.lit(0.0)).otherwise((x - F.lit(float(lo))) / F.lit(float(hi - lo)))


def apply_minmax(df: DataFrame, stats: dict[str, tuple], suffix: str = "", clips: dict | None = None) -> DataFrame:
    out = df
    for c, (lo, hi) in stats.items():
        out = out.withColumn(c + suffix, minmax_column(c, lo, hi, (clips or {}).get(c)))
    return out


def quantile_points(df: DataFrame, cols: Sequence[str], q: float = 0.95, ranked_values: int = RANKED_VALUES) -> DataFrame:
    """Exact linear-interpolated quantile per field (the clip points' stated origin), by distributed selection.

    The two order statistics around q * (n - 1) are bracketed by a mergeable quantile sketch; one aggregate over the
    table counts the rows below and inside every field's bracket exactly and sketches the inside for the next, narrower one. A
    bracket that a sketch placed wrongly is seen by its counts and widened. Only the values inside the last
    brackets are ranked, by their counts: at most ``ranked_values`` rows a field, or one value. No field is sorted, shuffled
    or gathered. Missing and NaN values don't count; a field without values gives no row.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    # per field: the bracket [lo, hi] (None: open), the sketch's margin, and the last bracket known to be right
    state = {c: {"lo": None, "hi": None, "margin": SKETCH_MARGIN, "sure": (None, None)} for c in cols}
    todo = list(cols)
    while todo:
        aggs = []
        for c in todo:
            x, s = F.col(c), state[c]
            below = F.lit(False) if s["lo"] is None else x < s["lo"]
            inside = x.isNotNull() & ~below if s["hi"] is None else ~below & (x <= s["hi"])
            aggs += [F.count(x).alias(f"{c}__n"), F.count(F.when(below, 1)).alias(f"{c}__below"), F.count(F.when(inside, 1)).alias(f"{c}__inside"),
                     F.min(F.when(inside, x)).alias(f"{c}__min"), F.max(F.when(inside, x)).alias(f"{c}__max"),
                     F.kll_sketch_agg_double(F.when(inside, x)).alias(f"{c}__sketch")]
        wide = values.agg(*aggs)
        shares = F.array(*[F.lit(i / SKETCH_STEPS) for i in range(SKETCH_STEPS + 1)])
        edges = [F.when(F.col(f"{c}__inside") > 0, F.kll_sketch_get_quantile_double(f"{c}__sketch", shares)).alias(f"{c}__edges") for c in todo]
        row = wide.select("*", *edges).drop(*[f"{c}__sketch" for c in todo]).first()  # a few hundred numbers per field
        for c in list(todo):
            s, get = state[c], lambda name, c=c: row[f"{c}__{name}"]
            n, below, inside = get("n"), get("below"), get("inside")
            position = q * (n - 1)
            if not n:
                todo.remove(c)
                del state[c]
            elif not below <= math.floor(position) <= math.ceil(position) < below + inside:  # a wrong bracket
                s["lo"], s["hi"] = s["sure"]
                s["margin"] *= 4
            elif inside <= ranked_values or get("min") == get("max"):
                s["lo"], s["hi"] = get("min"), get("max")
                s |= {"n": n, "below": below}
                todo.remove(c)
            else:
                s["sure"] = (get("min"), get("max"))
                low, high = (SKETCH_STEPS * (at - below) / inside for at in (math.floor(position), math.ceil(position)))
                margin = SKETCH_STEPS * s["margin"]
                s["lo"] = max(get("edges")[max(0, math.floor(low - margin))], get("min"))
                s["hi"] = min(get("edges")[min(SKETCH_STEPS, math.ceil(high + margin))], get("max"))
                if (s["lo"], s["hi"]) == s["sure"]:  # few values, many rows each: nothing more to narrow
                    s |= {"n": n, "below": below}
                    todo.remove(c)
    spark = df.sparkSession
    if not state:
        return spark.createDataFrame([], "field string, quantile double")
    inside = F.array(*[
        F.when(F.col(c).between(s["lo"], s["hi"]), F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))) for c, s in state.items()
    ])
    counted = values.select(F.explode(F.array_compact(inside)).alias("v")).groupBy("v.field", "v.value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("field").orderBy("value")
    before = F.create_map(*[v for c, s in state.items() for v in (F.lit(c), F.lit(s["below"]).cast("bigint"))])
    size = F.create_map(*[v for c, s in state.items() for v in (F.lit(c), F.lit(s["n"]).cast("bigint"))])
    placed = counted.withColumn("last", F.sum("n").over(upto) + F.element_at(before, F.col("field"))).withColumn("first", F.col("last") - F.col("n"))
    position = F.lit(q) * (F.element_at(size, F.col("field")) - 1)
    holds = lambda at: (F.col("first") <= at) & (at < F.col("last"))
    lo, hi = (F.max(F.when(holds(at), F.col("value"))) for at in (F.floor(position), F.ceil(position)))
    return placed.groupBy("field").agg((lo + (hi - lo) * F.first(position - F.floor(position))).alias("quantile"))


# ---------------------------------------------------------------- category fields

def unpivot(df: DataFrame, cols: Sequence[str], ids: Sequence[str], field: str = "field", value: str = "value",
            cast: str = "string", with_index: bool = False) -> DataFrame:
    """Long form (ids..., field, value[, field_idx]) of the given columns."""
    parts = [F.struct(F.lit(c).alias(field), F.col(c).cast(cast).alias(value),
                      F.lit(i).alias("field_idx")) for i, c in enumerate(cols)]
    out = df.select(*ids, F.explode(F.array(*parts)).alias("_kv")).select(
        *ids, F.col(f"_kv.{field}").alias(field), F.col(f"_kv.{value}").alias(value),
        *([F.col("_kv.field_idx").alias("field_idx")] if with_index else []),
    )
    return out


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, value, count) of non-missing values; partial counts per task first."""
    long = unpivot(df, cols, []).where(F.col("value").isNotNull() & (F.col("value") != ""))
    return long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def fit_vocab(df: DataFrame, cols: Sequence[str], cutoff: int = 10) -> DataFrame:
    """(field, value, count, code). ``<unk>`` is code 0; a literal ``<unk>`` in the data
    takes code 0 too and leaves its rank unused (B12)."""
    vc = materialize(value_counts(df, cols).where(F.col("count") >= cutoff), "value-counts")  # sampled, then sorted
    ranked = global_rank(vc, [F.col("count").desc(), F.col("value").asc()], by=["field"], name="code")
    return ranked.withColumn("code", F.when(F.col("value") == UNK, F.lit(0)).otherwise(F.col("code")).cast("bigint"))


def written_vocab(df: DataFrame, cols: Sequence[str], cutoff: int = 10) -> DataFrame:
    """``fit_vocab`` once, as a written table: later readers (sizes, one join per field, micro-batches)
    read that and never fit again."""
    return materialize(fit_vocab(df, cols, cutoff), "vocab")


def vocab_offsets(spark: SparkSession, vocab: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, field_idx, size, offset); size = codes + 1 for ``<unk>``, offset = sum of the
    sizes of the earlier fields. The field list is a parameter, so a field whose vocabulary
    is empty still has size 1 (B11)."""
    fields = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "field string, field_idx int")
    n = vocab.where(F.col("value") != UNK).groupBy("field").agg(F.count(F.lit(1)).alias("_n"))
    sizes = fields.join(n, "field", "left").select(
        "field", "field_idx", (F.coalesce("_n", F.lit(0)) + 1).cast("bigint").alias("size")
    )
    w = Window.orderBy("field_idx").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("offset", F.coalesce(F.sum("size").over(w), F.lit(0)).cast("bigint"))


def _entry_bytes() -> Column:
    """A generous estimate of what a broadcast entry takes: the value, its code and the hash table's row."""
    return F.octet_length("value") + F.lit(ENTRY_BYTES)


def head_cut(vocab: DataFrame, head_bytes: int) -> tuple[int | None, bool]:
    """(least count of the head, whether the head is all of ``vocab``), by a histogram of the entries' bytes over their counts.

    The head is the most frequent entries of all fields together, as many as fit in ``head_bytes``. Counts
    are binned by powers of 2^(1/4), so a few hundred rows reach the driver however large the vocabulary. None: not even
    the most frequent bin fits.
    """
    level = F.floor(4 * F.log2(F.col("count").cast("double"))).cast("int").alias("level")
    bins = vocab.groupBy(level).agg(F.sum(_entry_bytes()).alias("bytes"), F.min("count").alias("least")).collect()
    used, least = 0, None
    for b in sorted(bins, key=lambda r: -r.level):
        if used + b.bytes > head_bytes:
            return least, False
        used, least = used + b.bytes, b.least
    return least, True


def apply_vocab(df: DataFrame, cols: Sequence[str], vocab: DataFrame, suffix: str = "_code",
                head_bytes: int = HEAD_BYTES) -> DataFrame:
    """Add ``<col><suffix>`` = code of the value, 0 when missing or unseen.

    ``vocab`` is ``fit_vocab``'s (field, value, count, code). Its most frequent entries, up to ``head_bytes`` in all,
    are broadcast and joined field by field without moving ``df``; they are also the keys that hold more than their share of
    the rows. What is left of the vocabulary, if anything, is the tail: the values that the head lacks are joined to it by one
    shuffle in long form over all fields, where no key is frequent, and a row's few tail codes come back as one map.
    """
    least, whole = head_cut(vocab, head_bytes)
    voc = vocab.select("field", "value", "count", "code")
    head = voc.where(F.col("count") >= least) if least is not None else voc.limit(0)
    out = df
    for c in cols:
        v = F.broadcast(head.where(F.col("field") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(c + suffix)))
        out = out.join(v, out[c].cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    if not whole:
        rid = "_row_id"
        # written once: the readers below must see the same row numbers, whatever order ``df`` computes its rows in
        out = materialize(out.withColumn(rid, F.monotonically_increasing_id()), "vocab-rows")
        tail = voc if least is None else voc.where(F.col("count") < least)
        asked = [F.when(F.col(c + suffix).isNull() & F.col(c).isNotNull(), F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")))
                 for c in cols]
        missing = out.select(rid, F.explode(F.array_compact(F.array(*asked))).alias("_m")).select(rid, "_m.field", "_m.value")
        found = missing.join(tail.select("field", "value", "code"), ["field", "value"])
        codes = found.groupBy(rid).agg(F.map_from_entries(F.collect_list(F.struct("field", "code"))).alias("_codes"))  # an entry a field at most
        out = out.join(codes, rid, "left")
        out = out.select(*[c for c in out.columns if c not in (rid, "_codes") and c not in [k + suffix for k in cols]],
                         *[F.coalesce(F.col(c + suffix), F.element_at("_codes", F.lit(c))).alias(c + suffix) for c in cols])
    return out.withColumns({c + suffix: F.coalesce(F.col(c + suffix), F.lit(0)).cast("bigint") for c in cols})


def global_index_columns(cols: Sequence[str], offsets: dict[str, int], base: int, suffix: str = "_code") -> list[Column]:
    """one-hot index = code + field offset + base (the width of the numeric block)."""
    return [(F.col(c + suffix) + F.lit(offsets[c] + base)).alias(c + "_idx") for c in cols]


def collect_offsets(offsets: DataFrame) -> dict[str, int]:
    """One row per field reaches the driver."""
    return {r["field"]: int(r["offset"]) for r in offsets.collect()}


# ---------------------------------------------------------------- indexers and labels

def string_index(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """F8: frequency string indexer, 0-based; ties alphabetical (as Spark ML's default
    ``frequencyDesc`` orders them). Distinct values are ranked, then joined back."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c")).where(F.col(col).isNotNull())
    ranked = global_rank(counts, [F.col("_c").desc(), F.col(col).asc()], name="_r")
    labels = ranked.select(col, (F.col("_r") - 1).cast("int").alias(out))
    return df.join(labels, col, "left")


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """sorted distinct value -> 0..n-1 (scikit-learn LabelEncoder)."""
    distinct = df.select(col).distinct().where(F.col(col).isNotNull())
    ranked = global_rank(distinct, [F.col(col).asc()], name="_r")
    return df.join(ranked.select(col, (F.col("_r") - 1).cast("int").alias(out)), col, "left")


def threshold_label(rating: str = "rating", threshold: float = 4, name: str = "label") -> Column:
    """1 when rating >= threshold else 0."""
    return F.when(F.col(rating) >= threshold, F.lit(1)).otherwise(F.lit(0)).alias(name)


def sign_label(x: str, name: str = "target") -> Column:
    """P5: -1 when x < 0.5 else 1."""
    return F.when(F.col(x) < 0.5, F.lit(-1)).otherwise(F.lit(1)).alias(name)


def prior_log_odds(df: DataFrame, by: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """P14 re-aimed: ln(p / (1 - p)) of each 0/1 label's mean per group (e.g. a bias init)."""
    aggs = []
    for lab in labels:
        aggs.append(F.round(log_odds(F.avg(F.col(lab).cast("double"))), 6).alias(f"{lab}_logit"))
    return df.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n"))


def token_from_end(line: str, n: int, sep: str = " ", part_sep: str = ":", part: int = 2) -> Column:
    """The n-th token from the end, then its ``part``-th piece after splitting on ':'."""
    tok = F.element_at(F.split(F.col(line), sep), -n)
    return F.element_at(F.split(tok, part_sep), part)
