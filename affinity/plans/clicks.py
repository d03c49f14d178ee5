"""Click-log queries: clipping, scaling, vocabularies, offsets and the text line formats."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from affinity.functions.columns import hash_bucket, trim_decimal
from affinity.operators import features
from affinity.plans import sql as S
from affinity.plans.registry import query
from affinity.session import materialize
from affinity.sources import readers, tables, writers

NUM = tables.CLICK_NUMERIC
CAT = tables.CLICK_CATEGORY
CLIPS = tables.CLICK_CLIPS
CUTOFF = 10
CUTOFF_FFM = 200


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _clicks(spark: SparkSession, sf: str):
    """The click rows, written once: the fits and the apply step all read them."""
    return materialize(tables.clicks(spark, sf), "clicks")


def _encoded(spark: SparkSession, sf: str, cutoff: int = CUTOFF):
    """Rows with scaled numerics (<i>_s), codes (<c>_code), global indexes (<c>_idx), split."""
    clicks = _clicks(spark, sf)
    stats = features.fit_minmax(clicks, NUM, CLIPS)
    vocab = features.written_vocab(clicks, CAT, cutoff)
    offsets = features.collect_offsets(features.vocab_offsets(spark, vocab, CAT))
    out = features.apply_minmax(clicks, stats, suffix="_s")
    out = features.apply_vocab(out, CAT, vocab)
    out = out.select("*", *features.global_index_columns(CAT, offsets, base=len(NUM)))
    return out.withColumn("is_train", hash_bucket(["row_key"], 10) != 0)


_SPLIT_COL = f"{S.bucket('row_key')} <> 0 AS is_train"
_ENC = [S.CLICKS, S.MINMAX, S.SCALED, S.vocab(CUTOFF), S.offsets(), S.coded()]
_ENC_FFM = [S.CLICKS, S.MINMAX, S.SCALED, S.vocab(CUTOFF_FFM), S.offsets(), S.coded()]
_VALS = [f"{c}_s" for c in NUM]


def _fm_sql(sep: str, labeled: bool) -> str:
    parts = (["CAST(label AS VARCHAR)"] if labeled else []) + [
        f"'{i}:' || {S.trim(v)}" for i, v in enumerate(_VALS)] + [f"{c}_idx || ':1'" for c in CAT]
    return f"concat_ws({sep}, " + ", ".join(parts) + ")"


# ------------------------------------------------------------------ numeric fields

@query("num_clip_minmax", _with(S.CLICKS, S.MINMAX) + " UNION ALL ".join(
    f"SELECT '{c}' AS field, {c}_min AS min_value, {c}_max AS max_value FROM mm" for c in NUM))
def q_num_clip_minmax(spark, sf):
    return features.clipped_minmax(tables.clicks(spark, sf), NUM, CLIPS)


@query("num_quantile_clip", _with(S.CLICKS) + " UNION ALL ".join(
    f"SELECT '{c}' AS field, round(quantile_cont({c}, 0.95), 6) AS quantile FROM clicks" for c in NUM))
def q_num_quantile_clip(spark, sf):
    q = features.quantile_points(_clicks(spark, sf), NUM, 0.95)
    return q.select("field", F.round("quantile", 6).alias("quantile"))


@query("num_minmax_apply", _with(S.CLICKS, S.MINMAX, S.SCALED) + "SELECT row_key, "
       + ", ".join(f"round({c}_s, 6) AS {c}_s" for c in NUM) + " FROM scaled")
def q_num_minmax_apply(spark, sf):
    clicks = _clicks(spark, sf)
    out = features.apply_minmax(clicks, features.fit_minmax(clicks, NUM, CLIPS), suffix="_s")
    return out.select("row_key", *[F.round(f"{c}_s", 6).alias(f"{c}_s") for c in NUM])


@query("fmt_trim_decimal", _with(S.CLICKS, S.MINMAX, S.SCALED) + "SELECT row_key, "
       + ", ".join(f"{S.trim(c + '_s')} AS {c}_t" for c in NUM) + " FROM scaled")
def q_fmt_trim_decimal(spark, sf):
    clicks = _clicks(spark, sf)
    out = features.apply_minmax(clicks, features.fit_minmax(clicks, NUM, CLIPS), suffix="_s")
    return out.select("row_key", *[trim_decimal(f"{c}_s").alias(f"{c}_t") for c in NUM])


# ------------------------------------------------------------------ category fields

@query("enc_value_counts", _with(S.CLICKS) + "SELECT field, value, count(*) AS count FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value FROM clicks" for c in CAT)
       + ") WHERE value IS NOT NULL AND value <> '' GROUP BY field, value")
def q_enc_value_counts(spark, sf):
    return features.value_counts(tables.clicks(spark, sf), CAT)


@query("enc_vocab_fit", _with(S.CLICKS, S.vocab(CUTOFF)) + "SELECT field, value, count, code FROM vocab")
def q_enc_vocab_fit(spark, sf):
    # one reader of the click rows: no need to write them first
    return features.fit_vocab(tables.clicks(spark, sf), CAT, CUTOFF).select("field", "value", "count", "code")


@query("enc_offsets", _with(S.CLICKS, S.vocab(CUTOFF), S.offsets()) + 'SELECT field, field_idx, size, "offset" FROM offs')
def q_enc_offsets(spark, sf):
    vocab = features.written_vocab(_clicks(spark, sf), CAT, CUTOFF)
    return features.vocab_offsets(spark, vocab, CAT).select("field", "field_idx", "size", "offset")


@query("enc_vocab_apply", _with(*_ENC) + "SELECT row_key, " + ", ".join(f"{c}_code" for c in CAT) + " FROM coded")
def q_enc_vocab_apply(spark, sf):
    clicks = _clicks(spark, sf)
    vocab = features.written_vocab(clicks, CAT, CUTOFF)
    return features.apply_vocab(clicks, CAT, vocab).select("row_key", *[f"{c}_code" for c in CAT])


@query("enc_global_index", _with(*_ENC) + "SELECT row_key, " + ", ".join(f"{c}_idx" for c in CAT) + " FROM coded")
def q_enc_global_index(spark, sf):
    return _encoded(spark, sf).select("row_key", *[f"{c}_idx" for c in CAT])


# ------------------------------------------------------------------ line formats

_CTR_SQL = "concat_ws(',', " + ", ".join([S.trim(v) for v in _VALS] + [f"{c}_code" for c in CAT] + ["label"]) + ")"


@query("fmt_ctr_csv", _with(*_ENC) + f"SELECT row_key, {_SPLIT_COL}, {_CTR_SQL} AS line FROM coded")
def q_fmt_ctr_csv(spark, sf):
    e = _encoded(spark, sf)
    return e.select("row_key", "is_train", writers.ctr_line(_VALS, [f"{c}_code" for c in CAT], "label").alias("line"))


@query("fmt_fm_line", _with(*_ENC) + f"SELECT row_key, {_SPLIT_COL}, {_fm_sql(chr(39) + ' ' + chr(39), True)} AS line FROM coded")
def q_fmt_fm_line(spark, sf):
    e = _encoded(spark, sf)
    return e.select("row_key", "is_train", writers.fm_line(_VALS, [f"{c}_idx" for c in CAT], "label").alias("line"))


_FFM_SQL = "concat_ws(chr(9), " + ", ".join(
    ["CAST(label AS VARCHAR)"] + [f"'{i}:{i}:' || {S.trim(v)}" for i, v in enumerate(_VALS)]
    + [f"'{len(NUM) + j}:' || {c}_idx || ':1'" for j, c in enumerate(CAT)]) + ")"


@query("fmt_ffm_line", _with(*_ENC_FFM) + f"SELECT row_key, {_SPLIT_COL}, {_FFM_SQL} AS line FROM coded")
def q_fmt_ffm_line(spark, sf):
    e = _encoded(spark, sf, CUTOFF_FFM)
    return e.select("row_key", "is_train", writers.ffm_line(_VALS, [f"{c}_idx" for c in CAT], "label").alias("line"))


# ------------------------------------------------------------------ the test-file pass: no label column


@query("fmt_ctr_unlabeled", _with(*_ENC) + "SELECT row_key, concat_ws(',', "
       + ", ".join([S.trim(v) for v in _VALS] + [f"{c}_code" for c in CAT]) + ") AS line FROM coded")
def q_fmt_ctr_unlabeled(spark, sf):
    e = _encoded(spark, sf)
    return e.select("row_key", writers.ctr_line(_VALS, [f"{c}_code" for c in CAT]).alias("line"))


@query("fmt_fm_unlabeled", _with(*_ENC) + f"SELECT row_key, {_fm_sql(chr(39) + ' ' + chr(39), False)} AS line FROM coded")
def q_fmt_fm_unlabeled(spark, sf):
    e = _encoded(spark, sf)
    return e.select("row_key", writers.fm_line(_VALS, [f"{c}_idx" for c in CAT]).alias("line"))


@query("fmt_ffm_unlabeled", _with(*_ENC_FFM) + "SELECT row_key, concat_ws(chr(9), "
       + ", ".join([f"'{i}:{i}:' || {S.trim(v)}" for i, v in enumerate(_VALS)]
                   + [f"'{len(NUM) + j}:' || {c}_idx || ':1'" for j, c in enumerate(CAT)]) + ") AS line FROM coded")
def q_fmt_ffm_unlabeled(spark, sf):
    e = _encoded(spark, sf, CUTOFF_FFM)
    return e.select("row_key", writers.ffm_line(_VALS, [f"{c}_idx" for c in CAT]).alias("line"))


_SVM_SQL = ("concat_ws(' ', CAST(CASE WHEN label < 0.5 THEN -1 ELSE 1 END AS VARCHAR), "
            + ", ".join(f"CASE WHEN {v} <> 0 THEN '{i}:' || {S.double_text(v)} END" for i, v in enumerate(_VALS)) + ")")


@query("fmt_svmlight_line", _with(S.CLICKS, S.MINMAX, S.SCALED) + f"SELECT row_key, {_SVM_SQL} AS line FROM scaled")
def q_fmt_svmlight_line(spark, sf):
    clicks = _clicks(spark, sf)
    out = features.apply_minmax(clicks, features.fit_minmax(clicks, NUM, CLIPS), suffix="_s")
    return out.select("row_key", writers.svmlight_line(features.sign_label("label"), _VALS).alias("line"))


@query("fmt_svmlight_parse", _with(*_ENC) + f"""SELECT row_key, label, CAST(pos - 1 AS INTEGER) AS pos,
       CAST(split_part(tok, ':', 1) AS INTEGER) AS idx, CAST(split_part(tok, ':', 2) AS DOUBLE) AS val
FROM (SELECT row_key, label, unnest(toks) AS tok, unnest(generate_series(1, len(toks))) AS pos
      FROM (SELECT row_key, label, string_split({_fm_sql(chr(39) + ' ' + chr(39), True)}, ' ')[2:] AS toks FROM coded))""")
def q_fmt_svmlight_parse(spark, sf):
    e = _encoded(spark, sf)
    lines = e.select("row_key", writers.fm_line(_VALS, [f"{c}_idx" for c in CAT], "label").alias("line"))
    label, pairs = readers.parse_pairs("line")
    parsed = lines.select("row_key", label.alias("label"), pairs.alias("pairs"))
    return parsed.select("row_key", "label", F.posexplode("pairs").alias("pos", "p")).select(
        "row_key", "label", "pos", F.col("p.idx").alias("idx"), F.col("p.val").alias("val"))


# lines damaged by the hash of their key: no label, a value that is no number, a pair without a value, one with two
_DAMAGED = f"""SELECT row_key, CASE {S.bucket('row_key', 40)} WHEN 0 THEN 'x' || line WHEN 1 THEN line || ' 7:one'
       WHEN 2 THEN line || ' 8' WHEN 3 THEN line || ' 9:1:1' ELSE line END AS line, {S.bucket('row_key', 40)} AS b, label, toks
FROM (SELECT row_key, label, line, string_split(line, ' ')[2:] AS toks
      FROM (SELECT row_key, label, {_fm_sql(chr(39) + ' ' + chr(39), True)} AS line FROM coded))"""


@query("fmt_svmlight_rejects", _with(*_ENC) + f"""SELECT row_key, CASE WHEN b > 3 THEN label END AS label,
       CASE WHEN b > 3 THEN len(toks) END AS n_pairs, CASE WHEN b > 3 THEN round(list_sum(list_transform(toks,
            lambda t: CAST(split_part(t, ':', 1) AS BIGINT) * CAST(split_part(t, ':', 2) AS DOUBLE))), 6) END AS checksum,
       CASE WHEN b = 0 THEN 'label' WHEN b <= 3 THEN 'pair ' || (len(toks) + 1) END AS reason
FROM ({_DAMAGED})""")
def q_fmt_svmlight_rejects(spark, sf):
    """S10 with a reject channel: FM lines, one in ten damaged, parsed into good rows and lines with a reason."""
    e = _encoded(spark, sf)
    # the bucket and the line are columns of their own: used in several branches, they would be computed in each
    whole = e.select("row_key", hash_bucket(["row_key"], 40).alias("b"), writers.fm_line(_VALS, [f"{c}_idx" for c in CAT], "label").alias("line"))
    b, line = F.col("b"), F.col("line")
    damaged = F.when(b == 0, F.concat(F.lit("x"), line)).when(b == 1, F.concat(line, F.lit(" 7:one"))).when(
        b == 2, F.concat(line, F.lit(" 8"))).when(b == 3, F.concat(line, F.lit(" 9:1:1"))).otherwise(line)
    lines = whole.select("row_key", damaged.alias("line"))
    good, rejects = readers.parse_pairs_checked(lines, "line")
    total = F.aggregate("pairs", F.lit(0.0), lambda acc, p: acc + p["idx"] * p["val"])
    kept = good.select("row_key", "label", F.size("pairs").cast("bigint").alias("n_pairs"), F.round(total, 6).alias("checksum"))
    return kept.unionByName(rejects.select("row_key", "reason"), allowMissingColumns=True)


def _reformat_sql(labeled: bool) -> str:
    src = _fm_sql("chr(9)", labeled)
    rest = "toks[2:]" if labeled else "toks"
    label = "CAST(CAST(toks[1] AS DOUBLE) AS BIGINT)" if labeled else "0"
    return _with(*_ENC) + f"""SELECT row_key, concat_ws(' ', CAST({label} AS VARCHAR),
       array_to_string(list_transform({rest}, lambda t: CAST(split_part(t, ':', 1) AS INTEGER) || ':' ||
                       printf('%.16f', CAST(split_part(t, ':', 2) AS DOUBLE))), ' ')) AS line
FROM (SELECT row_key, string_split({src}, chr(9)) AS toks FROM coded)"""


@query("fmt_reformat", _reformat_sql(True))
def q_fmt_reformat(spark, sf):
    e = _encoded(spark, sf)
    tab = e.select("row_key", writers.fm_line(_VALS, [f"{c}_idx" for c in CAT], "label", sep="\t").alias("tl"))
    return tab.select("row_key", writers.reformat_line("tl", "\t", labeled=True).alias("line"))


@query("fmt_reformat_unlabeled", _reformat_sql(False))
def q_fmt_reformat_unlabeled(spark, sf):
    e = _encoded(spark, sf)
    tab = e.select("row_key", writers.fm_line(_VALS, [f"{c}_idx" for c in CAT], None, sep="\t").alias("tl"))
    return tab.select("row_key", writers.reformat_line("tl", "\t", labeled=False).alias("line"))


@query("project_token", _with(*_ENC_FFM) + f"""SELECT row_key, split_part(toks[len(toks) - 1], ':', 2) AS token
FROM (SELECT row_key, string_split({_FFM_SQL}, chr(9)) AS toks FROM coded)""")
def q_project_token(spark, sf):
    e = _encoded(spark, sf, CUTOFF_FFM)
    lines = e.select("row_key", writers.ffm_line(_VALS, [f"{c}_idx" for c in CAT], "label").alias("line"))
    return lines.select("row_key", features.token_from_end("line", 2, sep="\t").alias("token"))


@query("split_90_10", _with(S.CLICKS) + f"SELECT row_key, label, {_SPLIT_COL} FROM clicks")
def q_split_90_10(spark, sf):
    from affinity.operators import split
    return split.split_90_10(tables.clicks(spark, sf), ["row_key"]).select("row_key", "label", "is_train")


@query("label_logit", """SELECT d.lang,
       round(CASE WHEN avg(l.quality) > 0 AND avg(l.quality) < 1 THEN ln(avg(l.quality) / (1 - avg(l.quality))) END, 6) AS quality_logit,
       round(CASE WHEN avg(l.toxic) > 0 AND avg(l.toxic) < 1 THEN ln(avg(l.toxic) / (1 - avg(l.toxic))) END, 6) AS toxic_logit,
       count(*) AS n
FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY d.lang""")
def q_label_logit(spark, sf):
    lab = tables.load(spark, sf, "labels")
    docs = tables.load(spark, sf, "documents").select("doc_id", "lang")
    return features.prior_log_odds(lab.join(docs, "doc_id"), ["lang"], ["quality", "toxic"]).select(
        "lang", "quality_logit", "toxic_logit", "n")
