"""Writers and text line formats.

Every line format is a column expression, so a query can return the lines and be checked
row for row; ``write_text``/``write_csv``/``write_shards`` put them into files.

* CTR CSV  (S6): ``v1,...,vN,c1,...,cM[,label]``       values as trimmed 6-place decimals
* FM       (S7): ``label 0:v0 ... (N-1):v idx:1 ...``  zero-based, space separated
* FFM      (S8): ``label\\tf:f:v ... f:idx:1``          field number:feature index:value
* svmlight (S9): ``target idx:val ...``                 zero entries left out, zero-based
* reformat (S11/S12): ``label idx:val`` with the value written as ``%.16f``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.columns import double_text, fixed16, trim_decimal
from affinity.operators.ranking import global_rank


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ctr_line(values: Sequence, codes: Sequence, label=None) -> Column:
    parts = [trim_decimal(_c(v)) for v in values] + [_c(c).cast("string") for c in codes]
    if label is not None:
        parts.append(_c(label).cast("string"))
    return F.concat_ws(",", *parts)


def fm_line(values: Sequence, indexes: Sequence, label=None, sep: str = " ") -> Column:
    parts = [] if label is None else [_c(label).cast("string")]
    parts += [F.concat(F.lit(f"{i}:"), trim_decimal(_c(v))) for i, v in enumerate(values)]
    parts += [F.concat(_c(ix).cast("string"), F.lit(":1")) for ix in indexes]
    return F.concat_ws(sep, *parts)


def ffm_line(values: Sequence, indexes: Sequence, label=None, sep: str = "\t") -> Column:
    parts = [] if label is None else [_c(label).cast("string")]
    n = len(values)
    parts += [F.concat(F.lit(f"{i}:{i}:"), trim_decimal(_c(v))) for i, v in enumerate(values)]
    parts += [F.concat(F.lit(f"{n + j}:"), _c(ix).cast("string"), F.lit(":1")) for j, ix in enumerate(indexes)]
    return F.concat_ws(sep, *parts)


def svmlight_line(target, features: Sequence) -> Column:
    """Zero-based ``idx:val`` for the non-zero features only, values with all digits of the double."""
    items = [F.when(_c(f) != 0, F.concat(F.lit(f"{i}:"), double_text(_c(f)))) for i, f in enumerate(features)]
    return F.concat_ws(" ", _c(target).cast("string"), *items)  # concat_ws skips NULLs


def reformat_line(line, in_sep: str = "\t", labeled: bool = True, label_value: int = 0) -> Column:
    """Re-emit 'label idx:val ...' space separated with 16-decimal values.

    The value is read as a double and written as ``%.16f`` writes it, the double's exact value rounded half-even
    ('2.08' becomes '2.0800000000000001'). Unlabeled input gets ``label_value`` prepended
    (the reference overwrote feature 0 with it, B13).
    """
    toks = F.split(_c(line), in_sep)
    label = F.element_at(toks, 1).cast("double").cast("bigint").cast("string") if labeled else F.lit(str(label_value))
    first = 1 if labeled else 0
    pairs = F.transform(
        F.filter(toks, lambda t, i: (i >= first) & (t != "")),
        lambda t: F.concat(
            F.split(t, ":").getItem(0).cast("int").cast("string"), F.lit(":"), fixed16(F.split(t, ":").getItem(1).cast("double")),
        ),
    )
    return F.concat_ws(" ", label, F.array_join(pairs, " "))


def write_text(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    df.select(_c(col).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite",
              null_value: str | None = None) -> None:
    w = df.write.mode(mode).option("header", header).option("sep", sep)
    if null_value is not None:
        w = w.option("nullValue", null_value).option("emptyValue", null_value)
    w.csv(path)


def write_shards(df: DataFrame, path: str, n: int, header: bool = True, key: Sequence[str] | None = None,
                 ordered_by: Sequence[str] | None = None) -> None:
    """N CSV files, each with its own header.

    ``key`` hash-partitions (deterministic shard of each row); ``ordered_by`` range-partitions
    so that shards keep the order; neither gives near-equal round-robin shards.
    """
    if ordered_by:
        parts = df.repartitionByRange(n, *ordered_by).sortWithinPartitions(*ordered_by)
    elif key:
        parts = df.repartition(n, *key)
    else:
        parts = df.repartition(n)
    write_csv(parts, path, header=header)


def consecutive_shards(df: DataFrame, n: int, order: Sequence[str], name: str = "shard", place: str = "place") -> DataFrame:
    """``df`` dealt to n partitions of consecutive rows in ``order`` (unique), sizes at most one apart, sorted inside.

    ``name`` is the partition's number (from 0), ``place`` the row's place in it (from 1). The place in the whole
    table is a range-partitioned rank, so no task sorts or holds more than its share; the shard follows from it by
    arithmetic (the first ``total % n`` shards take one row more) and names the partition explicitly. Rows with a
    null in ``order`` come first.
    """
    ranked = global_rank(df, [F.col(c).asc() for c in order], name="_rank")
    total = ranked.count()
    small, more = divmod(total, n)
    at = F.col("_rank") - 1
    ahead = more * (small + 1)  # rows of the longer shards
    in_long = at < ahead
    shard = F.when(in_long, F.floor(at / (small + 1))).otherwise(more + F.floor((at - ahead) / max(small, 1))).cast("int")
    offset = F.when(in_long, at % (small + 1)).otherwise((at - ahead) % max(small, 1))
    dealt = ranked.withColumn(name, shard).withColumn(place, (offset + 1).cast("bigint"))
    return dealt.repartitionById(n, F.col(name)).sortWithinPartitions(place).drop("_rank")


def write_consecutive_shards(df: DataFrame, path: str, n: int, order: Sequence[str], header: bool = True) -> None:
    """N CSV files, each with its own header, that hold the table's rows one file after the other in ``order``.

    Spark names a file after its partition, so the files' names are in the rows' order too; a shard without rows
    (fewer rows than shards) has no file."""
    dealt = consecutive_shards(df, n, order)
    write_csv(dealt.drop("shard", "place"), path, header=header)


def dump_columns(df: DataFrame, cols: Sequence[str], path: str, mode: str = "overwrite") -> DataFrame:
    """Write the selected columns as Parquet at ``path`` and return the reread rows."""
    df.select(*cols).write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)
