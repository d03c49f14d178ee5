"""Readers (S1-S4, S10, S15-S17).

CSV with a header and an explicit schema (the reference declares one and never passes it, so
every column arrives as a string), CSV with inferred types, headerless TSV by position with
'' as missing, idx:val text parsed back into (label, [(idx, val)]), a text scan with a prefix
filter, an ordered head, and random columns attached to an existing table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinity.session import materialize


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             infer: bool = False, sep: str = ",", null_value: str | None = None) -> DataFrame:
    r = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value).option("emptyValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_tsv_positional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """S3: headerless tab-separated rows by position; an empty field is missing (NULL)."""
    return read_csv(spark, path, schema=schema, header=False, sep="\t", null_value="")


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, header: bool = False, sep: str = "\t",
                     null_value: str | None = "") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): delimited lines that fit the schema, and (line, reason) of those that don't.

    A line is rejected when its number of fields differs from the schema's or a field can't be read as its type; the reader itself
    keeps such lines as corrupt records. The reason names the first of them: ``fields: <found> of <expected>`` or
    ``value: <column>``. Nothing is dropped or read as missing: every line is in one of the two.
    """
    want = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    bad = "_corrupt_line"
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
    if null_value is not None:
        r = r.option("nullValue", null_value).option("emptyValue", null_value)
    # written once: both results read it, and a reader that parses only some of the columns would find fewer faults
    rows = materialize(r.schema(StructType([*want.fields]).add(bad, "string")).csv(path), "checked-lines")
    good = rows.where(F.col(bad).isNull()).drop(bad)
    rejects = rows.where(F.col(bad).isNotNull()).select(bad, *[F.col(f.name).isNull().alias(f.name) for f in want.fields])
    fields = F.split(bad, re.escape(sep), -1)
    reason = F.when(F.size(fields) != len(want.fields), F.concat(F.lit("fields: "), F.size(fields).cast("string"), F.lit(f" of {len(want.fields)}")))
    for i, f in enumerate(want.fields):
        given = F.get(fields, F.lit(i))
        reason = reason.when(F.col(f.name) & (given != (null_value or "")), F.lit(f"value: {f.name}"))
    return good, rejects.select(F.col(bad).alias("line"), reason.otherwise(F.lit("line")).alias("reason"))


def parse_pairs_checked(lines: DataFrame, line: str, sep: str = " ") -> tuple[DataFrame, DataFrame]:
    """S10 with a reject channel: (good, rejects) of 'label idx:val ...' lines.

    good: the columns of ``lines``, then label int and pairs; rejects: the columns of ``lines`` and the reason, ``label`` or
    ``pair <place>`` (from 1) of the first token that isn't ``index:number``.
    """
    toks = F.split(F.col(line), sep)
    label = F.expr("try_cast(try_cast(_toks[0] AS double) AS int)")
    pairs = F.expr("""transform(transform(filter(slice(_toks, 2, greatest(size(_toks) - 1, 0)), t -> t <> ''), t -> split(t, ':')), p -> struct(
        try_cast(p[0] AS int) AS idx, try_cast(get(p, 1) AS double) AS val, size(p) AS parts))""")
    wrong = F.expr("transform(_pairs, p -> p.idx IS NULL OR p.val IS NULL OR p.parts <> 2)")
    read = lines.withColumn("_toks", toks).withColumn("_label", label).withColumn("_pairs", pairs).withColumn("_at", F.array_position(wrong, F.lit(True)))
    clean = F.transform("_pairs", lambda p: F.struct(p["idx"].alias("idx"), p["val"].alias("val")))
    # written once: both results read it, and a filter on what was parsed would parse every line again, in each of them
    read = materialize(read.select(*lines.columns, "_label", clean.alias("_pairs"), "_at"), "parsed-lines")
    fine = F.col("_label").isNotNull() & (F.col("_at") == 0)
    reason = F.when(F.col("_label").isNull(), F.lit("label")).otherwise(F.concat(F.lit("pair "), F.col("_at").cast("string")))
    good = read.where(F.coalesce(fine, F.lit(False))).select(*lines.columns, F.col("_label").alias("label"), F.col("_pairs").alias("pairs"))
    return good, read.where(~F.coalesce(fine, F.lit(False))).select(*lines.columns, reason.alias("reason"))


def truncated_int(c) -> Column:
    """P2: '3.5' -> 3. A direct string -> int cast fails under ANSI mode, so go via double."""
    return (F.col(c) if isinstance(c, str) else c).cast("double").cast("int")


def parse_pairs(line, sep: str = " ", labeled: bool = True) -> tuple[Column, Column]:
    """S10: 'label idx:val idx:val ...' -> (label, array<struct<idx int, val double>>).

    Index 0 is valid (zero-based text), which Spark's libsvm source rejects.
    """
    toks = F.split(F.col(line) if isinstance(line, str) else line, sep)
    label = F.element_at(toks, 1).cast("double").cast("int") if labeled else F.lit(None).cast("int")
    first = 1 if labeled else 0
    parts = F.transform(F.filter(toks, lambda t, i: (i >= first) & (t != "")), lambda t: F.split(t, ":"))
    pairs = F.transform(parts, lambda p: F.struct(p.getItem(0).cast("int").alias("idx"), p.getItem(1).cast("double").alias("val")))
    return label, pairs


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def filter_prefix(lines: DataFrame, prefix: str, col: str = "value") -> DataFrame:
    """Keep the lines that start with ``prefix``."""
    return lines.where(F.col(col).startswith(prefix))


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    """A stable peek: the first n rows in a total order (top-n per task, then merged)."""
    return df.orderBy(*order).limit(n)


def with_random_columns(df: DataFrame, key: list[str], seed: int = 2020, uniform: str = "u", normal: str = "z") -> DataFrame:
    """A uniform (32 bits of an md5 of seed and key, / 2^32) and a normal column (Box-Muller of two
    such) per row: values depend on the row's key only, not on its partition."""

    def unit(salt: int) -> Column:
        text = F.concat_ws("-", F.lit(f"{seed}-{salt}"), *[F.col(k).cast("string") for k in key])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)

    z = F.sqrt(-2 * F.log(1 - unit(1))) * F.cos(2 * F.pi() * unit(2))
    return df.withColumn(uniform, unit(0)).withColumn(normal, z)
