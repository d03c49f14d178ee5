"""Scalar column expressions.

Each helper returns a ``Column`` made only of built-in functions, so that it stays inside
whole-stage codegen and can be mirrored exactly by the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(cols: Sequence) -> Column:
    """Unsigned 32-bit hash of the row key: the first 8 hex digits of md5('a-b-...').

    The same number comes out of the DuckDB expression
    ``('0x' || substr(md5(concat_ws('-', a, b)), 1, 8))::bigint``, so splits and samples are
    reproducible across engines, unlike seeded ``rand``.
    """
    key = F.concat_ws("-", *[_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_bucket(cols: Sequence, buckets: int = 10) -> Column:
    return hash_u32(cols) % F.lit(buckets)


def trim_decimal(x, digits: int = 6) -> Column:
    """Fixed-point text with trailing zeros and a bare dot removed: 0.5 -> '0.5', 10 -> '10'."""
    fixed = _col(x).cast(f"decimal(38,{digits})").cast("string")
    return F.rtrim(F.rtrim(fixed, F.lit("0")), F.lit("."))


def double_text(x) -> Column:
    """The shortest text that reads back as the same double: 0.5, 10, 0.9795975134490658, 1e-07.

    Plain digits from 1e-4 to 1e16, else mantissa and an exponent of two digits or more, as C's %g writes them.
    """
    x = _col(x).cast("double")
    text = x.cast("string")
    plain = F.regexp_replace(x.cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1)
    digits = F.regexp_replace(power, "^-", "")
    exponent = F.concat(F.when(power.startswith("-"), F.lit("e-")).otherwise(F.lit("e+")),
                        F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits))
    size = F.abs(x)
    small_or_large = text.contains("E") & ((size < 1e-4) | (size >= 1e16))
    return F.when(x == 0, F.lit("0")).when(small_or_large, F.concat(mantissa, exponent)).otherwise(plain)


_LIMB = 1_000_000_000


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable isn't evaluated again at each use, as an expression may be."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _times(limbs: Column, factor: Column) -> Column:
    """A whole number, as an array of base-10^9 digits from the lowest, times a factor below 2^30."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, limb: Column) -> Column:
        v = limb * factor + acc["carry"]
        return F.struct(F.floor(v / _LIMB).cast("bigint").alias("carry"), F.concat(acc["out"], F.array(v % _LIMB)).alias("out"))

    def close(acc: Column) -> Column:
        return F.when(acc["carry"] > 0, F.concat(acc["out"], F.array(acc["carry"]))).otherwise(acc["out"])

    return F.aggregate(limbs, start, step, close)


def _whole_text(x: Column) -> Column:
    """The digits of a whole, non-negative double, however large."""
    def large(power: Column) -> Column:
        # 53 bits times a power of 2, multiplied out 20 bits at a time; halves, as 2^power may be out of a double's range
        half = F.floor(power / 2).cast("int")
        mantissa = (x / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), power - half)).cast("bigint")
        limbs = _let(mantissa, lambda m: F.array(m % _LIMB, F.floor(m / _LIMB).cast("bigint")))
        rounds = F.floor(power / 20).cast("int")
        big = F.aggregate(F.when(rounds > 0, F.sequence(F.lit(1), rounds)).otherwise(F.array().cast("array<int>")), limbs,
                          lambda acc, _: _times(acc, F.lit(1 << 20).cast("bigint")))
        big = _times(big, F.pow(F.lit(2.0), power % 20).cast("bigint"))
        digits = F.array_join(F.transform(F.reverse(big), lambda v: F.lpad(v.cast("string"), 9, "0")), "")
        return F.regexp_replace(digits, "^0+", "")

    power = F.greatest(F.ceil(F.log2(F.greatest(x, F.lit(1.0)))).cast("int") - 54, F.lit(0))
    return F.when(x < float(1 << 62), x.cast("bigint").cast("string")).otherwise(_let(power, large))


def fixed16(x) -> Column:
    """The text C's ``%.16f`` gives: the double's exact binary value, rounded half-even at 16 places.

    2.08 -> '2.0800000000000001'. Error-free, in whole numbers: the fraction is a / 2^53 + b / 2^109 (powers of 2 only shift a
    double's bits), and eight times it is multiplied by 100, which brings out two more digits and stays below 2^63. Bits below
    2^-109 belong to fractions under 2^-56, which round to 0 with or without them. NaN and infinities are
    'nan', 'inf' and '-inf'; a negative zero keeps its sign.
    """
    a_bits, b_bits = 53, 56
    half = F.lit(1 << (a_bits - 1))

    def step(acc: Column, _) -> Column:
        low = acc["b"] * 100
        high = acc["a"] * 100 + F.shiftright(low, b_bits)
        return F.struct(high.bitwiseAND(F.lit((1 << a_bits) - 1)).alias("a"), low.bitwiseAND(F.lit((1 << b_bits) - 1)).alias("b"),
                        (acc["q"] * 100 + F.shiftright(high, a_bits)).alias("q"))

    def of_size(x: Column, size: Column) -> Column:
        whole = F.when(size < float(1 << 53), F.floor(size).cast("double")).otherwise(size)
        number = _let(whole, lambda w: _let((size - w) * float(1 << a_bits), lambda f: _let(
            F.aggregate(F.array(*[F.lit(0)] * 8), F.struct(
                F.floor(f).alias("a"), F.floor((f - F.floor(f)) * float(1 << b_bits)).alias("b"), F.lit(0).cast("bigint").alias("q")), step),
            lambda v: rounded(w, v))))
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        return F.when(F.isnan(x), "nan").when(size == float("inf"), F.concat(sign, F.lit("inf"))).otherwise(F.concat(sign, number))

    def rounded(whole: Column, v: Column) -> Column:
        up = (v["a"] > half) | ((v["a"] == half) & ((v["b"] > 0) | (v["q"] % 2 == 1)))
        return _let(v["q"] + F.when(up, 1).otherwise(0), lambda q: F.concat(
            _let(F.when(q >= 10**16, whole + 1).otherwise(whole), _whole_text), F.lit("."),
            F.lpad(F.when(q >= 10**16, q - 10**16).otherwise(q).cast("string"), 16, "0")))

    return _let(_col(x).cast("double"), lambda v: _let(F.abs(v), lambda size: of_size(v, size)))


def safe_div(num, den, zero: float = 0.0) -> Column:
    """num / den, or ``zero`` when the denominator is 0 or NULL (cosine guard)."""
    den = _col(den)
    return F.when(den.isNull() | (den == 0), F.lit(zero)).otherwise(_col(num) / den)


def log_odds(p) -> Column:
    """ln(p / (1 - p)); NULL outside (0, 1)."""
    p = _col(p)
    return F.when((p > 0) & (p < 1), F.log(p / (F.lit(1.0) - p)))


def damping(group_size, power: float) -> Column:
    """Divisor log1p(n)^power of the popularity-damped similarity formulas (1 when power is 0).

    With half the power it scales the rating rows of both sides before the self-join
    (``similarity.cosine_pairs``); ``pair_products`` divides each product.
    """
    if power == 0:
        return F.lit(1.0)
    return F.pow(F.log1p(_col(group_size).cast("double")), F.lit(float(power)))


def prefixed_key(prefix: str, c) -> Column:
    """'user_' + id style keys, for output compatible with the string-keyed reference data."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))
