"""Column expressions shared by the operators. All are built-in Spark expressions (codegen)."""

from affinity.functions.columns import (
    hash_u32,
    hash_bucket,
    trim_decimal,
    safe_div,
    log_odds,
    damping,
    prefixed_key,
)

__all__ = ["hash_u32", "hash_bucket", "trim_decimal", "safe_div", "log_odds", "damping", "prefixed_key"]
