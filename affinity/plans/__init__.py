"""Registered queries over the driver's test tables, and their SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> DuckDB SQL`` over the
pre-registered views (lineitem, orders, part, ...). Every query reads the whole tables.
"""

from affinity.plans.registry import QUERIES, ORACLES, query

# importing the modules registers their queries
from affinity.plans import recsys, clicks, io, misc  # noqa: F401,E402

__all__ = ["QUERIES", "ORACLES", "query"]
