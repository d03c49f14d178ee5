"""URL filters as a sort-merge range join, in DataFrame expressions only.

Host names are reversed label by label with a closing dot (``blog.example.net`` ->
``net.example.blog.``), so a rule's host and all its subdomains are one interval of keys, from
``net.example.`` up to ``net.example/`` ('/' follows '.'). Intervals of host prefixes nest or are
apart. The sweep sorts keys and interval boundaries together and carries the stack of active
rules: each boundary row holds the stack that is in force from it on, a page takes the stack of
the last boundary before it, and the longest rule of the stack whose path starts the page's wins.

Pages are dealt to ``buckets`` by a hash of their row, so one host (or one url) with a third
of all rows is swept by many tasks; each bucket sweeps its own copy of the boundaries, so the work is
pages + buckets * rules rows, sorted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The rules (action, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: What becomes of urls that no rule fits.
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): for the start and the end of every rule host's interval, the rules in force from there.

    ``rules(action, host, path)``. A host's stack is its own rules and those of the hosts above it,
    found by an equal join on the host's label suffixes. The longest rule is that of most characters in
    host and path together, on ties that of the longer host; of rules equal in both block wins.
    """
    clean = rules.dropna().groupBy("host", "path").agg(F.max("action").alias("action"))  # allow < block
    hosts = clean.groupBy(host_key(F.col("host")).alias("key")).agg(
        F.collect_list(F.struct(
            (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"), "path", "action"
        )).alias("own")
    )
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.", -1)
    above = hosts.select("key", labels.alias("labels")).select(
        "key", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("k"), "labels"
    ).select("key", F.concat(F.array_join(F.slice("labels", 1, F.col("k")), "."), F.lit(".")).alias("holder"))
    chain = above.join(hosts.withColumnRenamed("key", "holder"), "holder").groupBy("key").agg(
        F.flatten(F.collect_list("own")).alias("stack"),
        F.flatten(F.collect_list(F.when(F.col("holder") != F.col("key"), F.col("own")))).alias("outer_stack"),
    )
    start = chain.select("key", "stack")
    end = chain.select(F.expr("substring(key, 1, length(key) - 1) || '/'").alias("key"), F.col("outer_stack").alias("stack"))
    return start.unionByName(end)


def judge(pages: DataFrame, rules: DataFrame, buckets: int, page_id: str = "page_id", url: str = "url",
          default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per page.

    Null urls and urls without ``://`` have an empty host and path and fit no rule. Repeated
    ids and rows keep their rows. Without rules every page takes ``default``.
    """
    edges = boundaries(rules).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    keyed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    keyed = keyed.select(
        "*", host_key(F.col("host")).alias("key"),
        F.pmod(F.xxhash64("page_id", "host", "path", F.monotonically_increasing_id()), F.lit(buckets)).cast("int").alias("bucket"),
    )
    swept = keyed.withColumn("is_page", F.lit(1)).unionByName(edges.withColumn("is_page", F.lit(0)), allowMissingColumns=True)
    # a boundary comes before the pages of its own key; ends and starts never share a key
    order = Window.partitionBy("bucket").orderBy("key", "is_page").rowsBetween(Window.unboundedPreceding, 0)
    active = swept.withColumn("active", F.last("stack", ignorenulls=True).over(order)).where("is_page = 1")
    best = F.array_max(F.filter("active", lambda r: F.col("path").startswith(r["path"])))
    return active.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"),
    )
