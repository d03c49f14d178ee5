"""Secret scans with an incremental blob ledger, in DataFrame expressions only.

Every version of a document is a blob named by the SHA-256 of its text. A ledger holds which
(blob, rule, rule version) have been scanned and what was found. A scan

1. names the blobs of all rows and keeps one row per blob (a grouped aggregate over 32-byte
   names, so copies cost no text),
2. takes away the pairs the ledger has and fetches the text of one row for each blob with a
   pair left,
3. runs the rules still due on it, writes the new ledger rows, and
4. joins the findings back to all rows (paths) that hold the blob.

``scan_stored`` keeps the ledger as Parquet under a path: it reads what earlier scans stored and adds its own rows.

Positions are code points: ``split`` gives the text between matches, ``regexp_extract_all`` the
matches, and their lengths add up to the start of each. Only texts with a match pay for that.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.llm.common import free_names, materialize, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count when ``group`` has ``at_least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    at_least: int


#: The base rules, in the order that breaks ties between spans with one start.
BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),  # runs are maximal, so shorter ones can be passed over
)
#: Findings of a text that are gathered at a time.
BLOCK = 256
SPAN = "array<struct<start:int,rule:int,end:int>>"
LEDGER = f"blob binary, kind string, version int, spans {SPAN}"


def blob_name(text: Column) -> Column:
    """SHA-256 of the UTF-8 text; null counts as empty."""
    return F.unhex(F.sha2(text_or_empty(text), 256))


def _blocks(items: Column) -> Column:
    """``items`` (a plain column) cut into arrays of at most ``BLOCK`` entries; null for null. A fold copies what it
    has gathered at every step, so it runs inside a block: a text with very many findings doesn't cost their square."""
    starts = F.sequence(F.lit(0), F.floor(F.size(items) / BLOCK).cast("int"))  # the last block may be empty
    return F.when(items.isNotNull(), F.transform(starts, lambda b: F.slice(items, b * BLOCK + 1, BLOCK)))


def _block_spans(rule: Rule, number: int, blocks: Column) -> Column:
    """(at, spans) of each block of pairs (text before a match, match or null at the end): its length, and
    the spans of the matches that count, from the block's beginning."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["parts"])
        end = start + F.length(x["found"])
        what = x["found"] if rule.group == 0 else F.regexp_extract(x["found"], rule.pattern, rule.group)
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end")))
        spans = F.when(F.length(what) >= rule.at_least, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.when(x["found"].isNull(), acc).otherwise(F.struct(end.alias("at"), spans.alias("spans")))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.transform(blocks, lambda block: F.aggregate(block, first, step))


def _block_starts(blocks: Column) -> Column:
    """Where each block begins in the text."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(blocks, first, lambda acc, x: F.struct(
        (acc["at"] + x["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")
    ))["starts"]


def _spans(blocks: Column) -> Column:
    """The spans of all blocks, from the beginning of the text; none for null."""
    placed = F.transform(F.arrays_zip(blocks.alias("block"), _block_starts(blocks).alias("at")), lambda z: F.transform(
        z["block"]["spans"], lambda s: F.struct(
            (z["at"] + s["start"]).alias("start"), s["rule"].alias("rule"), (z["at"] + s["end"]).alias("end")
        )
    ))
    return F.coalesce(F.flatten(placed), F.array().cast(SPAN))


def find(texts: DataFrame, rules=BASE_RULES, text: str = "text", due: Column | None = None) -> DataFrame:
    """``texts`` without its text, with an array of spans per rule, named ``spans_<kind>``: null where
    ``due`` (an array of rule kinds) lacks the rule, else all that count."""
    cut = texts
    for r in rules:
        hit = F.col(text).rlike(r.pattern)
        if due is not None:
            hit = hit & F.array_contains(due, r.kind)
        parts = F.split(text, r.pattern, -1).alias("parts")
        found = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)).alias("found")
        cut = cut.withColumn(f"_cut_{r.kind}", F.when(hit, F.arrays_zip(parts, found)))
    for number, r in enumerate(rules):
        cut = cut.withColumn(f"_blocks_{r.kind}", _block_spans(r, number, _blocks(F.col(f"_cut_{r.kind}"))))
    keep = [F.col(c) for c in texts.columns if c != text]
    out = []
    for r in rules:
        spans = _spans(F.col(f"_blocks_{r.kind}"))
        out.append((spans if due is None else F.when(F.array_contains(due, r.kind), spans)).alias(f"spans_{r.kind}"))
    return cut.select(*keep, *out)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger rows stored under ``path``, one folder a scan; none if there is no such path yet."""
    try:
        return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_stored(docs: DataFrame, path: str, rules=BASE_RULES) -> DataFrame:
    """``scan`` against the ledger stored under ``path``, which takes the new rows: the next scan, in whatever session,
    fetches no text that this one has seen with the same rule versions. Returns the findings.

    New rows lie in a folder of their own that Spark commits as a whole, so a scan that fails leaves the ledger as it was; two
    scans at a time may both store a blob, which is harmless."""
    spark = docs.sparkSession
    return scan(docs, read_ledger(spark, path), rules, f"{path}/scan-{uuid.uuid4().hex}")[0]


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules=BASE_RULES, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows). ``docs`` needs ``doc_id`` and ``text``; other columns don't matter.

    findings: (doc_id, blob, spans), one row per row of ``docs``, spans sorted by start, then rule
    (an empty array without findings). Null texts count as empty; null and repeated ids and
    repeated rows keep their rows. New ledger rows (``LEDGER``) are those scanned now, written to the folder ``store`` if one
    is named: append them to the ledger, and the next scan reads no text of theirs. Repeated ledger rows count once.
    """
    spark = docs.sparkSession
    ledger = spark.createDataFrame([], LEDGER) if ledger is None else ledger
    paths = materialize(docs.select("doc_id", blob_name(F.col("text")).alias("blob")), "secret-paths")
    current = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(k).alias("number")) for k, r in enumerate(rules)
    ])
    pairs = paths.groupBy("blob").agg(F.min("doc_id").alias("at")).select("blob", "at", F.inline(current)).drop("number")
    unseen = (
        pairs.join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
        .groupBy("blob", "at").agg(F.collect_set("kind").alias("due"))  # at most one entry per rule
    )
    texts = docs.select(F.col("doc_id").alias("_at"), text_or_empty(F.col("text")).alias("text")).withColumn(
        "_blob", blob_name(F.col("text"))
    )
    fetched = texts.join(unseen, (F.col("_blob") == F.col("blob")) & F.col("_at").eqNullSafe(F.col("at")))
    scanned = find(fetched.select("blob", "due", "text"), rules, due=F.col("due")).dropDuplicates(["blob"])
    by_rule = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.col(f"spans_{r.kind}").alias("spans"))
        for r in rules
    ])
    new = scanned.select("blob", F.inline(by_rule)).where("spans IS NOT NULL")
    if store is None:
        new = materialize(new, "secret-ledger")
    else:
        new.write.parquet(store)
        new = spark.read.parquet(store)
    known = ledger.select("blob", "kind", "version", "spans").unionByName(new)
    versions = F.broadcast(spark.range(1).select(F.inline(current)))  # one row per rule
    numbered = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("number").alias("rule"), s["end"].alias("end")))
    found = (
        known.where(F.size("spans") > 0).join(versions, ["kind", "version"]).select("blob", numbered.alias("spans"))
        .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    )
    # written, so that the join deals both sides itself and can split a blob that very many paths hold
    found = materialize(found, "secret-found")
    findings = paths.join(found, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )
    return findings, new


def span_text(spans: Column, rules=BASE_RULES) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"], s["end"])), ","
    )


def span_count(spans: Column, rule: int) -> Column:
    """Number of spans (long) of the rule with this number."""
    return F.size(F.filter(spans, lambda s: s["rule"] == rule)).cast("bigint")


def redact(docs: DataFrame, findings: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a text replaced by ``mask`` (overlapping spans by one); ``n_chars``, if it is
    a column, is counted anew for texts that change. Texts without findings stay as they are."""
    hit, gap_list, tail, name, new_text = free_names(docs, "hit", "gap_list", "tail", "blob_name", "masked")
    hits = findings.where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
    in_text = Window.partitionBy("blob").orderBy("place")
    ends = hits.select("blob", F.posexplode("spans").alias("place", "s")).select(
        "blob", "s.start", "s.end",
        F.coalesce(F.max("s.end").over(in_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("from"),
    )
    # gaps: what stays before each mask; a span that begins inside an earlier one has none
    gap = F.when(F.col("start") >= F.col("from"), F.struct("from", F.col("start").alias("to")))
    gaps = ends.groupBy(F.col("blob").alias(hit)).agg(
        F.array_sort(F.collect_list(gap)).alias(gap_list), F.max("end").alias(tail)
    )
    joined = docs.withColumn(name, blob_name(F.col("text"))).join(gaps, F.col(name) == F.col(hit), "left")

    def stretch(block: Column) -> Column:
        # a block's part of the text, so that a gap isn't sought from the beginning of a long text
        low = F.coalesce(F.get(block, F.lit(0))["from"], F.lit(0))
        high = F.coalesce(F.try_element_at(block, F.greatest(F.size(block), F.lit(1)))["to"], F.lit(0))
        return F.struct(low.alias("low"), F.substr(F.col("text"), low + 1, high - low).alias("text"), block.alias("gaps"))

    def pieces(x: Column) -> Column:
        return F.array_join(F.transform(
            x["gaps"], lambda g: F.concat(F.substr(x["text"], g["from"] - x["low"] + 1, g["to"] - g["from"]), F.lit(mask))
        ), "")

    masked = F.concat(
        F.array_join(F.transform(F.transform(_blocks(F.col(gap_list)), stretch), pieces), ""),
        F.substr(F.col("text"), F.col(tail) + 1, F.length("text")),
    )
    changed = F.col(gap_list).isNotNull()
    out = joined.withColumn(new_text, F.when(changed, masked).otherwise(F.col("text")))
    cols = {"text": F.col(new_text)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cols["n_chars"] = F.when(changed, F.length(new_text).cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*[cols.get(c, F.col(c)).alias(c) for c in docs.columns])
