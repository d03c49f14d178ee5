"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Four shares of a text (symbols, repeated lines, repeated words, letters per word) reject it when
any lies above its cutoff. The cutoffs of a stratum (its language) are chosen by labelled documents, not by hand: they
tighten together along a fixed path, from the loosest cutoffs of the grids to the strictest. At each step the good
documents (label 1) of the stratum that the step would reject are counted, and the exact binomial test of "it rejects more than
``ALPHA`` of good documents" is made at level ``DELTA / strata``, which is the same as the exact (Clopper-Pearson) upper
bound lying below that share. The steps are tested in their order and the first that isn't refuted ends the path (a fixed sequence
needs no further correction, as nothing behind a failure is looked at; Bonferroni's covers the strata), so with
probability ``1 - DELTA`` no stratum rejects more than ``ALPHA`` of its good documents. About 220 good documents (four strata)
are the least that admit a step; a stratum with fewer rejects none.

The statistics of a text are computed in its own row, with no shuffle of words, and written once;
counting for the thresholds reads only them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import WORD_SPACE, materialize, text_or_empty

#: Limits of the base rule.
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
#: False rejection of good documents: at most ALPHA in every stratum, with probability 1 - DELTA.
ALPHA, DELTA = 0.02, 0.05
#: Cutoffs of each rule, from the strictest; step t of the path takes each rule's t-th from the end.
STEPS = 21
GRID = {
    "symbols": [round(0.01 * 1.25**k, 6) for k in range(21)],
    "dup_lines": [round(0.02 * 1.22**k, 6) for k in range(21)],
    "repeats": [round(0.01 * 1.25**k, 6) for k in range(21)],
    "word_length": [round(6 * 1.1**k, 6) for k in range(21)],
}
BROADCAST_STRATA = 10_000
#: Places of windows that fit beside the hash in one long; longer texts sort (hash, place) pairs instead.
PLACE_BITS = 22


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).
    Null and blank texts give 0 everywhere. Columns of these names are replaced."""
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    keep = [c for c in docs.columns if c not in (*names, text)]
    body = text_or_empty(F.col(text))
    trimmed = F.btrim(body, F.lit(" \t\n\x0b\x0c\r"))
    split_up = docs.select(
        *keep,
        F.when(trimmed != "", F.split(trimmed, f"[{WORD_SPACE}]+", -1)).otherwise(F.array().cast("array<string>")).alias("_words"),
        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(f"[^{WORD_SPACE}]")).alias("_lines"),
        F.length(F.regexp_replace(body, f"[{WORD_SPACE}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    low = (1 << PLACE_BITS) - 1
    words = F.col("_words")
    last = F.size(words) - WINDOW
    places = F.sequence(F.lit(0), last)

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[words[i + k] for k in range(WINDOW)])

    packed = F.sort_array(F.transform(places, lambda i: window_hash(i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
    paired = F.array_sort(F.transform(places, lambda i: F.struct(window_hash(i).alias("h"), i.alias("i"))))
    fits = F.size(words) <= low
    hashed = split_up.select(
        "*",
        F.when((last >= 1) & fits, packed).otherwise(F.array().cast("array<long>")).alias("_packed"),
        F.when((last >= 1) & ~fits, paired).otherwise(F.array().cast("array<struct<h:long,i:int>>")).alias("_paired"),
    )

    def same_words(a: Column, b: Column) -> Column:
        return F.slice(words, a + 1, WINDOW) == F.slice(words, b + 1, WINDOW)

    def equal_packed(v: Column, w: Column) -> Column:
        place = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
        return (F.shiftright(v, PLACE_BITS) == F.shiftright(w, PLACE_BITS)) & same_words(place(v), place(w))

    def repeated(entries: str, equal) -> Column:
        e = F.col(entries)
        return F.filter(e, lambda v, k: (
            F.when(k > 0, equal(v, e[k - 1])).otherwise(False) | F.when(k < F.size(e) - 1, equal(v, e[k + 1])).otherwise(False)
        ))

    from_packed = F.transform(repeated("_packed", equal_packed), lambda v: v.bitwiseAND(F.lit(low)).cast("int"))
    from_paired = F.transform(
        repeated("_paired", lambda v, w: (v["h"] == w["h"]) & same_words(v["i"], w["i"])), lambda v: v["i"]
    )
    start = F.sort_array(F.when(fits, from_packed).otherwise(from_paired))
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
    covered = F.aggregate(start, zero, lambda acc, p: F.struct(
        p.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("sum")
    ))["sum"]
    return hashed.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def shares() -> dict[str, Column]:
    """The measured value of each rule; 0 for texts without words."""
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def _log_factorial(x: Column) -> Column:
    """ln x!: exact below 20, else Stirling's series (error below 1e-12)."""
    y = F.greatest(x.cast("double"), F.lit(1.0))
    stirling = y * F.log(y) - y + 0.5 * F.log(2 * F.pi() * y) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y**5)
    return F.when(x <= 20, F.log(F.factorial(F.least(x, F.lit(20)).cast("int")).cast("double"))).otherwise(stirling)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with chance p, for k at most n * p; 1 for larger k (never significant).

    Terms are added downwards from k until they are far below double precision (40 standard deviations)."""
    log_top = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    )
    width = (40 * F.sqrt(n * p * (1 - p)) + 100).cast("long")
    terms = F.sequence(F.lit(0).cast("long"), F.least(k, width))

    def step(acc: Column, j: Column) -> Column:
        # the term at k - j, from that at k - j + 1
        return F.struct(
            (acc["term"] * (k - j).cast("double") / (n - k + j + 1) * ((1 - p) / p)).alias("term"),
            (acc["sum"] + acc["term"]).alias("sum"),
        )

    first = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    total = F.aggregate(terms, first, step)["sum"]
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_top) * total))


def strictness() -> Column:
    """How many steps of the path leave a text in: it is rejected by step t (from 0) when t >= this."""
    def below(rule: str, value: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, GRID[rule])), lambda c: c < value))

    return F.lit(STEPS) - F.greatest(*[below(r, v) for r, v in shares().items()])


def thresholds(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, steps): how many steps of the path a stratum takes, from statistics of good documents (``good``: stratum and
    statistics). Strata that can't take the first step have no row; an empty table gives none."""
    counts = materialize(good.groupBy("stratum", strictness().alias("kept_steps")).agg(F.count("*").alias("n")), "rule-bins")
    sizes = counts.groupBy("stratum").agg(F.sum("n").alias("n"))  # strata x (steps + 1) bins at most
    m = max(1, sizes.count())
    at = sizes.select("stratum", "n", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("step"))
    rejected = counts.where(F.col("kept_steps") < STEPS).select(
        "stratum", F.col("n").alias("k"), F.explode(F.sequence("kept_steps", F.lit(STEPS - 1))).alias("step")
    ).groupBy("stratum", "step").agg(F.sum("k").alias("k"))
    tested = at.join(rejected, ["stratum", "step"], "left").withColumn("k", F.coalesce("k", F.lit(0).cast("long")))
    passed = binomial_tail(F.col("k"), F.col("n"), alpha) <= delta / m
    taken = tested.groupBy("stratum").agg(F.coalesce(F.min(F.when(~passed, F.col("step"))), F.lit(STEPS)).alias("steps"))
    return taken.where("steps > 0")


def judge(docs: DataFrame, good_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(doc_id, statistics, base_failed, kept): one row per row of ``docs``.

    ``good_ids(doc_id)``: labelled good documents, distinct. A null stratum counts as one of its
    own; repeated ids and rows keep their rows (each counts); null ids are judged but never
    labelled.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
    )
    stats = materialize(text_stats(slim), "rule-stats")
    steps = thresholds(stats.where(~base_failed()).join(good_ids, "doc_id", "left_semi"), alpha, delta)
    if steps.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        steps = F.broadcast(steps)
    rejected = F.coalesce(strictness() < F.col("steps"), F.lit(False))
    failed = base_failed()
    return stats.join(steps, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~rejected).alias("kept"),
    )
