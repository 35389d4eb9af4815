"""Quality rules with risk-controlled thresholds.

A rule rejects a document when the ratio of two counts is above a cutoff. Labelled documents
that pass the base rules and are good are the holdout. The cutoffs of all rules form one path of
steps, fixed beforehand: the most lenient cutoff of each rule in turn, then the next of each. A
step adds its cutoff to those before it, so what is rejected only grows along the path. In each
stratum (language), a step is accepted if the exact binomial tail of the good documents lost so
far, k of n, at the allowed rate alpha is at most delta divided by the number of strata
(Bonferroni). Testing stops at the first step that fails (fixed-sequence testing, which needs no
further correction). So with probability 1 - delta all strata at once lose at most the rate alpha
of their good documents, to all rules together. The whole of alpha goes to the one path: with 4
strata, 217 good documents suffice for a step that loses none. The price is that one rule which
costs too much stops the others too. A rule with no accepted step rejects nothing. Built-in
functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, words

ALPHA = 0.02
DELTA = 0.05
WINDOW = 8

# --- fixed values -----------------------------------------------------------
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (500, 400, 300, 200, 150, 100, 70, 50, 30, 20, 10)),
    "repeats": ("n_repeat_words", "n_words", (300, 250, 200, 150, 100, 70, 50, 30)),
    "dup_lines": ("n_dup_lines", "n_words", (200, 150, 100, 70, 50, 30, 20, 10)),
    "word_length": ("word_chars", "n_words", (40_000, 30_000, 25_000, 20_000, 17_000, 15_000, 13_000, 12_000)),
}
"""Rules by name: numerator, denominator, and cutoffs in thousandths, the most lenient first."""

STEPS: list[tuple[str, int]] = [
    (rule, tried[i])
    for i in range(max(len(tried) for _, _, tried in RULES.values()))
    for rule, (_, _, tried) in RULES.items()
    if i < len(tried)
]
"""The path that is tested: rule and cutoff of each step."""


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, although the body uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(ws: Column) -> Column:
    """Number of words that lie in some window of 8 words found twice or more."""

    def positions(windows: Column) -> Column:
        numbered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, j: F.coalesce((F.get(s, j)["h"] == x["h"]), F.lit(False))
            return F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))

        return F.sort_array(F.filter(_let(numbered, twice), lambda i: i.isNotNull()))

    def covered(found: Column) -> Column:
        steps = F.transform(found, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(found, j + 1) - i, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def of_windows(windows: Column) -> Column:
        repeated = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeated, _let(positions(windows), covered)).otherwise(0)

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - WINDOW + 1)
        return _let(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))), of_windows)

    hashed = F.transform(ws, lambda word: F.xxhash64(word))
    return F.when(F.size(ws) > WINDOW, _let(hashed, of_hashes)).otherwise(0).cast("long")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    return _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id``, ``stratum`` and the counts of each text; all 0 for NULL."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counts = lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), _repeated_words(ws).alias("n_repeat_words")
    )
    solid = F.length(F.translate(text, BLANKS, ""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(stratum_col).alias("stratum"),
        F.explode(F.array(_let(words(text), counts))).alias("counts"),
        solid.cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _dup_lines(text).alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select("*", "counts.n_words", "counts.n_repeat_words").drop("counts").withColumn("base_failed", failed)


def _ln_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 8, within 1e-12."""
    z = x + F.lit(9.0)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    product = F.lit(0.0)
    for step in range(1, 9):
        product = product + F.ln(x + F.lit(float(step)))
    return (z - 0.5) * F.ln(z) - z + F.lit(0.9189385332046727) + series - product


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), exact for k below the mean; 1 from the mean on.

    The terms are summed down from k, where each is a fixed factor or more below the last: ten
    standard deviations hold all that a double can tell apart.
    """
    odds = (1 - p) / p
    top = _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k) + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1 - p))
    terms = F.least(k, F.ceil(10 * F.sqrt(n * F.lit(p))) + 50).cast("long")
    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"), k.cast("double").alias("i"))

    def lower(state: Column, _: Column) -> Column:
        term = state["term"] * state["i"] / (n - state["i"] + 1) * odds
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"), (state["i"] - 1).alias("i"))

    steps = F.when(terms > 0, F.sequence(F.lit(1).cast("long"), F.greatest(terms, F.lit(1))))
    total = F.coalesce(F.aggregate(steps, one, lower)["sum"], F.lit(1.0))
    return F.when(k < n * p, F.exp(top) * total).otherwise(1.0)


def _above(rule: str, cutoff: Column | int) -> Column:
    numerator, denominator, _ = RULES[rule]
    return 1000 * F.col(numerator) > cutoff * F.col(denominator)


def cutoffs(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and a column per rule with its accepted cutoff, NULL for none. Strata without
    good labelled documents are absent.

    Each document is counted in its task under the first step that rejects it, so what is
    shuffled and summed has a row per stratum and step."""
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("__id")).distinct()
    held = rows.filter("NOT base_failed").join(good, F.col("doc_id") == F.col("__id"), "left_semi")
    # From 1; 0 for documents that no step rejects.
    first = F.array_position(F.array(*[_above(rule, cutoff) for rule, cutoff in STEPS]), True)
    tally = held.select("stratum", first.alias("first")).groupBy("stratum", "first").agg(F.count("*").alias("n"))
    cells = tally.groupBy("stratum").agg(F.sum("n").alias("n"), F.collect_list(F.struct("first", "n")).alias("cells"))
    steps = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(cutoff).alias("cutoff")) for rule, cutoff in STEPS])
    lost = F.aggregate(
        F.filter("cells", lambda c: c["first"].between(1, F.col("i") + 1)),
        F.lit(0).cast("long"), lambda total, c: total + c["n"],
    )
    tests = cells.select("*", F.posexplode(steps).alias("i", "step")).withColumn("k", lost)
    strata = kept(cells.select("stratum"), "strata").count()
    passed = binomial_tail(F.col("k"), F.col("n"), alpha) <= delta / max(strata, 1)
    so_far = Window.partitionBy("stratum").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    accepted = tests.withColumn("all_passed", F.min(passed).over(so_far)).filter("all_passed")
    best = [F.min(F.when(F.col("step.rule") == rule, F.col("step.cutoff"))).alias(f"max_{rule}") for rule in RULES]
    return accepted.groupBy("stratum").agg(*best)


def assess(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    alpha: float = ALPHA, delta: float = DELTA,
) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed``, ``kept``, and the cutoffs
    that held for it.

    ``labels`` has ``doc_id, quality``; good is 1, NULLs and repeated rows do no harm. NULL text
    has no words and fails the base rules. NULL is a stratum like any other. Without labels only
    the base rules reject. An empty table gives an empty table. Other columns are ignored.
    """
    rows = kept(features(docs, id_col, text_col, stratum_col), "features")
    limits = kept(cutoffs(rows, labels, alpha, delta), "cutoffs").withColumnRenamed("stratum", "__stratum")
    judged = rows.join(limits, F.col("stratum").eqNullSafe(F.col("__stratum")), "left").drop("__stratum")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_above(rule, F.col(f"max_{rule}")), F.lit(False))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"), *[f"max_{r}" for r in RULES])
