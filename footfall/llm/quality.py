"""Quality rules with risk-controlled thresholds (operator 7).

Each rule is a number per document; a document whose number lies beyond the
rule's cutoff is rejected.  Cutoffs are chosen from a fixed ladder, per stratum
(a language), on labelled documents: a cutoff may be used only if an exact
binomial test shows that it rejects a good document with a probability of at
most ``risk / rules``.  The union over the rules then rejects at most ``risk`` of a
stratum's good documents.  The ladder is tested from lenient to strict and left
at the first cutoff not shown safe (a fixed sequence, which needs no correction
of its own); over rules and strata the level is divided (Bonferroni), so that all
cutoffs together are safe with a probability of at least ``1 - delta``.  Where no
cutoff is shown safe, as in a stratum with few labels, the rule rejects nothing.

Defined results: a null or empty text has no words and fails the base rule; a null
stratum is a stratum of its own; a label of a document that is absent, or null, is
ignored; a document with several labels is good only if all say so; repeated rows
are judged each; extra columns are kept, but those with the names of the result
(parameters of ``with_metrics`` and ``with_verdict``) are replaced.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, words_of

LEAST_WORDS = 50
MOST_REPEATED = 50          # per cent of the words
RISK = 0.05
DELTA = 0.05
MOST_STRATA = 10_000        # strata whose cutoffs are broadcast; beyond, they are joined

METRICS = ("struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, "
           "n_repeat_words: long, n_upper: long, n_marks: long>")

_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

# rule -> its number as a share of two sums of metrics; larger is worse
RULES = {
    "symbols": (("n_symbols", "n_marks"), "n_words"),
    "repeats": (("n_repeat_words",), "n_words"),
    "dup_lines": (("n_dup_lines",), "n_words"),
    "shouting": (("n_upper",), "word_chars"),
}
# the ladder of every rule, from strict to lenient
LADDER = tuple(round(0.02 * 1.25 ** i, 6) for i in range(20))


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``METRICS``."""
    words = words_of(text)
    n = len(words)
    if not n:
        return (0,) * 7
    length = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = Counter(x for x in text.encode("utf-8", "replace").split(b"\n") if x.split())
    repeated = 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if n >= 4:
        _, grams = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        _, which, times = np.unique(grams[:-1] * len(numbers) + ids[2:], return_inverse=True,
                                    return_counts=True)
        twice = times[which] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        repeated = int(covered.sum())
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = text.count("!") + text.count("?")
    return (n, length, symbols, sum(lines.values()) - len(lines), repeated, upper, marks)


def with_metrics(docs: DataFrame, text: str = "text", name: str = "m") -> DataFrame:
    """``docs`` with the struct ``name`` of counts of the column ``text``."""
    fields = [f.split(":")[0].strip() for f in METRICS[7:-1].split(",")]

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=fields, index=texts.index,
                            dtype=np.int64)

    # nondeterministic to the planner, so that what is computed from it doesn't run it again
    return docs.withColumn(name, F.pandas_udf(run, METRICS).asNondeterministic()(F.col(text)))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (
        m["n_repeat_words"] * 100 > m["n_words"] * MOST_REPEATED)


def rule_value(m: Column, rule: str) -> Column:
    """A rule's number; null for a text without words."""
    above, below = RULES[rule]
    return F.try_divide(sum((m[c] for c in above), F.lit(0)).cast("double"), m[below])


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exact up to rounding."""
    if k >= n:
        return 1.0
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
           + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def _choose(group: pd.DataFrame, risk: float, level: float) -> pd.DataFrame:
    """The strictest cutoff of one stratum and rule that is shown safe, or none."""
    good = int(group["n"].sum())
    cutoff = None
    for step in range(len(LADDER) - 1, -1, -1):
        # rank r: the number lies beyond the first r steps of the ladder
        rejected = int(group.loc[group["rank"] > step, "n"].sum())
        # P(at most this many | risk) falls below the level only for few rejections
        if rejected > risk * good or at_most(rejected, good, risk) > level:
            break
        cutoff = LADDER[step]
    return pd.DataFrame({"stratum": [group["stratum"].iloc[0]], "rule": [group["rule"].iloc[0]],
                         "cutoff": [cutoff], "n_good": [good]})


def calibrate(scored: DataFrame, labels: DataFrame, stratum: str = "lang", metrics: str = "m",
              good: str = "quality = 1", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Cutoffs (stratum, rule, cutoff, n_good) from all labelled documents, written.

    ``scored`` has doc_id, ``stratum`` and the struct ``metrics``; ``labels`` has doc_id and
    what ``good`` names.  Documents that fail the base rule are judged by it alone.
    Only counts per stratum, rule and ladder step are gathered.
    """
    told = (labels.where("doc_id is not null").groupBy("doc_id")
                  .agg(F.min(F.expr(good).cast("int")).alias("good")).where("good = 1")
                  .select(F.col("doc_id").alias("labelled")))
    rows = scored.select(F.col("doc_id").alias("id"), F.col(stratum).cast("string").alias("stratum"),
                         F.col(metrics).alias("m"))
    m = F.col("m")
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), rule_value(m, r).alias("value"))
                                 for r in RULES])).alias("x")
    known = rows.where(~base_failed(m)).join(told, F.col("id") == F.col("labelled")).select(
        "stratum", values)
    # how many steps of the ladder the number lies beyond
    rank = F.size(F.filter(F.array(*map(F.lit, LADDER)), lambda c: F.col("x.value") > c))
    counts = known.groupBy("stratum", F.col("x.rule").alias("rule"), rank.alias("rank")).agg(
        F.count(F.lit(1)).alias("n"))
    strata = max(1, counts.select("stratum").distinct().count())
    level = delta / (strata * len(RULES))
    share = risk / len(RULES)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        return _choose(group, share, level)

    return materialize(counts.groupBy("stratum", "rule").applyInPandas(
        choose, "stratum string, rule string, cutoff double, n_good long"), "cutoffs")


def with_verdict(scored: DataFrame, cutoffs: DataFrame, stratum: str = "lang",
                 metrics: str = "m", failed: str = "base_failed", kept: str = "kept"
                 ) -> DataFrame:
    """``scored`` with the booleans ``failed`` (the base rule) and ``kept``."""
    key = free_name(scored, "cutoff_stratum")
    names = {r: free_name(scored, f"cutoff_{r}") for r in RULES}
    wide = cutoffs.groupBy(F.col("stratum").alias(key)).agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(n) for r, n in names.items()])
    if cutoffs.count() <= MOST_STRATA * len(RULES):
        wide = F.broadcast(wide)
    m = F.col(metrics)
    beyond = F.lit(False)
    for r, n in names.items():
        beyond = beyond | F.coalesce(rule_value(m, r) > F.col(n), F.lit(False))
    joined = scored.join(wide, F.col(stratum).cast("string").eqNullSafe(F.col(key)), "left")
    return (joined.withColumn(failed, base_failed(m))
                  .withColumn(kept, ~F.col(failed) & ~beyond)
                  .drop(key, *names.values()))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """``docs`` without the rows that the rules reject; columns as they are."""
    m = free_name(docs, "quality_metrics")
    scored = with_metrics(docs, name=m)
    cutoffs = calibrate(scored, labels, stratum, m, **options)
    failed, kept = free_name(docs, "base_failed"), free_name(docs, "quality_kept")
    return with_verdict(scored, cutoffs, stratum, m, failed, kept).where(F.col(kept)).select(
        *docs.columns)
