"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose feature lies beyond a cutoff.  The cutoff
of a rule in a stratum (a language) is chosen from labelled documents so that
the share of good documents that the rule rejects there is limited with
stated confidence:

* labelled documents that pass the base rules are split by a hash of their id
  into a fitting part and a holdout;
* the cutoffs of a rule are nested, from mild to strict.  On the holdout they
  are tested in that order, each with the exact (Clopper-Pearson) upper bound
  of the rejection rate of good documents, until the bound first exceeds
  ``RISK / number of rules``.  Testing nested hypotheses in a fixed order
  needs no correction within a rule; across rules and strata the error
  probability is split evenly (Bonferroni);
* of the cutoffs that hold, the fitting part picks the one with the most bad
  less good documents rejected, the mildest on ties; none, if that is not
  above zero.

By the union bound, in every stratum at most ``RISK`` of the good documents
are rejected by any rule, in all strata at once with probability
``1 - ERROR``.  With too few labels nothing can be certified, and then only
the base rules reject; so it is in a language without labels.

Defined results: a null or empty text has no words and fails the base rules;
null ``lang`` is the stratum ``-``; labels that are null or contradict each
other for one ``doc_id`` are not used; without labels no rule is learned;
repeated rows are judged alike, each on its own; other columns of the input
are passed on, those named like an added one are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.llm import words as W
from saleswh.llm.tables import apart, together, written

if TYPE_CHECKING:
    import pandas as pd

#: Good documents that the learned rules may reject in a stratum, and the probability that a stratum has more.
RISK, ERROR = 0.05, 0.05
#: Base rules: too few words, too many words in repeated 5-word windows.
LEAST_WORDS, REPEAT_WORDS, MOST_REPEATED = 10, 5, 0.2
SYMBOLS = b"#*$%&|<>"

#: Rule: feature, whether high values are rejected, cutoffs from mild to strict.
RULES: dict[str, tuple[str, bool, list[float]]] = {
    "symbols": ("symbols_per_word", True, [round(2 * 0.75**i, 4) for i in range(20)]),
    "lines": ("repeated_lines", True, [round(1 - 0.05 * i, 2) for i in range(1, 20)]),
    "repeats": ("repeated_words", True, [round(MOST_REPEATED - 0.01 * i, 2) for i in range(1, 20)]),
    "long words": ("word_length", True, [round(14 - 0.5 * i, 2) for i in range(18)]),
    "short words": ("word_length", False, [round(1.5 + 0.125 * i, 3) for i in range(20)]),
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _repeated(codes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """For each text the number of words in windows of ``n`` words that it has twice or more."""
    rows = len(first) - 1
    whole = W.inside(first, n)
    starts = np.flatnonzero(whole)
    if not len(starts):
        return np.zeros(rows, np.int64)
    of = np.repeat(np.arange(rows), np.diff(first))
    # number the distinct windows exactly, two words at a time: no hashing
    window = codes[starts]
    for i in range(1, n):
        window = np.unique(window * (int(codes.max()) + 1) + codes[starts + i], return_inverse=True)[1]
    _, at, times = np.unique(of[starts] * (int(window.max()) + 1) + window, return_inverse=True, return_counts=True)
    twice = np.zeros(len(whole), bool)
    twice[starts] = times[at] > 1
    hit = W.covered(twice, n)
    return np.bincount(of[hit], minlength=rows)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.isin(np.arange(256), list(SYMBOLS))
    for batch in batches:
        for a, b in W.slices(batch["text"]):
            text = pc.fill_null(batch["text"].slice(a, b - a), "")
            w = W.split(text, W.NOT_SPACE)

            def per_row(flags: np.ndarray, w: W.Words = w) -> np.ndarray:
                upto = np.concatenate([[0], np.cumsum(flags)])
                return np.diff(upto[w.offsets[w.first]])

            codes, _ = w.coded()
            lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in text.cast(pa.binary()).to_pylist()]
            n_lines = np.array([len(x) for x in lines], np.int64)
            distinct = np.array([len(set(x)) for x in lines], np.int64)
            found = [w.counts(), per_row((w.data & 0xC0) != 0x80), per_row(symbol[w.data]), n_lines - distinct,
                     _repeated(codes, w.first, REPEAT_WORDS), n_lines]
            own = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(x, pa.int64()) for x in found)], names=[*batch.schema.names, *COUNTS])


#: What ``features`` adds.
ADDED = ["stratum", *COUNTS, "base_failed", "symbols_per_word", "repeated_lines", "repeated_words", "word_length"]


def features(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their stratum, the counts of ``COUNTS``, base_failed, and the rules' features."""
    own = docs.select(*(c for c in docs.columns if c not in ADDED))
    lang = F.col("lang").cast("string") if "lang" in own.columns else F.lit(None).cast("string")
    rows = own.withColumn("stratum", F.coalesce(lang, F.lit("-")))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    counts = rows.mapInArrow(_measure, schema)
    n = F.greatest(F.col("n_words"), F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MOST_REPEATED) * F.col("n_words"))
    return counts.select("*", failed.alias("base_failed"), (F.col("n_symbols") / n).alias("symbols_per_word"),
                         (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("repeated_lines"),
                         (F.col("n_repeat_words") / n).alias("repeated_words"), (F.col("word_chars") / n).alias("word_length"))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest rate at which ``k`` or fewer of ``n`` still have probability ``error``."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    lg = np.cumsum(np.concatenate([[0.0], np.log(np.arange(1, n + 1))]))
    choose = lg[n] - lg[i] - lg[n - i]

    def log_tail(p: float) -> float:
        x = choose + i * math.log(p) + (n - i) * math.log1p(-p)
        return float(x.max() + np.log(np.exp(x - x.max()).sum()))

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if mid in (0.0, 1.0) or log_tail(mid) < math.log(error):
            high = mid
        else:
            low = mid
    return high


def pick_cutoff(counts: pd.DataFrame, cutoffs: list[float], risk: float, error: float) -> float | None:
    """The cutoff of one rule in one stratum.

    ``counts``: n rows by ``beyond`` (how many of the nested cutoffs the
    feature is beyond), ``good`` and ``holdout``.
    """
    def rejected(mask: pd.Series) -> np.ndarray:
        by = counts[mask].groupby("beyond")["n"].sum().reindex(range(len(cutoffs) + 1), fill_value=0).to_numpy()
        return by[::-1].cumsum()  # [i]: rows beyond all but the i mildest cutoffs; last: all rows

    good, hold = counts["good"] == 1, counts["holdout"] == 1
    held, fit_good, fit_bad = rejected(good & hold), rejected(good & ~hold), rejected(~good & ~hold)
    best, most = None, 0
    for i, cutoff in enumerate(cutoffs):
        if held[-1] == 0 or upper_bound(int(held[i]), int(held[-1]), error) > risk:
            break
        if fit_bad[i] - fit_good[i] > most:
            best, most = cutoff, fit_bad[i] - fit_good[i]
    return best


def _beyond(rule: str, cutoff: float | Column) -> Column:
    feature, high, _ = RULES[rule]
    return F.col(feature) > cutoff if high else F.col(feature) < cutoff


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[tuple[str, str], float]:
    """(stratum, rule) -> cutoff.  Every language is a stratum, evaluated in a task; what comes to the driver is the
    cutoffs that hold."""
    one = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id") \
        .agg(F.min("quality").alias("good"), F.max("quality").alias("other")).where("good = other").drop("other")
    rows = measured.where("not base_failed").join(one, "doc_id")
    holdout = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0).cast("int").alias("holdout")
    bins = F.array(*(F.struct(F.lit(rule).alias("rule"), sum((_beyond(rule, c).cast("int") for c in cutoffs), F.lit(0)).alias("beyond"))
                     for rule, (_, _, cutoffs) in RULES.items()))
    exact = rows.select("stratum", "good", holdout, F.explode(bins).alias("b")) \
        .groupBy("stratum", "b.rule", "b.beyond", "good", "holdout").agg(F.count(F.lit(1)).alias("n"))
    exact = written(exact, "quality-counts")
    tests = max(1, exact.select("stratum").distinct().count() * len(RULES))

    def pick(counts: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        rule = counts["rule"].iloc[0]
        cutoff = pick_cutoff(counts, RULES[rule][2], risk / len(RULES), error / tests)
        rows = [] if cutoff is None else [(counts["stratum"].iloc[0], rule, cutoff)]
        return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff"])

    found = exact.groupBy("stratum", "rule").applyInPandas(pick, "stratum string, rule string, cutoff double")
    return {(r["stratum"], r["rule"]): r["cutoff"] for r in found.collect()}


def _verdicts(measured: DataFrame, cutoffs: dict[tuple[str, str], float]) -> DataFrame:
    rules = sorted(RULES)
    rows = [(s, *(cutoffs.get((s, rule)) for rule in rules)) for s in sorted({s for s, _ in cutoffs})]
    names = {rule: f"_cutoff{i}" for i, rule in enumerate(rules)}
    table = measured.sparkSession.createDataFrame(rows, ", ".join(["stratum string", *(f"{c} double" for c in names.values())]))
    by = F.coalesce(*(F.when(_beyond(rule, F.col(c)), F.lit(rule)) for rule, c in names.items()))
    return measured.join(F.broadcast(table), "stratum", "left").select(*(measured.columns), F.when(F.col("base_failed"), F.lit("base")).otherwise(by).alias("rejected_by")) \
        .withColumn("kept", F.col("rejected_by").isNull())


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each document: doc_id, its features, ``rejected_by`` (``base``, the first rule, or null) and ``kept``."""
    measured = written(features(docs.select("doc_id", "lang", "text")).drop("lang", "text"), "quality-features")
    return _verdicts(measured, thresholds(measured, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns as they were, whatever their names.

    Rows are measured and written once; the thresholds read the narrow
    columns of that table, the result its kept rows, so no text is shuffled.
    """
    needs = ("doc_id", "lang", "text")
    measured = written(features(apart(docs, needs)), "quality-measured")
    return together(_verdicts(measured, thresholds(measured, labels)).where("kept"), docs, needs)
