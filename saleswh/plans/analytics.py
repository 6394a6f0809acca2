"""Analytics (D1-D6, A12): forecast, anomaly detection, change drivers, text.

The reference calls closed warehouse models; only their inputs and
outputs are fixed.  Our definitions are built from distributed aggregates
so they scale and have an SQL twin:

* the daily series (one row per series and day) is written once, and so is
  the fitted model, so the base tables are read once.
* forecast: per series ``y ~ a + b*t`` (``regr_intercept/regr_slope``, t in
  days) plus the mean residual per ISO weekday; bounds = +- z * stddev of
  the remaining residuals.  Per-series parameters are a small aggregate
  (one row per series), the horizon is ``explode(sequence(...))``.
* anomalies: the same model fitted strictly before the scoring window.
* drivers: GROUPING SETS over single dimensions and pairs, current vs
  previous period sums, relative change, top-k by |change|.
* text: tokens exploded and joined to a fixed, broadcast lexicon.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.functions.sap import since_days
from saleswh.operators.commit import materialize
from saleswh.operators.sizing import small

EPOCH = "1970-01-01"

# Sentiment lexicon (our choice; the reference's model is closed).
POSITIVE = ["good", "great", "excellent", "happy", "love", "best", "fast", "correct", "improved", "perfect",
            "satisfied", "thanks", "nice", "recommend", "reliable", "fine", "better", "clean", "easy", "helpful"]
NEGATIVE = ["bad", "late", "delay", "delayed", "broken", "damaged", "poor", "wrong", "missing", "worst",
            "slow", "angry", "problem", "error", "fail", "failed", "complaint", "refund", "dirty", "never"]
# The four complaint categories in tie order, with their keywords.
CATEGORIES = [
    ("Logística/Entrega", ["delivery", "late", "delay", "delayed", "shipping", "arrived", "truck", "transport"]),
    ("Calidad de producto", ["quality", "damaged", "broken", "defect", "spoiled", "package", "product"]),
    ("Facturación", ["invoice", "billing", "price", "charge", "payment", "paid", "refund"]),
    ("Elogio", ["excellent", "great", "thanks", "happy", "good", "satisfied", "love"]),
]
#: Words are runs of letters of any script.
TOKEN_SPLIT = "[^\\p{L}]+"
SENTENCE_SPLIT = "[.!?]+"


# ------------------------------------------------------------------ time series
def _t(ts) -> F.Column:
    return F.datediff(F.col(ts).cast("date"), F.lit(EPOCH).cast("date")).cast("double")


def fit(df: DataFrame, series: str, ts: str, y: str) -> DataFrame:
    """Per-series trend + weekday effect + residual spread (one row per series x weekday)."""
    d = df.select(F.col(series).alias("_s"), F.col(ts).cast("date").alias("_ts"),
                  F.col(y).cast("double").alias("_y"))
    trend = d.groupBy("_s").agg(F.regr_slope("_y", _t("_ts")).alias("_b"),
                                F.regr_intercept("_y", _t("_ts")).alias("_a"),
                                F.max("_ts").alias("_last"))
    r = (d.join(trend, "_s")
          .withColumn("_dow", F.weekday("_ts") + 1)
          .withColumn("_r", F.col("_y") - (F.col("_a") + F.col("_b") * _t("_ts"))))
    wd = r.groupBy("_s", "_dow").agg(F.avg("_r").alias("_wd"))
    r2 = r.join(wd, ["_s", "_dow"]).withColumn("_e", F.col("_r") - F.col("_wd"))
    sig = r2.groupBy("_s").agg(F.stddev_samp("_e").alias("_sigma"))
    # one row per series and weekday: written once, as the callers read it several times
    return materialize(trend.join(sig, "_s").join(wd, "_s", "left"), "series_model")


def forecast(df: DataFrame, series: str, ts: str, y: str, periods: int = 90, z: float = 1.96) -> DataFrame:
    """SERIES, TS, FORECAST, LOWER_BOUND, UPPER_BOUND (rounded to 0)."""
    m = fit(materialize(df, "daily_series"), series, ts, y)
    params = m.select("_s", "_a", "_b", "_last", "_sigma").distinct()
    hz = params.select("_s", "_a", "_b", "_sigma",
                       F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", periods))).alias("TS"))
    hz = hz.withColumn("_dow", F.weekday("TS") + 1)
    wd = m.select("_s", "_dow", "_wd")
    j = hz.join(wd, ["_s", "_dow"], "left")
    fc = F.col("_a") + F.col("_b") * _t("TS") + F.coalesce(F.col("_wd"), F.lit(0.0))
    band = F.lit(z) * F.coalesce(F.col("_sigma"), F.lit(0.0))
    return j.select(F.col("_s").alias("SERIES"), "TS", F.round(fc, 0).alias("FORECAST"),
                    F.round(fc - band, 0).alias("LOWER_BOUND"), F.round(fc + band, 0).alias("UPPER_BOUND"))


def detect_anomalies(df: DataFrame, series: str, ts: str, y: str, as_of: str, days: int = 60,
                     z: float = 2.576) -> DataFrame:
    """Score the last ``days`` before ``as_of`` with a model fitted strictly before them."""
    d = materialize(df.withColumn("_d", F.col(ts).cast("date")), "daily_series")
    train = d.where(~since_days("_d", as_of, days))
    window = d.where(since_days("_d", as_of, days) & (F.col("_d") <= F.lit(as_of).cast("date")))
    m = fit(train, series, "_d", y)
    w = (window.select(F.col(series).alias("_s"), F.col("_d").alias("TS"), F.col(y).cast("double").alias("Y"))
               .withColumn("_dow", F.weekday("TS") + 1))
    j = w.join(m.select("_s", "_a", "_b", "_sigma", "_dow", "_wd"), ["_s", "_dow"], "left")
    fc = F.col("_a") + F.col("_b") * _t("TS") + F.coalesce(F.col("_wd"), F.lit(0.0))
    return j.select(F.col("_s").alias("SERIES"), "TS", "Y", F.round(fc, 0).alias("FORECAST"),
                    (F.abs(F.col("Y") - fc) > F.lit(z) * F.col("_sigma")).alias("IS_ANOMALY"))


# ------------------------------------------------------------------ drivers
def top_drivers(df: DataFrame, dims: list[str], label: str, metric: str, k: int = 10) -> DataFrame:
    """D3: segments (single dims and pairs) ranked by |relative change| current vs previous."""
    sets = [[F.col(d) for d in some] for some in [*((d,) for d in dims), *combinations(dims, 2)]]
    # sums are decomposable: aggregate to the dimensions and the period before the sets expand the rows
    df = df.groupBy(*dims, label).agg(F.sum(metric).alias(metric))
    out = df.groupingSets(sets, *dims).agg(
        F.grouping_id(*dims).alias("GID"), F.sum(F.when(F.col(label), F.col(metric)).otherwise(0)).alias("CURRENT_SUM"),
        F.sum(F.when(~F.col(label), F.col(metric)).otherwise(0)).alias("PREVIOUS_SUM"))
    rel = (F.col("CURRENT_SUM").cast("double") - F.col("PREVIOUS_SUM").cast("double")) / \
        F.nullif(F.col("PREVIOUS_SUM").cast("double"), F.lit(0.0))
    out = out.withColumn("RELATIVE_CHANGE", F.round(rel, 6))
    order = [F.abs("RELATIVE_CHANGE").desc_nulls_last(), F.col("GID").asc()] + [F.col(d).asc_nulls_first()
                                                                                 for d in dims]
    return out.orderBy(*order).limit(k)


# ------------------------------------------------------------------ text
def _tokens(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(id_col, F.explode(F.split(F.lower(F.col(text)), TOKEN_SPLIT)).alias("_w")).where("_w <> ''")


def sentiment(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(pos - neg) / (pos + neg) in -1..1; 0 when no lexicon word occurs."""
    spark = df.sparkSession
    lex = spark.createDataFrame([(w, 1) for w in POSITIVE] + [(w, -1) for w in NEGATIVE], "_w string, _p int")
    hits = _tokens(df, id_col, text).join(F.broadcast(lex), "_w")
    s = hits.groupBy(id_col).agg(F.sum(F.when(F.col("_p") > 0, 1).otherwise(0)).alias("_pos"),
                                 F.sum(F.when(F.col("_p") < 0, 1).otherwise(0)).alias("_neg"))
    score = (F.col("_pos") - F.col("_neg")).cast("double") / F.nullif((F.col("_pos") + F.col("_neg")).cast("double"),
                                                                      F.lit(0.0))
    return (df.select(id_col).join(s, id_col, "left")
              .select(id_col, F.round(F.coalesce(score, F.lit(0.0)), 4).alias("SENTIMIENTO")))


def classify(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Keyword score per category, argmax with the fixed category order on ties; NULL if no hit."""
    spark = df.sparkSession
    kw = spark.createDataFrame([(w, lab, i) for i, (lab, words) in enumerate(CATEGORIES) for w in words],
                               "_w string, _label string, _rank int")
    hits = _tokens(df, id_col, text).join(F.broadcast(kw), "_w")
    sc = hits.groupBy(id_col, "_label", "_rank").agg(F.count(F.lit(1)).alias("_n"))
    best = sc.groupBy(id_col).agg(F.max(F.struct(F.col("_n"), (-F.col("_rank")).alias("_r"),
                                                 F.col("_label"))).alias("_b"))
    return (df.select(id_col).join(best, id_col, "left")
              .select(id_col, F.col("_b._label").alias("CATEGORIA")))


def summarize(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Extractive summary = the sentence whose words are the most frequent in the document, on average.

    Ties go to the first sentence.  Every document comes back: without any
    word of letters its first sentence with text is the summary, and without
    such a sentence the summary is NULL.

    A document is one row, and its sentences are rated in place; nothing but
    the ids is shuffled.  Rows that share an id are one document: these are
    rated by grouping.
    """
    shared = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id")
    shared = materialize(shared, "shared_ids")
    if shared.isEmpty():
        return _own_summaries(df, id_col, text)
    shared = small(shared)
    return _own_summaries(df.join(shared, F.col(id_col) == shared["_id"], "left_anti"), id_col, text).unionByName(
        _shared_summaries(df.join(shared, F.col(id_col) == shared["_id"], "left_semi"), id_col, text))


def _own_summaries(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Summaries of documents of one row each; NULL without an id."""
    def best(sentences):  # the words of each sentence, None for one without text
        if sentences is None:
            return None
        seen = {}
        for words in sentences:
            for w in words if words is not None else ():
                seen[w] = seen.get(w, 0) + 1
        seen.pop("", None)
        found, top = None, -1.0
        for place, words in enumerate(sentences):
            if words is not None:
                counts = [seen[w] for w in words if w]
                score = sum(counts) / len(counts) if counts else 0.0
                if score > top:
                    found, top = place, score
        return found

    words = F.transform("_sents", lambda s: F.when(F.trim(s) != "", F.split(F.lower(s), TOKEN_SPLIT)))
    place = F.udf(best, "int", useArrow=True)(words)
    cut = df.select(id_col, F.split(F.col(text), SENTENCE_SPLIT).alias("_sents")).withColumn("_best", place)
    return cut.select(id_col, F.when(F.col(id_col).isNotNull(), F.trim(F.get("_sents", F.col("_best")))).alias("RESUMEN"))


def _shared_summaries(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Summaries of documents whose sentences may be in several rows."""
    sent = df.select(id_col, F.posexplode(F.split(F.col(text), SENTENCE_SPLIT)).alias("_pos", "_sent"))
    sent = sent.where(F.trim("_sent") != "")
    words = sent.select(id_col, "_pos", F.explode(F.split(F.lower("_sent"), TOKEN_SPLIT)).alias("_w")).where("_w <> ''")
    counts = words.groupBy(id_col, "_pos", "_w").agg(F.count(F.lit(1)).alias("_n"))
    tf = counts.groupBy(id_col, "_w").agg(F.sum("_n").alias("_tf"))
    score = counts.join(tf, [id_col, "_w"]).groupBy(id_col, "_pos").agg((F.sum(F.col("_n") * F.col("_tf")) / F.sum("_n")).alias("_score"))
    rated = sent.join(score, [id_col, "_pos"], "left")
    best = rated.groupBy(id_col).agg(F.max(F.struct(F.coalesce("_score", F.lit(0.0)).alias("_score"), (-F.col("_pos")).alias("_np"),
                                                    F.trim("_sent").alias("_sent"))).alias("_b"))
    return df.select(id_col).join(best, id_col, "left").select(id_col, F.col("_b._sent").alias("RESUMEN"))


def complaint_digest(scored: DataFrame) -> DataFrame:
    """A12: 'category (mean sentiment)' list joined by '; ' over the (bounded) categories."""
    per_cat = (scored.groupBy("CATEGORIA").agg(F.round(F.avg("SENTIMIENTO"), 2).alias("_s"))
                     .select(F.concat(F.coalesce("CATEGORIA", F.lit("Sin categoría")), F.lit(" ("),
                                      F.col("_s").cast("string"), F.lit(")")).alias("_item")))
    return per_cat.agg(F.array_join(F.sort_array(F.collect_list("_item")), "; ").alias("DIGEST"))
