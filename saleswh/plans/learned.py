"""Sentiment and categories learned from seeds.

Both start from a few seed words and carry them over to all words of the
corpus, so they score texts in any language that has seeds, whatever else it
says.  Counts are of texts that hold a word, each once.

* ``polarity``: how much more often a word stands in texts with positive seeds
  than in texts with negative ones: the difference of its pointwise mutual
  informations with the two, smoothed by one text.
* ``seeded_bayes``: texts with seed words of a category are its first examples;
  a naive Bayes model learned from them labels all texts with its seeds, and
  is learned once more from these labels.

Logarithms are kept in thousandths, as integers, so sums do not depend on the
order in which tasks add them.

Scale: a text is one row with the array of its different words, and it is told
from that row alone which seeds it holds.  Words are counted by partial
aggregates; the tables of words that come out are broadcast if they are small
(measured).  Else the words of most texts are, which is nearly all that a text
holds, and only the others are joined by shuffle, where AQE splits a word that
many texts have.  Words in fewer than ``least`` texts say nothing: they would be
most of such a table.  The arrays of words are written once; labels are joined
to them.  Seeds are a parameter and small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleswh.operators.commit import materialize
from saleswh.operators.sizing import frequent, small
from saleswh.plans.analytics import TOKEN_SPLIT

MILLI = 1000


def _milli(x: Column) -> Column:
    """Thousandths of the natural logarithm."""
    return F.round(F.log(x) * MILLI).cast("long")


def words(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, lang, words): the different words of each text; no words: an empty array."""
    found = F.array_remove(F.array_distinct(F.split(F.lower(F.col(text)), TOKEN_SPLIT)), "")
    return df.select(key, F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(found, F.array().cast("array<string>")).alias("words"))


def look_up(texts: DataFrame, key: str, table: DataFrame, by: list[str]) -> DataFrame:
    """(key, values): a row of ``table`` for each word of a text that it has.

    ``table``: (by, n, values), one row for each ``by``: the word ``w``, and
    columns of the texts.  ``n`` is the number of texts it was learned from.
    Words of many texts are looked up where the text is; if there are too many
    to broadcast them all, the words not found are shuffled to the others.
    """
    values = [c for c in table.columns if c not in (*by, "n")]
    found = texts.select(key, *(c for c in by if c != "w"), F.explode("words").alias("w"))
    often, seldom = frequent(table, "n")
    parts = [] if often is None else [found.join(often, by)]
    if seldom is not None:
        parts.append((found if often is None else found.join(often, by, "left_anti")).join(seldom, by))
    hits = [p.select(key, *values) for p in parts]
    return hits[0] if len(hits) == 1 else hits[0].unionByName(hits[1])


# ------------------------------------------------------------------ seeds
def seeds_of_labels(texts: DataFrame, labels: DataFrame, key: str, many: int = 20, least: int = 3) -> DataFrame:
    """(lang, w, p): for each language the ``many`` words that most tell good texts (p = 1) from bad ones (p = -1).

    ``labels``: (key, good).  Words in fewer than ``least`` labelled texts are no seeds.
    """
    known = texts.where(F.size("words") > 0).join(labels, key)
    sizes = known.groupBy("lang").agg(F.count_if("good").alias("_ng"), F.count_if(~F.col("good")).alias("_nb"))
    counts = known.select("lang", "good", F.explode("words").alias("w")).groupBy("lang", "w").agg(
        F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")).where(F.col("g") + F.col("b") >= least)
    # both shares with one denominator, so that they compare as integers
    gain = F.col("g") * F.col("_nb") - F.col("b") * F.col("_ng")
    rated = counts.join(small(sizes, 100_000), "lang").select("lang", "w", gain.alias("gain"))
    best = None
    for p, sign in ((1, 1), (-1, -1)):
        # the first of each task meet, not all words of a language
        place = F.row_number().over(Window.partitionBy("lang").orderBy((F.col("gain") * sign).desc(), "w"))
        found = rated.where(F.col("gain") * sign > 0).withColumn("_r", place).where(F.col("_r") <= many).select("lang", "w", F.lit(p).alias("p"))
        best = found if best is None else best.unionByName(found)
    return best


# ------------------------------------------------------------------ D4
def polarity(texts: DataFrame, seeds: DataFrame, least: int = 3) -> DataFrame:
    """(lang, w, n, pol): texts with the word and a seed, and thousandths of PMI with positive seeds less PMI with negative ones."""
    sides = seeds.groupBy("lang").agg(F.collect_list(F.when(F.col("p") > 0, F.col("w"))).alias("_p"), F.collect_list(F.when(F.col("p") < 0, F.col("w"))).alias("_n"))
    rows = texts.join(small(sides, 100_000), "lang").select("lang", "words", F.arrays_overlap("words", "_p").alias("pos"), F.arrays_overlap("words", "_n").alias("neg"))
    rows = rows.where("pos or neg")
    n = rows.groupBy("lang").agg(F.count_if("pos").alias("_np"), F.count_if("neg").alias("_nn"))
    counts = rows.select("lang", "pos", "neg", F.explode("words").alias("w")).groupBy("lang", "w").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("pos").alias("cp"), F.count_if("neg").alias("cn")).where(F.col("n") >= least)
    ratio = ((F.col("cp") + 1) * (F.col("_nn") + 2)).cast("double") / ((F.col("cn") + 1) * (F.col("_np") + 2)).cast("double")
    return counts.join(small(n, 100_000), "lang").select("lang", "w", "n", _milli(ratio).alias("pol"))


def sentiment(df: DataFrame, key: str, text: str, lang: str, seeds: DataFrame, least: int = 3) -> DataFrame:
    """(key, SENTIMIENTO): the polarities of a text's words, summed, over the sum of their sizes: -1 to 1; 0 without any."""
    texts = materialize(words(df, key, text, lang), "text_words")
    rated = materialize(polarity(texts, materialize(seeds, "seeds"), least), "polarity")
    sums = look_up(texts, key, rated, ["lang", "w"]).groupBy(key).agg(F.sum("pol").alias("_s"), F.sum(F.abs("pol")).alias("_a"))
    score = F.col("_s").cast("double") / F.nullif(F.col("_a").cast("double"), F.lit(0.0))
    return df.select(key).join(sums, key, "left").select(key, F.round(F.coalesce(score, F.lit(0.0)), 4).alias("SENTIMIENTO"))


# ------------------------------------------------------------------ D5
def seed_label(seeds: DataFrame, labels: int) -> Column:
    """The label with most seed words among ``words``, the first of equals; NULL without any.  ``seeds``: (w, label), few."""
    by: list[list[str]] = [[] for _ in range(labels)]
    for r in seeds.select("w", "label").collect():
        by[r["label"]].append(r["w"])
    hits = [F.size(F.array_intersect(F.col("words"), F.array(*map(F.lit, sorted(ws))).cast("array<string>"))) for ws in by]
    best = F.array_max(F.array(*(F.struct(h.alias("n"), F.lit(-i).alias("l")) for i, h in enumerate(hits))))
    return F.when(best["n"] > 0, -best["l"])


def _model(labelled: DataFrame, labels: int, least: int) -> tuple[DataFrame, list[int]]:
    """From (words, label): (w, n, l0, l1, ...), the texts with the word and thousandths of the log share of texts of each label with it; and the labels' texts."""
    found = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each label
    sizes = [next((r["n"] for r in found if r["label"] == i), 0) for i in range(labels)]
    counts = labelled.select("label", F.explode("words").alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("label") == i).alias(f"n{i}") for i in range(labels))).where(F.col("n") >= least)
    logs = [_milli((F.col(f"n{i}") + 1).cast("double") / F.lit(float(sizes[i] + 2))).alias(f"l{i}") for i in range(labels)]
    return materialize(counts.select("w", "n", *logs), "bayes_model"), sizes


def _labelled(texts: DataFrame, model: DataFrame, sizes: list[int], key: str, labels: int) -> DataFrame:
    """(key, label): the most likely label of each text with a known word, the first of equals."""
    sums = look_up(texts, key, model, ["w"]).groupBy(key).agg(*(F.sum(f"l{i}").alias(f"s{i}") for i in range(labels)))
    prior = [_milli(F.lit((n + 1.0) / (sum(sizes) + labels))) for n in sizes]
    best = F.array_max(F.array(*(F.struct((F.col(f"s{i}") + prior[i]).alias("s"), F.lit(-i).alias("i")) for i in range(labels))))
    return sums.select(key, (-best["i"]).alias("label"))


def seeded_bayes(df: DataFrame, key: str, text: str, lang: str, seeds: DataFrame, labels: list[str], holdout: Column | None = None, least: int = 2) -> DataFrame:
    """(key, CATEGORIA, SEED): the category that the twice learned model gives, and that of the seeds alone (NULL without any).

    ``seeds``: (w, label), the label as its place in ``labels``.  Texts that
    ``holdout`` (a condition on the key) takes out are not learned from in
    either round, so the agreement of the two columns on them measures the model.
    """
    n, learn = len(labels), F.lit(True) if holdout is None else ~holdout
    texts = materialize(words(df, key, text, lang).select(key, "words").withColumn("seed", seed_label(seeds, n)), "text_words")
    seeded = texts.where(F.col("seed").isNotNull() & learn).select("words", F.col("seed").alias("label"))
    first = materialize(_labelled(texts, *_model(seeded, n, least), key, n), "first_labels")
    relearned = texts.where(learn).join(small(first), key).select("words", "label")
    final = _labelled(texts, *_model(relearned, n, least), key, n)
    name = lambda c: F.element_at(F.array(*map(F.lit, labels)), (F.col(c) + 1).cast("int"))
    j = df.select(key).join(final, key, "left").join(texts.select(key, "seed"), key, "left")
    return j.select(key, F.when(F.col("label").isNotNull(), name("label")).alias("CATEGORIA"), F.when(F.col("seed").isNotNull(), name("seed")).alias("SEED"))
