"""Language identification by words first, and character n-grams for words never seen.

From labelled texts the log frequency of words, and of n-grams of 1 to 4
characters in them, is learned for each language.  A word of a text that was
learned scores its log frequency in each language.  An unseen word falls back
to its 4-grams; each of those that was never seen falls back to its two
3-grams, and so on, with a fixed penalty for each step; the word's score is
the mean over the grams that are left.  A text's score in a language is the
sum over its words.

Words are maximal runs of letters, lower-cased.  The model is fitted on about
``SAMPLE`` labelled texts of every language (chosen by a hash of text and
place in the table, so the same rows in other files may give another sample;
all of them if there are fewer).  It keeps the most frequent words and grams
of each language: an equal share of ``ENTRIES``, but ``EACH`` of every length
however many languages there are; each of them has its true count in all
languages.  The least count that gets in is read off a histogram of counts, by
eighths of powers of two, so no language is sorted in one task.  What is
broadcast is bounded by the number of languages; every text is scored whole,
where it is read, in ``ABREAST`` languages at a time.

Defined results: ``und`` with score 0 if a text is null or has no letter, or
if nothing could be learned; on ties the first language by name; otherwise the
score is the posterior of the predicted language under equal priors.  Repeated
rows are judged alike; other input columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleswh.llm import words as W
from saleswh.llm.tables import written

#: Labelled texts for each language, words and grams in the model, least share of a language and length of these, and
#: languages whose table a task holds at once.
SAMPLE, ENTRIES, EACH, ABREAST = 10_000, 400_000, 1000, 64
#: Longest n-gram; log penalty of a step to shorter grams; count of a word or gram in a language that lacks it.
LONGEST, STEP, ABSENT = 4, 1.0, 0.1

_LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between marks; those of one character without the marks."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in W.slices(batch["text"]):
            part = batch.slice(a, b - a)
            w = W.split(part["text"], W.NOT_SPACE)
            codes, distinct = w.coded()
            langs = part["lang"].dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False)[w.rows()]
            tokens = W.items(distinct)
            found: dict[tuple[str, int], Counter] = {}
            for k, name in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(codes[lang == k], minlength=len(tokens))
                terms = Counter()
                for i in np.flatnonzero(times).tolist():
                    for word in _LETTERS.findall(tokens[i].decode().lower()):
                        terms[word] += int(times[i])
                found[name, 0] = terms
                for n in range(1, LONGEST + 1):
                    of = found[name, n] = Counter()
                    for word, t in terms.items():
                        for g in grams(word, n):
                            of[g] += t
            for (name, n), c in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(c), pa.string()), pa.array([n] * len(c), pa.int32()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                                 names=["lang", "n", "gram", "times"])


class Model:
    """Log frequencies by language: one table of words (order 0) and one of grams of each length."""

    def __init__(self, counts: pa.Table | None, totals: dict[tuple[str, int], int]):
        """``counts``: a row for each word or gram with n, gram, and its languages (places in the sorted names) and times."""
        self.langs = sorted({x for x, _ in totals})
        self.rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        orders = counts["n"].to_pylist() if counts else []
        at = np.array([self.rows[n].setdefault(g, len(self.rows[n])) for n, g in zip(orders, counts["gram"].to_pylist() if counts else [], strict=True)], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in self.rows])])
        at += self.offsets[np.array(orders, np.int64)]
        # the counts that are not zero, by table row and language
        self.at, self.column, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if counts:
            self.at = at[pc.list_parent_indices(counts["columns"].combine_chunks()).to_numpy()]
            self.column, self.times = (pc.list_flatten(counts[c].combine_chunks()).to_numpy() for c in ("columns", "times"))
        self.sizes = np.array([[totals.get((x, n), 0) + 1.0 for x in self.langs] for n in range(LONGEST + 1)])
        self.held: tuple[int, np.ndarray] | None = None

    def table(self, first: int) -> np.ndarray:
        """Log frequencies of all words and grams in the languages from ``first``; only the last one made is held."""
        if self.held is None or self.held[0] != first:
            self.held = None
            sizes = self.sizes[:, first:first + ABREAST]
            here = (self.column >= first) & (self.column < first + ABREAST)
            logs = np.full((int(self.offsets[-1]), sizes.shape[1]), ABSENT)
            logs[self.at[here], self.column[here] - first] += self.times[here]
            for n in range(LONGEST + 1):
                logs[self.offsets[n]:self.offsets[n + 1]] /= sizes[n]
            self.held = first, np.log(logs, out=logs)
        return self.held[1]

    def parts(self, word: str) -> tuple[list[int], list[int]]:
        """Rows of the table that make up a word's score, and how many steps back each is."""
        known = self.rows[0].get(word)
        if known is not None:
            return [known], [0]
        left, at, steps = grams(word, LONGEST) or grams(word, 3), [], []
        n = len(left[0])
        while left and n:
            shorter: list[str] = []
            for g in left:
                row = self.rows[n].get(g)
                if row is not None:
                    at.append(int(self.offsets[n]) + row)
                    steps.append(LONGEST + 1 - n)
                elif n > 1:
                    shorter += [x for x in (g[:-1], g[1:]) if x not in ("<", ">")]
            left, n = shorter, n - 1
        return at, steps

    def found(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """How many parts each word has, and table row and steps back of all parts in turn."""
        parts = [self.parts(w) for w in words]
        return (np.array([len(at) for at, _ in parts], np.int64), np.array([x for at, _ in parts for x in at], np.int64),
                np.array([x for _, steps in parts for x in steps], np.float64))

    def scores(self, found: tuple[np.ndarray, ...], first: int) -> np.ndarray:
        """Words by the languages from ``first``; a word without any known gram scores zero throughout."""
        sizes, rows, steps = found
        table = self.table(first)
        out = np.zeros((len(sizes), table.shape[1]))
        full = np.flatnonzero(sizes)
        if len(full):
            begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            values = table[rows] - STEP * steps[:, None]
            out[full] = np.add.reduceat(values, begins, axis=0) / sizes[full][:, None]
        return out


def _chosen(counts: DataFrame, most: int) -> DataFrame:
    """About the ``most`` most frequent entries of each language and length; of those with the last count that gets in,
    a share by hash."""
    step = F.floor(F.log2("times") * 8).cast("int")
    sizes = counts.groupBy("lang", "n", step.alias("step")).agg(F.count(F.lit(1)).alias("size"))
    above = F.sum("size").over(Window.partitionBy("lang", "n").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1))
    shares = sizes.select("lang", "n", "step", ((F.lit(most) - F.coalesce(above, F.lit(0))) / F.col("size")).alias("share")).where("share > 0")
    drawn = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    # a row for each language, length and step of counts, of which there are some hundreds
    return counts.withColumn("step", step).join(shares, ["lang", "n", "step"]).where(drawn)


def fit(labelled: DataFrame) -> Model:
    """The model of texts (text, lang); rows without either teach nothing.  The driver gets a row for each language, and
    one for each word or gram of the model."""
    rows = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return Model(None, {})
    # a share of each language by a hash of text and place, so that no group of copies is drawn as a whole
    spark = labelled.sparkSession
    shares = spark.createDataFrame([(r["lang"], int((1 << 40) * min(1.0, SAMPLE / r["n"]))) for r in sizes], "lang string, _share long")
    drawn = rows.withColumn("_draw", F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 40)))
    drawn = drawn.join(F.broadcast(shares), "lang").where("_draw <= _share").select("text", "lang")
    counts = drawn.mapInArrow(_learn, "lang string, n int, gram string, times long").groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    counts = written(counts, "language-counts")
    totals = {(r["lang"], r["n"]): r["times"] for r in counts.groupBy("lang", "n").agg(F.sum("times").alias("times")).collect()}
    if not totals:
        return Model(None, {})
    chosen = _chosen(counts, max(EACH, ENTRIES // (len(sizes) * (LONGEST + 1)))).select("n", "gram").distinct()
    places = spark.createDataFrame(list(enumerate(sorted({x for x, _ in totals}))), "_column int, lang string")
    cells = counts.join(chosen, ["n", "gram"], "left_semi").join(F.broadcast(places), "lang") \
        .groupBy("n", "gram").agg(F.collect_list(F.struct("_column", "times")).alias("cells"))
    return Model(cells.select("n", "gram", F.col("cells._column").alias("columns"), F.col("cells.times").alias("times")).toArrow(), totals)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        langs = np.array([*model.langs, "und"], object)
        for batch in batches:
            for a, b in W.slices(batch["text"]):
                part = batch.slice(a, b - a)
                w = W.split(part["text"], W.NOT_SPACE)
                codes, distinct = w.coded()
                runs = [_LETTERS.findall(t.decode().lower()) for t in W.items(distinct)]
                distinct_words = {x: i for i, x in enumerate(dict.fromkeys(x for r in runs for x in r))}
                found = model.found(list(distinct_words))
                token = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
                word = np.array([distinct_words[x] for r in runs for x in r], np.int64)
                letters = np.array([bool(r) for r in runs] + [False])
                rows = w.rows()
                lettered = np.bincount(rows, weights=letters[codes], minlength=len(part)) > 0
                total = np.zeros((len(part), len(model.langs)))
                for first in range(0, len(model.langs), ABREAST):
                    of_word = model.scores(found, first)
                    of_token = np.zeros((len(runs), of_word.shape[1]))
                    np.add.at(of_token, token, of_word[word])
                    for i, of in enumerate(of_token.T, first):
                        total[:, i] = np.bincount(rows, weights=of[codes], minlength=len(part))
                known = lettered & pc.is_valid(part["text"]).to_numpy(zero_copy_only=False) & bool(model.langs)
                best, score = np.full(len(part), len(model.langs)), np.zeros(len(part))
                if known.any():
                    odds = total[known] - total[known].max(axis=1, keepdims=True)
                    best[known] = odds.argmax(axis=1)
                    score[known] = 1 / np.exp(odds).sum(axis=1)
                own = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([part[c] for c in own] + [pa.array(langs[best], pa.string()), pa.array(score)], names=[*own, "lang_pred", "score"])
    return run


def predicted(texts: DataFrame, model: Model) -> DataFrame:
    """The columns of ``texts`` but the text, with ``lang_pred`` and ``score``."""
    own = [c for c in texts.columns if c not in ("text", "lang_pred", "score")]
    shared = texts.sparkSession.sparkContext.broadcast(model)
    schema = texts.select(*own).schema.add("lang_pred", "string").add("score", "double")
    return texts.select(*own, "text").mapInArrow(_predict(shared), schema)
