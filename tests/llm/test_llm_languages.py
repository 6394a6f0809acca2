import random

import llm_data as D

from saleswh.llm import languages, queries


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op6_language_id"](spark, D.SMALL)
    docs = spark.read.parquet(f"{D.SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) >= 30 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert got.count() == docs.count() and all(0 <= r.score <= 1 for r in rows)


def model(spark):
    rows = [("the cat and the dog", "en"), ("the house of the king", "en"), ("le chat et le chien", "fr"), ("la maison du roi", "fr"), (None, "en"), ("zzz", None)]
    return languages.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_words_first_then_grams(spark):
    m = model(spark)
    assert m.langs == ["en", "fr"]
    assert m.parts("the") == ([m.rows[0]["the"]], [0])
    at, steps = m.parts("thx")  # <thx and thx> are unknown, <th is known as a 3-gram
    assert int(m.offsets[3]) + m.rows[3]["<th"] in at and min(steps) == 2
    rows = [(1, "the dog", "x"), (2, "le roi", "x"), (3, None, "x"), (4, "", "x"), (5, "123 ...", "x"), (6, "THE CAT", "x"), (7, "maisons", "x"), (8, "中文", "x"), (9, "the " * 20000, "x"),
            (1, "the dog", "x"), (None, "le roi", "x")]
    got = languages.predicted(D.frame(spark, rows).selectExpr("*", "'old' as lang_pred", "9 as score"), m).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, 6, 7, 9, None)] == ["en", "fr", "und", "und", "und", "en", "fr", "en", "fr"]
    assert by[3].score == 0 and by[8].lang_pred in m.langs and all(0 <= r.score <= 1 for r in got)


def test_nothing_learned(spark):
    none = spark.createDataFrame([], "text string, lang string")
    got = languages.predicted(D.frame(spark, [(1, "the dog"), (2, None)]), languages.fit(none)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert languages.predicted(D.frame(spark, [(1, "a")]).limit(0), model(spark)).count() == 0


def test_every_labelled_language_is_learned(spark):
    rows = [(f"{a}{b}{a}{b} {b}{b}{a}", f"l{a}{b}") for a in "abcdefghijk" for b in "qrstuvwxyz"]
    m = languages.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert m.langs == sorted(r[1] for r in rows) and len(m.langs) > languages.ABREAST
    got = languages.predicted(D.frame(spark, list(enumerate(r[0] for r in rows))), m).collect()
    assert len(got) == len(rows) and all(r.lang_pred == rows[r.doc_id][1] and r.score > 0.5 for r in got)


def test_chosen_words_have_their_counts_in_all_languages(spark, monkeypatch):
    monkeypatch.setattr(languages, "ENTRIES", 10)  # the most frequent word of each language
    monkeypatch.setattr(languages, "EACH", 1)
    rows = [("aa " * 100 + "bb " * 50, "en"), ("bb bb " + " ".join(f"c{x}" for x in "abcdefghij"), "fr")]
    m = languages.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert set(m.rows[0]) == {"aa", "bb"}
    assert [r.lang_pred for r in languages.predicted(D.frame(spark, [(1, "bb")]), m).collect()] == ["en"]


def _texts(language: int, many: int, seed: int) -> list[str]:
    """Texts of an invented language: 400 words of its own syllables, the common ones often."""
    rng = random.Random(language)
    syllables = ["".join(rng.choice(x) for x in ("bcdfghjklmnprstvz", "aeiou")) for _ in range(24)]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rng = random.Random(seed)
    return [" ".join(vocabulary[int(400 * rng.random() ** 3)] for _ in range(12)) for _ in range(many)]


def _accuracy(spark, languages_there: int) -> float:
    rows = [(t, f"l{k:02d}") for k in range(languages_there) for t in _texts(k, 40, 1000 + k)]
    m = languages.fit(spark.createDataFrame(rows, "text string, lang string"))
    share = max(languages.EACH, languages.ENTRIES // (languages_there * 5))
    assert max(map(len, m.rows)) <= languages_there * share * 1.2
    asked = [(k * 100 + i, t) for k in range(languages_there) for i, t in enumerate(_texts(k, 10, 5000 + k))]
    got = languages.predicted(D.frame(spark, asked), m).collect()
    return sum(r.lang_pred == f"l{r.doc_id // 100:02d}" for r in got) / len(asked)


def test_accuracy_holds_with_fifty_languages(spark, monkeypatch):
    """With shares that are cut: 50 languages have 200 words and grams of each length."""
    monkeypatch.setattr(languages, "ENTRIES", 10_000)
    monkeypatch.setattr(languages, "EACH", 200)
    few, many = _accuracy(spark, 5), _accuracy(spark, 50)
    assert few >= 0.97 and many >= 0.95


def test_shares_by_histogram(spark):
    rows = [("en", 0, f"w{i}", t) for i, t in enumerate([100] * 3 + [10] * 5 + [1] * 1000)] + [("fr", 0, "x", 1)]
    got = languages._chosen(spark.createDataFrame(rows, "lang string, n int, gram string, times long"), 108).collect()
    by = {t: sum(r.times == t and r.lang == "en" for r in got) for t in (100, 10, 1)}
    assert by[100] == 3 and by[10] == 5 and 60 <= by[1] <= 140 and sum(r.lang == "fr" for r in got) == 1


def test_scores_against_a_plain_evaluation(spark):
    """The posterior of every text from the definition: words first, then grams, a step's penalty for each length less."""
    import math
    import re
    from collections import Counter

    labelled = [(t, f"l{k}") for k in range(3) for t in _texts(k, 6, k)]
    texts = [*_texts(0, 3, 77), *_texts(2, 3, 78), "zzz qqq", "Ba-ba BA 1", ""]
    counts = {(lang, n): Counter() for _, lang in labelled for n in range(5)}
    for t, lang in labelled:
        for word in t.split():
            counts[lang, 0][word] += 1
            for n in range(1, 5):
                counts[lang, n].update(languages.grams(word, n))
    langs = sorted({lang for _, lang in labelled})
    known = [set().union(*(counts[lang, n] for lang in langs)) for n in range(5)]

    def log(lang, n, g):
        return math.log((counts[lang, n].get(g, 0) + languages.ABSENT) / (sum(counts[lang, n].values()) + 1))

    def score(word, lang):
        if word in known[0]:
            return log(lang, 0, word)
        left, n, out = languages.grams(word, 4) or languages.grams(word, 3), 4 if len(word) > 1 else 3, []
        while left and n:
            out += [log(lang, n, g) - (5 - n) * languages.STEP for g in left if g in known[n]]
            left = [x for g in left if g not in known[n] for x in (g[:-1], g[1:]) if x not in ("<", ">")] if n > 1 else []
            n -= 1
        return sum(out) / len(out) if out else 0.0

    m = languages.fit(spark.createDataFrame(labelled, "text string, lang string"))
    got = {r.doc_id: r for r in languages.predicted(D.frame(spark, list(enumerate(texts))), m).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\W\d_]+", t.lower())
        if not words:
            assert got[i].lang_pred == "und"
            continue
        totals = [sum(score(w, lang) for w in words) for lang in langs]
        best = totals.index(max(totals))
        assert got[i].lang_pred == langs[best]
        assert abs(got[i].score - 1 / sum(math.exp(x - totals[best]) for x in totals)) < 1e-9
