import math
from collections import Counter

import llm_data as D
import pandas as pd

from saleswh.llm import quality


def brute(text):
    text = text or ""
    w = text.encode().split()
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            hit[i:i + 5] = [True] * 5
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(hit),
            len(w) < 10 or 100 * sum(hit) > 20 * len(w))


TEXTS = [None, "", " \n\t", "one two", D.sentences(1, 300), "a b c d e " * 3 + D.sentences(2, 60), "x\nx\n x\nx \n\ny\ny", "### | $$ é&é <b> " * 4,
         D.sentences(3, 20000), "a " * 40, "ünï cödé " + D.sentences(4, 30), "a\x0bb\x0cc d\xa0e " + D.sentences(5, 20)]


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None), (None, TEXTS[4], "en")]
    got = quality.features(D.frame(spark, rows).selectExpr("*", "'clash' as n_words")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)


def test_upper_bound_is_exact():
    for k, n, error in ((0, 50, 0.05), (3, 200, 0.01), (20, 60, 0.001)):
        p = quality.upper_bound(k, n, error)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - error) < 1e-6 * max(1, error) or abs(tail / error - 1) < 1e-4
    assert quality.upper_bound(5, 5, 0.05) == 1.0


def counts(rows):
    return pd.DataFrame(rows, columns=["beyond", "good", "holdout", "n"])


def test_cutoffs_are_certified_in_order():
    cutoffs = [3.0, 2.0, 1.0]  # mild to strict; a value beyond all three counts 3
    clean = [(0, 1, 1, 2000), (0, 1, 0, 1000), (2, 0, 0, 50), (3, 0, 0, 5)]
    assert quality.pick_cutoff(counts(clean), cutoffs, 0.01, 0.01) == 2.0  # no more bad documents at the strictest
    risky = [*clean, (2, 1, 1, 300)]
    assert quality.pick_cutoff(counts(risky), cutoffs, 0.01, 0.01) == 3.0  # good ones lie beyond the second
    assert quality.pick_cutoff(counts([(0, 1, 1, 20), (3, 0, 0, 50)]), cutoffs, 0.01, 0.01) is None  # too few labels
    assert quality.pick_cutoff(counts([(0, 1, 1, 2000), (0, 0, 0, 9)]), cutoffs, 0.01, 0.01) is None  # nothing to reject


def corpus(n):
    rows, labels = [], []
    for i in range(n):
        junk = i % 6 == 0
        rows.append((i, D.sentences(i, 30).replace(" ", " ## ") if junk else D.sentences(i, 30), ("en", "fr", None)[i % 3]))
        labels.append((i, 0 if junk else 1, 0))
    return rows, labels


def test_verdicts_reject_junk_and_keep_clean(spark):
    rows, labels = corpus(9000)
    docs = D.frame(spark, [*rows, (9001, None, "en"), (9002, "short", "en"), (9003, D.sentences(9003, 40), "zz")])
    lab = spark.createDataFrame([*labels, (4, 0, 0), (4, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(docs, lab).collect()}
    assert all(got[i].kept for i in range(9000) if i % 6) and got[9003].kept
    assert not any(got[i].kept for i in range(9000) if i % 6 == 0)
    assert got[9001].rejected_by == got[9002].rejected_by == "base"
    kept = quality.accepted(docs.selectExpr("*", "'x' as kept", "1 as extra"), lab)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_without_labels_only_base_rules(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.judged(D.frame(spark, [(1, D.sentences(1, 30).replace(" ", " ## ")), (2, "a b")]), none).collect()
    assert {(r.doc_id, r.rejected_by) for r in got} == {(1, None), (2, "base")}
    assert quality.judged(D.frame(spark, [(1, "a")]).limit(0), none).count() == 0


def test_every_language_is_a_stratum(spark):
    # 32 large languages; x has bad documents of long words, y is small and clean, with long words
    lang = "case when id < 128000 then concat('l', id % 32) when id < 131500 then 'x' else 'y' end as stratum"
    bad = "id >= 131000 and id < 131500"
    measured = spark.range(131503).selectExpr("id as doc_id", lang, "false as base_failed", "0D as symbols_per_word", "0D as repeated_lines", "0D as repeated_words",
                                              "case when id >= 131000 then 13D else 5D end as word_length")
    labels = spark.range(131503).selectExpr("id as doc_id", f"cast(not ({bad}) as int) as quality")
    got = quality._verdicts(measured, quality.thresholds(measured, labels)).where("id >= 131000".replace("id", "doc_id")).groupBy("stratum", "kept").count().collect()
    assert {tuple(r) for r in got} == {("x", False, 500), ("y", True, 3)}
