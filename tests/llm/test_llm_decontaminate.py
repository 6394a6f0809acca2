import hashlib
import re

import llm_data as D
import pytest

from saleswh.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        if item is not None and n:
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k:k + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, found = words(text), set()
        hit = [False] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k:k + n])):
                    found |= got
                    hit[k:k + n] = [True] * n
        out.append((doc, len(w), sum(hit), sorted(found), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


BASE = D.sentences(1, 60)
ITEMS = [(7, BASE), (12, "Ein kurzer Satz, sehr kurz"), (3, "solo"), (5, D.sentences(2, 13)), (9, None), (10, ""), (None, "ghost words here"),
         (12, "Ein kurzer Satz, sehr kurz"), (20, "w1 w2 w3 w1 w2 w3 w1 w2"), (21, " ".join(["ab"] * 15)), (22, " ".join(["ab"] * 6)), (30, BASE)]
DOCS = [(1, None), (2, ""), (3, "... !!!"), (4, BASE), (5, D.sentences(3, 300) + " " + " ".join(BASE.split()[20:40]) + " " + D.sentences(4, 300)),
        (6, D.sentences(3, 300) + " " + " ".join(BASE.split()[20:32]) + " x"), (7, "EIN KURZER SATZ SEHR KURZ"), (8, "ein kurzer satz sehr"), (9, "x Solo y " * 3),
        (10, "w1 w2 w3 w1 w2 w3 w1 w2 w3 w1 w2"), (11, "AB " * 40), (12, "ab " * 5), (13, "ghost words here"), (14, "café naïve"), (4, BASE), (None, BASE),
        (15, D.sentences(9, 20000) + " " + BASE)]


@pytest.mark.parametrize("block_words", [100_000, 20])
def test_hits_equal_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)  # 20: many automata, one after the other
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.matched(D.frame(spark, DOCS), items).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got], key=key) == sorted(brute(DOCS, ITEMS), key=key)
    for r in got:
        assert sum(s.words for s in r.hit_spans) == r.n_hit


def test_cleaned_keeps_columns_and_cuts_spans(spark):
    docs = D.frame(spark, [(5, DOCS[4][1], "en", "s", 3), (4, BASE, "en", "s", 3), (2, None, None, None, None)]).selectExpr("*", "'old' as extra")
    got = {r.doc_id: r for r in decontaminate.cleaned(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}
    assert set(got) == {5, 2} and got[5].extra == "old" and got[2].text is None
    kept = words(got[5].text)
    assert not brute([(5, got[5].text)], ITEMS)[0][2] and len(kept) == 600


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = D.frame(spark, [(1, "a b")]).selectExpr("*", "'x' as n_hit", "1 as contaminated")
    r = decontaminate.matched(docs, none).collect()[0]
    assert (r.n_words, r.n_hit, r.contaminated) == (2, 0, False)
    assert decontaminate.matched(D.frame(spark, [(1, "a")]).limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_query_digest(spark):
    rows = queries.QUERIES["op1_benchmark_decontamination"](spark, D.SMALL).collect()
    docs = spark.read.parquet(f"{D.SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{D.SMALL}/benchmark.parquet").collect()
    want = {r[0]: r for r in brute([tuple(d) for d in docs], [tuple(i) for i in items])}
    assert len(rows) == len(docs)
    for r in rows:
        w = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (w[1], w[2], len(w[3]), w[4])
        assert r.items_sha256 == hashlib.sha256(",".join(w[3]).encode()).hexdigest()
