"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from saleswh.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"


def brute(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    found = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = {}
    for (lang, p), a in found.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for (x, q), b in found.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def mined(spark, rows, **how):
    frame = spark.createDataFrame([(i, t, lang, "x", 1) for i, (lang, t) in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in C.collocations(frame, **how).collect())


def prose(n, seed, langs=("en", "de", None)):
    g = random.Random(seed)
    vocabulary = ["The", "of", "a", "é", "x\x01y", "straße", "İi", "new", "york", "times", "in", "to"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(g.randrange(80)):
            words += g.choice([["new", "York", "Times"], ["of", "the"], [g.choice(vocabulary)], [g.choice(vocabulary) + g.choice(".,;:!?\n\t\r\x0b\x0c")]])
        rows.append((g.choice(langs), " ".join(words)))
    return rows + [(None, None), ("en", ""), ("und", " . \t"), ("fr", "one word")]


def test_equal_to_a_plain_count(spark):
    rows = prose(400, 1)
    want = brute(rows, least=8)
    assert len({r[0] for r in want}) == 3 and len(want) > 100
    assert mined(spark, rows, least=8) == want


def test_spills_bursts_cuts_and_common_prefixes_change_nothing(spark, monkeypatch):
    for name, value in {"PARTITION_BYTES": 2000, "HOT": 8, "FILTER_BITS": 1 << 9, "BLOCK_BITS": 1 << 7}.items():
        monkeypatch.setattr(C, name, value)
    rows = prose(150, 2) + [("en", " ".join(["new york times."] * 400)), ("en", "the of " * 300)]
    small = C.Limits(burst=3, held=40, merged=5, slice_bytes=300)
    assert mined(spark, rows, least=6, limits=small) == brute(rows, least=6)


def test_first_phrases_only_with_ties(spark):
    rows = [("en", f"{a}{b} z{a}{b}.") for a in "cab" for b in "fed"] * 5
    want = brute(rows, least=5, top=4)
    assert len(want) == 4 and want[0][2] == "ad zad"
    assert mined(spark, rows, least=5, top=4) == want


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "")], [("en", "a b c d")]])
def test_nothing_to_find(spark, rows):
    assert mined(spark, rows) == []


def test_merging_sorted_runs():
    runs = [(pa.array(sorted(p), pa.large_binary()), __import__("numpy").arange(len(p))) for p in ([b"a", b"c", b"d"], [b"b", b"c"], [])]
    out = [(r["phrase"], r["f"]) for t in C.merged(runs, 1) for r in t.to_pylist()]
    assert sorted(out) == [(b"a", 0), (b"b", 0), (b"c", 2), (b"d", 2)]


def test_blocks_follow_the_rows_and_not_the_runs():
    g = random.Random(3)
    lists = [sorted(g.sample(range(900), g.randrange(1, 12))) for _ in range(400)] + [[7]] * 300
    runs = [(pa.array([b"%03d" % x for x in p], pa.large_binary()), __import__("numpy").full(len(p), 2)) for p in lists]
    rows = sum(map(len, lists))
    blocks = list(C.merged(runs, 1000))
    assert len(blocks) <= 2 * rows // 1000 + 1
    out = [(r["phrase"], r["f"]) for t in blocks for r in t.to_pylist()]
    assert sorted(out) == sorted((b"%03d" % x, 2 * n) for x, n in Counter(x for p in lists for x in p).items())
    assert list(C.merged([], 10)) == []
