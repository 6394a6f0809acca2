import hashlib

import llm_data as D
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from saleswh.llm import queries, substrings
from saleswh.llm import words as W


def brute(rows):
    """(doc_id, words, hits) by the definition."""
    first, out = {}, []
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - 12):
                x = tuple(w[k:k + 13])
                first[x] = min(first.get(x, i), i)
    for i, w in split:
        hit = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                hit[k:k + 13] = [True] * 13
        out.append((i, w, hit))
    return out


def rows():
    a, b, c = D.sentences(1, 80), D.sentences(2, 60), D.sentences(3, 40)
    return [(5, a), (2, b), (9, f"{a} {b}"), (7, " ".join(a.split()[10:40]) + " " + " ".join(b.split()[5:30])), (1, None), (3, ""), (4, "short text"),
            (11, a.upper()), (12, "\n".join(a.split())), (13, " ".join(["a"] * 50)), (14, " ".join(["a"] * 30)), (15, c + " " + c), (5, a), (None, a),
            (20, D.sentences(4, 20000) + " " + c), (21, " ".join(a.split()[:13])), (22, " ".join(a.split()[:12])),
            # windows of one document known from different smaller documents, and across a factor's end
            (30, " ".join(a.split()[30:50] + b.split()[:20])), (31, " ".join(a.split()[40:50] + b.split()[:30])), (32, " ".join(a.split()[20:50] + b.split()[:40]))]


def test_removed_words_equal_brute_force(spark):
    docs = D.frame(spark, rows()).selectExpr("*", "'x' as n_words", "doc_id as other")
    got = substrings.deduplicated(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    have = sorted([(r.doc_id, (r.text or "").encode().split(), r.n_words, sum(s.words for s in r.word_spans)) for r in got], key=key)
    want = sorted([(i, [x for x, h in zip(w, hit) if not h], len(w), sum(hit)) for i, w, hit in brute(rows())], key=key)
    assert have == want
    assert all(r.other == r.doc_id for r in got)
    assert [r.text for r in got if r.doc_id == 1] == [None]
    assert substrings.deduplicated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("busy", [32, 0])
def test_blocks_and_busy_anchors(monkeypatch, busy):
    """All steps in one process, with a chunk for each document; busy 0 routes every shared window singly."""
    monkeypatch.setattr(substrings, "BUSY_CHUNKS", busy)
    table = pa.table({"doc_id": pa.array([r[0] for r in rows()], pa.int64()), "text": pa.array([r[1] for r in rows()], pa.string())})
    chunks = [pa.table({"chunk": [i], "blob": pa.array([substrings._pack(table.slice(i, 1).combine_chunks(), 1)], pa.binary())}) for i in range(len(table))]
    anchors = pa.Table.from_batches([b for c in chunks for b in substrings._anchors(5)(c.to_batches())])
    shared = pa.concat_tables([substrings._shared(anchors.filter(pc.equal(anchors["block"], k)).combine_chunks()) for k in range(5)])
    segments = pa.concat_tables([substrings._segments(5)(c, shared.filter(pc.equal(shared["chunk"], i)).combine_chunks()) for i, c in enumerate(chunks)])
    factors = pa.concat_tables([substrings._parse(segments.filter(pc.equal(segments["block"], k)).combine_chunks())
                                for k in range(5) if pc.any(pc.equal(segments["block"], k)).as_py()])
    out = pa.concat_tables([substrings._clean(c, factors.filter(pc.equal(factors["chunk"], i)).combine_chunks()) for i, c in enumerate(chunks)])
    for (_, w, hit), text in zip(brute(rows()), out["text"].to_pylist(), strict=True):
        assert (text or "").encode().split() == [x for x, h in zip(w, hit) if not h]


def test_greedy_factors():
    ref = [b"%d" % i for i in range(40)]
    index = {tuple(ref[i:i + 13]): (0, i) for i in range(28)}
    text = [b"x"] + ref[3:20] + [b"y"] + ref[:13]
    assert substrings.factor(text, index, [ref]) == [(1, 17, 0), (19, 13, 0)]


def test_text_without_words_keeps_the_rest():
    column = pa.array(["a  b\nc d", None, "", "é x"])
    w = W.split(column, W.NOT_SPACE)
    import numpy as np
    hit = np.array([False, True, False, False, True, False])
    assert W.without(column, hit, w, W.NOT_SPACE).to_pylist() == ["a  c d", None, "", "x"]


def test_query_digest(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_substring_dedup"](spark, D.SMALL).collect()}
    docs = spark.read.parquet(f"{D.SMALL}/documents.parquet").select("doc_id", "text").collect()
    for i, w, hit in brute([tuple(d) for d in docs]):
        kept = b" ".join(x for x, h in zip(w, hit) if not h)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(hit), hashlib.sha256(kept).hexdigest())
