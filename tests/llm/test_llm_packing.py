import zlib

import llm_data as D
import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleswh.llm import packing, queries
from saleswh.llm import words as W

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'st \n\t.,!é×à　\x85\xa0\u2003\x1c1中😀ñD-_<|>")), max_size=40), min_size=1, max_size=5))
def test_pieces_encode_like_whole_texts(texts):
    raw, at = W.text_bytes(pa.array(texts, pa.string()))
    cuts = packing.pieces(raw, at)
    w = W.Words(raw, cuts, np.searchsorted(cuts, at))
    codes, distinct = w.coded()
    encode = packing.encoder(PATH)
    begins, sizes = encode(W.items(distinct))
    for i, text in enumerate(texts):
        got = [x for c in codes[w.first[i]:w.first[i + 1]] for x in encode.pool[begins[c]:begins[c] + sizes[c]].tolist()]
        assert got == ids(text)[:-1]


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = packing.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, docs):
    """rows: pieces with their ids (little-endian, 32 bits)."""
    want = sorted((i is None, i or 0, ids(t)) for i, t in docs)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert sum(r.length for r in rows) == sum(len(x) for _, _, x in want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0
    return want, by


def test_round_trip(spark):
    docs = [(1, None), (2, ""), (3, " "), (4, "Hello, world's end"), (5, D.sentences(1, 20000)), (6, "<|endoftext|> x"), (7, "a\u00a0 b \u2003c")]
    docs += [(10 + i, D.sentences(i, 50 + 7 * i)) for i in range(40)]
    rows = packing.packed(D.frame(spark, docs).selectExpr("*", "1 as tokens", "2 as curve"), PATH).collect()
    _, by = check(rows, docs)
    for i, t in docs:
        at, got = 0, []
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids(t)) and len(r.ids) == 4 * r.length
            got += np.frombuffer(r.ids, "<u4").tolist()
            at += r.length
        assert got == ids(t)


def test_repeated_rows_and_empty_table(spark):
    docs = [(1, "same text"), (1, "same text"), (None, "x"), (None, "y")]
    check(packing.packed(D.frame(spark, docs), PATH).collect(), docs)
    assert packing.packed(D.frame(spark, docs).limit(0), PATH).count() == 0


def test_query_digest(spark):
    rows = queries.QUERIES["op7_packing"](spark, D.SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{D.SMALL}/documents.parquet").select("doc_id", "text").collect()]
    _, by = check(rows, docs)
    for i, t in docs[:100]:
        whole = np.array(ids(t), "<u4")
        for r in by[i]:
            assert r.ids_crc32 == zlib.crc32(whole[r.start:r.start + r.length].tobytes())
