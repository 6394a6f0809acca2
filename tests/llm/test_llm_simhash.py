import random

import llm_data as D
import xxhash
from pyspark.sql import functions as F

from saleswh.llm import graph, queries, simhash


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_equal_brute_force(spark):
    base = D.sentences(1, 300)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One  TWO"), (7, base), (8, base.upper()), (9, base + " extra"),
            (10, base + " extra more"), (11, D.sentences(2, 200)), (12, D.sentences(3, 20000)), (7, base), (None, base), (13, "é è É")]
    rows += [(100 + i, base.replace(f"w{i}", f"v{i}")) for i in range(20)]
    got = simhash.components(D.frame(spark, rows).selectExpr("*", "1 as bits", "2 as component_id")).collect()
    assert len(got) == len(rows)
    bits = {r[0]: fingerprint(r[1]) for r in rows}
    for r in got:
        assert r.bits & (2**64 - 1) == bits[r.doc_id]
    ids = [i for i in bits if i is not None]
    edges = [(a, b) for a in ids for b in ids if a < b and (bits[a] ^ bits[b]).bit_count() <= 3]
    want = roots(ids, edges)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert {r.component_id for r in got if r.doc_id is None} == {want[7]}


def test_links_of_crowded_keys_lose_nothing(spark, monkeypatch):
    rng = random.Random(5)
    centre = [rng.getrandbits(64) for _ in range(3)]
    bits = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centre for _ in range(120)}
    frame = spark.createDataFrame([(simhash._signed(b),) for b in bits], "bits long")
    want = {tuple(sorted((simhash._signed(a), simhash._signed(b)))) for a in bits for b in bits if a != b and (a ^ b).bit_count() <= 3}
    for crowded in (256, 4):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        got = [tuple(r) for r in simhash.links(frame).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_reachable_minimum(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(140)] + [(i, i + 1) for i in range(300, 340)] + [(400, i) for i in range(401, 450)]
    got = dict(map(tuple, graph.reachable_minimum(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = roots({n for e in edges for n in e}, edges)
    assert got == {n: r for n, r in want.items() if n != r}
    assert graph.reachable_minimum(spark.createDataFrame([], "u long, v long")).count() == 0


def test_representatives(spark):
    a, b = D.sentences(1, 100), D.sentences(2, 100)
    docs = D.frame(spark, [(3, a), (1, a), (2, b), (9, a + " x"), (4, None)]).selectExpr("*", "7 as component_id")
    got = {r.doc_id: r for r in simhash.representatives(docs).collect()}
    assert {1, 2, 4} <= set(got) and 3 not in got and got[1].component_id == 7
    assert simhash.representatives(docs.limit(0)).count() == 0


def test_query_digest(spark):
    got = queries.QUERIES["op4_simhash_near_dedup"](spark, D.SMALL)
    docs = spark.read.parquet(f"{D.SMALL}/documents.parquet")
    assert got.count() == docs.count() and got.where(F.length("fingerprint") != 16).count() == 0
    for r in got.join(docs, "doc_id").limit(50).collect():
        assert r.fingerprint == f"{fingerprint(r.text):016x}"


def test_rows_without_id_link_groups(spark, monkeypatch):
    rows = [(5, 0), (None, 0b111), (2, 0b111111), (None, 0b111111111), (None, 1 << 40 | 1 << 50 | 1 << 60 | 1 << 20), (8, -1)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: spark.createDataFrame(rows, "doc_id long, bits long"))
    got = {r.bits: r.component_id for r in simhash.components(D.frame(spark, [(1, "x")])).collect()}
    assert got == {0: 2, 0b111: 2, 0b111111: 2, 0b111111111: 2, rows[4][1]: None, -1: 8}


def test_one_row_of_each_group_without_ids(spark):
    a, b, c = (D.sentences(i, 100) for i in (1, 2, 3))
    docs = D.frame(spark, [(3, a), (3, a), (None, a), (None, b), (None, b), (None, b.upper()), (None, c)])
    got = [(r.doc_id, r.text) for r in simhash.representatives(docs).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (3, a), (None, b.upper()), (None, c)], key=str)
