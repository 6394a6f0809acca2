"""Nearest neighbours against a comparison of all rows with all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswh.llm import neighbours
from saleswh.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, score string, leaf int"


def product(a, b):
    """In order of the components; ``sum`` would correct its rounding."""
    out = 0.0
    for x, y in zip(a, b):  # noqa: B905
        out += x * y
    return out


def brute(rows, k):
    """(query_id, rank, vec_id, score) of the definition, for rows that take part; a list for each query row."""
    rows = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (q, a) in enumerate(rows):
        if q % 20 == 0:
            scored = sorted((-product(a, b), i) for m, (i, b) in enumerate(rows) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, **how):
    frame = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, **how).collect())


def clustered(n, d, seed):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(8, d)) * 3
    return [(i, (centres[g.integers(8)] + g.normal(size=d)).round(3).tolist()) for i in range(n)]


def test_factor_one_is_exact_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 60)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    monkeypatch.setattr(neighbours, "BUCKET", 8)
    rows = clustered(700, 6, 1)
    assert found(spark, rows, k=9, factor=1.0) == brute(rows, 9)


def test_copies_ties_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 30)
    rows = [(i, [1.0, 2.0]) for i in range(0, 130)] + [(200, [2.0, 4.0]), (220, [1.0]), (240, [-1.0, -0.0]), (201, [1.0, 0.0])]
    rows += [(300, None), (320, []), (340, [0.0, 0.0]), (360, [1.0, None]), (380, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (None, [9.0, 9.0])]
    rows += [(20, [1.0, 2.0]), (40, [5.0, -1.0])]  # repeated ids, with the same vector and another
    assert found(spark, rows, k=5, factor=1.0) == brute(rows, 5)


@pytest.mark.parametrize("rows", [[], [(20, None)], [(20, [1.0, 1.0])]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == []


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 3.0]), (2, [-4.0, 0.0])]
    assert found(spark, rows) == brute(rows, 20)


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    t = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").toArrow()
    x = np.array(t["embedding"].combine_chunks().flatten(), np.float64).reshape(len(t), -1)
    ids, got = t["vec_id"].to_numpy(), {}
    for r in QUERIES["op11_nearest_neighbours"](spark, folder).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = neighbours.products(np.broadcast_to(x[q], x.shape), x)
        s[q] = -np.inf
        hits.append(len({i for _, i in got[ids[q]]} & set(ids[np.lexsort((ids, -s))[:20]].tolist())))
        assert [r for r, _ in sorted(got[ids[q]])] == list(range(1, 21))
    assert np.mean(hits) / 20 >= 0.97
