"""Nearest neighbours by inner product, with a vantage-point tree in every shard.

Inner products become distances by one lift: with ``M`` the largest norm, a
vector ``x`` is the unit point (x / M, sqrt(1 - |x|² / M²)) and a query ``q``
the unit point (q / |q|, 0); their squared distance is 2 - 2 x·q / (M |q|), so
the nearest points are those of the largest inner product, and the triangle
inequality holds.

1. A coarse vantage-point tree over a bounded sample (``SAMPLE`` rows a leaf,
   at most ``LEAVES`` leaves) routes every row to one leaf.  A leaf of over
   ``SHARD_ROWS`` rows is dealt to several shards by row.
2. Each distinct query vector is searched in the shards of its own leaf: a
   vantage-point tree of the shard is built in the task and walked by all
   queries at once, the nearer child first.
3. With the distance ``t`` of its k-th neighbour so far, a query goes on to
   the leaves that the triangle inequality can't rule out, and is searched in
   their shards.  The best of all shards are its result.

A branch is skipped if it lies beyond a vantage point's radius by ``gap`` and
``gap * factor > t``.  With ``factor`` 1 no neighbour can be missed, a larger
one skips more and may miss some.  Trees only choose what is compared: scores
are sums of products of the original vectors in double precision, in order of
the components, and ties go to the smaller ``vec_id``.

Scale: only the sample's vantage points and a row count a leaf reach the
driver (bounded by ``LEAVES``).  A task holds one shard and at most
``QUERY_ROWS`` queries.  Copies of a query vector are searched once, copies in
a shard cost one comparison, and a leaf with a third of all rows is as many
shards as it needs.  How many leaves a query visits depends on the data: where
distances hardly differ (random vectors of many dimensions) nothing can be
ruled out at factor 1 and the search compares all with all, in blocks.

Defined results: vectors that are null, empty or zero, or hold null, NaN or
infinite components, and rows without ``vec_id``, take no part.  Shorter
vectors count as padded with zeros.  Every row is a candidate, repeated ones
too; a query leaves out just its own row, so rows that share a ``vec_id`` find
each other, and each such query row has its own list.  Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.tables import written

NEAREST, FACTOR = 20, 3.0
#: Rows of a shard, queries of a task, rows of a leaf of the tree in a shard, leaves of the coarse tree and its sample's rows for each.
SHARD_ROWS, QUERY_ROWS, BUCKET, LEAVES, SAMPLE = 2048, 8192, 64, 1024, 16
#: Rounding of distances, far above what double precision loses.
SLACK = 1e-6


@dataclass
class Node:
    """A vantage point with the radius that divides its points, or a leaf (``inner`` is None) with the rows it holds."""

    point: np.ndarray
    radius: float = 0.0
    inner: Node | None = None
    outer: Node | None = None
    rows: np.ndarray | None = None
    leaf: int = 0


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (points @ to)))


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """Unit points of candidates; ``most`` is the largest norm."""
    v = vectors / most
    return np.column_stack([v, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", v, v)))])


def aimed(vectors: np.ndarray) -> np.ndarray:
    """Unit points of queries."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    v = v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return np.column_stack([v, np.zeros(len(v))])


def grown(points: np.ndarray, bucket: int) -> tuple[Node, int]:
    """The vantage-point tree of ``points`` and the number of its leaves.

    The next vantage point is the one farthest from the last: it divides
    points better than one in their midst.  Points that are all equally far
    stay in one leaf.
    """
    leaves = 0

    def grow(rows: np.ndarray, far: int) -> Node:
        nonlocal leaves
        if len(rows) > bucket:
            d = distances(points[rows], points[far])
            radius = float(np.median(d))
            near = d < radius
            if near.any():
                inner, outer = rows[near], rows[~near]
                return Node(points[far], radius, grow(inner, int(rows[np.argmax(d)])), grow(outer, int(outer[0])))
        leaves += 1
        return Node(points[far], rows=rows, leaf=leaves - 1)

    return grow(np.arange(len(points)), 0), leaves


def homes(tree: Node, points: np.ndarray) -> np.ndarray:
    """The leaf of each point."""
    out = np.zeros(len(points), np.int32)

    def walk(node: Node, rows: np.ndarray) -> None:
        if node.inner is None:
            out[rows] = node.leaf
        elif len(rows):
            near = distances(points[rows], node.point) < node.radius
            walk(node.inner, rows[near])
            walk(node.outer, rows[~near])

    walk(tree, np.arange(len(points)))
    return out


def reached(tree: Node, points: np.ndarray, within: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) for each leaf that may hold something within a query's distance."""
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int32))]

    def walk(node: Node, rows: np.ndarray) -> None:
        if node.inner is None:
            found.append((rows, np.full(len(rows), node.leaf, np.int32)))
        elif len(rows):
            gap = distances(points[rows], node.point) - node.radius
            walk(node.inner, rows[gap * factor <= within[rows] + SLACK])
            walk(node.outer, rows[-gap * factor <= within[rows] + SLACK])

    walk(tree, np.arange(len(points)))
    return np.concatenate([q for q, _ in found]), np.concatenate([leaf for _, leaf in found])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in order of the components, so equal vectors have equal products."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


class Best:
    """The ``k`` best (score, vec_id) of each query: the larger score first, then the smaller ``vec_id``."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score, self.id = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``rows`` ascending, a query as often as it has candidates."""
        own, counts = np.unique(rows, return_counts=True)
        width = self.k + int(counts.max(initial=0))
        s, i = np.full((len(own), width), -np.inf), np.full((len(own), width), np.iinfo(np.int64).max)
        s[:, :self.k], i[:, :self.k] = self.score[own], self.id[own]
        at = np.repeat(np.arange(len(own)), counts)
        place = self.k + np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        s[at, place], i[at, place] = score, ids
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[own], self.id[own] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def found_in(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, within: np.ndarray, most: float, k: int, factor: float) -> Best:
    """The best ``k`` of a shard's rows for each query, as far as they may be within the query's distance."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    _, first, kind = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
    copies = np.argsort(kind, kind="stable")  # of each different vector, its ids in ascending order
    ends = np.cumsum(np.bincount(kind, minlength=len(first)))
    starts = np.concatenate([[0], ends[:-1]])
    different = vectors[first]
    points, aims = lifted(different, most), aimed(queries)
    reach = np.linalg.norm(queries, axis=1) * most
    best, limit = Best(len(queries), k), within.astype(float).copy()
    tree, _ = grown(points, BUCKET)

    def compare(rows: np.ndarray, held: np.ndarray) -> None:
        close = 1.0 - limit[rows] ** 2 / 2  # the cosine at the limit; -inf where there is none yet
        q, p = np.nonzero(aims[rows] @ points[held].T >= close[:, None] - SLACK)
        if not len(q):
            return
        score = products(queries[rows[q]], different[held[p]])
        n = np.minimum(ends[held[p]] - starts[held[p]], k)
        pick = np.repeat(starts[held[p]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        best.add(np.repeat(rows[q], n), np.repeat(score, n), ids[copies[pick]])
        last = best.score[rows, -1]
        full = np.isfinite(last)
        limit[rows[full]] = np.minimum(limit[rows[full]], np.sqrt(np.maximum(0.0, 2.0 - 2.0 * last[full] / reach[rows[full]])))

    def walk(node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.inner is None:
            return compare(rows, node.rows)
        gap = distances(aims[rows], node.point) - node.radius
        for child, sign in ((node.inner, 1.0), (node.outer, -1.0)):  # each child first by those that are in it
            mine = sign * gap < 0 if sign > 0 else gap >= 0
            walk(child, rows[mine])
        for child, sign in ((node.outer, -1.0), (node.inner, 1.0)):
            others = gap < 0 if sign < 0 else gap >= 0
            walk(child, rows[others & (sign * gap * factor <= limit[rows] + SLACK)])

    walk(tree, np.arange(len(queries)))
    return best


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1), np.float64) if len(column) else np.zeros((0, 1))


def _meet(rows: DataFrame, queries: DataFrame, most: float, k: int, factor: float) -> DataFrame:
    """(_q, found) for each query and each shard of its leaf; ``queries``: (_q, vec, within, leaf)."""
    size = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    share = queries.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("shares"))
    dealt = F.broadcast(written(size.join(share, "leaf"), "vp-dealt"))  # a row for each leaf: at most LEAVES
    left = rows.join(dealt, "leaf").select("vec_id", "vec", "leaf", F.pmod(F.xxhash64("vec_id", "vec"), "shards").cast("int").alias("shard"),
                                           F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    right = queries.join(dealt, "leaf").select("_q", F.col("vec").alias("query"), "within", "leaf", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                                               F.pmod("_q", "shares").cast("int").alias("share"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"_q": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        best = found_in(_matrix(a["vec"]), a["vec_id"].to_numpy(), _matrix(b["query"]), b["within"].to_numpy(), most, k, factor)
        there = np.isfinite(best.score) | (best.id < np.iinfo(np.int64).max)
        q = np.repeat(b["_q"].to_numpy(), there.sum(axis=1))
        return pa.table({"_q": q, "vec_id": best.id[there], "score": best.score[there]})

    keys = ["leaf", "shard", "share"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "_q long, vec_id long, score double")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """(_q, found): the best ``k`` of each query, best first."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("_q").orderBy(F.col("score").desc(), "vec_id")
    top = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return top.groupBy("_q").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST, factor: float = FACTOR) -> DataFrame:
    """The ``k`` nearest rows of each row that ``queries`` (a condition on ``vec_id``) chooses: query_id, rank, vec_id, score."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vec")).where(F.col("vec_id").isNotNull() & whole)
    peak = F.array_max(F.transform("vec", F.abs))
    norm = peak * F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + (x / peak) * (x / peak)))
    n, wide, most = valid.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(norm)).first()
    spark, empty = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    # -0.0 and 0.0 are one number, also as bytes
    padded = F.transform(F.concat("vec", F.array_repeat(F.lit(0.0), wide - F.size("vec"))), lambda x: x + F.lit(0.0))
    valid = valid.select("vec_id", padded.alias("vec"))

    leaves = min(LEAVES, 1 << max(0, math.ceil(math.log2(n / SHARD_ROWS))))
    drawn = valid.orderBy(F.xxhash64("vec_id", "vec")).limit(SAMPLE * leaves).select("vec").toArrow()
    sample = np.unique(lifted(_matrix(drawn["vec"]), most), axis=0)
    coarse, _ = grown(sample, max(1, len(sample) // leaves))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = homes(coarse, lifted(_matrix(b["vec"]), most))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=[*b.schema.names, "leaf"])

    rows = written(valid.mapInArrow(place, "vec_id long, vec array<double>, leaf int"), "vp-rows")
    asked = rows.where(queries)
    kinds = written(asked.groupBy("vec").agg(F.min("leaf").alias("home")).withColumn("_q", F.monotonically_increasing_id()), "vp-queries")
    # one more than asked for: each row leaves out itself
    start = kinds.select("_q", "vec", F.lit(float("inf")).alias("within"), F.col("home").alias("leaf"))
    first = written(_meet(rows, start, most, k + 1, factor), "vp-found")
    limits = _merged(first, k + 1).select("_q", F.when(F.size("found") > k, F.element_at("found", k + 1)["score"]).alias("least"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec, least = _matrix(b["vec"]), b["least"].to_numpy(zero_copy_only=False).astype(float)
            cosine = least / (np.linalg.norm(vec, axis=1) * most)
            within = np.where(np.isnan(cosine), np.inf, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.nan_to_num(cosine))))
            q, leaf = reached(coarse, aimed(vec), within, factor)
            more = leaf != b["home"].to_numpy()[q]
            q, leaf = q[more], leaf[more]
            yield pa.RecordBatch.from_arrays([b["_q"].take(pa.array(q)), b["vec"].take(pa.array(q)), pa.array(within[q]), pa.array(leaf)], names=["_q", "vec", "within", "leaf"])

    routed = kinds.join(limits, "_q", "left").select("_q", "vec", "home", "least").mapInArrow(route, "_q long, vec array<double>, within double, leaf int")
    found = first.union(_meet(rows, written(routed, "vp-routed"), most, k + 1, factor))
    best = kinds.join(_merged(found, k + 1), "_q").select(F.col("vec").alias("query"), F.transform("found", lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("found"))
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    own = asked.select(F.col("vec_id").alias("query_id"), "vec", F.struct("vec_id", square.alias("score")).alias("own"))
    listed = own.join(best, F.col("vec") == F.col("query")).withColumn("at", F.array_position("found", F.col("own")))
    others = F.slice(F.filter("found", lambda x, i: i + 1 != F.col("at")), 1, k)
    return listed.select("query_id", F.posexplode(others).alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
