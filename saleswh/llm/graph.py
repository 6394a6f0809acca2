"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.tables import replaced, written


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): ``m`` the smallest of ``u`` and all its ``v``; a busy ``u`` is aggregated before its shuffle."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; ``u`` > ``v`` in every edge."""
    s = _smallest(edges)
    return s.select(F.col("v").alias("u"), F.col("m").alias("v")).union(s.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def reachable_minimum(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component; ``edges``: (u, v), either way round.

    Each round is written to the shared folder and takes the place of the last,
    so plans stay short; the driver sees a count and a checksum of the edges only.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges, before = written(edges, "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).collect()[0]
        if now[0] == 0 or now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        edges = replaced(edges, _small_star(_large_star(edges)), "edges")
