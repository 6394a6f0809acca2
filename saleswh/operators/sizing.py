"""Broadcast only behind a proven size bound.

``small(df, max_rows)`` measures a side with one aggregate (rows, and bytes of
its values; every task sends one row) and adds a broadcast hint only within
both bounds.  Otherwise the plain frame is returned and the planner/AQE keeps
a shuffle join.  The sides are key and attribute columns of committed
dimensions, so the pass reads a pruned parquet table.

``light(df)`` is for a side that grows with the input: it also bounds what the
driver holds while it builds the relation, by a share of the driver's own heap.

``frequent(df, n)`` is for a side whose rows say how often they will be
looked up: where not all fit, those looked up most are broadcast, and only
look-ups of the others need a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most rows and bytes that may be replicated to every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20
# Most rows of one key that a task may get by itself.
KEY_ROWS = 100_000
# A relation may take one part in so many of the driver's heap.
HEAP_PART = 16


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row's values (8 for each that is no text or binary)."""
    size = F.lit(0)
    for f in df.schema:
        wide = isinstance(f.dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if wide else F.lit(8))
    return size


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of all values."""
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first())


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def hottest(df: DataFrame, keys: list[str]) -> int:
    """Rows of the most frequent key (NULL is one): counts by key, of which one number comes back."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the frame is within both bounds, else unchanged."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def relation_bytes(rows: int, size: int) -> int:
    """About what the hashed relation of a broadcast side takes: values twice (key and row), and a row's share of the map."""
    return rows * 64 + 2 * size


def driver_share(spark: SparkSession, part: int = HEAP_PART) -> int:
    """Bytes of a relation that the driver may build: it holds the collected rows and the sent blocks as well."""
    return spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() // part


def light(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether a side is within both bounds, and its relation within the driver's share."""
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes and relation_bytes(rows, size) <= driver_share(df.sparkSession)


def frequent(df: DataFrame, n: str, max_rows: int | None = None, max_bytes: int | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """(often, seldom): the rows of largest ``n`` with a broadcast hint, as many powers of two of ``n`` as are within both
    bounds, and the other rows; None for a side without any.  ``n``: a positive whole number, dropped from both."""
    rows_left = DEFAULT_BROADCAST_ROWS if max_rows is None else max_rows
    bytes_left = DEFAULT_BROADCAST_BYTES if max_bytes is None else max_bytes
    rest, bits = df.drop(n), F.length(F.bin(n))
    sizes = df.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("rows"), F.sum(_bytes(rest)).alias("size"))  # 63 rows at most
    cut = 64
    levels = sorted(sizes.collect(), reverse=True)
    for r in levels:
        rows_left, bytes_left = rows_left - r["rows"], bytes_left - r["size"]
        if rows_left < 0 or bytes_left < 0:
            break
        cut = r["bits"]
    if not levels or cut == levels[-1]["bits"]:
        return F.broadcast(rest), None
    if cut == 64:
        return None, rest
    return F.broadcast(df.where(bits >= cut).drop(n)), df.where(bits < cut).drop(n)
