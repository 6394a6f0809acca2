"""Window-family operators (W1-W5), written to survive skewed keys.

Design notes for scale:

* W1 ``latest`` is an aggregate (``max`` of a struct whose first fields are
  the ordering columns), not a ``row_number`` window: the partial
  aggregate collapses every key to one row per map task *before* the
  shuffle, so a key holding a third of all rows costs one row per task
  downstream instead of one giant sort in one task.
* W2 ``duplicates`` counts on the key columns alone, and looks at whole rows
  only of keys with several copies; the side with one row per key is what
  AQE's skew-join splitting needs.  Many such keys, none of them hot: a window.  W3 (order totals in ``plans/silver``) is
  ``groupBy + join`` for the same reason.
* W4 ``surrogate`` numbers rows by a global order without a single-task
  window: one range-partitioned copy in the shared folder, and per-partition
  offsets from that copy (one row per partition, counted once).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from saleswh.operators.commit import materialize
from saleswh.operators.sizing import DEFAULT_BROADCAST_ROWS, KEY_ROWS, fits, small


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest(df: DataFrame, keys, order: Sequence[str], tiebreak: Sequence[str] | None = None,
           ascending: bool = False, also: dict[str, Column] | None = None) -> DataFrame:
    """One row per key, the greatest by ``order`` (DESC NULLS LAST).

    ``tiebreak`` defaults to every remaining column, which makes the choice
    total: rows tied on all of them are identical, so any pick is the same.
    With ``ascending=True`` the smallest row wins (ASC NULLS FIRST order,
    i.e. min of the struct).  ``also``: columns that are aggregates over all
    rows of a key instead of the picked row's values.
    """
    keys = _names(keys)
    order = list(order)
    also = also or {}
    rest = [c for c in df.columns if c not in keys and c not in order and c not in also]
    tb = rest if tiebreak is None else [c for c in tiebreak if c not in keys and c not in order]
    tail = [c for c in rest if c not in tb]
    st = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order + tb)],
                  *[F.col(c) for c in tail])
    agg = F.min(st) if ascending else F.max(st)
    picked = df.groupBy(*keys).agg(agg.alias("_m"), *(a.alias(c) for c, a in also.items()))
    sel = [F.col(k) for k in [*keys, *also]]
    for i, c in enumerate(order + tb):
        sel.append(F.col(f"_m._o{i}").alias(c))
    sel += [F.col(f"_m.{c}").alias(c) for c in tail]
    return picked.select(*sel).select(*df.columns)


def duplicates(df: DataFrame, keys, order: Sequence[str], few: int = DEFAULT_BROADCAST_ROWS, hot: int = KEY_ROWS) -> DataFrame:
    """Every copy of a key beyond the first (first = smallest ``order``).

    Same result as ``COUNT(*) OVER k > 1 AND ROW_NUMBER() OVER (k ORDER BY
    order) > 1`` with a total tie-break over all columns; NULL keys are a
    group like any other, as in a window.  Keys are counted on their own
    columns; only rows of keys with several copies are looked at whole.  These
    are written with an id, so the first of identical copies is one row and
    not all of them; the first rows are a partial aggregate, and each copy is
    one joined row.  ``df`` is read twice: it should be a written table.

    Where the keys with several copies are more than ``few`` (they can't be
    broadcast) and none has more than ``hot``, both measured, all rows are
    dealt and sorted by key once instead: a window, in one shuffle.
    """
    keys = _names(keys)
    cols = df.columns
    ordered = list(order) + [c for c in cols if c not in keys and c not in order]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_n", *[F.col(k).alias(f"_k_{k}") for k in keys])
    counted = materialize(counted, "several")
    several = counted.drop("_n")
    if not fits(several, few) and counted.agg(F.max("_n")).first()[0] <= hot:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in ordered]))
        return df.withColumn("_place", place).where("_place > 1").select(*cols)
    several = small(several, few)

    def same(other: DataFrame, names: list[str]) -> Column:
        out = F.lit(True)
        for k, n in zip(keys, names, strict=True):
            out = out & F.col(k).eqNullSafe(other[n])
        return out

    copies = df.join(several, same(several, [f"_k_{k}" for k in keys]), "left_semi")
    copies = materialize(copies.withColumn("_rid", F.monotonically_increasing_id()), "copies")
    first = copies.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in ordered], F.col("_rid"))).alias("_first"))
    first = first.select(*[F.col(k).alias(f"_f_{k}") for k in keys], F.col("_first._rid").alias("_first"))
    return copies.join(first, same(first, [f"_f_{k}" for k in keys])).where(F.col("_rid") != F.col("_first")).select(*cols)


def surrogate(df: DataFrame, order: Sequence[str], name: str, start: int = 0,
              partitions: int | None = None) -> DataFrame:
    """Dense numbers ``start+1, start+2, ...`` in the global ``order``.

    The frame is range-partitioned once, and written once with its partition
    and its place in it; the counts and the rows both come from these files.
    (Two plans of one range exchange would each sample bounds of their own,
    and the offsets would belong to other partitions than the rows.)  The
    order is made total by all other sortable columns, so a row's number does
    not depend on how the frame was split.  The offsets have one row per
    partition, so they are broadcast without risk, and no task ever holds
    more than its own range.  What is returned is a scan of the written copy:
    it need not be written again to be read several times.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = list(order) + [f.name for f in df.schema if f.name not in order and not isinstance(f.dataType, (MapType, VariantType))]
    ranged = materialize(df.repartitionByRange(n, *total).sortWithinPartitions(*total)
                           .withColumn("_pid", F.spark_partition_id())
                           .withColumn("_mid", F.monotonically_increasing_id()), name)
    before, offsets = 0, []
    for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).orderBy("_pid").collect():  # a row for each partition
        offsets.append((r["_pid"], before))
        before += r["n"]
    offsets = spark.createDataFrame(offsets, "_pid int, _off bigint")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, (F.lit(start) + F.col("_off") + local + 1).cast("bigint"))
                  .drop("_pid", "_mid", "_off"))
