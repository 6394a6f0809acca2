"""Window, merge and SCD operators on literal rows (NULLs, ties, identical copies)."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleswh.operators import merge, windows


def test_latest_desc_nulls_last_and_total_tiebreak(spark):
    rows = [("k", None, "z"), ("k", dt.datetime(2020, 1, 1), "a"), ("k", dt.datetime(2020, 1, 1), "b"),
            ("j", None, "q")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v string")
    out = {r.k: (r.ts, r.v) for r in windows.latest(df, ["k"], ["ts"]).collect()}
    assert out["k"] == (dt.datetime(2020, 1, 1), "b")
    assert out["j"] == (None, "q")


def test_duplicates_matches_row_number(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("c", None, "n"), ("c", None, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = sorted(tuple(r) for r in windows.duplicates(df, ["k"], ["t"]).collect())
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), F.col("v").asc_nulls_first())
    ref = (df.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("k")))
             .withColumn("rn", F.row_number().over(w)).where("c > 1 AND rn > 1").drop("c", "rn"))
    assert got == sorted(tuple(r) for r in ref.collect())
    assert len(got) == 3


def test_surrogate_is_dense_global_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    out = windows.surrogate(df, ["k"], "sk", start=10, partitions=7)
    rows = sorted((r.k, r.sk) for r in out.collect())
    assert [sk for _, sk in rows] == list(range(11, 5011))


def test_merge_upsert_full_and_partial(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, x string, y int")
    src = spark.createDataFrame([(2, "B", 21), (3, "c", 30), (None, "m", 1)], "k int, x string, y int")
    full = sorted(merge.merge_upsert(tgt, src, ["k"]).collect(), key=str)
    assert sorted(map(tuple, full), key=str) == sorted(
        [(1, "a", 10), (2, "B", 21), (3, "c", 30), (None, "n", 0), (None, "m", 1)], key=str)
    part = merge.merge_upsert(tgt, src, ["k"], update=["y"]).collect()
    assert (2, "b", 21) in [tuple(r) for r in part]
    # idempotent for non-NULL keys (a NULL key never matches, as in SQL MERGE)
    src_nn = src.where("k IS NOT NULL")
    once = merge.merge_upsert(tgt, src_nn, ["k"], update=["y"])
    twice = merge.merge_upsert(once, src_nn, ["k"], update=["y"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_merge_insert_never_touches_existing(spark):
    tgt = spark.createDataFrame([(1, "old")], "k int, v string")
    src = spark.createDataFrame([(1, "new"), (2, "two")], "k int, v string")
    assert sorted(map(tuple, merge.merge_insert(tgt, src, ["k"]).collect())) == [(1, "old"), (2, "two")]


def _dim(spark):
    return spark.createDataFrame(
        [(1, "A", "g1", dt.datetime(2020, 1, 1), None, True),
         (2, "B", "g2", dt.datetime(2020, 1, 1), None, True)],
        "sk bigint, key string, attr string, ValidFrom timestamp, ValidTo timestamp, IsCurrent boolean")


def test_scd2_close_only(spark):
    src = spark.createDataFrame([("A", "g1"), ("B", "g9"), ("C", "g3")], "key string, attr string")
    out = merge.scd2(_dim(spark), src, "key", ["attr"], "2021-01-01 00:00:00", mode="close_only",
                     open_end=None, sk="sk")
    rows = {(r.key, r.attr): r for r in out.collect()}
    assert rows[("B", "g2")].IsCurrent is False and rows[("B", "g2")].ValidTo == dt.datetime(2021, 1, 1)
    assert ("B", "g9") not in rows            # not re-inserted in the same run
    assert rows[("C", "g3")].sk == 3 and rows[("C", "g3")].IsCurrent
    assert rows[("A", "g1")].IsCurrent


def test_scd2_close_and_insert(spark):
    src = spark.createDataFrame([("A", "g1"), ("B", "g9"), ("C", "g3")], "key string, attr string")
    out = merge.scd2(_dim(spark), src, "key", ["attr"], "2021-01-01 00:00:00", mode="close_and_insert",
                     open_end=None, sk="sk")
    rows = {(r.key, r.attr): r for r in out.collect()}
    assert rows[("B", "g9")].IsCurrent and rows[("B", "g9")].sk == 3   # rank by key among new rows
    assert rows[("C", "g3")].sk == 4
    assert out.where("IsCurrent").groupBy("key").count().where("count > 1").count() == 0


def test_merge_quarantine_idempotent(spark):
    schema = ("QuarantineKey string, SourceEntity string, RecordIdentifier string, FailedRule string, "
              "FailureSeverity string, RawRecord string, IngestionTimestamp timestamp")
    empty = spark.createDataFrame([], schema)
    src = spark.createDataFrame([(None, "E", "1", "R", "HARD", '{"a":1}', dt.datetime(2021, 1, 1))], schema)
    once = merge.merge_quarantine(empty, src)
    src2 = src.withColumn("IngestionTimestamp", F.lit(dt.datetime(2021, 2, 1)))
    twice = merge.merge_quarantine(once, src2).collect()
    assert len(twice) == 1 and twice[0].IngestionTimestamp == dt.datetime(2021, 2, 1)
    assert twice[0].QuarantineKey is not None


def test_check_constraints(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "x", 9), (2, "y", 7)], "k int, v string, fk int")
    parent = spark.createDataFrame([(5,), (7,)], "id int")
    out = {(r.kind, r.record_key): r.n for r in
           merge.check_constraints(df, "T", pk=["k"], not_null=["v"], fks=[("fk", parent, "id")]).collect()}
    assert out == {("NOT_NULL", None): 1, ("PRIMARY_KEY", "1"): 2, ("FOREIGN_KEY", "9"): 1}
