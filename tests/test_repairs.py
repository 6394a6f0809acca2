"""Keys on wide frames, replayed commits, DQ rules at scale, cleansing before dedup, whole text results."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.operators import commit, merge, sizing, windows
from saleswh.plans import analytics, dq_batch, silver
from saleswh.plans.warehouse import Warehouse
from saleswh.session import checkpoint_dir
from saleswh.sources import odata
from saleswh.streaming import runner


@pytest.mark.parametrize("sf,partitions", [("sf0.01", 4), ("sf0.01", 8), ("sf0.1", 200)])
def test_surrogate_on_wide_frames_is_dense(spark, sf, partitions):
    stg = Warehouse(spark, f"/root/testdata/{sf}").stg_materials
    keyed = windows.surrogate(stg, ["PRODUCT_ID"], "SK", partitions=partitions)
    n, distinct, low, high = keyed.agg(F.count("SK"), F.count_distinct("SK"), F.min("SK"), F.max("SK")).first()
    assert n == distinct == high == stg.count() and low == 1
    later = keyed.alias("b").join(keyed.alias("a"), F.col("b.SK") == F.col("a.SK") + 1).where("b.PRODUCT_ID < a.PRODUCT_ID")
    assert later.count() == 0


def test_assigned_keys_go_on_from_the_target(spark):
    tgt = spark.createDataFrame([(7, "a")], "sk long, k string")
    new = merge.assign_keys(spark.createDataFrame([("c",), ("b",)], "k string"), tgt, "sk", ["k"])
    assert sorted(map(tuple, new.select("sk", "k").collect())) == [(8, "b"), (9, "c")]
    assert sorted(r.sk for r in merge.assign_keys(new.select("k"), tgt.limit(0), "sk", ["k"]).collect()) == [1, 2]


def test_commit_stopped_before_publication_is_finished_by_its_replay(spark, scratch):
    commit.commit(spark.range(3), f"{scratch}/t", 0)
    spark.range(9).write.parquet(f"{scratch}/t/v=1")  # written, then stopped before its marker
    assert commit.read_table(spark, f"{scratch}/t").count() == 3
    assert commit.commit(spark.range(9), f"{scratch}/t", 1) is True
    assert commit.read_table(spark, f"{scratch}/t").count() == 9
    assert commit.commit(spark.range(5), f"{scratch}/t", 0) is False  # an old batch comes again
    assert commit.current_version(spark, f"{scratch}/t") == "v=1"
    for i in (2, 3, 4):
        commit.commit(spark.range(i), f"{scratch}/t", i)
    fs, path = commit.path_on(spark, f"{scratch}/t")
    assert sorted(s.getPath().getName() for s in fs.listStatus(path)) == ["_published", "v=3", "v=4"]


def test_materialized_tables_belong_to_the_application(spark):
    df = commit.materialize(spark.range(3), "x")
    assert spark.sparkContext.applicationId in df.inputFiles()[0] and df.count() == 3


def test_no_shared_folder_on_a_cluster_is_an_error():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert sizing.fits(wide, 1000) and not sizing.fits(wide, 1000, max_bytes=50_000) and not sizing.fits(wide, 99)


def billing(spark, rows):
    return spark.createDataFrame(rows, "BILLING_ID string, ITEM_NO string, REF_ORDER_ID string, QUANTITY decimal(18,3)")


def test_cross_check_of_copies_gives_each_billing_row_once(spark):
    n = 50_000
    b = spark.range(n).select(F.lit("b").alias("BILLING_ID"), F.lit("10").alias("ITEM_NO"), F.lit("o").alias("REF_ORDER_ID"), F.lit(Decimal(9)).cast("decimal(18,3)").alias("QUANTITY"))
    o = spark.range(n).select(F.lit("o").alias("ORDER_ID"), F.lit("10").alias("ITEM_NO"), F.lit(Decimal(1)).cast("decimal(18,3)").alias("QUANTITY"))
    assert dq_batch.cross_check(b, o).count() == n
    few = spark.createDataFrame([("o", "10", Decimal(10)), ("o", "10", None), ("p", "10", None)], "ORDER_ID string, ITEM_NO string, QUANTITY decimal(18,3)")
    rows = billing(spark, [("1", "10", "o", Decimal("10.5")), ("2", "10", "o", Decimal("10.501")), ("3", "10", "p", Decimal(5)), ("4", "20", "o", Decimal(50))])
    assert [r.BILLING_ID for r in dq_batch.cross_check(rows, few).collect()] == ["2"]


def test_duplicates_of_a_hot_key(spark):
    df = spark.range(30_000).select(F.lit("k").alias("k"), (F.col("id") % 2).alias("t")).unionByName(
        spark.createDataFrame([(None, 1), (None, 1), ("z", 1)], "k string, t long"))
    got = windows.duplicates(df, ["k"], ["t"]).groupBy("k", "t").count().collect()
    assert {(r.k, r.t): r["count"] for r in got} == {("k", 0): 14_999, ("k", 1): 15_000, (None, 1): 1}


def test_one_row_rules_on_literals(spark):
    stg = spark.createDataFrame(
        [("1", "10", dt.date(2000, 1, 1), Decimal(5), Decimal(1)), ("2", "10", None, None, Decimal(-1)), ("3", "10", dt.date(2000, 1, 1), Decimal(5), Decimal(100_001)),
         ("4", "10", dt.date(2000, 1, 1), None, None), ("5", "10", dt.date(2000, 1, 1), Decimal(5), Decimal(100_000)), ("6", "10", dt.date(2000, 1, 1), Decimal(5), Decimal(0))],
        "ORDER_ID string, ITEM_NO string, ORDER_DATE date, NET_AMOUNT decimal(18,2), QUANTITY decimal(18,3)")
    got = sorted((r.RULE_ID, r.RECORD_KEY) for r in dq_batch.rule_rows(stg, "2001-09-01").collect())
    assert got == [(1, "2-10"), (2, "2-10"), (2, "4-10"), (5, "2-10"), (5, "3-10")]


def test_batch_quarantine_is_idempotent(spark):
    q = spark.createDataFrame([(1, "S", "a", "{}", "PENDIENTE"), (1, "S", "a", "{}", "PENDIENTE"), (2, "S", "a", "{}", "PENDIENTE")],
                              "RULE_ID int, SOURCE_TABLE string, RECORD_KEY string, RECORD_PAYLOAD string, STATUS string")
    known = dq_batch.with_quarantine_id(q).dropDuplicates(["QUARANTINE_ID"])
    assert known.count() == dq_batch.merge_quarantine_batch(known, q).count() == 2
    assert dq_batch.merge_quarantine_batch(known.where("RULE_ID = 1"), q).count() == 2


def test_items_are_deduplicated_after_cleansing(spark):
    rows = [("0000000007", "000010", dt.datetime(2000, 1, 1), "old"), ("7", "10", dt.datetime(2000, 1, 2), "new"), ("7", None, dt.datetime(2000, 1, 1), "null"),
            ("7", " ", dt.datetime(2000, 1, 1), "blank")]
    items = spark.createDataFrame(rows, "SalesOrder string, SalesOrderItem string, _ingestion_timestamp timestamp, v string")
    assert sorted(r.v for r in silver.latest_cleansed(items, ["SalesOrder", "SalesOrderItem"]).collect()) == ["blank", "new", "null"]


def test_every_text_gets_its_summary(spark):
    df = spark.createDataFrame([(1, "One cat. Cat and cat! Dog."), (2, "123 456. 7"), (3, ""), (4, None), (5, "Ça été là. Été été")], "id int, t string")
    got = {r.id: r.RESUMEN for r in analytics.summarize(df, "id", "t").collect()}
    assert got == {1: "Cat and cat", 2: "123 456", 3: None, 4: None, 5: "Été été"}


def test_csv_report_counts_rows_with_line_breaks(spark, scratch):
    rows = [("a\nb", 1), ('say "x"\r\n', 2)]
    rep = odata.export_csv({"t": spark.createDataFrame(rows, "s string, n int")}, scratch)
    assert [tuple(r) for r in rep.collect()] == [("t", 2)]
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{scratch}/t")
    assert back.count() == 2


def test_calendar_spans_the_data(spark):
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    outside = wh.fact_sales_orders.join(wh.dim_date, "DATE_SK", "left_anti").count() + wh.fact_billing.join(wh.dim_date, "DATE_SK", "left_anti").count()
    assert outside == 0


def test_overwrite_replaces_the_table(spark, scratch):
    odata.overwrite(spark.range(3), f"{scratch}/o")
    odata.overwrite(spark.range(5), f"{scratch}/o")
    assert spark.read.parquet(f"{scratch}/o").count() == 5


def test_stream_adds_and_rescues_columns(spark, scratch):
    expected = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    spark.createDataFrame([("a", "1"), ("b", "x")], "k string, n string").write.parquet(f"{scratch}/raw/1")
    run = lambda add, to: runner.ingest_evolving(spark, f"{scratch}/raw", "*.parquet", expected, f"{scratch}/ck-{to}", f"{scratch}/{to}", add)
    run(True, "added"), run(False, "rescued")
    spark.createDataFrame([("c", "3", "new")], "k string, n string, extra string").write.parquet(f"{scratch}/raw/2")
    run(True, "added"), run(False, "rescued"), run(True, "added")  # the last has nothing to do
    rows = {r.k: r for r in spark.read.option("mergeSchema", True).parquet(f"{scratch}/added").collect()}
    assert {k: (r.n, r.extra, r._rescued_data) for k, r in rows.items()} == {"a": (1, None, None), "b": (None, None, '{"n":"x"}'), "c": (3, "new", None)}
    assert all(r._input_file_name and r.SourceSystem for r in rows.values())
    rows = {r.k: r for r in spark.read.parquet(f"{scratch}/rescued").collect()}
    assert rows["c"]._rescued_data == '{"extra":"new"}' and len(rows) == 3


def test_auto_ingest_by_name(spark, scratch):
    one = T.StructType([T.StructField("ID", T.LongType()), T.StructField("NAME", T.StringType())])
    spark.createDataFrame([("x", "7", "z")], "name string, id string, more string").coalesce(1).write.parquet(f"{scratch}/raw/customers")
    entities = {"customers": ("*.parquet", one), "none": ("*.absent", one)}
    report = runner.auto_ingest(spark, entities, f"{scratch}/raw", f"{scratch}/ck", f"{scratch}/t")
    assert [r["status"] for r in report] == ["OK", "ERROR"]
    assert [(r.ID, r.NAME) for r in spark.read.parquet(f"{scratch}/t/customers").collect()] == [(7, "x")]


def test_no_window_sorts_the_lines_of_an_order(spark):
    from saleswh.sources import bridge
    for frame in (bridge.bronze_items(spark, "/root/testdata/sf0.001"), bridge.header_totals(spark, "/root/testdata/sf0.001")):
        assert "Window" not in frame._jdf.queryExecution().optimizedPlan().toString()
