"""Sources and sinks: OData envelopes, entity runner, watermarks, landing writes,
rescued data, load by name, CSV export, calendars, role views."""
import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.plans import governance, warehouse
from saleswh.sources import odata

REC = T.StructType([T.StructField("__metadata", T.StructType([T.StructField("uri", T.StringType())])),
                    T.StructField("SalesOrder", T.StringType()), T.StructField("CreationDate", T.StringType())])


def test_odata_pages_v2_v4_and_to_raw(spark):
    pages = spark.createDataFrame([
        ('{"d":{"results":[{"__metadata":{"uri":"u"},"SalesOrder":"1","CreationDate":"/Date(1420102800000)/"}]}}',),
        ('{"value":[{"SalesOrder":"2","CreationDate":"x"},{"SalesOrder":"3"}]}',),
        ('{"value":[]}',)], "body string")
    flat = odata.drop_odata_metadata(odata.odata_pages(pages, REC))
    assert "__metadata" not in flat.columns and flat.count() == 3
    raw = odata.to_raw(flat, {"SalesOrder": "VBELN", "CreationDate": "AUDAT", "Missing": "ZZZ"})
    assert raw.columns == ["VBELN", "AUDAT"]
    assert sorted(map(tuple, raw.collect()), key=str) == sorted([("1", "20150101"), ("2", "x"), ("3", None)], key=str)


def test_run_entities_reports_errors_and_continues(spark):
    good = spark.createDataFrame([("1",)], "SalesOrder string")

    def reader(ent):
        if ent["name"] == "billing":
            raise ValueError("bad entity set")
        return good

    out = odata.run_entities(odata.ENTITIES, reader, lambda ent, df: df.count())
    status = {o["entity"]: o["status"] for o in out}
    assert status["billing"] == "ERROR" and status["sales_orders"] == "OK" and len(out) == 4


def test_next_watermark_modes(spark):
    df = spark.createDataFrame([("/Date(1420102800000)/",), ("/Date(1420189200000)/",)], "c string")
    assert df.transform(lambda d: odata.next_watermark(d, "c")).first()[0] == dt.datetime(2015, 1, 2, 9, 0)
    empty = df.where("false")
    assert odata.next_watermark(empty, "c", previous="2020-05-01 00:00:00").first()[0] == dt.datetime(2020, 5, 1)
    assert odata.next_watermark(empty, "c", previous="0").first()[0] == dt.datetime(1970, 1, 1)
    assert odata.next_watermark(df, "c", mode="run_ts", run_ts="2021-01-01 10:00:00").first()[0] == \
        dt.datetime(2021, 1, 1, 10, 0)


def test_incremental_slice_full_load(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2021, 1, 1),)], "t timestamp")
    assert odata.incremental_slice(df, "t", "2020-06-01 00:00:00").count() == 1
    assert odata.incremental_slice(df, "t", "2020-06-01 00:00:00", full_load=True).count() == 2
    assert odata.incremental_slice(df, "t", None).count() == 2


def test_landing_and_partitioned_writes(spark, scratch):
    df = spark.createDataFrame([("1",)], "VBELN string")
    run = dt.datetime(2021, 3, 4, 5, 6, 7)
    p = odata.write_landing(df, scratch, "sales_orders", run)
    assert p.endswith("sales_orders/sales_orders_20210304_050607")
    back = spark.read.parquet(p).first()
    assert back._SOURCE_FILE == "sales_orders/sales_orders_20210304_050607.parquet"
    odata.write_raw_partitioned(df, os.path.join(scratch, "raw"), run)
    r = spark.read.parquet(os.path.join(scratch, "raw")).first()
    assert (r.year, r.month, r.day) == (2021, 3, 4)


def test_export_csv_reports_rows(spark, scratch):
    rep = odata.export_csv({"a": spark.range(3), "b": spark.range(5)}, scratch)
    assert sorted(map(tuple, rep.collect())) == [("a", 3), ("b", 5)]


def test_rescue_and_copy_by_name(spark):
    df = spark.createDataFrame([("1", "12.5", None), ("2", "abc", "x")], "id string, amt string, extra string")
    exp = T.StructType([T.StructField("id", T.StringType()), T.StructField("amt", T.DecimalType(18, 2)),
                        T.StructField("missing", T.StringType())])
    out = {r.id: r for r in odata.rescue(df, exp).collect()}
    assert out["1"]._rescued_data is None and float(out["1"].amt) == 12.5
    assert out["2"]._rescued_data == '{"extra":"x","amt":"abc"}' and out["2"].amt is None
    cp = odata.copy_by_name(spark.createDataFrame([("1", "7")], "ID string, Qty string"),
                            T.StructType([T.StructField("id", T.StringType()), T.StructField("qty", T.IntegerType()),
                                          T.StructField("other", T.StringType())])).first()
    assert (cp.id, cp.qty, cp.other) == ("1", 7, None)


def test_calendar_and_validation(spark):
    cal = warehouse.dim_date(spark)
    v = warehouse.validate_calendar(cal).first()
    assert v.total_rows == 7671 and v.sentinel_rows == 1
    assert v.ok_rows and v.ok_sentinel and v.ok_history and v.ok_future
    iso = warehouse.dim_date_iso(spark, "2023-01-01", "2023-01-08").where("DATE_SK = 20230101").first()
    assert (iso.DAY_OF_WEEK, iso.IS_WEEKEND, iso.WEEK_OF_YEAR, iso.MONTH_NAME) == (7, True, 52, "Jan")


def test_publish_views_by_role(spark):
    dim = spark.createDataFrame([("1", "Ana", "20123", "a@b.c")], "CUSTOMER_ID string, CUSTOMER_NAME string, "
                                                                 "TAX_ID string, EMAIL string")
    kpi = spark.range(1)
    objs = {"dim_customer": ("curated", dim), "v_ventas_mensuales": ("curated", kpi)}
    assert governance.publish_views(spark, "R_GERENCIA", objs) == ["v_ventas_mensuales"]
    assert set(governance.publish_views(spark, "R_ANALYST_MASKED", objs)) == set(objs)
    assert spark.table("dim_customer").first().EMAIL == "*****@b.c"
    _ = F


def test_named_views(spark):
    from saleswh.plans import governance, marts
    from saleswh.plans.warehouse import Warehouse
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    views = governance.named_views(wh)
    assert governance.publish_views(spark, "R_GERENCIA", views) == ["v_ventas_mensuales", "v_cumplimiento_ppto"]
    assert set(governance.publish_views(spark, "R_ML_SERVICE", views)) == set(views)
    total = spark.sql("SELECT sum(VENTA_NETA) AS s FROM v_ventas_mensuales").first().s
    assert total == marts.monthly_sales(wh).groupBy().sum("VENTA_NETA").first()[0] and total > 0
    assert spark.sql("SELECT count(*) FROM model_daily_sales WHERE VENTA > 0").first()[0] > 0
