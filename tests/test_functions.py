"""Literal unit rows (FIXTURES §6) for the SAP column functions."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from saleswh.functions import sap
from saleswh.plans import governance


def _map(spark, fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_sap_alpha(spark):
    assert _map(spark, sap.sap_alpha, ["000", "0012", "00A1", "", None]) == ["", "12", "00A1", "", None]


def test_alpha_strip(spark):
    assert _map(spark, sap.alpha_strip, ["000", "0012", "00A1", "", None]) == ["0", "12", "A1", "0", None]


def test_alpha_lookup(spark):
    assert _map(spark, sap.alpha_lookup, ["000", "0012", None]) == ["", "12", None]


def test_sap_date(spark):
    out = _map(spark, sap.sap_date, ["20230110", "00000000", "2023-01", None, "20231345"])
    assert out == [dt.date(2023, 1, 10), None, None, None, None]


def test_sap_amount(spark):
    out = _map(spark, sap.sap_amount, ["1234.56-", "1250.00", "x", None])
    assert out == [Decimal("-1234.56"), Decimal("1250.00"), None, None]


def test_odata_ts(spark):
    out = _map(spark, sap.odata_ts, ["/Date(1420102800000)/", "2015-01-01", "/Date(-1)/",
                                     "/Date(1420102800000+0000)/", "bad", None])
    assert out[0] == dt.datetime(2015, 1, 1, 9, 0, 0)
    assert out[1] == dt.datetime(2015, 1, 1, 0, 0, 0)
    assert out[2:] == [None, None, None, None]


def test_odata_to_yyyymmdd(spark):
    out = _map(spark, sap.odata_to_yyyymmdd, ["/Date(1420102800000)/", "/Date(-86400000+0000)/", "/Date(x)/"])
    assert out == ["20150101", "19691231", "/Date(x)/"]


def test_date_key_default(spark):
    df = spark.createDataFrame([(dt.date(2001, 2, 3),), (None,)], "d date")
    assert [r[0] for r in df.select(sap.date_key("d")).collect()] == [20010203, -1]


def test_row_hash_keeps_null_slots(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r[0] for r in df.select(sap.row_hash("x", "y", "z")).collect()]
    assert h[0] != h[1]  # concat_ws would make them equal


def test_payload_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(sap.payload("x", "y")).first()[0] == '{"x":"a","y":null}'


def test_add_warning(spark):
    df = spark.createDataFrame([(True,), (False,)], "m boolean")
    out = [r[0] for r in df.select(sap.add_warning(sap.empty_warnings(), "W", F.col("m"))).collect()]
    assert out == [["W"], []]


def test_mask_email_and_string(spark):
    df = spark.createDataFrame([("ab.c@x.pe", "Ana"), ("noat", None)], "EMAIL string, CUSTOMER_NAME string")
    masked = governance.mask_pii(df, "R_ANALYST_MASKED").collect()
    assert [r.EMAIL for r in masked] == ["*****@x.pe", "*****"]
    assert [r.CUSTOMER_NAME for r in masked] == ["***PROTEGIDO***", "***PROTEGIDO***"]
    clear = governance.mask_pii(df, "R_DATA_ANALYST").collect()
    assert [r.EMAIL for r in clear] == ["ab.c@x.pe", "noat"]


def test_sql_functions_registered(spark):
    sap.register_sql_functions(spark)
    r = spark.sql("SELECT f_sap_alpha('0012') a, f_sap_date('20230110') d, f_sap_amount('5.00-') m").first()
    assert r.a == "12" and r.d == dt.date(2023, 1, 10) and r.m == Decimal("-5.00")
