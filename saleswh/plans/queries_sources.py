"""Registered source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.catalog import query
from saleswh.oracle import silver_ctes  # noqa: F401  (registers the bronze CTEs)
from saleswh.oracle.ctes import with_ctes
from saleswh.session import checkpoint_dir
from saleswh.sources import bridge, odata
from saleswh.streaming import landing

SO_RENAME = odata.ENTITIES[0]["rename"]
RECORD = T.StructType([T.StructField("__metadata", T.StructType([T.StructField("uri", T.StringType())]))] + [
    T.StructField(c, T.StringType()) for c in SO_RENAME])
PAGE_RECORDS = 1000  # most records of a landed page


def _records(spark, sf_dir):
    h = bridge.bronze_headers(spark, sf_dir).select(
        "SalesOrder", "CreationDate", "SoldToParty", "SalesOrganization", "DistributionChannel",
        F.col("OrganizationDivision").alias("Division"), "TransactionCurrency")
    i = bridge.bronze_items(spark, sf_dir).select("SalesOrder", "SalesOrderItem", "Material", "RequestedQuantity",
                                                  "NetAmount")
    return i.join(h, "SalesOrder")


@query("odata_roundtrip", "S1,S2,S3,F7,J1", with_ctes("""
SELECT i.SalesOrder AS VBELN, i.SalesOrderItem AS POSNR,
  strftime(epoch_ms(CAST(regexp_extract(h.CreationDate, '^/Date\\((-?[0-9]+)', 1) AS BIGINT)), '%Y%m%d') AS AUDAT,
  h.SoldToParty AS KUNNR, i.Material AS MATNR, h.SalesOrganization AS VKORG, h.DistributionChannel AS VTWEG,
  h.OrganizationDivision AS SPART, i.RequestedQuantity AS KWMENG, i.NetAmount AS NETWR, h.TransactionCurrency AS WAERK
FROM bronze_items i JOIN bronze_headers h ON i.SalesOrder = h.SalesOrder"""))
def q_odata_roundtrip(spark, sf_dir):
    """Records packed into V2/V4 OData pages, flattened back and mapped to RAW names."""
    r = _records(spark, sf_dir)
    rec = F.struct(F.struct(F.concat(F.lit("A_SalesOrderItem('"), F.col("SalesOrder"), F.lit("')")).alias("uri"))
                   .alias("__metadata"), *[F.col(c) for c in SO_RENAME])
    # by position, so no order, however long, fills a page beyond its size
    r = r.withColumn("page", F.floor(F.monotonically_increasing_id() / PAGE_RECORDS))
    pages = r.groupBy("page").agg(F.collect_list(rec).alias("recs"))
    body = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.struct(F.col("recs").alias("results")).alias("d"))))\
            .otherwise(F.to_json(F.struct(F.col("recs").alias("value"))))
    flat = odata.odata_pages(pages.select(body.alias("body")), RECORD)
    return odata.to_raw(odata.drop_odata_metadata(flat), SO_RENAME)


@query("incremental_orders", "S5,P6", with_ctes("""
SELECT SalesOrder, strftime(_ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS _ingestion_timestamp
FROM bronze_headers WHERE _ingestion_timestamp > TIMESTAMP '2000-01-01 00:00:00' AND TransactionCurrency = 'USD'"""))
def q_incremental_orders(spark, sf_dir):
    h = bridge.bronze_headers(spark, sf_dir)
    s = odata.incremental_slice(h, "_ingestion_timestamp", "2000-01-01 00:00:00",
                                F.col("TransactionCurrency") == "USD")
    return s.select("SalesOrder", "_ingestion_timestamp")


@query("watermark_next", "S6", with_ctes("""
SELECT strftime(coalesce(max(epoch_ms(CAST(regexp_extract(CreationDate, '^/Date\\((-?[0-9]+)', 1) AS BIGINT))),
  TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS watermark FROM bronze_headers
WHERE _ingestion_timestamp > TIMESTAMP '2000-01-01 00:00:00'"""))
def q_watermark_next(spark, sf_dir):
    """Next high-water mark = max decoded change date of the incremental slice."""
    h = bridge.bronze_headers(spark, sf_dir)
    s = odata.incremental_slice(h, "_ingestion_timestamp", "2000-01-01 00:00:00")
    return odata.next_watermark(s, "CreationDate", "max", previous="0")


_OLDEST_SQL = """(SELECT SalesOrder, CreationDate FROM bronze_headers
  ORDER BY epoch_ms(CAST(regexp_extract(CreationDate, '^/Date\\((-?[0-9]+)', 1) AS BIGINT)), SalesOrder LIMIT 50)"""


def _oldest(spark, sf_dir):
    h = bridge.bronze_headers(spark, sf_dir)
    return odata.take_oldest(h, 50, [odata.decode_odata_ms(F.col("CreationDate")).asc(), F.col("SalesOrder").asc()])


@query("oldest_headers", "S7,O1", with_ctes(f"SELECT * FROM {_OLDEST_SQL}"))
def q_oldest_headers(spark, sf_dir):
    """Oldest 50 headers by change date (one OData page)."""
    return _oldest(spark, sf_dir).select("SalesOrder", "CreationDate")


@query("items_of_oldest", "S8,J11", with_ctes(f"""
SELECT SalesOrder, SalesOrderItem, Material, NetAmount FROM bronze_items
WHERE SalesOrder IN (SELECT SalesOrder FROM {_OLDEST_SQL})"""))
def q_items_of_oldest(spark, sf_dir):
    """Items of exactly those headers, as one semi-join."""
    items = bridge.bronze_items(spark, sf_dir)
    return odata.items_of(_oldest(spark, sf_dir), items).select("SalesOrder", "SalesOrderItem", "Material",
                                                                "NetAmount")


@query("load_history", "S18", with_ctes("""
SELECT _SOURCE_FILE, CAST(COUNT(*) AS BIGINT) AS ROW_COUNT, strftime(min(_LOADED_AT), '%Y-%m-%d %H:%M:%S') AS FIRST_LOAD,
  strftime(max(_LOADED_AT), '%Y-%m-%d %H:%M:%S') AS LAST_LOAD
FROM raw_sales_orders GROUP BY 1"""))
def q_load_history(spark, sf_dir):
    return odata.load_history(bridge.raw_sales_orders(spark, sf_dir))


RAW_CUSTOMER = T.StructType([T.StructField(c, T.StringType()) for c in
                             ["KUNNR", "NAME1", "STCD1", "SMTP_ADDR", "ORT01", "REGIO", "LAND1", "KDGRP", "ERDAT"]]
                            + [T.StructField("_LOADED_AT", T.TimestampNTZType())])


@query("copy_by_name_customers", "S16", with_ctes("""
SELECT KUNNR, NAME1, STCD1, SMTP_ADDR, ORT01, REGIO, CAST(NULL AS VARCHAR) AS LAND1, KDGRP, ERDAT,
  strftime(_LOADED_AT, '%Y-%m-%d %H:%M:%S') AS _LOADED_AT FROM raw_customers"""))
def q_copy_by_name_customers(spark, sf_dir):
    """A landed file with lower-case names, an extra and a missing column, loaded by name."""
    raw = bridge.raw_customers(spark, sf_dir)
    landed = raw.select(*[F.col(c).alias(c.lower()) for c in raw.columns if c != "LAND1"],
                        F.lit("x").alias("unexpected_col"))
    return odata.copy_by_name(landed, RAW_CUSTOMER)


@query("evolved_headers", "S14,O3", with_ctes("""
SELECT SalesOrder, CAST(NULL AS VARCHAR) AS CustomerGroup, TransactionCurrency FROM bronze_headers
WHERE CAST(SalesOrder AS BIGINT) % 2 = 0
UNION ALL
SELECT SalesOrder, CustomerGroup, TransactionCurrency FROM bronze_headers WHERE CAST(SalesOrder AS BIGINT) % 2 = 1"""))
def q_evolved_headers(spark, sf_dir):
    """Older files lack a column the newer ones add; the union fills NULL."""
    h = bridge.bronze_headers(spark, sf_dir).select("SalesOrder", "CustomerGroup", "TransactionCurrency")
    even = F.col("SalesOrder").cast("bigint") % 2 == 0
    old = h.where(even).drop("CustomerGroup")
    new = h.where(~even)
    return odata.evolve(old, new).select("SalesOrder", "CustomerGroup", "TransactionCurrency")


EXPECTED_ITEM = T.StructType([T.StructField("SalesOrder", T.StringType()), T.StructField("SalesOrderItem", T.StringType()),
                              T.StructField("RequestedQuantity", T.DecimalType(18, 3)),
                              T.StructField("NetAmount", T.DecimalType(18, 2))])


@query("rescued_items", "S15", with_ctes("""
SELECT SalesOrder, SalesOrderItem, CAST(TRY_CAST(RequestedQuantity AS DECIMAL(18,3)) AS DOUBLE) AS RequestedQuantity,
  CAST(TRY_CAST(NetAmount AS DECIMAL(18,2)) AS DOUBLE) AS NetAmount,
  CASE WHEN ZZ_EXTRA IS NOT NULL THEN '{"ZZ_EXTRA":"' || ZZ_EXTRA || '"}'
       WHEN NetAmount IS NOT NULL AND TRY_CAST(NetAmount AS DECIMAL(18,2)) IS NULL
         THEN '{"NetAmount":"' || NetAmount || '"}' END AS _rescued_data
FROM (SELECT SalesOrder, SalesOrderItem, RequestedQuantity,
        CASE WHEN CAST(SalesOrder AS BIGINT) % 200 = 7 THEN 'N/A' ELSE NetAmount END AS NetAmount,
        CASE WHEN CAST(SalesOrder AS BIGINT) % 200 = 6 THEN 'x' END AS ZZ_EXTRA
      FROM bronze_items)"""))
def q_rescued_items(spark, sf_dir):
    """Unexpected columns and unparseable values packed into _rescued_data."""
    i = bridge.bronze_items(spark, sf_dir)
    k = F.col("SalesOrder").cast("bigint") % 200
    landed = i.select("SalesOrder", "SalesOrderItem", "RequestedQuantity",
                      F.when(k == 7, "N/A").otherwise(F.col("NetAmount")).alias("NetAmount"),
                      F.when(k == 6, "x").alias("ZZ_EXTRA"))
    return odata.rescue(landed, EXPECTED_ITEM)


# ------------------------------------------------------------------ landed files, ledger, stored watermark
def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}/{uuid.uuid4().hex}"


@query("load_ledger", "S17,S18,S16", """
SELECT 'headers' AS entity, d AS delivery, 'LOADED' AS status, CAST(count(*) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS bad_files
FROM (SELECT if(o_orderdate < TIMESTAMP '1996-01-01', '1', '2') AS d FROM orders) GROUP BY d
UNION ALL SELECT 'headers', '2', 'ERROR', 0, 2
UNION ALL SELECT 'customers', '1', 'LOADED', count(*), 0 FROM customer
UNION ALL SELECT 'TABLE headers', '-', 'ROWS', count(*), 0 FROM orders""")
def q_load_ledger(spark, sf_dir):
    """Two deliveries of order headers and one of customers, loaded by two runs of two pipes (the second run twice).  The
    second delivery has two files that are no Parquet files: the ledger says so, and the others are loaded."""
    base = _folder(spark, "ledger")
    orders = bridge.table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp")
    pipes = [landing.Pipe(spark, n, f"{base}/landing/{n}", f"{base}/{n}") for n in ("headers", "customers")]
    bridge.table(spark, sf_dir, "customer", "c_custkey", "c_name").write.parquet(f"{base}/landing/customers/delivery=1")
    for run, cond in ((1, early), (2, ~early), (2, ~early)):
        orders.where(cond).write.mode("ignore").parquet(f"{base}/landing/headers/delivery={run}")
        if run == 2:
            for n in range(2):
                landing.put_bytes(spark, f"{base}/landing/headers/delivery=2/broken-{n}.parquet", b"this is no Parquet file")
        landing.load_all(pipes, run, "2001-09-01 00:00:00")
    ledger = pipes[0].ledger().unionByName(pipes[1].ledger())
    delivery = F.regexp_extract("file", "delivery=([0-9]+)", 1).alias("delivery")
    totals = ledger.groupBy("entity", delivery, "status").agg(F.sum("row_count").alias("row_count"), F.count_if(F.col("error").isNotNull()).alias("bad_files"))
    rows = pipes[0].read().agg(F.count(F.lit(1)).alias("row_count"))
    return totals.unionByName(rows.select(F.lit("TABLE headers").alias("entity"), F.lit("-").alias("delivery"), F.lit("ROWS").alias("status"),
                                          "row_count", F.lit(0).alias("bad_files")))


@query("ingest_schema_log", "S11,S12,S14,S15,S13", """
SELECT CAST(l_orderkey AS BIGINT) AS id, CAST(l_linenumber AS BIGINT) AS line,
  CAST(if(part = 2 AND l_orderkey % 10 = 3, NULL, CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty,
  if(part = 2, l_returnflag, NULL) AS flag,
  if(part = 2 AND l_orderkey % 10 = 3, '{"qty":"n/a ' || l_linenumber || '"}', NULL) AS rescued
FROM (SELECT *, if(l_orderkey % 2 = 0, 1, 2) AS part FROM lineitem)""")
def q_ingest_schema_log(spark, sf_dir):
    """Order lines landed twice by two systems: the first writes short ids and whole quantities, the second long ids,
    quantities as text, some of them no numbers, and one column more.  Nothing stops and no value is lost."""
    base = _folder(spark, "schema-log")
    li = bridge.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    qty = F.col("l_quantity").cast("int")
    odd = F.col("l_orderkey") % 2 != 0
    first = li.where(~odd).select(F.col("l_orderkey").cast("int").alias("id"), F.col("l_linenumber").cast("int").alias("line"), qty.alias("qty"))
    text = F.when(F.col("l_orderkey") % 10 == 3, F.concat(F.lit("n/a "), F.col("l_linenumber").cast("string"))).otherwise(qty.cast("string"))
    later = li.where(odd).select(F.col("l_orderkey").cast("long").alias("id"), F.col("l_linenumber").cast("int").alias("line"), text.alias("qty"),
                                 F.col("l_returnflag").alias("flag"))
    pipe = landing.Pipe(spark, "lines", f"{base}/landing", f"{base}/lines")
    for run, df in enumerate((first, later)):
        df.write.parquet(f"{base}/landing/delivery={run}")
        pipe.load(run, "2001-09-01 00:00:00")
    return pipe.read().select("id", "line", "qty", "flag", F.col(landing.RESCUED).alias("rescued"))


@query("extract_resumable", "S4,S5,S6,S7,S10", """
WITH o AS (SELECT o_orderkey, o_orderdate FROM orders),
cut AS (SELECT max(o_orderdate) AS c FROM (SELECT o_orderdate FROM o ORDER BY o_orderdate LIMIT 500))
SELECT 'slice' AS what, CAST(o_orderkey AS BIGINT) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at FROM o
UNION ALL SELECT 'watermark 1', NULL, strftime(c, '%Y-%m-%d %H:%M:%S') FROM cut
UNION ALL SELECT 'watermark 2', NULL, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM o""")
def q_extract_resumable(spark, sf_dir):
    """The orders by change time in two slices, the first of about 500 rows, each published with its watermark; run 1 is
    repeated after it has been published, and run 2 begins where it ended."""
    orders = bridge.table(spark, sf_dir, "orders", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    job, marks = odata.Extraction(spark, _folder(spark, "extract"), "o_orderdate"), []
    for run, most in ((1, 500), (1, 500), (2, None)):
        job.run(run, orders, most)
        marks.append(job.watermark())
    stamps = spark.createDataFrame([("watermark 1", marks[1]), ("watermark 2", marks[2])], "what string, at string")
    return job.read().select(F.lit("slice").alias("what"), "o_orderkey", F.col("o_orderdate").alias("at")).unionByName(
        stamps.select("what", F.lit(None).cast("long").alias("o_orderkey"), F.col("at").cast("timestamp").alias("at")))
