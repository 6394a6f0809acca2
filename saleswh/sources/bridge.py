"""Bridge: the driver's TPC-H-like tables -> SAP-shaped RAW and bronze tables.

The warehouse needs ERP-shaped inputs (zero-padded codes, yyyyMMdd text
dates, trailing-minus amounts, ``/Date(ms)/`` stamps).  The rules below
derive them from ``lineitem / orders / customer / part / nation / region``
with plain modulo arithmetic (no hash functions), so the DuckDB oracle can
rebuild byte-identical inputs.  Every table grows with the source tables;
nothing is sampled or capped.

Fixed values (must match the oracle's bridge): the rules of FIXTURES.md §5.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.functions.sap import epoch_ms, to_odata_date
from saleswh.operators.sizing import light, small

# Market segment -> customer group code.
SEGMENT_GROUP = [("AUTOMOBILE", "01"), ("BUILDING", "02"), ("FURNITURE", "03"),
                 ("HOUSEHOLD", "04"), ("MACHINERY", "05")]
# Sales organisations, channels, divisions and their names.
SALES_ORGS = ["1000", "2000", "3000"]
CHANNELS = [("10", "Direct"), ("20", "Wholesale")]
DIVISIONS = [("01", "Division 01"), ("02", "Division 02"), ("03", "Division 03")]
SOURCE_SYSTEM = "SAP_S4HANA"
RESCUED_PAYLOAD = '{"ZZ_UNEXPECTED":"x"}'


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one driver table, projecting only the needed columns."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def _segment_group(c: Column) -> Column:
    expr = None
    for seg, code in SEGMENT_GROUP:
        expr = (F.when(c == seg, code) if expr is None else expr.when(c == seg, code))
    return expr


# ------------------------------------------------------------------ RAW (batch)
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer with the RAW order columns computed once.

    Both joins are equi-joins on large keys; AQE picks sort-merge or
    broadcast from runtime sizes, skew-split if one key is hot.  Orders meet
    their customers first, so the lines, which are the most, are shuffled once.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
               "l_shipdate")
    od = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    j = li.join(od.join(cu, od.o_custkey == cu.c_custkey), li.l_orderkey == od.o_orderkey)
    junk_date = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 100 == 0
    minus = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return j.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "o_orderdate",
        _pad(F.col("l_orderkey"), 10).alias("VBELN"),
        _pad(F.col("l_linenumber") * 10, 6).alias("POSNR"),
        F.when(junk_date, "00000000").otherwise(_ymd(F.col("o_orderdate"))).alias("AUDAT"),
        F.when(F.col("l_orderkey") % 997 == 1, "0000099999")
         .otherwise(_pad(F.col("o_custkey"), 10)).alias("KUNNR"),
        _pad(F.col("l_partkey"), 18).alias("MATNR"),
        (F.lit(1000) * (F.lit(1) + F.col("c_nationkey") % 3)).cast("string").alias("VKORG"),
        F.when(F.col("l_suppkey") % 2 == 0, "10").otherwise("20").alias("VTWEG"),
        _pad(F.lit(1) + F.col("l_partkey") % 3, 2).alias("SPART"),
        F.col("l_quantity").cast("int").cast("string").alias("KWMENG"),
        F.concat(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
                 F.when(minus, "-").otherwise("")).alias("NETWR"),
        F.lit("USD").alias("WAERK"),
        F.col("l_shipdate").alias("_LOADED_AT"),
        F.concat(F.lit("sales_orders/sales_orders_"), _ymd(F.col("l_shipdate")),
                 F.lit(".parquet")).alias("_SOURCE_FILE"),
    )


RAW_ORDER_COLS = ["VBELN", "POSNR", "AUDAT", "KUNNR", "MATNR", "VKORG", "VTWEG", "SPART",
                  "KWMENG", "NETWR", "WAERK", "_SOURCE_FILE", "_LOADED_AT"]
RAW_BILLING_COLS = ["VBELN", "POSNR", "FKDAT", "KUNAG", "MATNR", "VKORG", "FKIMG", "NETWR",
                    "WAERK", "AUBEL", "_SOURCE_FILE", "_LOADED_AT"]


def raw_sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(*RAW_ORDER_COLS)


def raw_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """~85 % of order lines are billed 0-5 days after the order date."""
    ol = order_lines(spark, sf_dir)
    billed = ol.where((F.col("l_orderkey") + F.col("l_linenumber")) % 100 < 85)
    qty = F.col("l_quantity").cast("int")
    return billed.select(
        _pad(F.lit(9000000) + F.col("l_orderkey"), 10).alias("VBELN"),
        "POSNR",
        F.when(F.col("AUDAT") == "00000000", "00000000")
         .otherwise(_ymd(F.date_add(F.col("o_orderdate").cast("date"),
                                    (F.col("l_partkey") % 6).cast("int")))).alias("FKDAT"),
        F.col("KUNNR").alias("KUNAG"),
        "MATNR", "VKORG",
        F.when(F.col("l_orderkey") % 211 == 0, qty * 2).otherwise(qty).cast("string").alias("FKIMG"),
        "NETWR", "WAERK",
        F.col("VBELN").alias("AUBEL"),
        F.concat(F.lit("billing/billing_"), _ymd(F.col("_LOADED_AT")),
                 F.lit(".parquet")).alias("_SOURCE_FILE"),
        "_LOADED_AT",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    na = small(table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"), 10_000)
    re = small(table(spark, sf_dir, "region", "r_regionkey", "r_name"), 10_000)
    k = F.col("c_custkey")
    j = cu.join(na, cu.c_nationkey == na.n_nationkey).join(re, F.col("n_regionkey") == re.r_regionkey)
    return j.select(
        _pad(k, 10).alias("KUNNR"),
        F.col("c_name").alias("NAME1"),
        F.when(k % 100 == 7, F.lit(None).cast("string"))
         .when(k % 100 == 9, F.concat(F.lit("20"), _pad(k, 8)))
         .otherwise(F.concat(F.lit("20"), _pad(k, 9))).alias("STCD1"),
        F.concat(F.lit("contact"), k.cast("string"), F.lit("@demo.example")).alias("SMTP_ADDR"),
        F.col("n_name").alias("ORT01"),
        F.col("r_name").alias("REGIO"),
        F.upper(F.substring("n_name", 1, 2)).alias("LAND1"),
        _segment_group(F.col("c_mktsegment")).alias("KDGRP"),
        F.when(k % 50 == 0, "00000000")
         .otherwise(_ymd(F.date_add(F.lit("1994-01-01").cast("date"), (k % 2000).cast("int"))))
         .alias("ERDAT"),
        F.lit("customers/customers_20020101.parquet").alias("_SOURCE_FILE"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("_LOADED_AT"),
    )


def raw_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    pa = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    return pa.select(
        _pad(F.col("p_partkey"), 18).alias("MATNR"),
        F.col("p_name").alias("MAKTX"),
        F.lit("FERT").alias("MTART"),
        F.col("p_type").alias("MATKL"),
        F.lit("KG").alias("MEINS"),
        _pad(F.lit(1) + F.col("p_partkey") % 3, 2).alias("SPART"),
        F.lit("materials/materials_20020101.parquet").alias("_SOURCE_FILE"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("_LOADED_AT"),
    )


def sales_org_rows(full: bool = True) -> list[tuple]:
    """S21 literal rows: 18 areas (every item finds one) or the 6-row demo grid."""
    rows = []
    orgs = SALES_ORGS
    divs = DIVISIONS if full else DIVISIONS[:1]
    for org in orgs:
        for ch, ch_txt in CHANNELS:
            for dv, dv_txt in divs:
                rows.append((org, f"Sales Org {org}", ch, ch_txt, dv, dv_txt))
    return rows


RAW_SALES_ORG_SCHEMA = ("VKORG string, VTEXT string, VTWEG string, VTWEG_TXT string, "
                        "SPART string, SPART_TXT string")


def raw_sales_org(spark: SparkSession, full: bool = True) -> DataFrame:
    df = spark.createDataFrame(sales_org_rows(full), RAW_SALES_ORG_SCHEMA)
    return df.withColumn("_LOADED_AT", F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"))


def raw_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget grid years x months x orgs x product lines.

    Years and lines are derived from the data (distinct order years,
    distinct material lines); each side is a bounded distinct set, so the
    grid is a broadcast nested loop over tiny inputs, never data x data.
    """
    years = (table(spark, sf_dir, "orders", "o_orderdate")
             .select(F.year("o_orderdate").alias("y")).distinct())
    lines = table(spark, sf_dir, "part", "p_type").select(F.col("p_type").alias("line")).distinct()
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    orgs = spark.createDataFrame([(o,) for o in SALES_ORGS], "org string")
    grid = (small(years, 1000).crossJoin(months)
            .crossJoin(F.broadcast(orgs)).crossJoin(small(lines, 100_000)))
    amount = F.lit(80000) + (F.col("m") * 1000 + F.col("org").cast("int")) % 120000
    return grid.select(
        F.col("y").cast("string").alias("ANIO"),
        F.col("m").cast("string").alias("MES"),
        F.col("org").alias("VKORG"),
        F.col("line").alias("MATKL"),
        amount.cast("string").alias("IMPORTE_PPTO"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("_LOADED_AT"),
    )


# ------------------------------------------------------------------ bronze (streaming branch)
ITEM_TIEBREAK = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def bronze_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sales_order_item bronze rows (all text), anomalies on the lowest line.

    The lowest line of an order is a partial aggregate joined back, so no
    order is sorted in one task.  These orders are few: they are broadcast if
    the driver can hold them, else only their own lines are shuffled.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
               "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag", "l_shipdate")
    code = F.col("l_orderkey") % 200
    least = li.where(code.isin(0, 1, 2)).groupBy("l_orderkey").agg(F.min("l_linenumber").alias("_lowest"))
    if light(least):
        li = li.join(F.broadcast(least), "l_orderkey", "left")
    else:
        odd = F.coalesce(code.isin(0, 1, 2), F.lit(False))
        others = li.where(~odd).withColumn("_lowest", F.lit(None).cast(least.schema["_lowest"].dataType))
        li = others.unionByName(li.where(odd).join(least, "l_orderkey", "left"))
    lowest = F.col("l_linenumber") == F.col("_lowest")
    q = F.col("l_quantity")
    dec2 = lambda c: c.cast("decimal(18,2)").cast("string")
    dec3 = lambda c: c.cast("decimal(18,3)").cast("string")
    return li.select(
        _pad(F.col("l_orderkey"), 10).alias("SalesOrder"),
        F.when((code == 0) & lowest, F.lit(None).cast("string"))
         .otherwise(_pad(F.col("l_linenumber") * 10, 6)).alias("SalesOrderItem"),
        _pad(F.col("l_partkey"), 18).alias("Material"),
        F.concat(F.lit("MG"), _pad(F.col("l_partkey") % 6, 2)).alias("MaterialGroup"),
        F.concat(F.lit("pg"), (F.col("l_partkey") % 4).cast("string")).alias("MaterialPricingGroup"),
        _pad(F.col("l_partkey"), 18).alias("OriginallyRequestedMaterial"),
        F.concat(F.lit(" c-"), F.col("l_partkey").cast("string")).alias("MaterialByCustomer"),
        F.lit("tan").alias("SalesOrderItemCategory"),
        F.when(F.col("l_linestatus") == "F", " c").otherwise("a ").alias("DeliveryStatus"),
        F.when(F.col("l_linestatus") == "F", "c").otherwise("b").alias("SDProcessStatus"),
        F.lower(F.col("l_returnflag")).alias("OrderRelatedBillingStatus"),
        F.when((code == 1) & lowest, "-5").otherwise(dec3(q)).alias("RequestedQuantity"),
        dec3(q).alias("ConfdDelivQtyInOrderQtyUnit"),
        dec2(F.col("l_extendedprice")).alias("NetAmount"),
        dec2(q * 2).alias("TaxAmount"),
        dec2(q * 100).alias("CostAmount"),
        dec3(q * 1.5).alias("ItemGrossWeight"),
        dec3(q).alias("ItemNetWeight"),
        dec3(q / 4).alias("ItemVolume"),
        F.when((code == 2) & lowest, F.lit(RESCUED_PAYLOAD)).alias("_rescued_data"),
        F.col("l_shipdate").cast("timestamp").alias("_ingestion_timestamp"),
        F.lit(SOURCE_SYSTEM).alias("SourceSystem"),
        F.lit(True).alias("IsSynthetic"),
        F.concat(F.lit("raw/sap/sales_order/"), F.date_format("l_shipdate", "yyyy/MM/dd"),
                 F.lit("/"), F.col("l_orderkey").cast("string"),
                 F.lit("_sales_order_item.parquet")).alias("_input_file_name"),
    )


def header_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: order total = sum of the order's deduplicated item amounts.

    Dedup = latest row per (order, line) by ship date with a total
    tie-break; partial aggregation happens before the order-key shuffle.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", *ITEM_TIEBREAK)
    latest = li.groupBy("l_orderkey", "l_linenumber").agg(F.max(F.struct(*ITEM_TIEBREAK)).alias("_last"))
    return latest.groupBy("l_orderkey").agg(
        F.sum(F.col("_last.l_extendedprice").cast("decimal(18,2)")).alias("items_total"))


def bronze_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    tot = header_totals(spark, sf_dir)
    j = (od.join(cu, od.o_custkey == cu.c_custkey)
           .join(tot, od.o_orderkey == tot.l_orderkey, "left"))
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    odata_day = lambda d: to_odata_date(epoch_ms(d.cast("timestamp")))
    delivery = (F.when(k % 50 == 7, F.lit(None).cast("string"))
                .when(k % 200 == 3, odata_day(F.date_sub(day, 10)))
                .otherwise(odata_day(F.date_add(day, (F.lit(3) + k % 12).cast("int")))))
    total = F.when(k % 200 == 4, F.col("items_total") + 250).otherwise(F.col("items_total"))
    return j.select(
        _pad(k, 10).alias("SalesOrder"),
        (F.lit(1000) * (F.lit(1) + F.col("c_nationkey") % 3)).cast("string").alias("SalesOrganization"),
        F.when(F.col("o_custkey") % 2 == 0, "10").otherwise("20").alias("DistributionChannel"),
        _pad(F.lit(1) + k % 3, 2).alias("OrganizationDivision"),
        _pad(F.col("o_custkey"), 10).alias("SoldToParty"),
        F.concat(F.lit("z0"), (F.col("o_custkey") % 4).cast("string")).alias("CustomerPaymentTerms"),
        _segment_group(F.col("c_mktsegment")).alias("CustomerGroup"),
        _pad(F.col("c_nationkey") % 5, 2).alias("CustomerAccountAssignmentGroup"),
        F.when(k % 50 == 11, "C").otherwise("").alias("OverallSDDocumentRejectionSts"),
        odata_day(F.col("o_orderdate")).alias("CreationDate"),
        odata_day(F.col("o_orderdate")).alias("SalesOrderDate"),
        delivery.alias("RequestedDeliveryDate"),
        total.cast("decimal(18,2)").cast("string").alias("TotalNetAmount"),
        F.when(k % 200 == 5, "US_DOLLAR").otherwise("USD").alias("TransactionCurrency"),
        F.when(k % 200 == 2, F.lit(RESCUED_PAYLOAD)).alias("_rescued_data"),
        F.col("o_orderdate").cast("timestamp").alias("_ingestion_timestamp"),
        F.lit(SOURCE_SYSTEM).alias("SourceSystem"),
        F.lit(True).alias("IsSynthetic"),
        F.concat(F.lit("raw/sap/sales_order/"), F.date_format("o_orderdate", "yyyy/MM/dd"),
                 F.lit("/sales_order_"), k.cast("string"), F.lit(".parquet")).alias("_input_file_name"),
    )


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text input for D4-D6: all documents, of any language, as complaints (id, customer, date, text)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select(
        F.col("doc_id").alias("RECLAMO_ID"),
        (F.col("doc_id") % 1000 + 1).alias("CUSTOMER_SK"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("doc_id") % 200).cast("int")).alias("FECHA"),
        F.col("text").alias("TEXTO"),
    )


def order_dates(spark: SparkSession, sf_dir: str) -> tuple:
    """First and last order date."""
    return tuple(table(spark, sf_dir, "orders", "o_orderdate").agg(F.min("o_orderdate"), F.max("o_orderdate")).first())
