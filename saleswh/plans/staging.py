"""Typed, cleaned, renamed STAGING copies of the six RAW entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.functions.sap import row_hash, sap_alpha, sap_amount, sap_date, try_number


def stg_sales_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        sap_alpha("VBELN").alias("ORDER_ID"),
        sap_alpha("POSNR").alias("ITEM_NO"),
        sap_date("AUDAT").alias("ORDER_DATE"),
        sap_alpha("KUNNR").alias("CUSTOMER_ID"),
        sap_alpha("MATNR").alias("PRODUCT_ID"),
        F.col("VKORG").alias("SALES_ORG_ID"),
        F.col("VTWEG").alias("CHANNEL_ID"),
        F.col("SPART").alias("DIVISION_ID"),
        try_number("KWMENG", 18, 3).alias("QUANTITY"),
        sap_amount("NETWR").alias("NET_AMOUNT"),
        F.col("WAERK").alias("CURRENCY"),
        "_LOADED_AT",
    )


def stg_billing(raw: DataFrame) -> DataFrame:
    return raw.select(
        sap_alpha("VBELN").alias("BILLING_ID"),
        sap_alpha("POSNR").alias("ITEM_NO"),
        sap_date("FKDAT").alias("BILLING_DATE"),
        sap_alpha("KUNAG").alias("CUSTOMER_ID"),
        sap_alpha("MATNR").alias("PRODUCT_ID"),
        F.col("VKORG").alias("SALES_ORG_ID"),
        try_number("FKIMG", 18, 3).alias("QUANTITY"),
        sap_amount("NETWR").alias("NET_AMOUNT"),
        F.col("WAERK").alias("CURRENCY"),
        sap_alpha("AUBEL").alias("REF_ORDER_ID"),
        "_LOADED_AT",
    )


# Row-hash inputs (country and created date are not part of it, as in the reference).
CUSTOMER_HASH = ["NAME1", "STCD1", "SMTP_ADDR", "ORT01", "REGIO", "KDGRP"]
MATERIAL_HASH = ["MAKTX", "MATKL", "MEINS", "SPART"]


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        sap_alpha("KUNNR").alias("CUSTOMER_ID"),
        F.col("NAME1").alias("CUSTOMER_NAME"),
        F.col("STCD1").alias("TAX_ID"),
        F.col("SMTP_ADDR").alias("EMAIL"),
        F.col("ORT01").alias("CITY"),
        F.col("REGIO").alias("REGION"),
        F.col("LAND1").alias("COUNTRY"),
        F.col("KDGRP").alias("CUSTOMER_GROUP"),
        sap_date("ERDAT").alias("CREATED_DATE"),
        row_hash(*CUSTOMER_HASH).alias("ROW_HASH"),
        "_LOADED_AT",
    )


def stg_materials(raw: DataFrame) -> DataFrame:
    return raw.select(
        sap_alpha("MATNR").alias("PRODUCT_ID"),
        F.col("MAKTX").alias("PRODUCT_NAME"),
        F.col("MTART").alias("PRODUCT_TYPE"),
        F.col("MATKL").alias("PRODUCT_LINE"),
        F.col("MEINS").alias("BASE_UOM"),
        F.col("SPART").alias("DIVISION_ID"),
        row_hash(*MATERIAL_HASH).alias("ROW_HASH"),
        "_LOADED_AT",
    )


def stg_sales_org(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("VKORG").alias("SALES_ORG_ID"), F.col("VTEXT").alias("SALES_ORG_NAME"),
        F.col("VTWEG").alias("CHANNEL_ID"), F.col("VTWEG_TXT").alias("CHANNEL_NAME"),
        F.col("SPART").alias("DIVISION_ID"), F.col("SPART_TXT").alias("DIVISION_NAME"),
        "_LOADED_AT",
    )


def stg_budget(raw: DataFrame) -> DataFrame:
    return raw.select(
        try_number("ANIO", None).alias("BUDGET_YEAR"),
        try_number("MES", None).alias("BUDGET_MONTH"),
        F.col("VKORG").alias("SALES_ORG_ID"),
        F.col("MATKL").alias("PRODUCT_LINE"),
        try_number("IMPORTE_PPTO", 18, 2).alias("BUDGET_AMOUNT"),
        "_LOADED_AT",
    )


# Columns the propagation task may change on a known (order, item); org,
# channel, division and currency keep their first-loaded values (M2).
ORDER_PROPAGATE_UPDATE = ["ORDER_DATE", "CUSTOMER_ID", "PRODUCT_ID", "QUANTITY", "NET_AMOUNT", "_LOADED_AT"]


#: The same for billing and customers: what a re-delivered document or master row may change.
BILLING_PROPAGATE_UPDATE = ["BILLING_DATE", "CUSTOMER_ID", "PRODUCT_ID", "QUANTITY", "NET_AMOUNT", "_LOADED_AT"]
CUSTOMER_PROPAGATE_UPDATE = ["CUSTOMER_NAME", "TAX_ID", "EMAIL", "CITY", "REGION", "CUSTOMER_GROUP", "ROW_HASH", "_LOADED_AT"]


def propagate_orders(changes_raw: DataFrame, stg: DataFrame) -> DataFrame:
    """Change feed of RAW orders -> STAGING.

    Latest change per raw key (W1 on VBELN, POSNR), cleaned (P1), merged on
    the cleaned key updating only ``ORDER_PROPAGATE_UPDATE`` (M2).  Every
    staging row of a matched key is updated, as a MERGE does.
    """
    from saleswh.operators.merge import merge_upsert
    from saleswh.operators.windows import latest
    last = latest(changes_raw, ["VBELN", "POSNR"], ["_LOADED_AT"])
    return merge_upsert(stg, stg_sales_orders(last), ["ORDER_ID", "ITEM_NO"], update=ORDER_PROPAGATE_UPDATE)
