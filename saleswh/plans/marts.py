"""KPI marts (D-12..D-14, A1, A2, A9).

The billing rows are pre-aggregated to what the mart groups by *before* the
calendar and organisation joins ("eager aggregation"): sums are decomposable,
so the result is identical, but the joins then see one row per (date, line,
org) instead of one per billing line, and the sales-org fan-out of the
reference view multiplies aggregates, not lines.  Dimensions that a mart does
not use are neither built nor joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.functions.sap import since_months
from saleswh.operators.sizing import small
from saleswh.plans.warehouse import DIM_BROADCAST_ROWS, Warehouse, billing_rows


def monthly_sales(wh: Warehouse, grain_safe: bool = False) -> DataFrame:
    """D-12/A1: net sales and quantity by year, month, org name, product line.

    Parity: the org dimension is joined on the org id only, so every amount
    is counted once per (channel, division) row of that org.  With
    ``grain_safe`` the org names are taken distinct first.
    """
    f = (wh.billing_lines.groupBy("DATE_SK", "PRODUCT_LINE", "SALES_ORG_ID")
           .agg(F.sum("NET_AMOUNT").alias("NET_AMOUNT"), F.sum("QUANTITY").alias("QUANTITY")))
    d = F.broadcast(wh.dim_date.select("DATE_SK", "YEAR", "MONTH"))  # bounded by the calendar span
    o = wh.stg_sales_org.select("SALES_ORG_ID", "SALES_ORG_NAME")  # names only: no key is numbered for them
    if grain_safe:
        o = o.distinct()
    o = small(o, DIM_BROADCAST_ROWS)
    j = f.join(d, "DATE_SK").join(o, "SALES_ORG_ID")
    return (j.groupBy("YEAR", "MONTH", "SALES_ORG_NAME", "PRODUCT_LINE")
             .agg(F.sum("NET_AMOUNT").alias("VENTA_NETA"), F.sum("QUANTITY").alias("CANTIDAD")))


def budget_attainment(wh: Warehouse, grain_safe: bool = False) -> DataFrame:
    """D-13/A2/J10: actual vs budget per year, month, product line.

    Parity: the budget is joined without the org, so each (year, month,
    line) pairs every org's actual with every org's budget.  The grain-safe
    variant sums each side to (year, month, line) first.
    """
    v = monthly_sales(wh, grain_safe)
    b = wh.fact_budget
    if grain_safe:
        v = v.groupBy("YEAR", "MONTH", "PRODUCT_LINE").agg(F.sum("VENTA_NETA").alias("VENTA_NETA"))
        b = (b.groupBy("BUDGET_YEAR", "BUDGET_MONTH", "PRODUCT_LINE")
              .agg(F.sum("BUDGET_AMOUNT").alias("BUDGET_AMOUNT")))
    j = v.join(b, (v.YEAR == b.BUDGET_YEAR) & (v.MONTH == b.BUDGET_MONTH) &
               (v.PRODUCT_LINE == b.PRODUCT_LINE)).drop(b.PRODUCT_LINE)
    real = F.sum("VENTA_NETA")
    ppto = F.sum("BUDGET_AMOUNT")
    pct = F.round(real.cast("double") / F.nullif(ppto.cast("double"), F.lit(0.0)) * 100, 1)
    return (j.groupBy("YEAR", "MONTH", "PRODUCT_LINE")
             .agg(real.alias("REAL"), ppto.alias("PRESUPUESTO"), pct.alias("CUMPLIMIENTO_PCT")))


def daily_sales(wh: Warehouse) -> DataFrame:
    """Daily positive net sales per product line (forecast input)."""
    f = wh.billing_lines.where(F.col("NET_AMOUNT") > 0)
    f = f.groupBy("DATE_SK", "PRODUCT_LINE").agg(F.sum("NET_AMOUNT").alias("VENTA"))
    d = F.broadcast(wh.dim_date.select("DATE_SK", "FULL_DATE"))
    return (f.join(d, "DATE_SK")
             .groupBy(F.col("FULL_DATE").alias("TS"), F.col("PRODUCT_LINE").alias("SERIE"))
             .agg(F.sum("VENTA").alias("VENTA")))


def daily_billing(wh: Warehouse) -> DataFrame:
    """Daily billed amount per sales org (anomaly input)."""
    f = billing_rows(wh.stg_billing).groupBy("DATE_SK", "SALES_ORG_ID").agg(F.sum("NET_AMOUNT").alias("FACTURADO"))
    d = F.broadcast(wh.dim_date.select("DATE_SK", "FULL_DATE"))
    return (f.join(d, "DATE_SK")
             .groupBy(F.col("FULL_DATE").alias("TS"), F.col("SALES_ORG_ID").alias("SERIE"))
             .agg(F.sum("FACTURADO").alias("FACTURADO")))


def driver_base(wh: Warehouse, as_of: str | None = None) -> DataFrame:
    """D-14/J7: six-month base with the current-period (last 3 months) flag."""
    as_of = as_of or wh.as_of
    d = F.broadcast(wh.dim_date.select("DATE_SK", "FULL_DATE").where(since_months("FULL_DATE", as_of, 6)))
    p = small(wh.dim_product.select("PRODUCT_SK", "PRODUCT_LINE"), DIM_BROADCAST_ROWS)
    o = small(wh.dim_sales_org.select("SALES_ORG_ID", "SALES_ORG_NAME", "CHANNEL_NAME"), DIM_BROADCAST_ROWS)
    c = small(wh.dim_customer.select("CUSTOMER_SK", "REGION"), DIM_BROADCAST_ROWS)
    f = wh.fact_billing.select("DATE_SK", "PRODUCT_SK", "SALES_ORG_ID", "CUSTOMER_SK", "NET_AMOUNT")
    j = f.join(d, "DATE_SK").join(p, "PRODUCT_SK").join(o, "SALES_ORG_ID").join(c, "CUSTOMER_SK")
    return j.select("PRODUCT_LINE", "SALES_ORG_NAME", "CHANNEL_NAME", "REGION", "NET_AMOUNT",
                    since_months("FULL_DATE", as_of, 3).alias("ES_PERIODO_ACTUAL"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A10: row counts of several tables in one result (union of 1-row aggregates)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
