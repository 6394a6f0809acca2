"""Batch warehouse branch: calendar, dimensions, facts and KPI marts.

``Warehouse`` is a lazy bundle of DataFrames; each attribute is a plan
that Catalyst optimises end-to-end when an action runs (views are
expanded, pruning reaches the parquet scans).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.functions.sap import date_key
from saleswh.operators.merge import merge_upsert
from saleswh.operators.sizing import small
from saleswh.operators.windows import latest, surrogate
from saleswh.plans import staging
from saleswh.operators.commit import materialize
from saleswh.sources import bridge

# Parameters (the reference anchors on today; we anchor on a parameter).
AS_OF = "2001-09-01"
LOAD_TS = "2002-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"
DIM_BROADCAST_ROWS = 2_000_000


# ------------------------------------------------------------------ calendars
def dim_date(spark: SparkSession, start: str = "2015-01-01", end: str = "2035-12-31",
             sentinel: bool = True) -> DataFrame:
    """D-1: calendar with DateKey yyyyMMdd + sentinel -1 (1900-01-01, 'Unknown')."""
    d = F.col("d")
    cal = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS d").select(
        date_key(d, None).alias("DateKey"), d.alias("FullDate"),
        F.year(d).alias("YearNbr"), F.quarter(d).alias("QuarterNbr"), F.month(d).alias("MonthNbr"),
        F.date_format(d, "MMMM").alias("MonthName"), F.dayofmonth(d).alias("DayNbr"),
        F.date_format(d, "EEEE").alias("DayOfWeekName"))
    if not sentinel:
        return cal
    sent = spark.sql("SELECT -1 AS DateKey, DATE'1900-01-01' AS FullDate, -1 AS YearNbr, -1 AS QuarterNbr, "
                     "-1 AS MonthNbr, 'Unknown' AS MonthName, -1 AS DayNbr, 'Unknown' AS DayOfWeekName")
    return sent.unionByName(cal)


def dim_date_iso(spark: SparkSession, start: str, end: str) -> DataFrame:
    """D-2: calendar with ISO week, ISO weekday and weekend flag (batch branch)."""
    d = F.col("d")
    dow = F.weekday(d) + 1
    return spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS d").select(
        date_key(d, None).alias("DATE_SK"), d.alias("FULL_DATE"),
        F.year(d).alias("YEAR"), F.quarter(d).alias("QUARTER"), F.month(d).alias("MONTH"),
        F.date_format(d, "MMM").alias("MONTH_NAME"), F.weekofyear(d).alias("WEEK_OF_YEAR"),
        dow.alias("DAY_OF_WEEK"), (dow >= 6).alias("IS_WEEKEND"))


def validate_calendar(cal: DataFrame, key: str = "DateKey") -> DataFrame:
    """One aggregate pass -> rows, sentinels, min/max key and verdicts."""
    k = F.col(key)
    m = cal.agg(F.count(F.lit(1)).alias("total_rows"),
                F.sum(F.when(k == -1, 1).otherwise(0)).alias("sentinel_rows"),
                F.min(F.when(k != -1, k)).alias("min_key"),
                F.max(F.when(k != -1, k)).alias("max_key"))
    return m.select("*",
                    (F.col("total_rows") >= 7000).alias("ok_rows"),
                    (F.col("sentinel_rows") == 1).alias("ok_sentinel"),
                    (F.col("min_key") <= 20160101).alias("ok_history"),
                    (F.col("max_key") >= 20301231).alias("ok_future"))


# ------------------------------------------------------------------ dimensions
def initial_scd2(stg: DataFrame, key: str, sk: str, cols: list[str], as_of: str) -> DataFrame:
    """D-4/D-5 initial load: every staging row becomes a current version."""
    base = stg.select(*cols)
    keyed = surrogate(base, [key], sk)
    return keyed.select(sk, *cols,
                        F.lit(as_of).cast("timestamp").alias("VALID_FROM"),
                        F.lit(OPEN_END).cast("timestamp").alias("VALID_TO"),
                        F.lit(True).alias("IS_CURRENT"))


CUSTOMER_COLS = ["CUSTOMER_ID", "CUSTOMER_NAME", "TAX_ID", "EMAIL", "CITY", "REGION", "COUNTRY",
                 "CUSTOMER_GROUP", "CREATED_DATE", "ROW_HASH"]
PRODUCT_COLS = ["PRODUCT_ID", "PRODUCT_NAME", "PRODUCT_TYPE", "PRODUCT_LINE", "BASE_UOM",
                "DIVISION_ID", "ROW_HASH"]
SALES_ORG_COLS = ["SALES_ORG_ID", "SALES_ORG_NAME", "CHANNEL_ID", "CHANNEL_NAME", "DIVISION_ID",
                  "DIVISION_NAME"]


def dim_sales_org(stg: DataFrame) -> DataFrame:
    """D-7/M6: SCD1 rebuild numbered by (org, channel, division)."""
    return surrogate(stg.select(*SALES_ORG_COLS), ["SALES_ORG_ID", "CHANNEL_ID", "DIVISION_ID"],
                     "SALES_ORG_SK").select("SALES_ORG_SK", *SALES_ORG_COLS)


def current(dim: DataFrame, flag: str = "IS_CURRENT") -> DataFrame:
    return dim.where(F.col(flag))


# ------------------------------------------------------------------ facts
@dataclass(frozen=True)
class Lookups:
    """Natural and surrogate keys of the current dimension rows, broadcast where small."""

    customer: DataFrame
    product: DataFrame
    org: DataFrame

    @classmethod
    def of(cls, dim_customer: DataFrame, dim_product: DataFrame, dim_org: DataFrame) -> Lookups:
        return cls(small(current(dim_customer).select("CUSTOMER_ID", "CUSTOMER_SK"), DIM_BROADCAST_ROWS),
                   small(current(dim_product).select("PRODUCT_ID", "PRODUCT_SK"), DIM_BROADCAST_ROWS),
                   small(dim_org.select("SALES_ORG_ID", "CHANNEL_ID", "DIVISION_ID", "SALES_ORG_SK"), DIM_BROADCAST_ROWS))


def fact_sales_orders_src(stg: DataFrame, keys: Lookups) -> DataFrame:
    """D-9 source: dated rows, latest per (order, item), lookups without fallback."""
    s = latest(stg.where(F.col("ORDER_DATE").isNotNull()), ["ORDER_ID", "ITEM_NO"], ["_LOADED_AT"])
    j = (s.join(keys.customer, "CUSTOMER_ID", "left").join(keys.product, "PRODUCT_ID", "left")
          .join(keys.org, ["SALES_ORG_ID", "CHANNEL_ID", "DIVISION_ID"], "left"))
    return j.select("ORDER_ID", "ITEM_NO", date_key("ORDER_DATE", None).cast("bigint").alias("DATE_SK"),
                    "CUSTOMER_SK", "PRODUCT_SK", "SALES_ORG_SK", "QUANTITY", "NET_AMOUNT", "CURRENCY",
                    "_LOADED_AT")


def billing_rows(stg: DataFrame) -> DataFrame:
    """D-10: dated rows, latest per (billing, item), before any lookup."""
    s = latest(stg.where(F.col("BILLING_DATE").isNotNull()), ["BILLING_ID", "ITEM_NO"], ["_LOADED_AT"])
    return s.withColumn("DATE_SK", date_key("BILLING_DATE", None).cast("bigint"))


def fact_billing_src(stg: DataFrame, keys: Lookups) -> DataFrame:
    """D-10 source: dated rows, latest per (billing, item), with the dimension keys."""
    j = billing_rows(stg).drop("DATE_SK").join(keys.customer, "CUSTOMER_ID", "left").join(keys.product, "PRODUCT_ID", "left")
    return j.select("BILLING_ID", "ITEM_NO", date_key("BILLING_DATE", None).cast("bigint").alias("DATE_SK"),
                    "CUSTOMER_SK", "PRODUCT_SK", "SALES_ORG_ID", "QUANTITY", "NET_AMOUNT", "CURRENCY",
                    "REF_ORDER_ID", "_LOADED_AT")


# Columns a re-delivered billing row may change (M2 partial update).
BILLING_UPDATE = ["NET_AMOUNT", "_LOADED_AT"]
ORDER_UPDATE = ["DATE_SK", "CUSTOMER_SK", "PRODUCT_SK", "SALES_ORG_SK", "QUANTITY", "NET_AMOUNT",
                "_LOADED_AT"]


class Warehouse:
    """Lazy bundle of the batch branch for one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF, commit_tables: bool = True):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.commit_tables = commit_tables
        self.order_copies: DataFrame | None = None  # extra copies in the committed orders, once they are known

    @cached_property
    def calendar_span(self) -> tuple[str, str]:
        """First and last day of the years that the orders' dates span, and one year more for what is billed later:
        no dated fact row lies outside, whatever the data."""
        low, high = bridge.order_dates(self.spark, self.sf_dir)
        return f"{low.year}-01-01", f"{high.year + 1}-12-31"

    # RAW
    @cached_property
    def raw_sales_orders(self):
        return bridge.raw_sales_orders(self.spark, self.sf_dir)

    @cached_property
    def raw_billing(self):
        return bridge.raw_billing(self.spark, self.sf_dir)

    @cached_property
    def raw_customers(self):
        return bridge.raw_customers(self.spark, self.sf_dir)

    @cached_property
    def raw_materials(self):
        return bridge.raw_materials(self.spark, self.sf_dir)

    @cached_property
    def raw_sales_org(self):
        return bridge.raw_sales_org(self.spark)

    @cached_property
    def raw_budget(self):
        return bridge.raw_budget(self.spark, self.sf_dir)

    # STAGING
    @cached_property
    def stg_sales_orders(self):
        return staging.stg_sales_orders(self.raw_sales_orders)

    @cached_property
    def committed_sales_orders(self):
        """Staging orders written once, for plans that read them several times (DQ rules, audit)."""
        return self._commit(self.stg_sales_orders, "stg_sales_orders")

    @cached_property
    def stg_billing(self):
        return staging.stg_billing(self.raw_billing)  # read once per plan: not committed

    @cached_property
    def stg_customers(self):
        return staging.stg_customers(self.raw_customers)  # read once per plan: not committed

    @cached_property
    def stg_materials(self):
        return staging.stg_materials(self.raw_materials)  # read once per plan: not committed

    @cached_property
    def stg_sales_org(self):
        return staging.stg_sales_org(self.raw_sales_org)

    @cached_property
    def stg_budget(self):
        return staging.stg_budget(self.raw_budget)

    # CURATED
    def _commit(self, df: DataFrame, label: str = "table") -> DataFrame:
        """Staging tables and dimensions are committed before facts read them:
        write once as parquet under ``spark.checkpoint.dir`` and read back, so
        probes, lookups and rules reuse the files (with pruning/pushdown)."""
        if not self.commit_tables:
            return df
        return materialize(df, label)

    @cached_property
    def dim_date(self):
        return dim_date_iso(self.spark, *self.calendar_span)

    # numbering writes each dimension once; what it returns is a scan of that table
    @cached_property
    def dim_customer(self):
        return initial_scd2(self.stg_customers, "CUSTOMER_ID", "CUSTOMER_SK", CUSTOMER_COLS, self.as_of)

    @cached_property
    def dim_product(self):
        return initial_scd2(self.stg_materials, "PRODUCT_ID", "PRODUCT_SK", PRODUCT_COLS, self.as_of)

    @cached_property
    def dim_sales_org(self):
        return dim_sales_org(self.stg_sales_org)

    @cached_property
    def lookups(self) -> Lookups:
        """The keys of the dimensions, measured once for all facts that look them up."""
        return Lookups.of(self.dim_customer, self.dim_product, self.dim_sales_org)

    @cached_property
    def fact_sales_orders(self):
        # first MERGE into an empty target == the deduplicated source
        return fact_sales_orders_src(self.stg_sales_orders, self.lookups)

    @cached_property
    def fact_billing(self):
        return fact_billing_src(self.stg_billing, self.lookups)

    @cached_property
    def fact_budget(self):
        return self.stg_budget.select("BUDGET_YEAR", "BUDGET_MONTH", "SALES_ORG_ID", "PRODUCT_LINE",
                                      "BUDGET_AMOUNT")

    @cached_property
    def billing_lines(self):
        """Billing rows with the product line that the marts group by.

        The marts read no surrogate key, so lines come from the staged master
        (all of it is current after the initial load) and no dimension is built.
        """
        p = small(self.stg_materials.select("PRODUCT_ID", "PRODUCT_LINE"), DIM_BROADCAST_ROWS)
        return billing_rows(self.stg_billing).join(p, "PRODUCT_ID")

    def merged_fact_sales_orders(self, cutoff: str) -> DataFrame:
        """M1: the fact loaded up to a cut-off and committed, then the later rows merged into it."""
        cut = F.lit(cutoff).cast("timestamp_ntz")
        staged = self.committed_sales_orders  # built from RAW once, for both sides of the cut-off
        loaded = fact_sales_orders_src(staged.where(F.col("_LOADED_AT") < cut), self.lookups)
        later = fact_sales_orders_src(staged.where(F.col("_LOADED_AT") >= cut), self.lookups)
        return merge_upsert(self._commit(loaded, "fact_sales_orders"), later, ["ORDER_ID", "ITEM_NO"], update=ORDER_UPDATE)

    def merged_fact_billing(self, cutoff: str) -> DataFrame:
        """M2: billing loaded up to a cut-off, then the later deliveries; those of known rows update
        NET_AMOUNT and _LOADED_AT only."""
        cut = F.lit(cutoff).cast("timestamp_ntz")
        staged = self._commit(self.stg_billing, "stg_billing")
        loaded = fact_billing_src(staged.where(F.col("_LOADED_AT") < cut), self.lookups)
        later = fact_billing_src(staged.where(F.col("_LOADED_AT") >= cut), self.lookups)
        return merge_upsert(self._commit(loaded, "fact_billing"), later, ["BILLING_ID", "ITEM_NO"], update=BILLING_UPDATE)
