"""Landed OData pages and extraction helpers.

The network client of the reference is not rebuilt: extraction starts at
landed page files (one JSON document per page).  Everything after the
fetch - flattening, renaming, slicing, watermarks, landing writes - is a
DataFrame operation.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from saleswh.functions.sap import odata_to_yyyymmdd
from saleswh.operators.commit import File, attempts, live

# Entity catalogue (OData field -> RAW column), incremental field.
ENTITIES = [
    {"name": "sales_orders", "entity_set": "A_SalesOrderItem", "incremental_field": "LastChangeDateTime",
     "rename": {"SalesOrder": "VBELN", "SalesOrderItem": "POSNR", "CreationDate": "AUDAT",
                "SoldToParty": "KUNNR", "Material": "MATNR", "SalesOrganization": "VKORG",
                "DistributionChannel": "VTWEG", "Division": "SPART", "RequestedQuantity": "KWMENG",
                "NetAmount": "NETWR", "TransactionCurrency": "WAERK"}},
    {"name": "billing", "entity_set": "A_BillingDocumentItem", "incremental_field": "LastChangeDateTime",
     "rename": {"BillingDocument": "VBELN", "BillingDocumentItem": "POSNR", "CreationDate": "FKDAT",
                "SoldToParty": "KUNAG", "Material": "MATNR", "SalesOrganization": "VKORG",
                "BillingQuantity": "FKIMG", "NetAmount": "NETWR", "TransactionCurrency": "WAERK",
                "ReferenceSDDocument": "AUBEL"}},
    {"name": "customers", "entity_set": "A_BusinessPartner", "incremental_field": "LastChangeDate",
     "rename": {"BusinessPartner": "KUNNR", "OrganizationBPName1": "NAME1"}},
    {"name": "materials", "entity_set": "A_Product", "incremental_field": "LastChangeDateTime",
     "rename": {"Product": "MATNR", "ProductType": "MTART", "ProductGroup": "MATKL", "BaseUnit": "MEINS",
                "Division": "SPART"}},
]
EPOCH_WATERMARK = "1970-01-01 00:00:00"


# ------------------------------------------------------------------ S1-S3
def page_schema(record: T.StructType) -> T.StructType:
    """V2 ``{"d": {"results": [...]}}`` and V4 ``{"value": [...]}`` in one schema."""
    arr = T.ArrayType(record)
    return T.StructType([T.StructField("d", T.StructType([T.StructField("results", arr)])),
                         T.StructField("value", arr)])


def odata_pages(pages: DataFrame, record: T.StructType, body: str = "body") -> DataFrame:
    """One row per record of every landed page (V2 or V4 envelope)."""
    p = pages.select(F.from_json(F.col(body), page_schema(record)).alias("_p"))
    recs = F.coalesce(F.col("_p.d.results"), F.col("_p.value"), F.array().cast(T.ArrayType(record)))
    return p.select(F.explode(recs).alias("_r")).select("_r.*")


def drop_odata_metadata(df: DataFrame) -> DataFrame:
    """Drop the ``__metadata`` member."""
    return df.drop("__metadata")


def to_raw(df: DataFrame, rename: dict[str, str]) -> DataFrame:
    """S3: entity map -> RAW names; only mapped columns that exist; all text; /Date(ms)/ -> yyyyMMdd."""
    keep = [(src, dst) for src, dst in rename.items() if src in df.columns]
    return df.select(*[odata_to_yyyymmdd(F.col(src).cast("string")).alias(dst) for src, dst in keep])


# ------------------------------------------------------------------ S4-S8
def incremental_slice(df: DataFrame, field: str | None, watermark: str | None,
                      static_filter: Column | None = None, full_load: bool = False) -> DataFrame:
    """``field > watermark`` AND static filter; full load or no watermark reads everything."""
    out = df
    if field and watermark and not full_load:
        out = out.where(F.col(field) > F.lit(watermark).cast("timestamp"))
    if static_filter is not None:
        out = out.where(static_filter)
    return out


def decode_odata_ms(c) -> Column:
    """``/Date(ms[+off])/`` -> timestamp (UTC), NULL when not an OData date."""
    ms = F.regexp_extract(c, r"^/Date\((-?[0-9]+)", 1)
    return F.when(ms != "", F.timestamp_millis(ms.cast("bigint")))


def next_watermark(df: DataFrame, field: str, mode: str = "max", previous: str | None = None,
                   run_ts: str | None = None) -> DataFrame:
    """The next high-water mark as a one-row frame ``(watermark)``.

    * ``run_ts``: the run's timestamp (first extractor).
    * ``max``: the largest change time seen (decoded from ``/Date(ms)/`` text
      when needed); unchanged when the slice is empty; a missing / '0' /
      empty previous state counts as 1970-01-01.
    """
    prev = previous if previous not in (None, "", "0") else EPOCH_WATERMARK
    spark = df.sparkSession
    if mode == "run_ts":
        return spark.createDataFrame([(run_ts,)], "watermark string").select(
            F.col("watermark").cast("timestamp").alias("watermark"))
    c = F.col(field)
    dec = decode_odata_ms(c) if isinstance(df.schema[field].dataType, T.StringType) else c.cast("timestamp")
    return df.agg(F.max(dec).alias("_m")).select(
        F.coalesce(F.col("_m"), F.lit(prev).cast("timestamp")).alias("watermark"))


class Extraction:
    """S4-S7 with stored state: slices of a source, landed in a committed table together with the watermark.

    A slice and the watermark after it are one version of the table, so a run
    that stops before it is published has done nothing, and one that is
    repeated finds its slice there: none is skipped and none lands twice.
    ``most`` bounds a slice to about that many of the oldest changes; rows
    that changed at the same time as the last of them belong to it too, so
    the next slice can begin after that time.
    """

    def __init__(self, spark: SparkSession, root: str, field: str, keep: int = 2):
        self.spark, self.root, self.field, self.keep = spark, root, field, keep

    def watermark(self) -> str | None:
        found = live(self.spark, self.root)
        return found.state.get("watermark") if found else None

    def read(self) -> DataFrame | None:
        found = live(self.spark, self.root)
        return found.read(self.spark, self.root) if found else None

    def run(self, number: int, source: DataFrame, most: int | None = None, static_filter: Column | None = None, full_load: bool = False) -> bool:
        """Land the next slice of ``source`` as run ``number``; False if that run has been published."""
        def write(base, folder: str) -> tuple:
            mark = base.state.get("watermark") if base else None
            rows = incremental_slice(source, self.field, mark, static_filter, full_load)
            if most is not None:
                last = rows.select(self.field).where(F.col(self.field).isNotNull()).orderBy(self.field).limit(most).agg(F.max(self.field)).first()[0]
                rows = rows.where(F.col(self.field) <= F.lit(last)) if last is not None else rows.limit(0)
            rows.write.parquet(f"{self.root}/{folder}")
            landed = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")
            after = next_watermark(landed, self.field, previous=mark).first()[0]  # of what has landed, not of the source again
            files = [] if full_load or not base else list(base.files)
            return rows.schema, [*files, File(folder)], {"watermark": f"{after:%Y-%m-%d %H:%M:%S.%f}"}

        return attempts(self.spark, self.root, f"run{number}", write, self.keep)


def take_oldest(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Stable 'oldest changes first, top N' slice (page size is the feature)."""
    return df.orderBy(*order).limit(n)


def items_of(headers: DataFrame, items: DataFrame, key: str = "SalesOrder") -> DataFrame:
    """The items of exactly the selected headers, as one semi-join (no per-order loop)."""
    return items.join(headers.select(key).distinct(), key, "left_semi")


def run_entities(catalog: list[dict], reader: Callable[[dict], DataFrame],
                 writer: Callable[[dict, DataFrame], int]) -> list[dict]:
    """Run every entity; one failing entity is reported as ERROR, the others go on."""
    out = []
    for ent in catalog:
        try:
            df = to_raw(drop_odata_metadata(reader(ent)), ent["rename"])
            rows = writer(ent, df)
            out.append({"entity": ent["name"], "status": "OK", "rows": rows})
        except (AnalysisException, OSError, ValueError, KeyError) as e:
            out.append({"entity": ent["name"], "status": "ERROR", "error": str(e)})
    return out


# ------------------------------------------------------------------ S9, S10, S20, S22
def write_raw_partitioned(df: DataFrame, path: str, run_ts: datetime, mode: str = "append") -> None:
    """Hive layout ``entity/year=/month=/day=`` of the run date."""
    (df.withColumn("year", F.lit(f"{run_ts:%Y}")).withColumn("month", F.lit(f"{run_ts:%m}"))
       .withColumn("day", F.lit(f"{run_ts:%d}"))
       .write.mode(mode).partitionBy("year", "month", "day").parquet(path))


def with_lineage(df: DataFrame, entity: str, run_ts: datetime) -> DataFrame:
    stamp = f"{run_ts:%Y%m%d_%H%M%S}"
    return (df.withColumn("_SOURCE_FILE", F.lit(f"{entity}/{entity}_{stamp}.parquet"))
              .withColumn("_EXTRACTED_AT", F.lit(run_ts.isoformat())))


def write_landing(df: DataFrame, base: str, entity: str, run_ts: datetime) -> str:
    """Run-stamped landing folder with lineage columns."""
    stamp = f"{run_ts:%Y%m%d_%H%M%S}"
    path = f"{base}/{entity}/{entity}_{stamp}"
    with_lineage(df, entity, run_ts).write.mode("overwrite").parquet(path)
    return path


def export_csv(tables: dict[str, DataFrame], base: str) -> DataFrame:
    """Distributed CSV export (header) + a (table, rows) report; no driver collect.

    The rows are counted while they are written, so the report holds whatever
    the values contain (line breaks, quotes); quotes are doubled and texts
    with line breaks quoted, for readers with ``multiLine``.
    """
    spark = None
    counts = []
    for name, df in tables.items():
        spark = df.sparkSession
        seen = Observation(f"export {name}")
        (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
           .option("header", True).option("escape", '"').csv(f"{base}/{name}"))
        counts.append((name, seen.get["rows"]))
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def overwrite(df: DataFrame, path: str) -> None:
    """Create-or-replace a table folder (never a path the same plan reads)."""
    df.write.mode("overwrite").parquet(path)


# ------------------------------------------------------------------ S14-S16, S18
def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Schema evolution; new columns appear, older rows get NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def rescue(df: DataFrame, expected: T.StructType, col: str = "_rescued_data") -> DataFrame:
    """Unexpected columns and values that do not parse into the expected
    type are packed as JSON into ``_rescued_data`` (NULL when clean)."""
    exp = {f.name: f for f in expected.fields}
    extra = [c for c in df.columns if c not in exp and c != col]
    bad_parts = []
    out = []
    for f in expected.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(src.cast("string").alias(f.name))
            continue
        parsed = src.try_cast(f.dataType)
        out.append(parsed.alias(f.name))
        bad_parts.append((f.name, F.when(src.isNotNull() & parsed.isNull(), src.cast("string"))))
    pairs = [(c, F.col(c).cast("string")) for c in extra] + bad_parts
    if pairs:
        m = F.map_filter(F.create_map(*[x for name, v in pairs for x in (F.lit(name), v)]),
                         lambda k, v: v.isNotNull())
        rescued = F.when(F.size(m) > 0, F.to_json(m))
    else:
        rescued = F.lit(None).cast("string")
    return df.select(*out, rescued.alias(col))


def copy_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Load by column name, case-insensitive; missing -> NULL, extra ignored, lenient cast."""
    lower = {c.lower(): c for c in df.columns}
    out = []
    for f in target.fields:
        src = lower.get(f.name.lower())
        v = F.col(src).try_cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        out.append(v.alias(f.name))
    return df.select(*out)


def load_history(df: DataFrame, file_col: str = "_SOURCE_FILE", ts_col: str = "_LOADED_AT") -> DataFrame:
    """Rows and first/last load per landed file."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("ROW_COUNT"), F.min(ts_col).alias("FIRST_LOAD"),
                                    F.max(ts_col).alias("LAST_LOAD"))
