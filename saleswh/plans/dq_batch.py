"""Batch data-quality catalogue (Q11-Q21), quarantine and audit.

``run_dq_checks`` unions the rules' quarantine rows (a record may appear
under several rules).  The rules that look at one row only share one pass
(``rule_rows``); the uniqueness rule uses the skew-safe ``duplicates``
operator; the cross-consistency rule compares each billing row with the
smallest ordered quantity of its key, so it is quarantined once however many
copies its order has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saleswh.functions.sap import TAX_ID_RE, payload, quarantine_key
from saleswh.operators.commit import Keyed, materialize
from saleswh.operators.merge import merge_insert
from saleswh.operators.sizing import small
from saleswh.operators.windows import duplicates
from saleswh.plans.warehouse import Warehouse, fact_sales_orders_src

# The rule catalogue (id, name, type, target, description, severity).
DQ_RULES = [
    (1, "Fecha de documento obligatoria", "OBLIGATORIO", "STG_SALES_ORDERS", "ORDER_DATE IS NOT NULL", "ERROR"),
    (2, "Importe obligatorio y numérico", "OBLIGATORIO", "STG_SALES_ORDERS", "NET_AMOUNT IS NOT NULL", "ERROR"),
    (3, "Unicidad de clave orden+posición", "UNICIDAD", "STG_SALES_ORDERS", "(ORDER_ID, ITEM_NO) únicos", "ERROR"),
    (4, "Cliente existe en maestro", "INTEGRIDAD_REF", "STG_SALES_ORDERS", "CUSTOMER_ID en DIM_CUSTOMER", "ERROR"),
    (5, "Cantidad en rango razonable", "RANGO", "STG_SALES_ORDERS", "QUANTITY BETWEEN 0 AND 100000", "WARN"),
    (6, "RUC con formato válido (11 dígitos)", "FORMATO", "STG_CUSTOMERS", "TAX_ID REGEXP 11 dígitos", "WARN"),
    (7, "Factura ≤ cantidad de la orden", "CONSISTENCIA_CRUZADA", "STG_BILLING",
     "FKIMG <= KWMENG de la orden ref.", "WARN"),
]
DQ_RULES_SCHEMA = ("RULE_ID int, RULE_NAME string, RULE_TYPE string, TARGET_TABLE string, "
                   "RULE_SQL_DESC string, SEVERITY string")
PENDING = "PENDIENTE"
QTY_MIN, QTY_MAX = 0, 100000
CROSS_TOLERANCE = 1.05


def dq_rules(spark: SparkSession) -> DataFrame:
    """Q11: the rule catalogue as a literal frame."""
    return spark.createDataFrame(DQ_RULES, DQ_RULES_SCHEMA)


def _quarantine(df: DataFrame, rule_id: int | F.Column, source: str, key, detected_at: str) -> DataFrame:
    """Q10 (batch form): rule id, source table, record key, whole-row JSON payload (columns with ``_RULE`` are ours)."""
    rule = F.lit(rule_id) if isinstance(rule_id, int) else rule_id
    return df.select(rule.alias("RULE_ID"), F.lit(source).alias("SOURCE_TABLE"),
                     key.alias("RECORD_KEY"), payload(*[c for c in df.columns if c != "_RULE"]).alias("RECORD_PAYLOAD"),
                     F.lit(detected_at).cast("timestamp").alias("DETECTED_AT"),
                     F.lit(PENDING).alias("STATUS"))


def _order_key(prefix: str = "") -> F.Column:
    return F.concat(F.col(f"{prefix}ORDER_ID"), F.lit("-"), F.col(f"{prefix}ITEM_NO"))


def rule_rows(stg: DataFrame, as_of: str) -> DataFrame:
    """Q12, Q13, Q16 in one pass: order date and amount are mandatory, quantity lies in 0..100000 (NULL passes).

    Each row gets the ids of the rules it fails; one quarantine row for each.
    """
    q = F.col("QUANTITY")
    failed = F.array_compact(F.array(
        F.when(F.col("ORDER_DATE").isNull(), 1), F.when(F.col("NET_AMOUNT").isNull(), 2),
        F.when((q < QTY_MIN) | (q > QTY_MAX), 5)))
    bad = stg.select("*", F.explode(failed).alias("_RULE"))
    return _quarantine(bad, F.col("_RULE"), "STG_SALES_ORDERS", _order_key(), as_of)


def extra_copies(stg: DataFrame) -> DataFrame:
    """Copies of (order, item) beyond the earliest load."""
    return duplicates(stg, ["ORDER_ID", "ITEM_NO"], ["_LOADED_AT"])


def rule_unique(stg: DataFrame, as_of: str, extra: DataFrame | None = None) -> DataFrame:
    """Q14: extra copies of (order, item) beyond the earliest load; ``extra``: these, where they are known."""
    extra = extra_copies(stg) if extra is None else extra
    return _quarantine(extra, 3, "STG_SALES_ORDERS", _order_key(), as_of)


def rule_fk(stg: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """Customer not among the current ones (NULL key is an orphan too).

    Ids are looked up on their own, each once; whole rows are read only of those that are missing.
    """
    cur = customers.select("CUSTOMER_ID").distinct()
    missing = stg.select("CUSTOMER_ID").distinct().join(cur, "CUSTOMER_ID", "left_anti").select(F.col("CUSTOMER_ID").alias("_missing"))
    missing = small(materialize(missing, "missing_customers"))
    orphans = stg.join(missing, stg.CUSTOMER_ID.eqNullSafe(missing._missing), "left_semi")
    return _quarantine(orphans, 4, "STG_SALES_ORDERS", _order_key(), as_of)


def rule_format(stg_customers: DataFrame, as_of: str) -> DataFrame:
    """Q17: tax id must be 11 digits; NULL fails."""
    t = F.col("TAX_ID")
    bad = stg_customers.where(t.isNull() | ~t.rlike(TAX_ID_RE))
    return _quarantine(bad, 6, "STG_CUSTOMERS", F.col("CUSTOMER_ID"), as_of)


def cross_check(billing: DataFrame, orders: DataFrame, tol: float = CROSS_TOLERANCE) -> DataFrame:
    """Billing rows whose quantity exceeds an ordered quantity x tol on equal keys; each billing row once.

    A row exceeds some ordered quantity if it exceeds the smallest of its
    key, so the orders come as one aggregated row per key and the join can
    neither multiply rows nor pair up copies.
    """
    o = (orders.groupBy(F.col("ORDER_ID").alias("_oid"), F.col("ITEM_NO").alias("_oit"))
               .agg(F.min("QUANTITY").alias("_oq")))
    j = billing.join(o, (billing.REF_ORDER_ID == o._oid) & (billing.ITEM_NO == o._oit))
    return j.where(F.col("QUANTITY") > F.col("_oq") * F.lit(tol).cast("decimal(3,2)")).select(*billing.columns)


def rule_cross(stg_billing: DataFrame, stg_orders: DataFrame, as_of: str) -> DataFrame:
    """Q18: rule 7, billing vs order quantity with 5 % tolerance."""
    bad = cross_check(stg_billing, stg_orders)
    key = F.concat(F.col("BILLING_ID"), F.lit("-"), F.col("ITEM_NO"))
    return _quarantine(bad, 7, "STG_BILLING", key, as_of)


def run_dq_checks(wh: Warehouse, as_of: str | None = None, orders: DataFrame | None = None) -> DataFrame:
    """Q19: the whole catalogue as one quarantine frame (status PENDIENTE); ``orders``: the committed staging orders of a load."""
    as_of = as_of or wh.as_of
    so = wh.committed_sales_orders if orders is None else orders
    if orders is None and wh.order_copies is None:  # of one committed table: found once, however many runs check it
        wh.order_copies = materialize(extra_copies(so), "order_copies")
    parts = [rule_rows(so, as_of),
             rule_unique(so, as_of, wh.order_copies if orders is None else None),
             rule_fk(so, wh.stg_customers, as_of),  # all staged customers are current; no key is needed
             rule_format(wh.stg_customers, as_of),
             rule_cross(wh.stg_billing, so, as_of)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_quarantine_id(q: DataFrame) -> DataFrame:
    """F17 for the batch quarantine: deterministic id from (rule, key, payload)."""
    return q.withColumn("QUARANTINE_ID", quarantine_key(F.col("SOURCE_TABLE"), F.col("RECORD_KEY"),
                                                        F.col("RULE_ID").cast("string"),
                                                        F.col("RECORD_PAYLOAD")))


def merge_quarantine_batch(known: DataFrame, found: DataFrame) -> DataFrame:
    """§2.12 no. 16, batch form: a record already in quarantine under a rule stays as it was found first; only
    new (source, key, rule, payload) identities are added, each once."""
    new = with_quarantine_id(found).dropDuplicates(["QUARANTINE_ID"])
    return merge_insert(known, new.select(*known.columns), ["QUARANTINE_ID"])


def dq_dashboard(rules: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per rule the affected rows and last detection; 0-hit rules kept."""
    q = quarantine.groupBy("RULE_ID").agg(F.count(F.lit(1)).alias("_n"),
                                          F.max("DETECTED_AT").alias("ULTIMA_DETECCION"))
    j = rules.join(q, "RULE_ID", "left")
    return j.select("RULE_ID", "RULE_NAME", "RULE_TYPE", "SEVERITY",
                    F.coalesce(F.col("_n"), F.lit(0)).alias("REGISTROS_AFECTADOS"), "ULTIMA_DETECCION")


AUDIT = ("RUN_ID bigint, PIPELINE_NAME string, SOURCE_NAME string, STARTED_AT timestamp, FINISHED_AT timestamp, ROWS_READ bigint, "
         "ROWS_INSERTED bigint, ROWS_REJECTED bigint, STATUS string, DETAIL string")


class Audited:
    """Q21: what a load reads, inserts and rejects, observed by the jobs that write its results; nothing is counted again."""

    def __init__(self, pipeline: str, source: str, started_at: str, finished_at: str, detail: str = ""):
        self.pipeline, self.source, self.started_at, self.finished_at, self.detail = pipeline, source, started_at, finished_at, detail
        self.seen = {name: Observation() for name in ("read", "inserted", "rejected")}

    def observed(self, name: str, df: DataFrame, condition: Column | None = None) -> DataFrame:
        """``df``, whose rows (those of a condition) count as read, inserted or rejected when they are written."""
        return df.observe(self.seen[name], F.count(F.lit(1) if condition is None else F.when(condition, 1)).alias("n"))

    def row(self, spark: SparkSession, run_id: int) -> DataFrame:
        """The audit row, after the observed frames were written."""
        read, inserted, rejected = (int(self.seen[name].get["n"]) for name in ("read", "inserted", "rejected"))
        status = "ERROR" if read and not inserted else "WARN" if rejected else "OK"
        ts = [F.lit(x).cast("timestamp").alias(n) for n, x in (("STARTED_AT", self.started_at), ("FINISHED_AT", self.finished_at))]
        row = spark.createDataFrame([(run_id, self.pipeline, self.source, read, inserted, rejected, status, self.detail)],
                                    "RUN_ID bigint, PIPELINE_NAME string, SOURCE_NAME string, ROWS_READ bigint, ROWS_INSERTED bigint, ROWS_REJECTED bigint, "
                                    "STATUS string, DETAIL string")
        return row.select("RUN_ID", "PIPELINE_NAME", "SOURCE_NAME", *ts, "ROWS_READ", "ROWS_INSERTED", "ROWS_REJECTED", "STATUS", "DETAIL")

    def log(self, table: Keyed, run_id: int) -> None:
        """Append the row to the audit table; a repeated run leaves the row it has."""
        table.append(f"run{run_id}", self.row(table.spark, run_id))


def audit_table(spark: SparkSession, root: str) -> Keyed:
    return Keyed(spark, root, AUDIT, ["RUN_ID"], buckets=1)


def load_fact_audited(wh: Warehouse, as_of: str, audit: Audited, orders: DataFrame | None = None) -> DataFrame:
    """Write the order fact and the quarantine of a load; returns the fact.  Each is written once, by a job that counts."""
    staged = wh.committed_sales_orders if orders is None else orders
    fact = materialize(audit.observed("inserted", fact_sales_orders_src(audit.observed("read", staged), wh.lookups)), "fact_audited")
    rules = run_dq_checks(wh, as_of, staged)
    materialize(audit.observed("rejected", rules, F.col("SOURCE_TABLE") == "STG_SALES_ORDERS"), "quarantine_audited")
    return fact
