"""Merge family (M1-M12) as pure functions ``(target, source) -> new target``.

There is no transactional table format in the runtime, so a MERGE is
expressed as relational algebra over the two frames and the caller commits
the result as a new snapshot (``saleswh.operators.commit``).  All joins are
on the natural key; both sides shuffle on that key once, and a target
written ``repartition(key)``/bucketed by key avoids the target-side
shuffle on the next run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.functions.sap import any_changed, fingerprint, quarantine_key
from saleswh.operators.windows import surrogate


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def merge_upsert(tgt: DataFrame, src: DataFrame, keys, update: Sequence[str] | None = None,
                 insert: bool = True) -> DataFrame:
    """M1/M2: ``MERGE ... WHEN MATCHED UPDATE SET <update> WHEN NOT MATCHED INSERT``.

    ``update=None`` updates every non-key column.  Source must hold at most
    one row per key (callers dedup with W1 first).  NULL keys never match,
    as in SQL.  Output has the target's columns.

    Plan: one full outer equi-join on the natural key (one shuffle per side);
    each output column picks its side by which of the two rows is there.
    """
    keys = _names(keys)
    cols = tgt.columns
    types = {f.name: f.dataType for f in tgt.schema.fields}
    upd = {c for c in cols if c not in keys} if update is None else set(update)
    s = src.select(*[(F.col(c) if c in src.columns else F.lit(None)).cast(types[c]).alias(f"_s_{c}") for c in cols],
                   F.lit(True).alias("_src"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_s_{k}"))
    j = tgt.withColumn("_tgt", F.lit(True)).join(s, cond, "full_outer")
    if not insert:
        j = j.where("_tgt")
    both = F.col("_tgt").isNotNull() & F.col("_src").isNotNull()
    return j.select(*[
        F.when(F.col("_tgt").isNull() | (both if c in upd else F.lit(False)), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        for c in cols])


def merge_insert(tgt: DataFrame, src: DataFrame, keys) -> DataFrame:
    """Insert-only merge; existing keys are never touched."""
    keys = _names(keys)
    new = src.join(tgt.select(*keys), keys, "left_anti")
    return tgt.unionByName(new.select(*tgt.columns))


def with_sentinel(dim: DataFrame, sentinel: DataFrame, key: str) -> DataFrame:
    """Idempotent seeding of the 'unknown' member (M3 with a 1-row source)."""
    return merge_insert(dim, sentinel, [key])


def assign_keys(new_rows: DataFrame, tgt: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """M8: identity replacement, ``max(name) of tgt + dense rank`` over the new rows only.

    The maximum is a one-row aggregate; its value is read once, before the
    new rows are numbered from it.
    """
    top = tgt.agg(F.max(name)).first()[0] or 0
    return surrogate(new_rows, order, name, start=top)


def scd2(tgt: DataFrame, src: DataFrame, key: str, attrs: Sequence[str], as_of: str,
         mode: str = "close_and_insert", open_end: str | None = "9999-12-31 00:00:00",
         sk: str | None = None, hash_col: str | None = None,
         valid_from_col: str | None = None,
         cols: tuple = ("ValidFrom", "ValidTo", "IsCurrent")) -> DataFrame:
    """M4/M5: slowly changing dimension type 2.

    * ``close_only`` (M4): a changed current row is closed (ValidTo=as_of,
      IsCurrent=false) and *no* new version is inserted in this run; keys
      without a current row are inserted.
    * ``close_and_insert`` (M5): changed rows are closed and their new
      version inserted in the same run.

    The change test is ``hash_col <>`` when given (row-hash SCD), else a
    null-safe compare of ``attrs``.  ``sk`` names a surrogate column that
    new rows receive as ``max(sk) + rank by key``.  ``src`` holds one row
    per key.
    """
    vf, vt, cur = cols
    ts = F.lit(as_of).cast("timestamp")
    end = F.lit(open_end).cast("timestamp") if open_end else F.lit(None).cast("timestamp")
    current = tgt.where(F.col(cur))
    history = tgt.where(~F.col(cur))
    payload_cols = [key] + list(attrs) + ([hash_col] if hash_col and hash_col not in attrs else [])
    s = src.select(*payload_cols,
                   *([F.col(valid_from_col).alias("_vf")] if valid_from_col else [])).alias("s")
    c = current.alias("c")
    j = c.join(s, F.col(f"c.{key}") == F.col(f"s.{key}"), "left")
    if hash_col:
        changed = F.col(f"s.{key}").isNotNull() & (F.col(f"c.{hash_col}") != F.col(f"s.{hash_col}"))
    else:
        changed = F.col(f"s.{key}").isNotNull() & any_changed(
            [(F.col(f"c.{a}"), F.col(f"s.{a}")) for a in attrs])
    kept = j.select(*[
        (F.when(changed, ts).otherwise(F.col(f"c.{vt}")).alias(vt) if n == vt else
         F.when(changed, F.lit(False)).otherwise(F.col(f"c.{cur}")).alias(cur) if n == cur else
         F.col(f"c.{n}"))
        for n in tgt.columns])
    if mode == "close_only":
        # inserts: source keys without any current row before this run
        new = src.join(current.select(key), key, "left_anti")
    elif mode == "close_and_insert":
        still = kept.where(F.col(cur)).select(key)
        new = src.join(still, key, "left_anti")
    else:
        raise ValueError(mode)
    vf_expr = F.coalesce(F.col(valid_from_col), ts) if valid_from_col else ts
    ins = new.select(*payload_cols, vf_expr.alias(vf), end.alias(vt), F.lit(True).alias(cur))
    if sk:
        ins = assign_keys(ins, tgt, sk, [key])
    for n, f in zip(tgt.columns, tgt.schema.fields):
        if n not in ins.columns:
            ins = ins.withColumn(n, F.lit(None).cast(f.dataType))
    ins = ins.select(*[F.col(n).cast(f.dataType).alias(n) for n, f in zip(tgt.columns, tgt.schema.fields)])
    return history.unionByName(kept).unionByName(ins)


def merge_quarantine(tgt: DataFrame, src: DataFrame) -> DataFrame:
    """M7: idempotent quarantine; a known (entity, id, rule, payload) only
    gets a new timestamp, anything else is inserted with a deterministic key.
    """
    ident = ["SourceEntity", "RecordIdentifier", "FailedRule", "_fp"]
    t = tgt.withColumn("_fp", fingerprint("RawRecord"))
    s = (src.withColumn("_fp", fingerprint("RawRecord"))
            .withColumn("QuarantineKey", quarantine_key(F.col("SourceEntity"), F.col("RecordIdentifier"),
                                                        F.col("FailedRule"), F.col("RawRecord"))))
    # NULL-safe identity: RecordIdentifier is never NULL (coalesced upstream)
    out = merge_upsert(t, s, ident, update=["IngestionTimestamp"])
    return out.drop("_fp")


def check_constraints(df: DataFrame, table: str, pk: Sequence[str] = (),
                      not_null: Sequence[str] = (),
                      fks: Sequence[tuple] = ()) -> DataFrame:
    """Constraint violations as rows (table, constraint, kind, record_key, n).

    * NOT NULL: one row per column with the count of NULLs (if any).
    * PRIMARY KEY: one row per duplicated key with its multiplicity.
    * FOREIGN KEY ``(cols, parent_df, parent_cols)``: one row per orphan
      key value with its count (NULL child keys are not violations, as in SQL).
    """
    spark = df.sparkSession
    parts = []
    schema = "table_name string, constraint_name string, kind string, record_key string, n bigint"
    for c in not_null:
        parts.append(df.where(F.col(c).isNull())
                       .agg(F.count(F.lit(1)).alias("n"))
                       .where("n > 0")
                       .select(F.lit(table).alias("table_name"), F.lit(f"nn_{c}").alias("constraint_name"),
                               F.lit("NOT_NULL").alias("kind"), F.lit(None).cast("string").alias("record_key"),
                               F.col("n").cast("bigint")))
    if pk:
        parts.append(df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                       .select(F.lit(table).alias("table_name"), F.lit("pk").alias("constraint_name"),
                               F.lit("PRIMARY_KEY").alias("kind"),
                               F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in pk])
                                .alias("record_key"),
                               F.col("n").cast("bigint")))
    for i, (cols, parent, pcols) in enumerate(fks):
        cols, pcols = _names(cols), _names(pcols)
        child = df.select(*cols).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
        par = parent.select(*[F.col(p).alias(c) for p, c in zip(pcols, cols)]).distinct()
        orphans = child.join(par, cols, "left_anti")
        parts.append(orphans.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(table).alias("table_name"), F.lit(f"fk_{i}_{'_'.join(cols)}").alias("constraint_name"),
                             F.lit("FOREIGN_KEY").alias("kind"),
                             F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("record_key"),
                             F.col("n").cast("bigint")))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
