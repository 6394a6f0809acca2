"""Change feeds (S19, T3): what changed between two versions of a committed table, applied to another table.

A reader's offset is part of the table it writes: the version it has consumed
is the batch number of its commit, published in one step with the rows.  A run
that is repeated, or stopped and started again, neither skips nor applies a
change twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.operators.commit import Keyed, versions
from saleswh.operators.merge import merge_upsert
from saleswh.operators.windows import latest
from saleswh.plans import staging


@dataclass(frozen=True)
class Entity:
    """How changes of a RAW entity reach its staging table."""

    raw_keys: Sequence[str]
    stage: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    #: Columns a change may set on a known key; the others keep their first-loaded values (M2).
    update: Sequence[str]


ENTITIES = {
    "sales_orders": Entity(["VBELN", "POSNR"], staging.stg_sales_orders, ["ORDER_ID", "ITEM_NO"], staging.ORDER_PROPAGATE_UPDATE),
    "billing": Entity(["VBELN", "POSNR"], staging.stg_billing, ["BILLING_ID", "ITEM_NO"], staging.BILLING_PROPAGATE_UPDATE),
    "customers": Entity(["KUNNR"], staging.stg_customers, ["CUSTOMER_ID"], staging.CUSTOMER_PROPAGATE_UPDATE),
}


def consumed(target: Keyed, reader: str) -> int | None:
    """The last version of its source that ``reader`` has applied to ``target``."""
    base = target.live()
    return base.done.get(reader) if base else None


def propagate(entity: Entity, changes: DataFrame, stg: DataFrame) -> DataFrame:
    """RAW rows -> STAGING: the latest change of each raw key (W1), cleaned (P1), merged on the cleaned key (M2).

    Every staging row of a matched key is updated, as a MERGE does.
    """
    return merge_upsert(stg, entity.stage(latest(changes, entity.raw_keys, ["_LOADED_AT"])), entity.keys, update=entity.update)


def follow(entity: Entity, raw: Keyed, target: Keyed, reader: str = "feed") -> int | None:
    """Apply what ``raw`` has gained since the reader's offset to ``target``; the version that it is at now.

    Of an update the row after it counts; a deleted RAW row changes nothing
    in staging, as RAW is a log.  Cleaned keys of several raw keys may be
    equal, the latest of them wins.
    """
    there = versions(raw.spark, raw.root)
    if not there:
        return None
    since = consumed(target, reader)
    if since is not None and since >= there[-1]:
        return since
    if since is not None and since < there[0]:
        raise ValueError(f"version {since} of {raw.root} is gone: keep more versions, or load {target.root} anew")
    new = raw.changes(since, there[-1]).where(F.col("_change").isin("insert", "update_after")).drop("_change")
    rows = latest(entity.stage(latest(new, entity.raw_keys, ["_LOADED_AT"])), entity.keys, ["_LOADED_AT"])
    target.merge(f"{reader}{there[-1]}", rows, update=entity.update)
    return there[-1]
