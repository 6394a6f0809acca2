"""Registered queries: name -> (Spark plan, DuckDB oracle SQL, inventory ids).

Every query reads the driver's tables (or frames Spark derives from them)
over their whole extent; outputs pass through ``conform`` so both engines
return the same column types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from saleswh.plans.output import conform
from saleswh.session import configure


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def query(name: str, ids: str = "", sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return conform(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, sql, tuple(i.strip() for i in ids.split(",") if i.strip()))
        return run
    return deco


def load_all() -> dict[str, Entry]:
    """Every registered query; importing the modules registers them."""
    from saleswh.plans import (queries_analytics, queries_batch, queries_dq, queries_sources,  # noqa: F401
                               queries_stream)
    return REGISTRY
