"""Reproducible N-row sample.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
its own top-n, the driver merges n x tasks rows.  n is the feature's
parameter (a fixed, small sample size), never a function of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def sample_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """O1: order + limit (top-k report)."""
    return df.orderBy(*order).limit(k)
