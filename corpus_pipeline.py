"""The corpus pipeline: documents through quality rules, near-dedup, substring dedup, decontamination and packing.

Every stage reads what its predecessor has written and returns a DataFrame;
all but the last return the columns of ``documents``, also columns of its own
that are named like those of an operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.llm import decontaminate, packing, quality, simhash, substrings
from saleswh.llm.queries import table
from saleswh.llm.tables import ship, written


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; no other column changes."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    ship(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links, that of the smallest id."""
    ship(spark)
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the words of windows that start in a document with a smaller id as well."""
    ship(spark)
    return _measured(substrings.cleaned(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated; what spans of items these have below the coverage limit go."""
    ship(spark)
    return _measured(decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences with their token ids."""
    ship(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("benchmark decontamination", benchmark_decontamination), ("packing", pack)]

#: Thresholds, fingerprints and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
