"""Tables that a job writes between its steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The struct that holds columns an operator does not use, whatever their names.
CARRIED = "carried"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a scratch folder, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet and read again.

    Cuts the lineage: a lost executor is made up for from these files.  They
    stay until the job deletes its folder (``drop_tables``).
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def replaced(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``new`` written; then ``old``, a table that ``written`` returned and that only ``new`` has read, is deleted."""
    out = written(new, name)
    context = old.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(old.inputFiles()[0]).getParent()
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    return out


def apart(docs: DataFrame, needs: Sequence[str]) -> DataFrame:
    """The columns ``needs`` of ``docs``, and all others in one struct, so that none of them can clash with an operator's own."""
    own, others = [c for c in docs.columns if c in needs], [F.col(f"`{c}`") for c in docs.columns if c not in needs]
    return docs.select(*own, *([F.struct(*others).alias(CARRIED)] if others else []))


def together(rows: DataFrame, like: DataFrame, needs: Sequence[str]) -> DataFrame:
    """The columns of ``like`` again, from rows that come from ``apart(like, needs)``."""
    return rows.select(*(F.col(c) if c in needs else F.col(f"{CARRIED}.`{c}`").alias(c) for c in like.columns))


def drop_tables(spark: SparkSession) -> None:
    """Delete what ``written`` has left; call it when all results have been stored."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once for each application."""
    import zipfile
    from pathlib import Path

    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    name = f"{root.name}_source.zip"
    if name not in context._python_includes:
        file = Path(tempfile.mkdtemp(prefix="ship-")).resolve() / name
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        context.addPyFile(str(file))
