"""Loading landed files into a committed table (S11, S12, S14-S18): schema log and load ledger.

Every landed file is loaded once.  What a run does with it is one row of the
ledger (entity, file, size, rows, status, error, schema), which is published
in the same step as the rows.  A file that can't be read is reported there and
tried no more; the others go on.

The ledger is the schema log too: the schema of a file is read when it comes,
and never again.  The table's schema is that of its version, so no run opens
the footers of files that were loaded before.  New columns are added; a column
whose type grows (int to long, float to double, date to timestamp) is widened;
values of any other type are cast, and where a value does not fit, it is kept
as text in ``_rescued_data`` with the name of its column.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.operators.commit import File, Version, attempts, live
from saleswh.session import path_on
from saleswh.sources.odata import rescue

RESCUED, FILE = "_rescued_data", "_input_file_name"
LEDGER = "entity string, file string, size bigint, row_count bigint, status string, error string, schema string, loaded_at timestamp"
LOADED, ERROR = "LOADED", "ERROR"

#: Fixed order of number types: each holds all values of those before it.
_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, or None."""
    if a == b:
        return a
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    kinds = {type(a), type(b)}
    if kinds == {T.FloatType, T.DoubleType} or kinds <= {T.DoubleType, T.IntegerType, T.ShortType, T.ByteType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    return None


def evolved(table: T.StructType, new: T.StructType) -> T.StructType:
    """The table's columns, wider where a file needs it, then the file's new ones; what has no common type keeps the table's."""
    there = {f.name.lower(): f for f in table}
    incoming = {f.name.lower(): f for f in new}
    kept = [T.StructField(f.name, (wider(f.dataType, incoming[k].dataType) or f.dataType) if k in incoming else f.dataType) for k, f in there.items()]
    return T.StructType([*kept, *(T.StructField(f.name, f.dataType) for k, f in incoming.items() if k not in there)])


@dataclass
class Pipe:
    """Loads the files under ``src`` that match ``glob`` into the table at ``root``."""

    spark: SparkSession
    entity: str
    src: str
    root: str
    glob: str = "*.parquet"
    #: The table's columns before the first file; more come with the files.
    columns: T.StructType = T.StructType([])

    def ledger(self) -> DataFrame:
        found = live(self.spark, self.root)
        side = found.side(self.spark, self.root, "ledger") if found else None
        return self.spark.createDataFrame([], LEDGER) if side is None else side

    def read(self) -> DataFrame:
        return live(self.spark, self.root).read(self.spark, self.root)

    def landed(self) -> DataFrame:
        """(file, size) of the files that are there; listed by Spark's reader."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", self.glob).option("recursiveFileLookup", "true").load(self.src)
        return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))

    def _schemas(self, files: list[str]) -> Iterator[tuple[str, T.StructType | str]]:
        """The schema of each new file, or why it can't be read."""
        def one(file: str) -> tuple[str, T.StructType | str]:
            try:
                return file, self.spark.read.parquet(file).schema
            except (PySparkException, Py4JJavaError) as e:
                return file, str(e).splitlines()[0][:300]

        with ThreadPoolExecutor(8) as pool:
            yield from pool.map(one, files)

    def _frame(self, groups: dict[str, list[str]], table: T.StructType) -> DataFrame | None:
        """The rows of all files, group by group of one schema, in the table's columns."""
        out = None
        for schema, files in groups.items():
            rows = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*files)
            types = {f.name.lower(): f.dataType for f in table}
            # what has no common type with the table's goes by its text
            own = [F.col(f.name) if wider(types[f.name.lower()], f.dataType) else F.col(f.name).cast("string").alias(f.name)
                   for f in rows.schema if f.name not in (RESCUED, FILE)]
            named = rows.select(*own, F.col("_metadata.file_path").alias(FILE))
            marked = rescue(named, T.StructType([f for f in table if f.name != RESCUED]), RESCUED)
            out = marked if out is None else out.unionByName(marked)
        return out

    def _readable(self, schema: str, file: str) -> str | None:
        """None, or why the rows of a file can't be read."""
        try:
            self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(file).write.format("noop").mode("overwrite").save()
            return None
        except (PySparkException, Py4JJavaError) as e:
            return str(e).splitlines()[0][:300]

    def load(self, run: int, at: str) -> bool:
        """Load what has come since the last run; ``run`` numbers the runs, a repeated one does nothing."""
        def write(base: Version | None, folder: str) -> tuple:
            known = base.side(self.spark, self.root, "ledger") if base else None
            new = self.landed() if known is None else self.landed().join(known.select("file"), "file", "left_anti")
            sizes = {r["file"]: r["size"] for r in new.collect()}  # the files of this delivery
            bad, groups = {}, {}
            table = T.StructType.fromJson(json.loads(base.schema)) if base else T.StructType([*self.columns])
            table = T.StructType([f for f in table if f.name not in (RESCUED, FILE)])
            for file, schema in self._schemas(sorted(sizes)):
                if isinstance(schema, str):
                    bad[file] = schema
                else:
                    table = evolved(table, schema)
                    groups.setdefault(json.dumps(schema.jsonValue()), []).append(file)
            full = T.StructType([*table, T.StructField(FILE, T.StringType()), T.StructField(RESCUED, T.StringType())])
            files = list(base.files) if base else []
            counts = {}
            if groups:
                try:
                    counts = self._write(self._frame(groups, full), full, f"{folder}/rows")
                except (PySparkException, Py4JJavaError):  # a file with a sound footer and broken pages
                    for schema, some in groups.items():
                        bad |= {f: why for f in some if (why := self._readable(schema, f))}
                    groups = {s: left for s, some in groups.items() if (left := [f for f in some if f not in bad])}
                    if groups:
                        counts = self._write(self._frame(groups, full), full, f"{folder}/again")
                        files.append(File(f"{folder}/again"))
                else:
                    files.append(File(f"{folder}/rows"))
            schemas = {f: s for s, some in groups.items() for f in some}
            rows = [(self.entity, f, sizes[f], 0 if f in bad else counts.get(f, 0), ERROR if f in bad else LOADED, bad.get(f), schemas.get(f)) for f in sorted(sizes)]
            log = self.spark.createDataFrame(rows, LEDGER.rpartition(",")[0]).withColumn("loaded_at", F.lit(at).cast("timestamp"))
            log.coalesce(1).write.parquet(f"{self.root}/{folder}/ledger")
            paths = [*(base.sides["ledger"]["paths"] if base else []), f"{folder}/ledger"]
            return full, files, (base.state if base else {}), {"ledger": {"schema": json.dumps(log.schema.jsonValue()), "paths": paths}}

        return attempts(self.spark, self.root, f"run{run}", write)

    def _write(self, rows: DataFrame, schema: T.StructType, folder: str) -> dict[str, int]:
        """Write the rows; rows by file, one for each file of this delivery."""
        rows.select(*schema.names).write.mode("overwrite").parquet(f"{self.root}/{folder}")
        back = self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        return {r[FILE]: r["n"] for r in back.groupBy(FILE).agg(F.count(F.lit(1)).alias("n")).collect()}


def load_all(pipes: list[Pipe], run: int, at: str) -> list[dict]:
    """A run of every pipe; one that fails is reported and the others go on."""
    out = []
    for p in pipes:
        try:
            p.load(run, at)
            out.append({"entity": p.entity, "status": "OK"})
        except (PySparkException, Py4JJavaError, OSError, ValueError) as e:
            out.append({"entity": p.entity, "status": ERROR, "error": str(e)[:300]})
    return out


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A landed file of any content, in any store that Spark reads."""
    fs, target = path_on(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(data))
    out.close()
