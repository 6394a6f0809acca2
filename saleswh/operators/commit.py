"""Committed tables: immutable files, a manifest for each version, optimistic commits.

A table is a folder.  ``v=<name>/<attempt>/`` holds files, which are never
written again; ``_published/<number>`` is the manifest of a version: its files
with their key ranges and row counts, the schema, the version it was built on,
and the last batch of every writer.  The highest number is the live version.

Publishing is a compare-and-set.  A writer that read version n writes its
manifest under another name and renames it to n + 1; the rename does not
replace, so of several writers only one gets the number, and the others build
their result again on the version that won.  (HDFS does that rename in one
step, as Spark's own stream logs rely on; within one driver a lock stands in
where a store has no such rename.)  What an attempt has written that was not
published is never read, so a stopped commit leaves no trace and its replay
does the work again; a batch that was published before is a no-op.

``commit`` and ``commit_on`` replace a whole table.  ``Keyed`` rewrites only
the files that the keys of a batch touch: rows are dealt to buckets, every file
has one bucket and a range of its first key, and a batch reads and rewrites
those files of its buckets whose range it overlaps.  Others stay as they are.

All paths go through Hadoop's file systems, so a root in any store that Spark
reads works, and nothing touches the driver's own disk.  The driver holds
manifests (a few dozen bytes a file), never rows.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.session import checkpoint_dir, path_on

PUBLISHED = "_published"
#: Versions that stay: the live one and the one before it, which a plan may still be reading.
KEPT_VERSIONS = 2
#: Codec of written tables: about two thirds of the bytes of the default.
CODEC = "zstd"
_LOCK = threading.RLock()


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, in a form that the optimizer knows as empty: a merge into it is planned without a join or shuffle."""
    return spark.createDataFrame([], schema).limit(0)


# ------------------------------------------------------------------ versions
@dataclass(frozen=True)
class File:
    """A folder of Parquet files with its bucket, rows, and least and greatest first key (None: no range is known)."""

    path: str
    bucket: int | None = None
    rows: int | None = None
    low: str | int | None = None
    high: str | int | None = None


@dataclass(frozen=True)
class Version:
    number: int
    name: str
    schema: str
    files: tuple[File, ...]
    done: dict[str, int]
    #: Small values that are published with the rows (a watermark), and tables that are: name -> schema and folders.
    state: dict[str, str] = field(default_factory=dict)
    sides: dict[str, dict] = field(default_factory=dict)

    def side(self, spark: SparkSession, root: str, name: str) -> DataFrame | None:
        found = self.sides.get(name)
        return found and spark.read.schema(T.StructType.fromJson(json.loads(found["schema"]))).parquet(*(f"{root}/{p}" for p in found["paths"]))

    def paths(self) -> list[str]:
        return [f.path for f in self.files] + [p for s in self.sides.values() for p in s["paths"]]

    def holds(self, name: str) -> bool:
        writer, batch = _batch(name)
        return self.done.get(writer, -1) >= batch

    def read(self, spark: SparkSession, root: str, files: Iterable[File] | None = None) -> DataFrame:
        """The version's rows, or those of some of its files; the schema comes from the manifest, no footer is opened for it."""
        schema = T.StructType.fromJson(json.loads(self.schema))
        paths = [f"{root}/{f.path}" for f in (self.files if files is None else files)]
        return spark.read.schema(schema).parquet(*paths) if paths else empty(spark, schema)


def _batch(name: str) -> tuple[str, int]:
    """Writer and batch number of a version's name: ``h12`` is batch 12 of ``h``."""
    writer, digits = re.fullmatch(r"(.*?)(\d*)", str(name)).groups()
    return writer, int(digits or 0)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests that are there, ascending."""
    fs, path = path_on(spark, f"{root}/{PUBLISHED}")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def version(spark: SparkSession, root: str, number: int) -> Version:
    fs, path = path_on(spark, f"{root}/{PUBLISHED}/{number:012d}")
    stream = fs.open(path)
    try:
        raw = bytes(stream.readAllBytes())
    finally:
        stream.close()
    found = json.loads(raw)
    return Version(number, found["name"], found["schema"], tuple(File(**f) for f in found["files"]), found["done"], found["state"], found["sides"])


def _known(spark: SparkSession, root: str, number: int) -> Version | None:
    """The version, or None if another writer has cleaned it away meanwhile."""
    try:
        return version(spark, root, number)
    except Py4JJavaError as e:
        if "FileNotFound" not in e.java_exception.getClass().getName():
            raise
        return None


def live(spark: SparkSession, root: str) -> Version | None:
    while numbers := versions(spark, root):
        if found := _known(spark, root, numbers[-1]):
            return found
    return None


def _publish(spark: SparkSession, root: str, new: Version) -> bool:
    """Make ``new`` live unless another version has taken its number."""
    body = {"name": new.name, "schema": new.schema, "files": [asdict(f) for f in new.files], "done": new.done, "state": new.state, "sides": new.sides}
    fs, draft = path_on(spark, f"{root}/{PUBLISHED}/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(body).encode()))
    out.close()
    _, target = path_on(spark, f"{root}/{PUBLISHED}/{new.number:012d}")
    context = spark.sparkContext
    options = context._gateway.new_array(context._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = context._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), context._jsc.hadoopConfiguration())
    with _LOCK:
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            fs.delete(draft, False)
            return False


def _clean(spark: SparkSession, root: str, new: Version, keep: int) -> None:
    """Drop manifests before the last ``keep`` versions, and the files that only they name."""
    numbers = [n for n in versions(spark, root) if n <= new.number]
    old = [v for n in numbers[:-keep] if (v := _known(spark, root, n))]
    kept = [_known(spark, root, n) for n in numbers[-keep:]]
    if not old or None in kept:  # a later writer cleans, and knows more
        return
    needed = {p for v in kept for p in v.paths()}
    folders = {p.split("/")[0] for p in needed}
    gone = {p for v in old for p in v.paths()} - needed
    for name in {p if p.split("/")[0] in folders else p.split("/")[0] for p in gone}:
        fs, path = path_on(spark, f"{root}/{name}")
        fs.delete(path, True)
    for v in old:
        fs, path = path_on(spark, f"{root}/{PUBLISHED}/{v.number:012d}")
        fs.delete(path, False)


def attempts(spark: SparkSession, root: str, name: str, write: Callable[[Version | None, str], tuple], keep: int = KEPT_VERSIONS) -> bool:
    """Build on the live version, publish, and build again if another version came first; False if ``name`` is in already.

    ``write(base, folder)`` writes below ``<root>/<folder>`` and returns the new version's schema and files, and, if
    they change, its state and side tables.
    """
    while True:
        base = live(spark, root)
        if base and base.holds(name):
            return False
        folder = f"v={name}/{uuid.uuid4().hex}"
        try:
            schema, files, *more = write(base, folder)
        except Exception:
            now = live(spark, root)
            if base is None or now is None or now.number == base.number:
                raise
            continue  # the files it read may have gone with their version
        writer, batch = _batch(name)
        done = {**(base.done if base else {}), writer: batch}
        state, sides = [*more, *((base.state, base.sides) if base else ({}, {}))[len(more):]]
        new = Version(base.number + 1 if base else 0, f"v={name}", json.dumps(schema.jsonValue()), tuple(files), done, state, sides)
        if _publish(spark, root, new):
            _clean(spark, root, new, keep)
            return True
        fs, path = path_on(spark, f"{root}/{folder}")
        fs.delete(path, True)


# ------------------------------------------------------------------ whole tables
def current_version(spark: SparkSession, root: str) -> str | None:
    found = live(spark, root)
    return found.name if found else None


def read_table(spark: SparkSession, root: str, empty: DataFrame | None = None) -> DataFrame | None:
    found = live(spark, root)
    return found.read(spark, root) if found else empty


def commit_on(spark: SparkSession, root: str, name: int | str, build: Callable[[DataFrame | None], DataFrame], keep: int = KEPT_VERSIONS) -> bool:
    """Replace the table by ``build(rows of the live version, or None)`` as version ``name``; False if it was published before.

    ``build`` is called again on the new live version if another writer published in between.
    """
    def write(base: Version | None, folder: str) -> tuple[T.StructType, list[File]]:
        df = build(base.read(spark, root) if base else None)
        df.write.option("compression", CODEC).parquet(f"{root}/{folder}")
        return df.schema, [File(folder)]

    return attempts(spark, root, str(name), write, keep)


def commit(df: DataFrame, root: str, version: int | str, keep: int = KEPT_VERSIONS) -> bool:
    """Replace the table by ``df``, which must not depend on what other writers of the table do (else: ``commit_on``)."""
    return commit_on(df.sparkSession, root, version, lambda _: df, keep)


# ------------------------------------------------------------------ tables with keys
def order_ranges(column: str, span: int, buckets: int) -> Column:
    """Buckets for keys that are numbers as text, in order of time: ``span`` consecutive numbers share one, so a batch of
    recent keys touches few.  Other texts are dealt by hash."""
    number = F.expr(f"try_cast({column} AS DECIMAL(38,0))")
    return F.coalesce(F.pmod(F.floor(number / span), F.lit(buckets)).cast("int"), F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))


class Keyed:
    """A committed table whose merges rewrite the files that the keys of a batch touch (``append``: none).

    ``bucket`` is a column of the keys with values from 0 to ``buckets`` - 1; it
    must not change while the table lives.  ``buckets`` should make a bucket a
    few hundred MB: a merge reads the touched files and a task writes at least
    one bucket (more tasks a large one, by AQE's rebalancing).  A batch that
    does not reach into the key range of a file leaves it alone and puts a file
    of its own beside it; from ``files`` of them on a bucket is written anew.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, keys: Sequence[str], buckets: int = 32,
                 bucket: Column | None = None, files: int = 8, keep: int = KEPT_VERSIONS):
        self.spark, self.root, self.keys, self.files, self.keep = spark, root, list(keys), files, keep
        self.schema = spark.createDataFrame([], schema).schema
        self.bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int") if bucket is None else bucket

    def live(self) -> Version | None:
        return live(self.spark, self.root)

    def read(self, number: int | None = None) -> DataFrame:
        found = self.live() if number is None else version(self.spark, self.root, number)
        return found.read(self.spark, self.root) if found else empty(self.spark, self.schema)

    def _ranges(self, rows: DataFrame) -> dict[int, tuple]:
        """bucket -> (rows, least, greatest first key): a row for each bucket comes to the driver."""
        first = F.col(self.keys[0])
        found = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("low"), F.max(first).alias("high")).collect()
        return {r["_bucket"]: (r["n"], r["low"], r["high"]) for r in found}

    @staticmethod
    def _overlaps(f: File, ranges: dict[int, tuple]) -> bool:
        if f.bucket not in ranges:
            return False
        _, low, high = ranges[f.bucket]
        if not all(isinstance(x, (str, int)) for x in (low, high, f.low, f.high)):
            return True
        return f.low <= high and low <= f.high

    def matching(self, keys: DataFrame) -> tuple[DataFrame, list[File]]:
        """The rows of all files that may hold a key of ``keys`` (which has the key columns), and these files."""
        base = self.live()
        if base is None:
            return empty(self.spark, self.schema), []
        ranges = self._ranges(keys.select(*self.keys).withColumn("_bucket", self.bucket))
        files = [f for f in base.files if self._overlaps(f, ranges)]
        rows = base.read(self.spark, self.root, files)
        bounds = [(low, high) for _, low, high in ranges.values() if low is not None]
        if bounds:  # reaches the scan: row groups outside are skipped
            first = F.col(self.keys[0])
            rows = rows.where((first >= F.lit(min(b[0] for b in bounds))) & (first <= F.lit(max(b[1] for b in bounds))))
        return rows, files

    def merge(self, name: str, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
              update: Sequence[str] | None = None, append: bool = False) -> bool:
        """Merge ``rows`` (one for each key) as batch ``name``; False if it was merged before.

        ``combine(old rows of the touched files, rows)`` gives their new rows;
        by default known keys are updated (``update``: these columns only) and
        others inserted.  With ``append`` the rows are put beside what is
        there, whatever their keys: the table is a log then, and columns that
        are new in ``rows`` are added to it (older rows have NULL there).
        """
        from saleswh.operators.merge import merge_upsert

        spark, before = self.spark, self.live()
        if before and before.holds(name):
            return False
        if append:  # no file is read or compared: rows are written once, into the table

            def put(base: Version | None, folder: str) -> tuple[T.StructType, list[File]]:
                return self._grown(base), [*(base.files if base else ()), *self._write(rows, folder, self._grown(base))]

            return attempts(spark, self.root, name, put, self.keep)
        rows = materialize(rows.withColumn("_bucket", self.bucket), "merge")
        ranges, batch = self._ranges(rows), rows.drop("_bucket")

        def write(base: Version | None, folder: str) -> tuple[T.StructType, list[File]]:
            files = list(base.files) if base else []
            many = {b for b in ranges if sum(f.bucket == b for f in files) >= self.files}
            touched = [f for f in files if f.bucket in many or self._overlaps(f, ranges)]
            old = base.read(spark, self.root, touched) if base else empty(spark, self.schema)
            new = combine(old, batch) if combine else merge_upsert(old, batch, self.keys, update)
            return self.schema, [f for f in files if f not in touched] + self._write(new, folder, self.schema)

        return attempts(spark, self.root, name, write, self.keep)

    def append(self, name: str, rows: DataFrame) -> bool:
        return self.merge(name, rows, append=True)

    def _grown(self, base: Version | None) -> T.StructType:
        """The columns of the table and those of this object's schema that it lacks."""
        known = list(T.StructType.fromJson(json.loads(base.schema))) if base else []
        return T.StructType([*known, *(f for f in self.schema if f.name not in {k.name for k in known})])

    def _write(self, rows: DataFrame, folder: str, schema: T.StructType) -> list[File]:
        """Write rows by bucket, and read back what range of keys each bucket has got."""
        path = f"{self.root}/{folder}"
        rows = rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        rows.withColumn("_bucket", self.bucket).hint("rebalance", F.col("_bucket")).write.option("compression", CODEC).partitionBy("_bucket").parquet(path)
        written = self.spark.read.schema(T.StructType([*schema, T.StructField("_bucket", T.IntegerType())])).parquet(path)
        return [File(f"{folder}/_bucket={b}", b, n, *((low, high) if isinstance(low, (str, int)) else (None, None)))
                for b, (n, low, high) in sorted(self._ranges(written).items())]

    def changes(self, since: int | None, upto: int) -> DataFrame:
        """Rows that changed between two versions (``since`` None: the empty table), with ``_change``: insert, update_before,
        update_after or delete.

        Only files that one of them names alone are read, so rows that were
        rewritten unchanged are compared and left out.
        """
        new = version(self.spark, self.root, upto)
        old = version(self.spark, self.root, since) if since is not None else Version(-1, "", new.schema, (), {})
        before = old.read(self.spark, self.root, [f for f in old.files if f not in new.files])
        after = new.read(self.spark, self.root, [f for f in new.files if f not in old.files])
        if all(f in new.files for f in old.files):
            return after.withColumn("_change", F.lit("insert"))
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}"))
        a, b = after.select(F.struct("*").alias("a")), before.select(F.struct("*").alias("b"))
        j = b.join(a, same, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        kind = F.when(F.col("b").isNull(), F.array(F.struct(F.lit("insert").alias("_change"), F.col("a").alias("row")))) \
            .when(F.col("a").isNull(), F.array(F.struct(F.lit("delete").alias("_change"), F.col("b").alias("row")))) \
            .otherwise(F.array(F.struct(F.lit("update_before").alias("_change"), F.col("b").alias("row")),
                               F.struct(F.lit("update_after").alias("_change"), F.col("a").alias("row"))))
        return j.select(F.inline(kind)).select("row.*", "_change")


# ------------------------------------------------------------------ tables of one job
def _materialized(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/materialized/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared
    checkpoint folder (``spark.checkpoint.dir``) and reading it back.

    Unlike ``checkpoint()`` the re-read is a parquet scan, so later plans
    keep column pruning and filter pushdown on it.  The folder survives
    executor loss (it is the cluster's shared checkpoint location); it is
    the application's own, and ``drop_materialized`` deletes it when all
    results have been stored.
    """
    spark = df.sparkSession
    path = f"{_materialized(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete this application's materialised tables."""
    fs, path = path_on(spark, _materialized(spark))
    fs.delete(path, True)
