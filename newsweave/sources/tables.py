"""Tables that take updates by key, and dated output (SNK-2, SNK-3, SNK-6, J-3, J-8, J-9).

``KeyedTable``: rows are dealt into hash buckets of their key, each a folder of Parquet files. An
update rewrites only the buckets that hold a changed key, into a new folder, and then publishes a
manifest that names the folder of every bucket. Publishing is one rename that fails if the
version is there already, so a reader sees one version or the next, never a mix, and of two
writers one fails. The manifest also notes the last batch of every source: a repeated batch
changes nothing.

The manifest is small (one name per bucket); rows never pass the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Files:
    """The few file operations needed, on whatever file system a path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Create ``path`` with its whole content at once; an error if it exists."""
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self.path(tmp), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self.exists(path) or not self.fs.rename(self.path(tmp), self.path(path)):
            self.fs.delete(self.path(tmp), False)
            raise RuntimeError(f"{path} was written by another writer")


class KeyedTable:
    """A table of ``schema`` with rows found by ``keys``; ``buckets`` is fixed when it is made."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType, buckets: int = 64):
        self.spark, self.top, self.keys, self.schema = spark, path.rstrip("/"), keys, schema
        self.files = Files(spark, path)
        last = self.manifest()
        self.buckets = last["buckets"] if last else buckets

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.top}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        """The given or the last version's manifest; None before the first one."""
        if version is None:
            version = max(self.versions(), default=None)
        return None if version is None else json.loads(self.files.read(f"{self.top}/manifests/{version:012d}.json"))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, manifest: dict | None, only: set[int] | None = None) -> DataFrame:
        folders = manifest["folders"] if manifest else {}
        paths = [f"{self.top}/data/{f}/bucket={b}" for b, f in sorted(folders.items()) if only is None or int(b) in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of one version, by default the last."""
        return self._rows(self.manifest(version))

    def update(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], source: str = "", batch: int | None = None) -> bool:
        """Publish a version in which the buckets that hold a key of ``changes`` contain
        ``merge(stored rows of these buckets, changes)``, rows of the table's schema whose keys
        lie in these buckets. False, and no change, if ``batch`` of ``source`` or a later one is
        applied already. ``changes`` is read more than once: store it first if that is dear."""
        last = self.manifest()
        applied = dict(last["applied"]) if last else {}
        if batch is not None and applied.get(source, -1) >= batch:
            return False
        touched = {r["b"] for r in changes.select(self._bucket().alias("b")).distinct().collect()}  # one row per bucket at most
        folder = uuid.uuid4().hex
        rows = merge(self._rows(last, touched), changes).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        # a bucket too large for one file is split, small ones share a task
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.top}/data/{folder}")
        written = {int(n[7:]) for n in self.files.names(f"{self.top}/data/{folder}") if n.startswith("bucket=")}
        if not written <= touched:
            raise ValueError(f"merge gave rows of other keys than the changes (buckets {sorted(written - touched)})")
        folders = {b: f for b, f in (last["folders"] if last else {}).items() if int(b) not in touched} | {str(b): folder for b in written}
        if batch is not None:
            applied[source] = batch
        version = max(self.versions(), default=-1) + 1
        self.files.publish(f"{self.top}/manifests/{version:012d}.json", json.dumps({"buckets": self.buckets, "folders": folders, "applied": applied}))
        return True

    def vacuum(self, keep: int = 2) -> int:
        """Delete manifests but the last ``keep`` and data folders that none of them names;
        returns the number of folders. Not for use beside a running writer."""
        old, kept = self.versions()[:-keep], self.versions()[-keep:]
        named = {f for v in kept for f in self.manifest(v)["folders"].values()}
        gone = [f for f in self.files.names(f"{self.top}/data") if f not in named]
        for v in old:
            self.files.fs.delete(self.files.path(f"{self.top}/manifests/{v:012d}.json"), False)
        for f in gone:
            self.files.fs.delete(self.files.path(f"{self.top}/data/{f}"), True)
        return len(gone)


def write_dated(df: DataFrame, path: str, run_date: str, cycle: int | str) -> None:
    """SNK-2, SNK-6: the rows of one cycle, as a partition of its day. Writing a cycle again
    replaces its rows, so a repeated run changes nothing."""
    (df.withColumn("run_date", F.lit(run_date)).withColumn("cycle", F.lit(str(cycle))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "cycle").parquet(path))


def dates(spark: SparkSession, path: str) -> list[str]:
    """The days of a dated output, from its folders alone."""
    return [n[9:] for n in Files(spark, path).names(path) if n.startswith("run_date=")]


def read_dated(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """Read side of SNK-6: all cycles of one day, by default the last; the day is a literal, so
    only its partitions are listed and read."""
    day = run_date or max(dates(spark, path), default=None)
    if day is None:
        raise FileNotFoundError(f"no dated output in {path}")
    typed = {"run_date": T.StringType(), "cycle": T.StringType()}
    files = spark.read.option("basePath", path).parquet(f"{path}/run_date={day}")
    return files.withColumns({c: F.col(c).cast(t) for c, t in typed.items()}).where(F.col("run_date") == day)


def first_available(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame | None:
    """The first of ``paths`` that exists, if it has the ``columns``: lookups fall back from a
    dated table to the undated one only where there is no dated one. None without any."""
    for p in paths:
        if Files(spark, p).exists(p):
            df = spark.read.parquet(p)
            if set(columns) <= set(df.columns):
                return df
    return None
