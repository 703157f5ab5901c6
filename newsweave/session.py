"""Session helpers.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a shared folder;
we only read it. Tests and benchmarks create a local session and set a scratch folder when
the setting is unset.
"""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "newsweave") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("NEWSWEAVE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        # Unset only in tests and local benchmarks; a cluster names a shared folder.
        conf_dir = tempfile.mkdtemp(prefix="newsweave-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def release(spark: SparkSession) -> None:
    """Have the files of shuffles that nothing refers to any more deleted: Spark does so when the
    driver collects its garbage, which may be after the end of a long plan of many jobs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, rows: int = 256) -> DataFrame:
    """The rows of ``df`` as a checkpoint of compressed batches: a checkpoint of wide rows takes
    several times the bytes of their text."""
    checkpoint_dir(df.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema) as out:
                    out.write_batch(b.slice(lo, rows))
                raw = sink.getvalue()
                yield pa.RecordBatch.from_pydict({"size": pa.array([raw.size], pa.int64()), "body": pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary())})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for size, body in zip(b.column("size"), b.column("body")):
                yield from pa.ipc.open_stream(pa.decompress(body.as_buffer(), size.as_py(), codec="zstd"))
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema])
    return df.mapInArrow(pack, "size long, body binary").checkpoint().mapInArrow(unpack, schema)
