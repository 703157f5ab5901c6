"""A ledger of finished steps, so that a repeated batch goes on where it stopped.

Every step of a batch writes its result to a folder of its own, ``<step>/stream=<s>/batch_id=<n>``.
The marker that Spark writes when a job commits is the entry: with it the result is read and not
made again, without it whatever is there is replaced. Later steps and batches read the stored
result, so a step sees the same rows however often its batch is repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.sources.tables import Files


class Ledger:
    """Steps of the batches of one stream below the folder ``top``."""

    def __init__(self, spark: SparkSession, top: str, stream: str = "main"):
        self.spark, self.top, self.stream, self.files = spark, top.rstrip("/"), stream, Files(spark, top)

    def path(self, step: str, batch: int) -> str:
        return f"{self.top}/{step}/stream={self.stream}/batch_id={batch}"

    def done(self, step: str, batch: int) -> bool:
        return self.files.exists(f"{self.path(step, batch)}/_SUCCESS")

    def once(self, step: str, batch: int, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored result of a step, made by ``make`` if there is none."""
        if not self.done(step, batch):
            make().write.mode("overwrite").parquet(self.path(step, batch))
        return self.spark.read.parquet(self.path(step, batch))

    def earlier(self, step: str, batch: int) -> DataFrame | None:
        """Rows of a step of all other streams and of earlier batches of this one; None without
        any. Partition columns are not among the columns."""
        streams = [n for n in self.files.names(f"{self.top}/{step}") if n.startswith("stream=")]
        folders = ((s[7:], int(b[9:])) for s in streams for b in self.files.names(f"{self.top}/{step}/{s}") if b.startswith("batch_id="))
        if not any((s != self.stream or b < batch) and self.files.exists(f"{self.top}/{step}/stream={s}/batch_id={b}/_SUCCESS") for s, b in folders):
            return None
        df = self.spark.read.parquet(f"{self.top}/{step}")
        return df.where((F.col("stream") != self.stream) | (F.col("batch_id") < batch)).drop("stream", "batch_id")

    def last(self, step: str, batch: int) -> DataFrame | None:
        """Result of the last finished earlier batch that has the step."""
        found = [int(n[9:]) for n in self.files.names(f"{self.top}/{step}/stream={self.stream}") if n.startswith("batch_id=")]
        for k in sorted((k for k in found if k < batch), reverse=True):
            if self.done(step, k):
                return self.spark.read.parquet(self.path(step, k))
        return None
