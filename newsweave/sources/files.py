"""SRC-1, SRC-2, SNK-1, SNK-4, SNK-5: file tables (see ``tables`` for updates and dated output).

CSV cells may span lines and carry a byte-order mark; the pandas reader the reference
uses turns a set of tokens into null in every column, which Spark's single ``nullValue``
cannot express, so that is a projection after the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsweave import schemas

# Cell texts the pandas CSV reader turns into null by default.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-1: quoted multi-line cells, BOM; columns are found by header name (a missing one is
    null, others are not read); every column gets the null-token rule; integers may be written
    with a zero fraction (``3.0``), other columns are cast leniently."""
    raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
           .option("encoding", "UTF-8").option("inferSchema", False).csv(path))
    there = {c.lstrip("\ufeff").strip(): c for c in raw.columns}
    cols = []
    for f in schema:
        c = F.col(f"`{there[f.name]}`") if f.name in there else F.lit(None).cast("string")
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
            c = F.regexp_replace(F.trim(c), r"^([+-]?\d+)\.0*$", "$1")
        c = F.when(c.isin(NULL_TOKENS), F.lit(None)).otherwise(c)
        cols.append((c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name))
    return raw.select(*cols)


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1 export (to a new path, never over one being read)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """SNK-5: an empty table with the schema exists afterwards."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def read_failed(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: failed-answer records (JSON Lines)."""
    return spark.read.schema(schemas.FAILED).json(path)


def write_failed(df: DataFrame, path: str, mode: str = "append") -> None:
    """SNK-4: failed-answer records as JSON Lines."""
    df.select("cluster_id", "timestamp", "response").write.mode(mode).json(path)
