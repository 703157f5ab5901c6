"""SRC-3, SNK-3: tables of a database, read in ranges and appended to by key.

Reading sends the projection and the condition to the database and splits the rest into ranges of
a numeric column, one connection each. Appending writes the rows to a staging table first, in
parallel, and moves those with new keys in one statement and transaction: a job that is repeated
after a lost executor or driver adds nothing twice.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _names(names: Sequence[str]) -> str:
    for n in names:
        if not _NAME.fullmatch(n):
            raise ValueError(f"not a name: {n!r}")
    return ", ".join(names)


class Database(NamedTuple):
    url: str
    properties: tuple[tuple[str, str], ...] = ()
    fetch_rows: int = 10_000
    batch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        return {"url": self.url, **dict(self.properties)}


class Split(NamedTuple):
    """Ranges of a numeric column; rows outside the bounds belong to the first and last range,
    null values to the first."""
    column: str
    low: int
    high: int
    parts: int


def read_options(db: Database, table: str, columns: Sequence[str], where: str | None = None, split: Split | None = None) -> dict[str, str]:
    """Options of a read of ``columns``; the column of ``split`` must be one of them."""
    query = f"SELECT {_names(columns)} FROM {_names([table])}" + (f" WHERE {where}" if where else "")
    out = db.options() | {"dbtable": f"({query}) q", "fetchsize": str(db.fetch_rows), "pushDownPredicate": "true"}
    if split is not None:
        if split.column not in columns:
            raise ValueError(f"{split.column} is not read")
        if split.high > split.low and split.parts > 1:
            out |= {"partitionColumn": split.column, "lowerBound": str(split.low), "upperBound": str(split.high), "numPartitions": str(min(split.parts, split.high - split.low))}
    return out


def read(spark: SparkSession, db: Database, table: str, columns: Sequence[str], where: str | None = None, split: Split | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(db, table, columns, where, split)).load()


def bounds(spark: SparkSession, db: Database, table: str, column: str, parts: int) -> Split | None:
    """Split over the whole range of a column, from one row; None for an empty table."""
    query = f"(SELECT MIN({_names([column])}) AS low, MAX({column}) AS high FROM {_names([table])}) q"
    r = spark.read.format("jdbc").options(**db.options(), dbtable=query).load().first()
    return None if r is None or r[0] is None else Split(column, int(r[0]), int(r[1]) + 1, parts)


def stage_options(db: Database, table: str, batch: str) -> dict[str, str]:
    return db.options() | {"dbtable": staging(table, batch), "batchsize": str(db.batch_rows), "truncate": "true"}


def staging(table: str, batch: str) -> str:
    return _names([f"{table}_stage_{batch}"])


def move_statement(table: str, batch: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Rows of the staging table whose keys (nulls equal) the table lacks, once per key."""
    cols = _names(columns)
    same = " AND ".join(f"(t.{k} = s.{k} OR (t.{k} IS NULL AND s.{k} IS NULL))" for k in _names(keys).split(", "))
    return f"INSERT INTO {_names([table])} ({cols}) SELECT DISTINCT {', '.join(f's.{c}' for c in columns)} FROM {staging(table, batch)} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})"


def append(df: DataFrame, db: Database, table: str, keys: Sequence[str], batch: str) -> int:
    """Append the rows of ``df`` (one per key) whose keys are not in ``table`` yet; returns their
    number. A repeated batch replaces its staging table and moves nothing twice."""
    df.write.format("jdbc").mode("overwrite").options(**stage_options(db, table, batch)).save()
    jvm = df.sparkSession._jvm
    properties = jvm.java.util.Properties()
    for k, v in db.properties:
        properties.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(db.url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        moved = statement.executeUpdate(move_statement(table, batch, df.columns, keys))
        connection.commit()
        statement.executeUpdate(f"DROP TABLE {staging(table, batch)}")
        connection.commit()
        return moved
    finally:
        connection.close()
