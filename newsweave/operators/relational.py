"""Relational building blocks shared by the stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A-9: first row per key by an explicit order (pandas ``drop_duplicates(keep='first')``).

    A grouped ``min_by`` per column, all by the same order: partial aggregation map-side, one
    shuffle on the keys, output rows exactly as input rows; columns that nobody reads are not
    shuffled. Null keys form one group, as in pandas.
    """
    cols = [c for c in df.columns]
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
            .agg(*[F.min_by(c, ordering).alias(f"_r{i}") for i, c in enumerate(cols)])
            .select(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(cols)]))


def null_safe_anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-1: rows of ``left`` with no equal key in ``right``; nulls compare equal (<=>)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_anti")


def lenient_int(col) -> Column:
    """``pd.to_numeric(errors='coerce')`` then int: non-numbers become null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string").try_cast("double").try_cast("int")


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row DataFrame (an aggregate) to every row: an equi-join
    on a constant key against a broadcast side of exactly one row."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one", "left")
            .drop("_one"))
