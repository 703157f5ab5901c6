"""Operator 2: token counts from the exact histogram of encoded lengths.

Documents are aggregated by encoded length, which leaves one row per distinct length and
group whatever the number of documents. Suffix sums over that histogram answer, for every
context limit L: documents and tokens of at least L, documents and tokens below it, the
total after cutting each document at L, and the share of documents that fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths per bucket of the two-level suffix sums.
BUCKET = 1024


def length_histogram(counts: DataFrame, by: list[str] = (), length: str = "n_tokens") -> DataFrame:
    """(*by, n_tokens, n_docs): exact, with map-side sums. A null length counts as 0."""
    return counts.groupBy(*by, F.coalesce(F.col(length), F.lit(0)).cast("long").alias("n_tokens")).agg(F.count("*").alias("n_docs"))


def limits(hist: DataFrame, by: list[str] = ()) -> DataFrame:
    """One row per group and distinct length L = ``n_tokens``, taken as a context limit:

    n_docs (of that length), docs_ge, tokens_ge (of at least L), docs_total, tokens_total,
    truncated_total (sum of min(length, L)), fit_share (documents of at most L, 0..1).
    Between two distinct lengths every figure is linear in L, so these rows answer every
    limit. An empty input gives no rows.

    Suffix sums run in two levels (buckets of 1024 lengths, then inside each bucket), so no
    task holds a whole group's histogram.
    """
    by = list(by)
    h = hist.withColumn("tokens", F.col("n_docs") * F.col("n_tokens")).withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET))
    per = h.groupBy(*by, "bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.partitionBy(*by).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    per = per.select(*by, "bucket",
                     F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
                     F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                     F.sum("d").over(whole).alias("docs_total"), F.sum("t").over(whole).alias("tokens_total"))
    keys = [*by, "bucket"]
    a, b = h.alias("a"), per.alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    j = a.join(b, on).select("a.*", *[f"b.{c}" for c in ("d_above", "t_above", "docs_total", "tokens_total")])
    inside = Window.partitionBy(*keys).orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = (j.withColumn("docs_ge", F.sum("n_docs").over(inside) + F.col("d_above"))
           .withColumn("tokens_ge", F.sum("tokens").over(inside) + F.col("t_above")))
    below = F.col("tokens_total") - F.col("tokens_ge")
    return out.select(*by, "n_tokens", "n_docs", "docs_ge", "tokens_ge", "docs_total", "tokens_total",
                      (below + F.col("n_tokens") * F.col("docs_ge")).alias("truncated_total"),
                      ((F.col("docs_total") - F.col("docs_ge") + F.col("n_docs")) / F.col("docs_total")).alias("fit_share"))


def quantile(table: DataFrame, share: float, by: list[str] = ()) -> DataFrame:
    """Smallest length at which at least ``share`` of the documents fit, per group."""
    return table.where(F.col("fit_share") >= share).groupBy(*by).agg(F.min("n_tokens").alias("n_tokens"))


def truncated(table: DataFrame, limit: int, by: list[str] = ()) -> DataFrame:
    """Tokens left in total when every document is cut at ``limit``, for any limit."""
    over = F.col("n_tokens") >= limit
    return table.groupBy(*by).agg(
        F.sum(F.when(over, F.col("n_docs") * F.lit(limit)).otherwise(F.col("n_docs") * F.col("n_tokens"))).alias("tokens"))
