"""Incremental ingest: several files through the stream give the batch keep-first result,
and a replayed batch adds nothing."""

import tempfile

from pyspark.sql import functions as F

from newsweave.plans.ingest import preprocess
from newsweave.sources import testdata as TD
from newsweave.streaming.cycle import article_stream, merge_batch


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="nw-src-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="nw-out-", dir="/tmp") + "/articles"
    ck = tempfile.mkdtemp(prefix="nw-ck-", dir="/tmp")
    raw = TD.raw_articles(spark, "/root/testdata/sf0.001").where(F.col("news_link").isNotNull())
    raw = raw.select("title", "press", "news_summary", "publish_date", "datetime_sort", "news_link", "pos")
    raw.where(F.col("pos") < 100).write.parquet(src + "/part1")
    raw.where(F.col("pos") >= 100).write.parquet(src + "/part2")
    q = article_stream(spark, src + "/*", out, ck)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    expected = raw.groupBy("news_link").agg(F.min("pos").alias("pos"))
    assert got.count() == expected.count()
    assert got.select("news_link").distinct().count() == got.count()
    # another batch with the same rows adds nothing
    again = merge_batch(preprocess(raw), out, 1000, "other")
    assert again.count() == 0


def test_default_stream_keeps_old_and_undated_rows(spark):
    src = tempfile.mkdtemp(prefix="nw-src-", dir="/tmp")
    top = tempfile.mkdtemp(prefix="nw-out-", dir="/tmp")
    cols = "title string, press string, news_summary string, publish_date string, datetime_sort string, news_link string, pos long"
    first = [("a", "p", "s", "2025.07.10. 오후 7:58", None, "l1", 0), ("b", "p", "s", None, None, "l2", 1)]
    second = [("c", "p", "s", "2024.01.02. 오전 7:58", None, "l3", 2), ("d", "p", "s", "2024.01.03. 오전 7:58", None, "l4", 3)]
    for k, rows in enumerate((first, second)):
        spark.createDataFrame(rows, cols).write.parquet(f"{src}/part{k}")
        article_stream(spark, src + "/*", top + "/articles", top + "/ck").awaitTermination(300)
    assert {r.news_link for r in spark.read.parquet(top + "/articles").collect()} == {"l1", "l2", "l3", "l4"}
