"""Topic/news load: J-1..J-4, J-8..J-10, A-9, A-13, C-13, C-14.

Built-in file tables have no row-level MERGE, so every "update" produces a new snapshot
and every "insert" is the anti-join of the incoming rows against the stored keys; this
also makes a replayed micro-batch add nothing (idempotent sinks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.functions import text as TX
from newsweave.operators.relational import keep_first, lenient_int, null_safe_anti

# Fixed value: columns of the news table.
NEWS_COLS = ["topic_id", "title", "news_link", "press", "publish_date", "news_summary", "is_new", "is_third"]


def topics_from_summary(summary: DataFrame, with_image: bool = True) -> DataFrame:
    """Rename cluster_id -> id, first row per id (rows carry ``_row`` order)."""
    cols = ["id", "topic_name", "ai_summary", "summary_time"] + (["image_url"] if with_image else [])
    s = summary.withColumnRenamed("cluster_id", "id")
    if with_image:
        s = s.withColumn("image_url", TX.normalise_image_url("image_url"))
    return keep_first(s, ["id"], ["_row"]).select(*cols)


def new_topics(topics: DataFrame, existing_topic: DataFrame) -> DataFrame:
    """J-2: topics whose id is not stored yet (stored ids read leniently)."""
    ids = existing_topic.select(lenient_int("id").alias("id")).where(F.col("id").isNotNull()).distinct()
    return topics.join(ids, topics["id"].cast("int") == ids["id"], "left_anti")


def existing_topics(topics: DataFrame, existing_topic: DataFrame) -> DataFrame:
    """J-3: topics that already exist."""
    ids = existing_topic.select(lenient_int("id").alias("_id")).where(F.col("_id").isNotNull()).distinct()
    return topics.join(ids, topics["id"].cast("int") == ids["_id"], "left_semi")


def insert_news(articles: DataFrame, summary: DataFrame, existing_topic: DataFrame,
                existing_news: DataFrame):
    """C-13: (topics to insert, news rows to insert).

    articles: summary-article rows (cluster_id, title, news_link, ..., _row order);
    summary: summary rows (cluster_id, topic_name, ai_summary, summary_time, _row)."""
    topics = topics_from_summary(summary, with_image="image_url" in summary.columns)
    ins_topics = new_topics(topics, existing_topic)
    arts = articles
    for c, d in {"news_summary": "", "is_new": 0, "is_third": 0}.items():
        if c not in arts.columns:
            arts = arts.withColumn(c, F.lit(d))
    merged = keep_first(arts, ["cluster_id", "title", "news_link"], ["_row"]) \
        .withColumn("topic_id", F.col("cluster_id").cast("int"))
    valid = (existing_topic.select(lenient_int("id").alias("topic_id"))
             .unionByName(ins_topics.select(F.col("id").cast("int").alias("topic_id")))
             .where(F.col("topic_id").isNotNull()).distinct())
    merged = merged.join(valid, "topic_id", "left_semi")                                   # J-4
    fresh = null_safe_anti(merged, existing_news, ["topic_id", "title", "news_link"])       # J-1
    return ins_topics, fresh.select(*NEWS_COLS)


def topic_image_updates(summary: DataFrame, topic: DataFrame) -> DataFrame:
    """J-9: new snapshot of ``topic`` - image_url set from the summary where the stored one
    is NULL, '' or 'nan' and the summary has a non-blank one; other rows unchanged."""
    s = topics_from_summary(summary).select(F.col("id").cast("int").alias("_id"),
                                            TX.strip_py(F.coalesce("image_url", F.lit(""))).alias("_img"))
    s = s.where(F.col("_img") != "")
    j = topic.join(s, topic["id"].cast("int") == s["_id"], "left")
    return j.withColumn("image_url", F.when(TX.is_sql_empty_image("image_url") & F.col("_img").isNotNull(),
                                            F.col("_img")).otherwise(F.col("image_url"))).drop("_id", "_img")


def fill_images(summary: DataFrame, chosen: DataFrame) -> DataFrame:
    """J-8: image_url filled from ``chosen`` (cluster_id, url) only where it is empty."""
    c = chosen.select(F.col("cluster_id").alias("_cid"), F.col("url").alias("_url"))
    j = summary.join(c, summary["cluster_id"] == c["_cid"], "left")
    return j.withColumn("image_url", F.when(TX.is_empty_image("image_url"),
                                            F.coalesce("_url", "image_url")).otherwise(F.col("image_url"))) \
        .drop("_cid", "_url")


def news_with_image(news: DataFrame, summary: DataFrame) -> DataFrame:
    """J-10: the cluster's representative image on each news row ('' when none)."""
    img = keep_first(summary.select(F.col("cluster_id").cast("int").alias("topic_id"), "image_url", "_row"),
                     ["topic_id"], ["_row"]).select("topic_id", "image_url")
    return (news.join(img, "topic_id", "left")
            .withColumn("image_url", TX.strip_py(F.coalesce("image_url", F.lit("")))))


def refresh_is_new(news: DataFrame, ref_time, hours: int = 24) -> DataFrame:
    """A-13: is_new = 1 when publish_date (two formats) >= ref_time - 24h, else 0."""
    ts = TX.two_format_timestamp("publish_date")
    ref = ref_time if not isinstance(ref_time, str) else F.lit(ref_time).cast("timestamp_ntz")
    cut = ref - F.make_dt_interval(F.lit(0), F.lit(hours))
    return news.withColumn("is_new", F.when(ts >= cut, F.lit(1)).otherwise(F.lit(0)))


def complete_summary(articles: DataFrame, summary: DataFrame) -> DataFrame:
    """J-7: every cluster that has articles, with its summary row when there is one
    (image_url null when absent)."""
    ids = articles.select(F.col("cluster_id").cast("int").alias("cluster_id")).distinct()
    return ids.join(summary, "cluster_id", "left")
