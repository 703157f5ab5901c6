"""T-2, C-11..C-14: one cycle over the new articles of a batch, from clusters to stored topics.

embedding -> clusters (the first batch by the offline chain, later ones by centroids and the third
stage) -> cluster ids -> prompts -> answers -> summaries -> topic and news tables. Every step is
an entry of the ledger: a batch that failed goes on behind its last finished step, with the rows
that the failed run had stored. Tables take a batch once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave import schemas
from newsweave.operators import centroids as C
from newsweave.operators import dbscan as DB
from newsweave.operators import simjoin as SJ
from newsweave.operators.encoder import hashing_encoder
from newsweave.plans import load as LD
from newsweave.plans import stages as ST
from newsweave.plans import summaries as SM
from newsweave.session import checkpoint_dir
from newsweave.sources import files as FS
from newsweave.sources.pages import cluster_image
from newsweave.sources.tables import KeyedTable, write_dated
from newsweave.streaming.ledger import Ledger

ARTICLE = ["pos", "title", "press", "news_summary", "publish_date", "konlpy_nouns", "news_link"]


def offline_baseline(rows: DataFrame, eps: float = 0.25, min_samples: int = 3, min_docs: int = 50) -> DataFrame:
    """C-3 then C-4: DBSCAN over embeddings, then TF-IDF DBSCAN inside every large cluster.
    Adds tfidf_cluster_id and second."""
    pairs, reps = SJ.dense_cosine_pairs(rows.select("pos", "embedding"), eps)
    first = DB.dbscan_labels(rows.select("pos"), pairs, reps, min_samples).select("pos", F.col("label").alias("embedding_cluster_id"))
    return ST.second_stage(rows.join(first, "pos").checkpoint(), min_docs=min_docs).drop("embedding_cluster_id")


def upsert_topics(table: KeyedTable, summary: DataFrame, source: str, batch: int) -> bool:
    """J-2, J-3, J-9 on the stored table: unknown topics are added, known ones get an image where
    they have none. ``summary``: summary rows with an order ``_row``."""
    def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
        topics = LD.topics_from_summary(new.drop("id"))
        known = LD.existing_topics(topics, stored).withColumnRenamed("id", "cluster_id").withColumn("_row", F.lit(0))
        return LD.topic_image_updates(known, stored).unionByName(LD.new_topics(topics, stored))
    return table.update(summary.withColumn("id", F.col("cluster_id").cast("int")), merge, source, batch)


def insert_news(table: KeyedTable, articles: DataFrame, summary: DataFrame, topics: DataFrame, source: str, batch: int) -> bool:
    """C-13 on the stored table: rows of known topics that are not stored yet are added."""
    def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
        return stored.unionByName(LD.insert_news(new.drop("topic_id"), summary, topics, stored)[1])
    return table.update(articles.withColumn("topic_id", F.col("cluster_id").cast("int")), merge, source, batch)


def refresh_news(table: KeyedTable, ref_time, source: str = "refresh", batch: int | None = None) -> bool:
    """A-13 on the stored table: only buckets with a row whose flag changes are rewritten."""
    before = table.read()
    changed = LD.refresh_is_new(before.withColumn("_was", F.col("is_new")), ref_time).where(~F.col("_was").eqNullSafe(F.col("is_new")))
    return table.update(changed, lambda stored, _: LD.refresh_is_new(stored, ref_time), source, batch)


class Cycle:
    """Called with the new articles of a batch (``preprocess`` columns) and its number.

    ``responder`` turns prompts (cluster_id, n, titles, prompt) into answers (cluster_id,
    response); it is asked in ``parts`` portions, each stored when it is complete, and only for
    prompts that no earlier batch has an answer to. ``images`` gives (news_link, image_url) for
    articles. Failed clusters are asked again in the next cycle.
    """

    def __init__(self, spark: SparkSession, top: str, responder: Callable[[DataFrame], DataFrame], images: Callable[[DataFrame], DataFrame] | None = None,
                 encoder=hashing_encoder, stream: str = "main", parts: int = 4, buckets: int = 64, min_docs: int = 50, threshold: float = 0.85,
                 clock: Callable[[], datetime] = datetime.now):
        self.spark, self.top, self.responder, self.images, self.encoder, self.stream = spark, top.rstrip("/"), responder, images, encoder, stream
        self.parts, self.min_docs, self.threshold, self.clock = parts, min_docs, threshold, clock
        self.ledger = Ledger(spark, f"{self.top}/steps", stream)
        self.topics = KeyedTable(spark, f"{self.top}/topic", ["id"], schemas.TOPIC, buckets)
        self.news = KeyedTable(spark, f"{self.top}/news", ["topic_id", "title", "news_link"], schemas.NEWS, buckets)
        checkpoint_dir(spark)

    def __call__(self, fresh: DataFrame, batch: int) -> None:
        once = self.ledger.once
        schemas.require_columns(fresh, ARTICLE, "cycle")
        started = once("started", batch, lambda: self.spark.createDataFrame([(self.clock().strftime("%Y-%m-%d %H:%M:%S"),)], "at string")).first()["at"]
        rows = once("embedded", batch, lambda: fresh.select(*ARTICLE, self.encoder("news_summary").alias("embedding")))
        if rows.isEmpty():
            return
        final = once("clustered", batch, lambda: self._clustered(rows, batch))
        prompts = once("prompts", batch, lambda: self._prompts(final, batch, started[:16]))
        answers = [once(f"answers-{k}", batch, lambda k=k: self._answers(prompts, batch, k)) for k in range(self.parts)]
        whole = answers[0]
        for a in answers[1:]:
            whole = whole.unionByName(a)
        keyed = prompts.select(F.col("cluster_id").cast("int").alias("cluster_id"), "prompt_hash")
        parsed = once("parsed", batch, lambda: SM.parse_responses(whole, started[:16]).join(keyed, "cluster_id"))
        matched = once("matched", batch, lambda: SM.match_titles(parsed, final))
        summary = once("summary", batch, lambda: self._summary(parsed, matched))
        self._publish(parsed, matched, summary, batch, started)

    def _clustered(self, rows: DataFrame, batch: int) -> DataFrame:
        carry = ("konlpy_nouns", "cluster_id")
        before = self.ledger.last("clustered", batch)
        if before is None:
            first = offline_baseline(rows, min_docs=self.min_docs)
            merged = ST.merge_clusters(first.limit(0), first, carry)
        else:
            base = before.drop("is_new", "is_second", "is_third", "ord")
            new = C.assign_to_centroids(rows, C.centroids(base), threshold=self.threshold).checkpoint()
            merged = ST.merge_clusters(*ST.third_stage(base, new), carry)
        known = self.topics.read().agg(F.max("id").alias("m")).first()["m"]
        return ST.assign_cluster_ids(merged.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(ST.NOISE))), db_max_id=known or 0)

    def _prompts(self, final: DataFrame, batch: int, summary_time: str) -> DataFrame:
        first = self.ledger.last("clustered", batch) is None
        wanted = final.select("cluster_id").where(F.col("cluster_id") != ST.NOISE).distinct() if first else ST.target_clusters(final)
        failed = self.ledger.earlier("parsed", batch)
        if failed is not None:
            done = self.topics.read().select(F.col("id").alias("cluster_id"))
            wanted = wanted.unionByName(failed.where(F.col("status") != "ok").select("cluster_id").join(done, "cluster_id", "left_anti")).distinct()
        prompts = SM.build_prompts(ST.target_rows(final, wanted), summary_time)
        # the same articles make the same key, whenever they are asked about
        return prompts.withColumn("prompt_hash", F.sha2(F.replace("prompt", F.lit(summary_time)), 256))

    def _answers(self, prompts: DataFrame, batch: int, part: int) -> DataFrame:
        mine = prompts.where(F.pmod(F.xxhash64("prompt_hash"), F.lit(self.parts)) == part)
        earlier = self.ledger.earlier("parsed", batch)
        if earlier is None:
            return self.responder(mine).select("cluster_id", "response")
        had = earlier.where(F.col("status") == "ok").groupBy("prompt_hash").agg(F.any_value("response").alias("response"))
        asked = self.responder(mine.join(had, "prompt_hash", "left_anti")).select("cluster_id", "response")
        return asked.unionByName(mine.join(had, "prompt_hash").select(F.col("cluster_id").cast("long").alias("cluster_id"), "response"))

    def _summary(self, parsed: DataFrame, matched: DataFrame) -> DataFrame:
        summary = SM.summary_rows(parsed)
        if self.images is not None:
            chosen = cluster_image(matched.select("cluster_id", "pos", "news_link"), self.images(matched), summary)
            summary = LD.fill_images(summary, chosen)
        return summary.withColumn("_row", F.col("cluster_id"))

    def _publish(self, parsed: DataFrame, matched: DataFrame, summary: DataFrame, batch: int, started: str) -> None:
        articles = SM.summary_article_rows(matched)
        name = f"{self.stream}-{batch}"
        write_dated(summary.drop("_row"), f"{self.top}/summary", started[:10], name)
        write_dated(articles, f"{self.top}/summary_articles", started[:10], name)
        FS.write_failed(SM.failed_rows(parsed, started), f"{self.top}/failed/cycle={name}", mode="overwrite")
        upsert_topics(self.topics, summary, self.stream, batch)
        insert_news(self.news, articles.withColumn("_row", F.struct("title", "news_link")), summary, self.topics.read(), self.stream, batch)
