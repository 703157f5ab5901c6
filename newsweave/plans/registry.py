"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame whose columns match
the DuckDB oracle of the same key (newsweave.plans.oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.operators import centroids as C
from newsweave.sources import testdata as TD

R6 = 6


def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline, _ = TD.baseline_and_new_vectors(spark, sf_dir)
    c = C.centroids(baseline)
    return c.select("cluster_id", "first_pos", "n",
                    F.posexplode("centroid").alias("dim", "value")) \
        .select("cluster_id", "first_pos", "n", "dim", F.round("value", R6).alias("value"))


def _assigned(spark, sf_dir):
    baseline, new = TD.baseline_and_new_vectors(spark, sf_dir)
    return baseline, C.assign_to_centroids(new, C.centroids(baseline))


def q_assign_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, a = _assigned(spark, sf_dir)
    return a.select("pos", "assigned_tfidf_cluster", F.round("best_sim", R6).alias("best_sim"))


def q_cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: baseline + centroid-assigned new rows, clusters with at least two articles."""
    baseline, a = _assigned(spark, sf_dir)
    rows = baseline.select(F.col("tfidf_cluster_id").alias("cluster_id"), F.lit(False).alias("is_new")) \
        .unionByName(a.select(F.col("assigned_tfidf_cluster").alias("cluster_id"), F.lit(True).alias("is_new")))
    return (rows.where(F.col("cluster_id") != C.NOISE)
            .groupBy("cluster_id")
            .agg(F.count("*").alias("n_articles"), F.count_if("is_new").alias("n_new"))
            .where(F.col("n_articles") >= 2))


# --- text rules and ingest ------------------------------------------------------------------------
from newsweave.functions import text as TX  # noqa: E402
from newsweave.plans import ingest as IG  # noqa: E402


def _articles(spark, sf_dir):
    return IG.preprocess(TD.raw_articles(spark, sf_dir))


def q_clean_text(spark, sf_dir):
    return TD.table(spark, sf_dir, "documents").select("doc_id", TX.clean_content("text").alias("cleaned"))


def q_remove_brackets(spark, sf_dir):
    return TD.raw_articles(spark, sf_dir).select("pos", TX.remove_brackets("title").alias("title"))


def q_korean_datetime(spark, sf_dir):
    return TD.raw_articles(spark, sf_dir).select("pos", TX.korean_datetime("publish_date").alias("publish_ts"))


def q_preprocess(spark, sf_dir):
    a = _articles(spark, sf_dir)
    return a.select("pos", "title", "summary", "press", "datetime", "publish_date",
                    F.array_join("konlpy_nouns", " ").alias("nouns_text"),
                    F.size("konlpy_nouns").alias("n_nouns"), "news_link")


def q_tokens(spark, sf_dir):
    t = TD.table(spark, sf_dir, "documents").select("doc_id", TX.regex_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"),
                    F.array_join("t", " ").alias("tokens_text"))


def q_parse_vector(spark, sf_dir):
    e = TD.table(spark, sf_dir, "embeddings")
    p = e.select("vec_id", TX.parse_vector_text(TX.vector_text("embedding")).alias("p"))
    return p.select("vec_id", F.posexplode("p").alias("dim", "v")) \
        .select("vec_id", "dim", F.round(F.col("v").cast("double"), R6).alias("value"))


def q_parse_tokens(spark, sf_dir):
    t = TD.table(spark, sf_dir, "documents").select("doc_id", TX.regex_tokens("text").alias("t"))
    lit = F.concat(F.lit("["), F.array_join(F.transform("t", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                   F.lit("]"))
    p = t.select("doc_id", TX.parse_list_literal(lit).alias("p"))
    return p.select("doc_id", F.size("p").alias("n_tokens"), F.array_join("p", " ").alias("tokens_text"))


def q_nonempty_summary(spark, sf_dir):
    r = TD.raw_articles(spark, sf_dir)
    return r.where(TX.nonempty_text("news_summary")).select("pos", "news_link")


def q_parse_sort_ts(spark, sf_dir):
    return TD.raw_articles(spark, sf_dir).select("pos", TX.lenient_timestamp("datetime_sort").alias("sort_ts"))


# --- TF-IDF, similarity joins, DBSCAN -------------------------------------------------------------
from newsweave.operators import dbscan as DB  # noqa: E402
from newsweave.operators import simjoin as SJ  # noqa: E402
from newsweave.operators import tfidf as TF  # noqa: E402

THIRD_EPS, THIRD_MIN = 0.6, 2
EMB_EPS, EMB_MIN = 0.25, 3


def q_tfidf(spark, sf_dir):
    v = TF.tfidf(_articles(spark, sf_dir))
    return v.select("pos", "gram", "tf", "df", F.round("w", R6).alias("w"))


def q_similar_pairs(spark, sf_dir):
    v = TF.GramBlocks(_articles(spark, sf_dir))
    pairs, reps = SJ.sparse_cosine_pairs(v, THIRD_EPS)
    # expand representatives back to every copy: all pairs of rows, as the brute force sees them
    r = reps.select("pos", "rep")
    ex = (pairs.join(r.withColumnsRenamed({"rep": "a", "pos": "x"}), "a")
          .join(r.withColumnsRenamed({"rep": "b", "pos": "y"}), "b")
          .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "sim"))
    dup = (r.join(r.withColumnsRenamed({"pos": "pos2"}), "rep").where(F.col("pos") < F.col("pos2"))
           .select(F.col("pos").alias("a"), F.col("pos2").alias("b"), F.lit(1.0).alias("sim")))
    return ex.unionByName(dup).select("a", "b", F.round("sim", 4).alias("sim"))


def q_dbscan_labels(spark, sf_dir):
    a = _articles(spark, sf_dir)
    v = TF.GramBlocks(a)
    pairs, reps = SJ.sparse_cosine_pairs(v, THIRD_EPS)
    return DB.dbscan_labels(a.select("pos"), pairs, reps, THIRD_MIN).select("pos", "label")


def q_dbscan_embeddings(spark, sf_dir):
    pv = TD.planted_vectors(spark, sf_dir).select("pos", "embedding")
    pairs, reps = SJ.dense_cosine_pairs(pv, EMB_EPS)
    return DB.dbscan_labels(pv.select("pos"), pairs, reps, EMB_MIN).select("pos", "label")


# --- batch cluster cycle ------------------------------------------------------------------------
from newsweave.operators.encoder import hashing_encoder  # noqa: E402
from newsweave.plans import stages as ST  # noqa: E402

NEW_EVERY = 7


def _cycle(spark, sf_dir):
    """Articles split into the clustered baseline and this cycle's new articles
    (doc_id % 7 == 0); every article is used on one side or the other."""
    a = _articles(spark, sf_dir).withColumn("is_new", (F.col("pos") % NEW_EVERY) == 0)
    return ST.cluster_cycle(a, db_max_id=0)


def q_embed(spark, sf_dir):
    a = _articles(spark, sf_dir).select("pos", hashing_encoder("news_summary").alias("e"))
    # the outer form keeps the optimizer from encoding every text again for a size filter
    return a.select("pos", F.posexplode_outer("e").alias("dim", "val")).where(F.col("val") != 0)


def q_baseline_labels(spark, sf_dir):
    a = _articles(spark, sf_dir).where((F.col("pos") % NEW_EVERY) != 0)
    lab = ST.tfidf_dbscan(a.withColumn("ord", F.col("pos")), 0.6, 3)
    return lab.select(F.col("ord").alias("pos"), F.col("label").alias("tfidf_cluster_id"))


def q_third_stage(spark, sf_dir):
    return _cycle(spark, sf_dir).select("is_new", "pos", "tfidf_cluster_id", "is_third")


def q_assign_cluster_ids(spark, sf_dir):
    return _cycle(spark, sf_dir).select("is_new", "pos", "tfidf_cluster_id", "cluster_id")


def q_target_clusters(spark, sf_dir):
    return ST.target_clusters(_cycle(spark, sf_dir))


# --- summaries and load -------------------------------------------------------------------------
from newsweave.plans import load as LD  # noqa: E402
from newsweave.plans import summaries as SM  # noqa: E402

SUMMARY_TIME = "2025-07-11 09:00"
RUN_TS = "2025-07-11 09:00:00"
UNSEEN_EVERY = 3


def _press_topics(spark, sf_dir, baseline_only=False):
    """Articles grouped into topics by press (the number in the source name); new = this
    cycle's articles (doc_id % 7 == 0). ``baseline_only`` gives the previous cycle's view."""
    a = _articles(spark, sf_dir).withColumns({
        "cluster_id": F.regexp_extract("press", "[0-9]+", 0).try_cast("int"),
        "is_new": (F.col("pos") % NEW_EVERY) == 0, "is_third": F.lit(False)})
    return a.where(~F.col("is_new")) if baseline_only else a


def _summarise(arts, store=False):
    """``store``: for callers that read the answers in several branches."""
    prompts = SM.build_prompts(arts, SUMMARY_TIME)
    parsed = asked = SM.parse_responses(SM.template_responder(prompts), SUMMARY_TIME)
    if store:
        parsed, asked = SM.store_answers(parsed)
    matched = SM.match_titles(asked, arts)
    return prompts, parsed, matched


def q_build_prompts(spark, sf_dir):
    prompts, _, _ = _summarise(_press_topics(spark, sf_dir))
    return prompts.select("cluster_id", "n", "prompt")


def q_prompt_titles(spark, sf_dir):
    prompts, _, _ = _summarise(_press_topics(spark, sf_dir))
    return prompts.select("cluster_id", TX.prompt_title_count("prompt").alias("n_titles"))


def q_parse_response(spark, sf_dir):
    _, parsed, _ = _summarise(_press_topics(spark, sf_dir))
    return parsed.select("cluster_id", "status", "topic_name", "ai_summary", "summary_time",
                         F.size("article_titles").alias("n_titles"))


def q_match_titles(spark, sf_dir):
    _, _, matched = _summarise(_press_topics(spark, sf_dir))
    return matched.select("cluster_id", "title_pos", "pos", "title", "news_link")


def q_summaries(spark, sf_dir):
    _, parsed, _ = _summarise(_press_topics(spark, sf_dir))
    return SM.summary_rows(parsed)


def q_failed_responses(spark, sf_dir):
    _, parsed, _ = _summarise(_press_topics(spark, sf_dir))
    return SM.failed_rows(parsed, RUN_TS).select(
        "cluster_id", F.col("response").endswith(" trailing words").alias("has_trailing_words"))


def _load(spark, sf_dir, all_stored=False):
    """Previous cycle (baseline articles) is stored; the current cycle is loaded on top.
    ``all_stored``: the previous cycle had seen every topic."""
    _, p_parsed, p_matched = _summarise(_press_topics(spark, sf_dir, baseline_only=True), store=True)
    if not all_stored:
        # the previous cycle had not seen every third topic yet
        p_parsed, p_matched = (df.where(F.col("cluster_id") % UNSEEN_EVERY != 0) for df in (p_parsed, p_matched))
    stored_topic = SM.summary_rows(p_parsed).select(F.col("cluster_id").alias("id"), "topic_name",
                                                    "ai_summary", "summary_time", "image_url")
    p_arts = SM.summary_article_rows(p_matched).withColumn("_row", F.lit(0))
    # first load: nothing stored yet
    no_topic = spark.createDataFrame([], "id int, topic_name string, ai_summary string, summary_time string")
    no_news = spark.createDataFrame([], "topic_id int, title string, news_link string")
    _, p_news = LD.insert_news(p_arts, SM.summary_rows(p_parsed).withColumn("_row", F.col("cluster_id")),
                               no_topic, no_news)
    _, parsed, matched = _summarise(_press_topics(spark, sf_dir), store=True)
    summ = SM.summary_rows(parsed).withColumn("_row", F.col("cluster_id"))
    arts = SM.summary_article_rows(matched).withColumn("_row", F.lit(0))
    topics, news = LD.insert_news(arts, summ, stored_topic, p_news)
    return stored_topic, p_news, topics, news


def q_new_topics(spark, sf_dir):
    _, _, topics, _ = _load(spark, sf_dir)
    return topics.select("id", "topic_name", "ai_summary", "summary_time")


def q_insert_news(spark, sf_dir):
    _, _, _, news = _load(spark, sf_dir)
    return news


def q_refresh_is_new(spark, sf_dir):
    _, stored, _, news = _load(spark, sf_dir)
    allnews = stored.unionByName(news)
    ref = allnews.agg(F.max(TX.two_format_timestamp("publish_date")).alias("_ref"))
    out = LD.refresh_is_new(attach_row(allnews, ref), F.col("_ref"))
    return out.select("topic_id", "title", "news_link", "is_new")


def q_news_count(spark, sf_dir):
    _, stored, _, news = _load(spark, sf_dir)
    return stored.unionByName(news).agg(F.count("*").alias("n_news"))


# --- links, ingest bookkeeping, pages, images --------------------------------------------------
from newsweave.operators.relational import attach_row, keep_first  # noqa: E402
from newsweave.sources import pages as PG  # noqa: E402


def _listing(spark, sf_dir):
    return PG.listing_links(TD.table(spark, sf_dir, "pages"), container=None, link="a")


def _marker(listing):
    """Where the previous crawl stopped: the first link of the oldest listing page."""
    last_page = listing.agg(F.max("page_id").alias("_lp"))
    oldest = attach_row(listing, last_page).where(F.col("page_id") == F.col("_lp"))
    return IG.last_seen(oldest)


def q_extract_links(spark, sf_dir):
    return _listing(spark, sf_dir).select("page_id", "idx", "news_link")


def q_last_seen(spark, sf_dir):
    return IG.last_seen(_listing(spark, sf_dir))


def q_new_links(spark, sf_dir):
    lst = _listing(spark, sf_dir)
    return IG.new_links(lst, _marker(lst)).select("pos.page_id", "pos.idx", "news_link")


def q_merge_links(spark, sf_dir):
    lst = _listing(spark, sf_dir)
    new = IG.new_links(lst, _marker(lst))
    prev = keep_first(lst.select("news_link", "pos"), ["news_link"], ["pos"])
    return IG.merge_links(new, prev).select("news_link", "batch", "pos.page_id", "pos.idx")


def q_gated_links(spark, sf_dir):
    lst = _listing(spark, sf_dir)
    new = IG.new_links(lst, _marker(lst))
    prev = keep_first(lst.select("news_link", "pos"), ["news_link"], ["pos"])
    return IG.gated(IG.merge_links(new, prev))


def q_dedup_keep_first(spark, sf_dir):
    return keep_first(TD.raw_articles(spark, sf_dir), ["news_link"], ["pos"]).select("pos", "news_link")


def q_accumulate(spark, sf_dir):
    a = _articles(spark, sf_dir)
    new = a.where((F.col("pos") % NEW_EVERY) == 0)
    total = a.where((F.col("pos") % NEW_EVERY) != 0)
    return IG.accumulate(new, total).select("pos", "news_link", F.col("_batch").alias("batch"))


def q_skip_first(spark, sf_dir):
    return IG.skip_first(TD.raw_articles(spark, sf_dir), 5).select("pos")


def q_sort_articles(spark, sf_dir):
    return IG.crawl_frame(TD.raw_articles(spark, sf_dir)).select("pos", "news_link")


def q_page_fields(spark, sf_dir):
    fields = (PG.Field("title", "head > title", required=True), PG.Field("h1", "article h1", separator=" "))
    return PG.page_fields(TD.table(spark, sf_dir, "pages"), fields).select("page_id", TX.remove_brackets("title").alias("title"), "h1")


def q_extract_pages(spark, sf_dir):
    """SRC-4 with the crawler's selectors: pages without a required field are dropped."""
    return PG.article_rows(TD.news_pages(spark, sf_dir))


def q_listing_articles(spark, sf_dir):
    """SRC-5 with the crawler's selectors: links inside the listing container only."""
    return PG.listing_links(TD.news_pages(spark, sf_dir)).select("page_id", "idx", "news_link", "text")


def q_page_image(spark, sf_dir):
    return PG.page_image(TD.news_pages(spark, sf_dir)).select("page_id", "image_url")


def q_image_object(spark, sf_dir):
    p = TD.table(spark, sf_dir, "pages")
    return p.select("page_id", TX.safe_filename("url").alias("file_name"),
                    TX.image_object_key("news-images", F.col("page_id"), F.col("url")).alias("object_key"))


# --- remaining relational items -------------------------------------------------------------------
def q_cluster_count(spark, sf_dir):
    a = _press_topics(spark, sf_dir)
    return a.where(F.col("cluster_id") != -1).agg(F.count_distinct("cluster_id").alias("n_clusters"))


def q_quality_metrics(spark, sf_dir):
    """A-7: in-flight data-quality counts of one crawl batch."""
    r = TD.raw_articles(spark, sf_dir)
    return r.agg(F.count("*").alias("n_rows"),
                 F.count_if(TX.nonempty_text("news_summary")).alias("n_with_summary"),
                 F.count_if(TX.lenient_timestamp("datetime_sort").isNotNull()).alias("n_sort_parsed"),
                 F.count_if(TX.korean_datetime("publish_date").isNotNull()).alias("n_date_parsed"))


def q_preprocess_alt(spark, sf_dir):
    a = IG.preprocess_alt(TD.raw_articles(spark, sf_dir))
    return a.select("pos", "title", "news_summary", "publish_date", F.size("konlpy_nouns").alias("n_nouns"))


def q_retry_prompts(spark, sf_dir):
    arts = _press_topics(spark, sf_dir)
    _, parsed, _ = _summarise(arts)
    return SM.retry_prompts(SM.failed_rows(parsed, RUN_TS), arts, SUMMARY_TIME).select("cluster_id", "n")


def _images(arts):
    """Image found on an article page: every third article has one (derived from its link)."""
    return arts.where((F.col("pos") % 3) == 0).select(
        "news_link", F.concat(F.lit("https://img.example.com/"), F.md5("news_link"), F.lit(".jpg")).alias("image_url"))


def _summary_with_images(spark, sf_dir):
    arts = _press_topics(spark, sf_dir)
    _, parsed, matched = _summarise(arts, store=True)
    summ = SM.summary_rows(parsed)
    chosen = PG.cluster_image(matched.select("cluster_id", "pos", "news_link"), _images(arts), summ)
    return arts, matched, summ, LD.fill_images(summ, chosen)


def q_cluster_image(spark, sf_dir):
    arts = _press_topics(spark, sf_dir)
    _, parsed, matched = _summarise(arts, store=True)
    return PG.cluster_image(matched.select("cluster_id", "pos", "news_link"), _images(arts), SM.summary_rows(parsed))


def q_fill_image(spark, sf_dir):
    _, _, _, filled = _summary_with_images(spark, sf_dir)
    return filled.select("cluster_id", "image_url")


def q_image_completeness(spark, sf_dir):
    _, _, _, filled = _summary_with_images(spark, sf_dir)
    return filled.agg(F.count("*").alias("n"), F.count_if(TX.normalise_image_url("image_url") == "").alias("n_empty"),
                      ((F.count_if(TX.normalise_image_url("image_url") == "") == 0) & (F.count("*") > 0)).alias("complete"))


def q_update_topic_images(spark, sf_dir):
    """J-9: stored topics (previous cycle, no images) take the new summary images."""
    stored, _, _, _ = _load(spark, sf_dir, all_stored=True)
    _, _, _, filled = _summary_with_images(spark, sf_dir)
    return LD.topic_image_updates(filled.withColumn("_row", F.col("cluster_id")), stored) \
        .select("id", "image_url")


def q_news_with_image(spark, sf_dir):
    _, _, _, news = _load(spark, sf_dir, all_stored=True)
    _, _, _, filled = _summary_with_images(spark, sf_dir)
    return LD.news_with_image(news, filled.withColumn("_row", F.col("cluster_id"))) \
        .select("topic_id", "title", "news_link", "image_url")


def q_second_stage(spark, sf_dir):
    """C-4 over the press topics (every topic has >= 50 articles at sf >= 0.01)."""
    a = _press_topics(spark, sf_dir).withColumn("embedding_cluster_id", F.coalesce("cluster_id", F.lit(-1)))
    out = ST.second_stage(a)
    return out.select("pos", "embedding_cluster_id", "tfidf_cluster_id", "second")


# --- id bookkeeping over the planted-vector clusters -------------------------------------------------
def _planted_final(spark, sf_dir):
    baseline, a = _assigned(spark, sf_dir)
    b = baseline.withColumn("is_third", F.lit(False))
    n = a.withColumn("is_third", F.lit(False))
    return ST.merge_clusters(b, n)


def q_noise_union(spark, sf_dir):
    """U-3: noise of both sides pooled, baseline first (side 0), then new (side 1)."""
    baseline, a = _assigned(spark, sf_dir)
    return (baseline.where(F.col("tfidf_cluster_id") == -1).select(F.lit(0).alias("side"), "pos")
            .unionByName(a.where(F.col("assigned_tfidf_cluster") == -1).select(F.lit(1).alias("side"), "pos")))


def q_id_seed(spark, sf_dir):
    """A-5: max over the baseline's non-noise, non-third labels and the stored max id (10)."""
    f = _planted_final(spark, sf_dir)
    m = f.where(~F.col("is_new") & ~F.col("is_third") & (F.col("tfidf_cluster_id") != -1)) \
        .agg(F.max("tfidf_cluster_id").alias("m"))
    return m.select(F.greatest(F.coalesce("m", F.lit(10)), F.lit(10)).alias("seed_max"))


def q_cluster_id_range(spark, sf_dir):
    """A-6 after C-7 (stored max id 10): range of the issued ids."""
    out = ST.assign_cluster_ids(_planted_final(spark, sf_dir), db_max_id=10)
    return out.where(F.col("cluster_id") != -1).agg(F.min("cluster_id").alias("min_id"),
                                                   F.max("cluster_id").alias("max_id"),
                                                   F.count("*").alias("n_rows"))


def q_complete_summary(spark, sf_dir):
    _, parsed, matched = _summarise(_press_topics(spark, sf_dir))
    summ = SM.summary_rows(parsed)
    # every press topic's articles, with the summary of those whose answer parsed
    return LD.complete_summary(_press_topics(spark, sf_dir).where(F.col("cluster_id").isNotNull()), summ) \
        .select("cluster_id", "topic_name", "image_url")


def q_target_rows(spark, sf_dir):
    final = _cycle(spark, sf_dir)
    return ST.target_rows(final, ST.target_clusters(final)).select("is_new", "pos", "cluster_id")
