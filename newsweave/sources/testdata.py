"""Pipeline inputs derived from the TESTDATA tables.

The reference reads crawled articles and a baseline of clustered articles. The driver's
tables hold neither, so we derive them deterministically from `documents`, `embeddings`
and `pages` (recipes in FIXTURES.md). Every row of the source table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.functions.text import AM, PM

# Derivation constants (FIXTURES.md §2).
LINK_PREFIX = "https://news.example.com/"
EPOCH = "2024-01-01 00:00:00"
MINUTES_PER_DOC = 37
MALFORMED_EVERY = 20          # doc_id % 20 == 19 -> date string without the Korean day half
NEW_EVERY = 7                 # vec_id % 7 == 0 -> "new" article, else baseline
BASE_CLUSTERS = 20            # vector i is planted near base vector i % 20
NOISE_EVERY = 10              # vec_id % 10 == 9 -> planted noise (raw vector)
PLANT_SCALE = 0.4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy row work (regex cleaning, n-grams) every core: a table read as fewer
    splits than the default parallelism (one small file) is redistributed. Large inputs
    already arrive in many splits and are left alone, so this never shuffles at scale."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


def _publish_ts(doc_id):
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (doc_id * MINUTES_PER_DOC).cast("int"), F.lit(0))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled-article shape: title, press, news_summary, publish_date (Korean text),
    datetime_sort (ISO text, unparseable on malformed rows), news_link, plus `pos`."""
    d = table(spark, sf_dir, "documents")
    ts = _publish_ts(F.col("doc_id"))
    hour = F.hour(ts)
    h12 = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    korean = F.concat(F.date_format(ts, "yyyy.MM.dd."), F.lit(" "),
                      F.when(hour < 12, F.lit(AM)).otherwise(F.lit(PM)), F.lit(" "),
                      h12.cast("string"), F.lit(":"), F.date_format(ts, "mm"))
    malformed = (F.col("doc_id") % MALFORMED_EVERY) == (MALFORMED_EVERY - 1)
    return d.select(
        F.col("doc_id").alias("pos"),
        F.split(F.col("text"), "\n").getItem(0).alias("title"),
        F.col("source").alias("press"),
        F.col("text").alias("news_summary"),
        F.when(malformed, F.date_format(ts, "yyyy-MM-dd HH:mm")).otherwise(korean).alias("publish_date"),
        F.when(malformed, F.lit("unknown")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("datetime_sort"),
        F.concat(F.lit(LINK_PREFIX), F.md5(F.col("text"))).alias("news_link"),
    )


def planted_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, embedding array<double>, label, is_new): vectors near 20 base vectors, every
    10th left raw as noise. The 20 base rows are a fixed-size broadcast side."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    base = F.broadcast(e.where(F.col("vec_id") < BASE_CLUSTERS)
                       .select(F.col("vec_id").alias("base_id"), F.col("embedding").alias("base")))
    j = e.join(base, (F.col("vec_id") % BASE_CLUSTERS) == F.col("base_id"), "left")
    noise = (F.col("vec_id") % NOISE_EVERY) == (NOISE_EVERY - 1)
    planted = F.zip_with("base", "embedding",
                         lambda b, x: b.cast("double") + F.lit(PLANT_SCALE) * x.cast("double"))
    raw = F.transform("embedding", lambda x: x.cast("double"))
    return j.select(
        F.col("vec_id").alias("pos"),
        F.when(noise, raw).otherwise(planted).alias("embedding"),
        F.when(noise, F.lit(-1)).otherwise((F.col("vec_id") % BASE_CLUSTERS).cast("int")).alias("label"),
        ((F.col("vec_id") % NEW_EVERY) == 0).alias("is_new"),
    )


def baseline_and_new_vectors(spark: SparkSession, sf_dir: str):
    """Split planted vectors into the clustered baseline (`tfidf_cluster_id`) and new rows."""
    v = planted_vectors(spark, sf_dir)
    baseline = v.where(~F.col("is_new")).select(
        "pos", "embedding", F.col("label").alias("tfidf_cluster_id"))
    new = v.where(F.col("is_new")).select("pos", "embedding")
    return baseline, new


def news_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): every page of the table inside an article and listing page of the
    kind the crawler reads. Fields are missing, quoted and ordered in different ways by page_id,
    image variants by page_id % 9, field variants by page_id % 8."""
    p = table(spark, sf_dir, "pages")
    i = F.col("page_id").cast("string")
    day = F.lpad((1 + F.col("page_id") % 28).cast("string"), 2, "0")
    k8, k9 = F.col("page_id") % 8, F.col("page_id") % 9

    def html(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    image = (F.when(k9 == 0, html('<img id="img1" src="https://img.example.com/', i, '.jpg">'))
             .when(k9 == 1, html("<div id='img1'><p><img data-src=\"//img.example.com/", i, '.png?w=1&amp;h=2"></p></div>'))
             .when(k9 == 2, html('<img data-id="img1" src="https://wrong/"><meta content="https://og.example.com/', i, '" property="og:image">'))
             .when(k9 == 3, html('<div id="img1"></div><img src="https://wrong/"><META name=twitter:image content=\'https://tw.example.com/', i, "'>"))
             .when(k9 == 4, html('<img id="img1" srcset="https://a.example.com/1.jpg 1x, https://a.example.com/', i, '.jpg 2x">'))
             .when(k9 == 5, html('<img id="img1" src="/relative/', i, '.jpg">'))
             .when(k9 == 7, html('<img id="img1" src="" data-origin-src="https://o.example.com/', i, '">'))
             .when(k9 == 8, html('<meta property="og:image"><meta property="og:image" content="https://late/"><meta name="twitter:image" content="https://tw.example.com/', i, '">'))
             .otherwise(F.lit("")))
    title = F.when(k8 == 5, "").otherwise(html('<h2 class="x media_end_head_headline y"><span>[속보] </span>News ', i, " &amp; <b>more</b></h2>"))
    press = F.when(k8 == 6, "").otherwise(html("<a class='media_end_head_top_logo' href=/p><span><img src=\"/l.png\" alt=\"Press ", (F.col("page_id") % 13).cast("string"), ' &lt;K&gt;"></span></a>'))
    time = F.when(k8 == 7, "").otherwise(html("<span class=\"media_end_head_info_datestamp_time\" data-date-time='2024-01-", day, " 10:00:00'> 2024.01.", day, ". 오전 10:00 </span>"))
    summary = F.when(k8 == 4, "").otherwise(html('<div class="_SUMMARY_CONTENT_BODY"><strong>[요약] Part ', i, '</strong> line<br>two<script>var x="</div>"</script></div>'))
    links = html('<div class="section_article _TEMPLATE" data-template-id="SECTION_ARTICLE_LIST"><ul><li><a class="sa_text_title" href=\'', F.col("url"), "&amp;n=", i,
                 "'> Title <em>", i, "</em></a><li><A HREF=/x/", i, ' CLASS="big sa_text_title">Second</A><li><a class="sa_text_title">none</a></ul></div>',
                 '<div class="section_article"><a class="sa_text_title" href="/not/me">out</a></div>')
    return p.select("page_id", "url", html("<html><body>", image, title, press, time, summary, links, '<div class="page">', F.col("html"), "</div></body></html>").alias("html"))
