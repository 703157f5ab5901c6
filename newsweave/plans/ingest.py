"""Article ingest: preprocessing (P-7..P-10), sort/filter (W-1, P-14, P-15), keep-first
dedup (A-9), accumulation (U-1), link-list bookkeeping (W-2..W-5, J-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.functions import text as TX
from newsweave.operators.relational import attach_row, keep_first
from newsweave.sources.tables import Files


def preprocess(df: DataFrame, tokenizer=TX.regex_tokens) -> DataFrame:
    """P-9: Hanja -> Hangul then cleaning on title and summary, Korean date parsing, and
    the token list of ``title + ' ' + summary``. One projection, no UDF."""
    if "summary" not in df.columns and "news_summary" in df.columns:   # P-7 fallbacks
        df = df.withColumn("summary", F.col("news_summary"))
    if "datetime" not in df.columns and "publish_date" in df.columns:
        df = df.withColumn("datetime", F.col("publish_date"))
    cols = {}
    for c in ("title", "summary"):
        if c in df.columns:
            cols[c] = TX.clean_content(TX.hanja_to_hangul(TX.fill_str(c)))
    df = df.withColumns(cols)
    if "datetime" in df.columns:
        df = df.withColumn("publish_date", TX.korean_datetime("datetime"))
    text = TX.strip_py(F.concat(TX.fill_str("title") if "title" in df.columns else F.lit(""), F.lit(" "),
                                TX.fill_str("summary") if "summary" in df.columns else F.lit("")))
    return df.withColumn("konlpy_nouns", tokenizer(text))


def preprocess_alt(df: DataFrame, tokenizer=TX.regex_tokens) -> DataFrame:
    """P-10: title cleaned only, news_summary Hanja-converted only, date parsed, tokens of
    news_summary."""
    df = df.withColumns({
        "title": TX.clean_content("title"),
        "news_summary": TX.hanja_to_hangul(TX.fill_str("news_summary")),
        "publish_date": TX.korean_datetime("publish_date"),
    })
    return df.withColumn("konlpy_nouns", tokenizer(TX.fill_str("news_summary")))


def crawl_frame(raw: DataFrame) -> DataFrame:
    """Crawler post-processing (P-14, P-5, W-1): drop blank summaries, parse the sort time,
    drop unparseable times, order newest first (news_link breaks ties)."""
    return (raw.where(TX.nonempty_text("news_summary"))
            .withColumn("_sort_ts", TX.lenient_timestamp("datetime_sort"))
            .where(F.col("_sort_ts").isNotNull())
            .orderBy(F.col("_sort_ts").desc(), F.col("news_link"))
            .drop("_sort_ts", "datetime_sort"))


def accumulate(new: DataFrame, total: DataFrame, key: str = "news_link",
               order_col: str = "pos") -> DataFrame:
    """U-1: new rows first, then the accumulated ones; first row per key wins (new wins).
    Row order is carried as (batch, pos) so that keep-first is a grouped min, not a sort."""
    both = new.withColumn("_batch", F.lit(0)).unionByName(
        total.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, [key], ["_batch", order_col])


def skip_first(df: DataFrame, n: int = 5, order_col: str = "pos") -> DataFrame:
    """W-5: drop the first n rows by position. The cut-off is the n-th smallest position,
    found with a top-n (per-partition heaps), then a plain filter; no global sort."""
    if n <= 0:
        return df
    cut = df.select(order_col).orderBy(order_col).limit(n).agg(F.max(order_col).alias("_cut"))
    return attach_row(df, cut).where(
        F.col("_cut").isNull() | (F.col(order_col) > F.col("_cut"))).drop("_cut")


def last_seen(df: DataFrame, key: str = "news_link", order_col: str = "pos") -> DataFrame:
    """W-2: the first row's link = the last-seen marker (one row, null when empty)."""
    return df.agg(F.min_by(key, order_col).alias("last_seen_link"))


def load_marker(spark, pending_path: str, total_path: str, key: str = "news_link", order_col: str = "pos"):
    """W-2 over stored tables: (waiting links, marker). The list of waiting links counts if it is
    there, even empty or without links (then there is no marker); only without it the accumulated
    articles give the marker, and nothing waits. The marker is one row, null when unknown."""
    nothing = spark.createDataFrame([], f"{key} string, {order_col} long")
    for path, waits in ((pending_path, True), (total_path, False)):
        if Files(spark, path).exists(path):
            df = spark.read.parquet(path)
            df = df if key in df.columns else nothing
            return (df if waits else nothing), last_seen(df, key, order_col)
    return nothing, last_seen(nothing, key, order_col)


def new_links(listing: DataFrame, marker: DataFrame, cap: int | None = None,
              key: str = "news_link", order_cols=("pos",)) -> DataFrame:
    """W-3: links before the first occurrence of the marker, first occurrence of each link
    kept, in listing order. ``cap`` limits a trial run; links beyond it are lost for good,
    because the newest link is the next marker, so there is none by default."""
    order = F.struct(*[F.col(c) for c in order_cols])
    stop = listing.join(F.broadcast(marker), listing[key] == marker["last_seen_link"], "left_semi") \
        .agg(F.min(order).alias("_stop"))
    before = attach_row(listing, stop) \
        .where(F.col("_stop").isNull() | (order < F.col("_stop"))).drop("_stop")
    firsts = keep_first(before.where(F.col(key).isNotNull() & (F.col(key) != "")), [key], list(order_cols))
    out = firsts.orderBy(*order_cols)
    return out.limit(cap) if cap else out


def merge_links(new: DataFrame, prev: DataFrame, key: str = "news_link") -> DataFrame:
    """J-12: new links first, then previous links not among the new ones; order kept as
    (batch, pos)."""
    old = prev.join(new.select(key).distinct(), key, "left_anti")
    return (new.select(key, F.lit(0).alias("batch"), "pos")
            .unionByName(old.select(key, F.lit(1).alias("batch"), "pos")))


def gated(merged: DataFrame, min_count: int = 3) -> DataFrame:
    """W-4: (n_links, proceed) of the merged list, new and waiting links together; the list is
    kept either way, the cycle goes on only with enough links."""
    return merged.agg(F.count("*").alias("n_links"), (F.count("*") >= min_count).alias("proceed"))
