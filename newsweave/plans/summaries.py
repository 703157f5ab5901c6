"""Summary stage: prompts per cluster (A-10), answer parsing (P-21, P-22), title matching
(J-5), summary / article / failure outputs (C-11, SNK-2, SNK-4), retry selection (C-12).

The LLM call itself is outside Spark: a ``responder`` is any function
DataFrame(cluster_id, prompt, ...) -> DataFrame(cluster_id, response).
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsweave.functions.text import FAILURE_MARK
from newsweave.session import checkpoint_dir

NOISE = -1

# The prompt the reference sends for one cluster ({articles}, {cluster_id},
# {summary_time} are filled in), and the layout of one article inside it.
PROMPT_TEMPLATE = """반드시 주어진 기사 데이터만을 사용하여, 뉴스 기사들을 분석하여 JSON으로 응답해주세요.

기사 데이터:
{articles}

다음 JSON 형식으로만 응답하세요:

{{
  "cluster_id": {cluster_id},
  "topic_name": "이 기사들의 공통 주제를 한 줄로 정리",
  "ai_summary": "통합 요약문을 6문장 이상으로 작성",
  "summary_time": "{summary_time}",
  "article_titles": [
    "기사 제목1",
    "기사 제목2"
  ]
}}

중요:
1. 반드시 위 JSON 형식만 출력
2. article_titles에는 분석한 기사의 정확한 제목만 포함
3. cluster_id는 숫자 {cluster_id}로 설정"""
ARTICLE_LAYOUT = "{n}. title: {title}\nnews_summary: {news_summary}\npress: {press}\n"
TITLE_LAYOUT = "{title}\nnews_summary: "


def _fmt(template: str, **cols):
    """Fill a str.format-style template with Column values, natively (split on the named
    fields, concat the pieces)."""
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts.append(F.lit(template[pos:m.start()].replace("{{", "{").replace("}}", "}")))
        parts.append(F.coalesce(cols[m.group(1)].cast("string"), F.lit("nan")))
        pos = m.end()
    parts.append(F.lit(template[pos:].replace("{{", "{").replace("}}", "}")))
    return F.concat(*parts)


def large_clusters(df: DataFrame, cluster_col: str = "cluster_id", min_size: int = 2) -> DataFrame:
    """A-2: clusters (not -1) with at least ``min_size`` rows: (cluster_id, n)."""
    return (df.where(F.col(cluster_col).isNotNull() & (F.col(cluster_col) != NOISE))
            .groupBy(F.col(cluster_col).cast("int").alias("cluster_id")).agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_size))


def build_prompts(df: DataFrame, summary_time: str, cluster_col: str = "cluster_id",
                  order_col: str = "pos", min_size: int = 2, chunk_rows: int = 10_000) -> DataFrame:
    """A-10: one prompt per cluster of size >= 2, whatever its size; articles in row order,
    numbered pos + 1, joined by a blank line.

    Articles are laid out in ranges of ``chunk_rows`` positions first, so the sorting and
    rendering of a large cluster is spread over many tasks; the last step only joins the
    finished chunks in order. The result does not depend on ``chunk_rows``. Titles and texts are
    gathered apart, so a caller that reads no prompt never holds a cluster's texts.
    """
    o = F.col(order_col).alias("o")
    docs = df.where(F.col(cluster_col).isNotNull() & (F.col(cluster_col) != NOISE)).select(
        F.col(cluster_col).cast("int").alias("cluster_id"), F.floor(F.col(order_col) / F.lit(chunk_rows)).alias("chunk"),
        F.struct(o, _fmt(ARTICLE_LAYOUT, n=F.col(order_col) + 1, title=F.col("title"),
                         news_summary=F.col("news_summary"), press=F.col("press")).alias("t")).alias("d"),
        # titles of one position come in the order of its texts
        F.struct(o, _fmt(TITLE_LAYOUT, title=F.col("title")).alias("t"), F.col("title").alias("title")).alias("h"))
    chunks = (docs.groupBy("cluster_id", "chunk")
              .agg(F.count("*").alias("n"), F.sort_array(F.collect_list("d")).alias("ds"), F.sort_array(F.collect_list("h")).alias("hs"))
              .select("cluster_id", "n", F.struct("chunk", F.array_join(F.transform("ds", lambda d: d["t"]), "\n\n").alias("text")).alias("c"),
                      F.struct("chunk", F.transform("hs", lambda h: h["title"]).alias("titles")).alias("h")))
    whole = (chunks.groupBy("cluster_id")
             .agg(F.sum("n").alias("n"), F.sort_array(F.collect_list("c")).alias("cs"), F.sort_array(F.collect_list("h")).alias("hs"))
             .where(F.col("n") >= min_size))
    body = F.array_join(F.transform("cs", lambda c: c["text"]), "\n\n")
    return whole.select("cluster_id", "n", F.flatten(F.transform("hs", lambda h: h["titles"])).alias("titles"),
                        _fmt(PROMPT_TEMPLATE, articles=body, cluster_id=F.col("cluster_id"),
                             summary_time=F.lit(summary_time)).alias("prompt"))


# --- P-21 / P-22: strict JSON parsing -------------------------------------------------------------
PARSED = T.StructType([
    T.StructField("status", T.StringType()),        # ok | failed | skipped
    T.StructField("cluster_id", T.StringType()),
    T.StructField("topic_name", T.StringType()),
    T.StructField("ai_summary", T.StringType()),
    T.StructField("summary_time", T.StringType()),
    T.StructField("article_titles", T.ArrayType(T.StringType())),
])

# Fixed value: a fenced block of JSON inside an answer.
_BLOCK = re.compile(r"```json\s*\n(.*?)\n```", re.DOTALL)


def _parse_one(text):
    if text is None or text == "" or text.startswith(FAILURE_MARK):
        return ("skipped", None, None, None, None, None)
    obj = None
    if text.strip():
        try:
            obj = json.loads(text.strip())
        except Exception:  # noqa: BLE001
            m = _BLOCK.search(text)
            if m:
                try:
                    obj = json.loads(m.group(1).strip())
                except Exception:  # noqa: BLE001
                    obj = None
    if not obj or not isinstance(obj, dict):
        return ("failed", None, None, None, None, None)

    def s(v):
        return None if v is None else (v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))

    titles = obj.get("article_titles", [])
    titles = [s(t) for t in titles] if isinstance(titles, list) else []
    return ("ok", s(obj.get("cluster_id")), s(obj.get("topic_name")), s(obj.get("ai_summary")),
            s(obj.get("summary_time")), titles)


@F.arrow_udf(PARSED)
def parse_answer(texts: pa.Array) -> pa.Array:
    columns = list(zip(*[_parse_one(t.as_py()) for t in texts])) or [()] * len(PARSED)
    kinds = [pa.list_(pa.string()) if f.name == "article_titles" else pa.string() for f in PARSED]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], PARSED.names)


def parse_responses(responses: DataFrame, run_time: str) -> DataFrame:
    """(cluster_id, response) -> (cluster_id, status, response, summary_time, topic_name,
    ai_summary, article_titles) with the reference's defaults for missing fields. An answer that
    names another cluster than the one asked for has failed; one that names none has not. Answers
    are dealt over many tasks, as an answer grows with its cluster and a Python worker holds all
    of a task's answers at once."""
    tasks = int(responses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = responses.repartition(tasks, "cluster_id").withColumn("_p", parse_answer(F.col("response")))
    other = F.col("_p.cluster_id").isNotNull() & ~F.col("_p.cluster_id").try_cast("double").eqNullSafe(F.col("cluster_id").cast("double"))
    return p.select(
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.when((F.col("_p.status") == "ok") & other, F.lit("failed")).otherwise(F.col("_p.status")).alias("status"), "response",
        F.coalesce("_p.summary_time", F.lit(run_time)).alias("summary_time"),
        F.coalesce("_p.topic_name", F.lit("")).alias("topic_name"),
        F.coalesce("_p.ai_summary", F.lit("")).alias("ai_summary"),
        F.coalesce("_p.article_titles", F.array().cast("array<string>")).alias("article_titles"))


def store_answers(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers without response and titles, their titles as rows for ``match_titles``), stored.
    An answer is as long as its cluster, so where several branches read the answers, each of them
    would hold a whole one at the same time; here it is held once, and read as short rows."""
    checkpoint_dir(parsed.sparkSession)
    heads = [c for c in parsed.columns if c not in ("cluster_id", "status", "response", "article_titles")]
    rows = parsed.select("cluster_id", "status", *heads, F.posexplode_outer("article_titles").alias("title_pos", "_t"))
    first = F.coalesce("title_pos", F.lit(0)) == 0
    rows = rows.withColumns({c: F.when(first, F.col(c)) for c in heads}).checkpoint()
    return rows.where(first).drop("title_pos", "_t"), rows.where("title_pos is not null").select("cluster_id", "status", "title_pos", "_t")


def match_titles(parsed: DataFrame, articles: DataFrame, cluster_col: str = "cluster_id",
                 order_col: str = "pos") -> DataFrame:
    """J-5: exact title match inside the cluster; the first article (row order) per title;
    output in the order the answer lists titles (``title_pos``), repeats kept. Every column has
    its own aggregate by the same order, so columns that nobody reads are not shuffled.
    ``parsed``: answers, or the titles of ``store_answers``."""
    cols = [c for c in articles.columns if c != cluster_col]
    firsts = (articles.where(F.col(cluster_col) != NOISE)
              .groupBy(F.col(cluster_col).cast("int").alias("cluster_id"), F.col("title").alias("_t"))
              .agg(*[F.min_by(c, order_col).alias(f"_a_{c}") for c in cols]))
    titles = [F.col("title_pos"), F.col("_t")] if "title_pos" in parsed.columns else [F.posexplode("article_titles").alias("title_pos", "_t")]
    asked = parsed.where(F.col("status") == "ok").select("cluster_id", *titles)
    return asked.join(firsts, ["cluster_id", "_t"]).select("cluster_id", "title_pos", *[F.col(f"_a_{c}").alias(c) for c in cols])


def summary_rows(parsed: DataFrame) -> DataFrame:
    """SNK-2 rows of the summary table for successful answers (saved id = requested id)."""
    return parsed.where(F.col("status") == "ok").select(
        "cluster_id", "summary_time", "topic_name", "ai_summary", F.lit("").alias("image_url"))


def summary_article_rows(matched: DataFrame) -> DataFrame:
    return matched.select(
        F.col("cluster_id").cast("int"), "title", "news_link", "press",
        F.date_format(F.col("publish_date"), "yyyy-MM-dd HH:mm:ss").alias("publish_date")
        if dict(matched.dtypes).get("publish_date", "").startswith("timestamp") else F.col("publish_date"),
        F.coalesce("news_summary", F.lit("")).alias("news_summary"),
        F.coalesce(F.col("is_new").cast("int"), F.lit(0)).alias("is_new"),
        F.coalesce(F.col("is_third").cast("int"), F.lit(0)).alias("is_third"))


def failed_rows(parsed: DataFrame, run_ts: str) -> DataFrame:
    """SNK-4 records: answers that were not skipped and did not parse to an object."""
    return parsed.where(F.col("status") == "failed").select(
        F.col("cluster_id").cast("long"), F.lit(run_ts).alias("timestamp"), "response")


def retry_prompts(failed: DataFrame, df: DataFrame, summary_time: str, cluster_col: str = "cluster_id") -> DataFrame:
    """C-12: distinct failed ids whose cluster still has >= 2 rows, prompts rebuilt."""
    ids = failed.select(F.col("cluster_id").cast("int").alias(cluster_col)).distinct()
    return build_prompts(df.join(ids, cluster_col, "left_semi"), summary_time, cluster_col)


def template_responder(prompts: DataFrame) -> DataFrame:
    """Deterministic stand-in for the LLM, built from each prompt part's own articles: the
    titles are listed newest position first; clusters whose id % 5 == 1 answer inside a
    ```json block, id % 5 == 2 with trailing words (a parse failure), id % 5 == 3 with the
    failure mark (skipped). Used by tests and registered queries; production passes its own."""
    titles = F.reverse(F.col("titles"))
    obj = F.to_json(F.struct(
        F.col("cluster_id"), F.concat(F.lit("topic "), F.col("cluster_id").cast("string")).alias("topic_name"),
        F.concat(F.lit("summary of "), F.size("titles").cast("string"), F.lit(" articles")).alias("ai_summary"),
        F.lit("2025-07-11 09:00").alias("summary_time"),
        titles.alias("article_titles")))
    k = F.col("cluster_id") % 5
    resp = (F.when(k == 1, F.concat(F.lit("Here it is:\n```json\n"), obj, F.lit("\n```\nthanks")))
            .when(k == 2, F.concat(obj, F.lit(" trailing words")))
            .when(k == 3, F.lit(FAILURE_MARK + ": 500]"))
            .otherwise(obj))
    return prompts.select(F.col("cluster_id").cast("long"), resp.alias("response"))
