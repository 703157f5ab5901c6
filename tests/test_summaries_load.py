"""Answer parsing, title matching and idempotent loads."""

from pyspark.sql import functions as F

from newsweave.plans import load as LD
from newsweave.plans import summaries as SM


def test_parse_answers(spark):
    ok = '{"cluster_id": 1, "topic_name": "t", "ai_summary": "s", "article_titles": ["a"]}'
    rows = [(1, ok), (2, "text\n```json\n" + ok.replace("1", "2", 1) + "\n```\nmore"), (3, "```\n" + ok + "\n```"),
            (4, ok + " words"), (5, ""), (6, None), (7, "  "), (8, "{}"), (9, "[1]"), (10, "[요약 실패: 500]")]
    df = spark.createDataFrame(rows, "cluster_id long, response string")
    got = {r.cluster_id: r.status for r in SM.parse_responses(df, "2025-01-01 00:00").collect()}
    assert got == {1: "ok", 2: "ok", 3: "failed", 4: "failed", 5: "skipped", 6: "skipped", 7: "failed",
                   8: "failed", 9: "failed", 10: "skipped"}


def test_match_titles_first_article_and_repeats(spark):
    arts = spark.createDataFrame([(0, 1, "A", "l0"), (1, 1, "B", "l1"), (2, 1, "A", "l2"), (3, 2, "A", "l3")],
                                 "pos long, cluster_id int, title string, news_link string")
    parsed = spark.createDataFrame([(1, "ok", ["A", "C", "A", "B"])],
                                   "cluster_id int, status string, article_titles array<string>")
    got = [(r.title_pos, r.news_link) for r in SM.match_titles(parsed, arts).orderBy("title_pos").collect()]
    assert got == [(0, "l0"), (2, "l0"), (3, "l1")]


def test_insert_news_is_idempotent(spark):
    summ = spark.createDataFrame([(1, "t", "s", "x", 1)], "cluster_id int, topic_name string, ai_summary string, summary_time string, _row int")
    arts = spark.createDataFrame([(1, "A", None, "p", "2025-01-01 00:00:00", "s", 1, 0, 0),
                                  (1, "A", None, "p", "2025-01-01 00:00:00", "s", 1, 0, 1)],
                                 "cluster_id int, title string, news_link string, press string, publish_date string, "
                                 "news_summary string, is_new int, is_third int, _row int")
    empty_topic = spark.createDataFrame([], "id int, topic_name string, ai_summary string, summary_time string")
    empty_news = spark.createDataFrame([], ", ".join(f"{c} string" for c in LD.NEWS_COLS))
    t1, n1 = LD.insert_news(arts, summ, empty_topic, empty_news)
    assert t1.count() == 1 and n1.count() == 1   # null link keys compare equal
    t2, n2 = LD.insert_news(arts, summ, t1, n1)
    assert t2.count() == 0 and n2.count() == 0


def test_prompt_does_not_depend_on_the_chunk_size(spark):
    arts = spark.createDataFrame([(i, 7, f"t{i}", "s", "p") for i in range(23)] + [(29, 8, "u", "s", "p"), (30, 8, "v", "s", "p"), (31, 9, "w", "s", "p")],
                                 "pos long, cluster_id int, title string, news_summary string, press string")
    small, large = ({r.cluster_id: r for r in SM.build_prompts(arts, "2025-01-01 00:00", chunk_rows=n).collect()} for n in (7, 10_000))
    assert small == large and set(small) == {7, 8} and small[7].n == 23
    assert small[7].titles == [f"t{i}" for i in range(23)]
    at = [small[7].prompt.index(f"{i + 1}. title: t{i}") for i in range(23)]
    assert at == sorted(at)
