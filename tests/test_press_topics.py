"""Queries over the press topics, on a small table of documents."""

import pytest

from newsweave.operators.relational import keep_first
from newsweave.plans import registry as R
from newsweave.plans import summaries as SM

TOPICS = 11
OK = {t for t in range(TOPICS) if t % 5 not in (2, 3)}


@pytest.fixture(scope="module")
def docs_dir(spark, tmp_path_factory):
    """Six documents of each of eleven sources; each has a title of its own."""
    top = str(tmp_path_factory.mktemp("press"))
    rows = [(i, f"Title {i}\nSome words of text {i}", "en", f"src{i % TOPICS}", 10) for i in range(6 * TOPICS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1) \
        .write.parquet(f"{top}/documents.parquet")
    return top


def test_topic_images_reach_every_stored_topic(spark, docs_dir):
    got = {r.id: r.image_url for r in R.q_update_topic_images(spark, docs_dir).collect()}
    assert set(got) == OK and all(u.startswith("https://img.example.com/") for u in got.values())


def test_news_with_image_compares_with_the_news_of_every_stored_topic(spark, docs_dir):
    got = [(r.topic_id, r.title) for r in R.q_news_with_image(spark, docs_dir).collect()]
    assert sorted(got) == sorted((i % TOPICS, f"Title {i}") for i in range(0, 6 * TOPICS, 7) if i % TOPICS in OK)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_answers_do_not_carry_the_texts_of_a_cluster(spark):
    arts = spark.createDataFrame([(0, 7, "t", "long text", "p"), (1, 7, "u", "long text", "p")],
                                 "pos long, cluster_id int, title string, news_summary string, press string")
    prompts = SM.build_prompts(arts, "2025-01-01 00:00")
    answers = SM.template_responder(prompts)
    assert "press: " not in _plan(answers) and "press: " in _plan(prompts)
    assert [t.titles for t in prompts.collect()] == [["t", "u"]]
    assert "RepartitionByExpression" in _plan(SM.parse_responses(answers, "2025-01-01 00:00"))


def test_titles_of_one_position_come_in_the_order_of_their_texts(spark):
    rows = [(4, 7, t, "s", "p") for t in ("b", None, "a", "a", "o", "n")]
    arts = spark.createDataFrame(rows, "pos long, cluster_id int, title string, news_summary string, press string")
    got = SM.build_prompts(arts, "2025-01-01 00:00").first()
    assert got.titles == ["a", "a", "b", "n", None, "o"]
    assert [x.split("\n")[0] for x in got.prompt.split("5. title: ")[1:]] == ["a", "a", "b", "n", "nan", "o"]


def test_unread_columns_are_not_shuffled(spark):
    arts = spark.createDataFrame([(0, 1, "A", "l0", "x"), (1, 1, "A", "l1", "y")],
                                 "pos long, cluster_id int, title string, news_link string, news_summary string")
    parsed = spark.createDataFrame([(1, "ok", ["A"])], "cluster_id int, status string, article_titles array<string>")
    matched = SM.match_titles(parsed, arts)
    assert matched.columns == ["cluster_id", "title_pos", "pos", "title", "news_link", "news_summary"]
    assert matched.first().news_summary == "x"
    firsts = keep_first(arts, ["title"], ["pos"])
    assert firsts.columns == arts.columns and firsts.first().news_summary == "x"
    for df in (matched.select("pos", "title_pos"), firsts.select("pos")):
        assert "min_by(news_summary" not in _plan(df) and "struct(" not in _plan(df).split("min_by(")[1].split(",")[0]


@pytest.mark.parametrize("query", [R.q_news_with_image, R.q_refresh_is_new, R.q_image_completeness, R.q_insert_news, R.q_update_topic_images])
def test_answers_are_parsed_once_for_all_branches(spark, docs_dir, query):
    assert "parse_answer" not in _plan(query(spark, docs_dir))


def test_stored_answers_keep_every_answer_and_title(spark):
    rows = [(1, "ok", "t", "a1", ["x", None, "x"]), (2, "ok", "t", None, []), (3, "failed", "t", "", ["y"]), (None, "ok", "t", "a4", ["x"])]
    parsed = spark.createDataFrame(rows, "cluster_id int, status string, summary_time string, ai_summary string, article_titles array<string>")
    heads, titles = SM.store_answers(parsed)
    assert sorted(heads.collect(), key=str) == sorted([r[:4] for r in rows], key=str)
    arts = spark.createDataFrame([(5, 1, "x"), (6, 1, "x"), (7, 3, "y")], "pos long, cluster_id int, title string")
    assert sorted(SM.match_titles(titles, arts).collect()) == sorted(SM.match_titles(parsed, arts).collect()) == [(1, 0, 5, "x"), (1, 2, 5, "x")]
