"""Ledger, keyed tables, dated output and the whole cycle with induced failures."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsweave.plans import cycle as CY
from newsweave.plans import summaries as SM
from newsweave.plans.ingest import load_marker
from newsweave.sources import tables as TB
from newsweave.sources.files import read_failed
from newsweave.streaming.cycle import article_stream
from newsweave.streaming.ledger import Ledger

COLS = "title string, press string, news_summary string, publish_date string, datetime_sort string, news_link string, pos long"
THEMES = ["storm coast harbour flood warning sailors", "election vote senate ballot recount governor", "striker goal league match keeper final"]


def raw(first, n):
    """Articles about three themes; every seventh is about nothing else's theme."""
    rows = []
    for i in range(first, first + n):
        theme = THEMES[i % 3] if i % 7 else f"lone{i} topic{i} of{i} its{i} own{i}"
        rows.append((f"title {i}", f"press {i % 2}", f"{theme} {theme} report{i % 4}", "2024.01.02. 오전 7:58", None, f"l{i}", i))
    return rows


def run(spark, top, fail=()):
    """Two batches through the stream; the responder, the image source or the table fails once
    where ``fail`` says so. Returns the numbers of prompts asked."""
    asked, left = [], list(fail)

    def failing(name):
        if name in left:
            left.remove(name)
            raise RuntimeError(f"induced in {name}")

    def responder(prompts):
        failing("answers")
        asked.append(prompts.count())
        return SM.template_responder(prompts)

    def images(articles):
        failing("images")
        return articles.select("news_link", F.concat(F.lit("http://img/"), "news_link").alias("image_url"))
    cycle = CY.Cycle(spark, f"{top}/state", responder, images, parts=2, buckets=8, clock=lambda: datetime(2024, 1, 2, 9, 0))
    insert = CY.insert_news

    def insert_failing(*args):
        failing("news")
        return insert(*args)
    CY.insert_news = insert_failing
    try:
        for k, rows in enumerate((raw(0, 18), raw(15, 14))):
            spark.createDataFrame(rows, COLS).coalesce(1).write.parquet(f"{top}/src/part{k}")
            for attempt in range(5):
                try:
                    article_stream(spark, f"{top}/src/*", f"{top}/articles", f"{top}/ck", cycle).awaitTermination(300)
                    break
                except Exception as e:  # noqa: BLE001
                    assert "induced" in str(e)
    finally:
        CY.insert_news = insert
    return cycle, asked, left


def test_two_cycles_with_failures_equal_undisturbed_ones(spark, tmp_path):
    calm, asked, _ = run(spark, str(tmp_path / "calm"))
    hurt, asked_again, left = run(spark, str(tmp_path / "hurt"), fail=["answers", "images", "news"])
    assert not left
    for a, b in ((calm.topics, hurt.topics), (calm.news, hurt.news)):
        rows = sorted(map(tuple, a.read().collect()), key=str)
        assert rows and rows == sorted(map(tuple, b.read().collect()), key=str)
    assert sum(asked) == sum(asked_again)  # no finished part is asked again
    articles = [r.news_link for r in spark.read.parquet(str(tmp_path / "hurt" / "articles")).collect()]
    assert sorted(articles) == sorted(f"l{i}" for i in range(29))
    for name in ("summary", "summary_articles"):
        both = [sorted(map(str, TB.read_dated(spark, f"{c.top}/{name}").collect())) for c in (calm, hurt)]
        assert both[0] == both[1]
    failed = [sorted((r.cluster_id, r.response) for r in read_failed(spark, f"{c.top}/failed").collect()) for c in (calm, hurt)]
    assert failed[0] == failed[1]
    # every news row belongs to a stored topic, and topics with articles have an image
    topics = {r.id: r.image_url for r in calm.topics.read().collect()}
    assert {r.topic_id for r in calm.news.read().collect()} <= set(topics) and all(u.startswith("http://img/l") for u in topics.values())


def test_keyed_table(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    t = TB.KeyedTable(spark, str(tmp_path / "t"), ["k"], schema, buckets=16)

    def rows(*r):
        return spark.createDataFrame(list(r), "k int, v string")

    def replace(stored, new):
        return stored.join(new, "k", "left_anti").unionByName(new)
    assert t.read().count() == 0
    assert t.update(rows(*[(i, "a") for i in range(40)], (None, "n")), replace, "s", 0)
    before = t.manifest()
    old = t.read()
    assert t.update(rows((3, "b"), (100, "b")), replace, "s", 1)
    after = t.manifest()
    changed = [b for b in after["folders"] if before["folders"].get(b) != after["folders"][b]]
    assert 1 <= len(changed) <= 2  # only buckets of changed keys are written
    assert not t.update(rows((3, "never")), replace, "s", 1) and t.update(rows((4, "c")), replace, "other", 0)
    got = {r.k: r.v for r in t.read().collect()}
    assert got == {i: "a" for i in range(40)} | {3: "b", 100: "b", 4: "c", None: "n"}
    assert {r.k: r.v for r in old.collect()} == {r.k: r.v for r in t.read(0).collect()}  # a reader keeps its version
    with pytest.raises(ValueError, match="other keys"):
        t.update(rows((5, "x")), lambda stored, new: rows(*[(i, "y") for i in range(64)]))
    t.update(rows((3, "b")), lambda stored, new: stored.where("k <> 3"))
    assert 3 not in {r.k for r in t.read().collect()}
    assert t.vacuum(keep=1) > 0 and t.read().count() == 41
    with pytest.raises(RuntimeError, match="another writer"):
        t.files.publish(f"{t.top}/manifests/{max(t.versions()):012d}.json", "{}")


def test_dated_output_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    for day, cycle in (("2024-01-01", 0), ("2024-01-02", 0), ("2024-01-02", 1), ("2024-01-02", 1)):
        TB.write_dated(df.withColumn("y", F.lit(cycle)), path, day, cycle)
    last = TB.read_dated(spark, path)
    assert TB.dates(spark, path) == ["2024-01-01", "2024-01-02"] and last.count() == 4 and TB.read_dated(spark, path, "2024-01-01").count() == 2
    assert sorted({f.split("run_date=")[1][:10] for f in last.inputFiles()}) == ["2024-01-02"]
    with pytest.raises(FileNotFoundError):
        TB.read_dated(spark, str(tmp_path / "none"))


def test_ledger_replaces_unfinished_steps(spark, tmp_path):
    ledger, calls = Ledger(spark, str(tmp_path / "l")), []

    def make(n):
        calls.append(n)
        return spark.range(n)
    (tmp_path / "l" / "a" / "stream=main" / "batch_id=0" / "_temporary").mkdir(parents=True)
    assert ledger.earlier("a", 1) is None and ledger.last("a", 1) is None
    assert ledger.once("a", 0, lambda: make(2)).count() == 2 and ledger.once("a", 0, lambda: make(3)).count() == 2 and calls == [2]
    assert ledger.once("a", 1, lambda: make(4)).count() == 4
    assert ledger.earlier("a", 1).count() == 2 and ledger.earlier("a", 0) is None and ledger.last("a", 5).count() == 4
    assert Ledger(spark, str(tmp_path / "l"), "other").earlier("a", 0).count() == 6


def test_marker_and_lookup_fall_back(spark, tmp_path):
    pending, total = str(tmp_path / "pending"), str(tmp_path / "total")

    def seen():
        waiting, marker = load_marker(spark, pending, total)
        return [r.news_link for r in waiting.orderBy("pos").collect()], marker.first()["last_seen_link"]
    assert seen() == ([], None)
    links = "news_link string, pos long"
    spark.createDataFrame([("t2", 2), ("t1", 1)], links).write.parquet(total)
    assert seen() == ([], "t1")
    spark.createDataFrame([], links).write.parquet(pending)
    assert seen() == ([], None)
    spark.createDataFrame([("p9", 9), ("p3", 3)], links).write.mode("overwrite").parquet(pending)
    assert seen() == (["p3", "p9"], "p3")
    assert TB.first_available(spark, [str(tmp_path / "x"), total], ["news_link"]).count() == 2
    assert TB.first_available(spark, [str(tmp_path / "x"), total], ["image_url"]) is None


def test_answers_for_another_cluster_fail(spark):
    answer = '{"cluster_id": %s, "topic_name": "t", "article_titles": []}'
    rows = [(1, answer % 1), (2, answer % 7), (3, answer % '"3"'), (4, answer % "null"), (5, answer % '"x"')]
    got = {r.cluster_id: r.status for r in SM.parse_responses(spark.createDataFrame(rows, "cluster_id long, response string"), "now").collect()}
    assert got == {1: "ok", 2: "failed", 3: "ok", 4: "ok", 5: "failed"}
