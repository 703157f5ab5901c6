"""Options and statements for databases; none is started."""

import pytest

from newsweave.sources import jdbc as J

DB = J.Database("jdbc:mysql://h/news", (("user", "u"),))


def test_reads_push_projection_condition_and_ranges():
    o = J.read_options(DB, "news", ["topic_id", "title"], "is_new = 1", J.Split("topic_id", 0, 1000, 8))
    assert o == {"url": "jdbc:mysql://h/news", "user": "u", "dbtable": "(SELECT topic_id, title FROM news WHERE is_new = 1) q", "fetchsize": "10000", "pushDownPredicate": "true",
                 "partitionColumn": "topic_id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}
    assert "partitionColumn" not in J.read_options(DB, "news", ["id"], None, J.Split("id", 5, 5, 8))
    assert J.read_options(DB, "topic", ["id"], None, J.Split("id", 0, 3, 8))["numPartitions"] == "3"
    with pytest.raises(ValueError):
        J.read_options(DB, "news", ["title"], None, J.Split("topic_id", 0, 9, 2))
    for bad in ("news; DROP TABLE topic", "a b", "", "x--"):
        with pytest.raises(ValueError):
            J.read_options(DB, bad, ["id"])


def test_appends_move_new_keys_only():
    assert J.stage_options(DB, "news", "main_7") == {"url": "jdbc:mysql://h/news", "user": "u", "dbtable": "news_stage_main_7", "batchsize": "10000", "truncate": "true"}
    assert J.move_statement("news", "7", ["topic_id", "title"], ["topic_id", "title"]) == (
        "INSERT INTO news (topic_id, title) SELECT DISTINCT s.topic_id, s.title FROM news_stage_7 s WHERE NOT EXISTS (SELECT 1 FROM news t WHERE "
        "(t.topic_id = s.topic_id OR (t.topic_id IS NULL AND s.topic_id IS NULL)) AND (t.title = s.title OR (t.title IS NULL AND s.title IS NULL)))")
