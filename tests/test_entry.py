"""Driver contract: every registered query has an oracle, and the flagship runs at sf0.001."""

import re

import __spark_entry__ as E


def test_every_query_has_an_oracle():
    own = {q for q in E.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert own <= set(E.oracle_sql()) <= set(E.queries())
    assert len(own) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["cluster_id", "n_articles", "n_new"]
    assert len(rows) > 0 and all(r.n_articles >= 2 for r in rows)
