import tempfile

from pyspark.sql import types as T

from newsweave.sources import files as FS


def test_csv_roundtrip_multiline_and_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="nw-csv-", dir="/tmp")
    with open(d + "/a.csv", "w", encoding="utf-8-sig") as f:
        f.write('title,news_summary,n\n"a","line1\nline2",1\nNA,"x",nan\n')
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("news_summary", T.StringType()),
                           T.StructField("n", T.IntegerType())])
    rows = FS.read_csv_table(spark, d + "/a.csv", schema).collect()
    assert [tuple(r) for r in rows] == [("a", "line1\nline2", 1), (None, "x", None)]


def test_failed_jsonl_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="nw-json-", dir="/tmp") + "/failed"
    df = spark.createDataFrame([(3, "2025-01-01 00:00:00", "bad {")], "cluster_id long, timestamp string, response string")
    FS.write_failed(df, d)
    FS.write_failed(df, d)
    got = FS.read_failed(spark, d)
    assert got.count() == 2 and got.select("cluster_id").distinct().count() == 1


def test_csv_columns_by_header_name_and_float_like_ints(spark):
    d = tempfile.mkdtemp(prefix="nw-csv-", dir="/tmp")
    with open(d + "/a.csv", "w", encoding="utf-8-sig") as f:
        f.write("cluster_id,other,title\n3.0,x,a\n,y,b\n4,z,NA\n")
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("cluster_id", T.IntegerType()), T.StructField("gone", T.StringType())])
    rows = FS.read_csv_table(spark, d + "/a.csv", schema).collect()
    assert [tuple(r) for r in rows] == [("a", 3, None), ("b", None, None), (None, 4, None)]
