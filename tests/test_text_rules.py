"""Golden rows for the scalar rules (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from newsweave.functions import text as TX

NL = "\n"

CLEAN = [
    ("[속보] 금리 인하 △확정", "금리 인하 확정"),
    ("문의 hong @ news.co.kr 바랍니다", "문의 바랍니다"),
    ("hong@news.co.kr로 문의", "문의"),
    ("@홍길동 기자", "기자"),
    ("https://a.b/c 읽기", "읽기"),
    ("기사 ※ 공지 사항", "기사"),
    ("앞 사진=연합뉴스 뒤" + NL + "다음", "앞 다음"),
    ("앞 사진=" + NL + "다음 줄", "앞"),
    ("카카오톡 : @abc", "카카오톡 :"),
    ("본문입니다. ⓒ 한국경제 무단전재. 끝", "본문입니다. 끝"),
    ("▲1.5% 상승", "5% 상승"),
    ("중국 韓中 회담", "중국 회담"),
    (None, None),
]


def _one(spark, expr, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_clean_content(spark):
    got = _one(spark, TX.clean_content("v"), [c[0] for c in CLEAN])
    assert got == [c[1] for c in CLEAN]


def test_hanja_then_clean(spark):
    got = _one(spark, TX.clean_content(TX.hanja_to_hangul("v")), ["중국 韓中 회담", "農心 실적"])
    assert got == ["중국 한국중국 회담", "농업 실적"]


def test_remove_brackets(spark):
    assert _one(spark, TX.remove_brackets("v"), ["[단독] 제목 [종합]"]) == ["제목"]


def test_korean_datetime(spark):
    rows = [("2025.07.10. 오후 7:58", dt.datetime(2025, 7, 10, 19, 58)),
            ("2025.07.10. 오전 12:05", dt.datetime(2025, 7, 10, 0, 5)),
            ("2025.07.10. 오후 12:05", dt.datetime(2025, 7, 10, 12, 5)),
            ("2025.07.10. 오전 13:00", dt.datetime(2025, 7, 10, 13, 0)),
            ("2025.07.10. 오후 13:00", None),
            ("2025.07.10. 오후 7:58 수정", dt.datetime(2025, 7, 10, 19, 58)),
            ("2025.13.10. 오전 1:00", None), ("2025.07.10.", None), (None, None)]
    assert _one(spark, TX.korean_datetime("v"), [r[0] for r in rows]) == [r[1] for r in rows]


def test_list_and_vector_cells(spark):
    assert _one(spark, TX.parse_list_literal("v"), ["['가', \"it's\"]"]) == [["가", "it's"]]
    got = _one(spark, TX.parse_vector_text("v"), ["[ 0.1 -2.e-01" + NL + " 3. ]"])[0]
    assert [round(x, 6) for x in got] == [0.1, -0.2, 3.0]


def test_image_emptiness(spark):
    vals = [None, "", " ", "nan", "NaN", "None", "null", "NULL", "NA", "NaT", "http://x/a.jpg"]
    assert _one(spark, TX.is_empty_image("v"), vals) == [True] * 10 + [False]
    assert _one(spark, TX.normalise_image_url("v"), vals) == \
        ["", "", "", "", "", "", "null", "NULL", "NA", "NaT", "http://x/a.jpg"]


def test_safe_filename_and_srcset(spark):
    assert _one(spark, TX.safe_filename("v"), ["https://h/p/a%20b+c.jpg?x=1"]) == ["a_b_c.jpg"]
    assert _one(spark, TX.last_of_srcset("v"), ["a 1x, http://h/b 2x", "", None]) == ["http://h/b", None, None]


def test_freshness(spark):
    from newsweave.plans.load import refresh_is_new
    df = spark.createDataFrame([(v,) for v in ["2025-07-10 12:00:00", "2025-07-10 11:59:59",
                                               "2025-07-11 09:00", None, "abc"]], "publish_date string")
    got = [r.is_new for r in refresh_is_new(df, "2025-07-11 12:00:00").collect()]
    assert got == [1, 0, 1, 0, 0]


def test_prompt_title_count(spark):
    p = "1. title: a" + NL + "x" + NL + NL + "2. title: b" + NL
    assert _one(spark, TX.prompt_title_count("v"), [p]) == [2]


def test_strip_knows_every_white_space_character(spark):
    every = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    values = [f"{c}a{c} b{c}{c}" for c in every if c != "\0"]
    assert _one(spark, TX.strip_py("v"), values) == [v.strip() for v in values]


def test_costly_rules_run_only_where_their_mark_is(spark):
    plan = spark.createDataFrame([("a",)], "v string").select(TX.clean_content(TX.hanja_to_hangul("v")).alias("c"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") == 15   # every rule but the last two, which each text needs
    marks = [("a  b \t c\xa0 ", "a b c"), ("x　", "x"), ("é é", "é é"), ("中é", "중국é"), ("[中]a", "a"), ("a@", "a@"), ("url.kr/x y", "y")]
    assert _one(spark, TX.clean_content(TX.hanja_to_hangul("v")), [m for m, _ in marks]) == [w for _, w in marks]
