"""Header, body, media lists, names and dates against plain Python models."""

import datetime
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newslens.functions import dates as D, text as T

FULL = ("标题: A: \"big\" day?\n网址: https://news.example.com/a/202401/15/x.html\n\n"
        "First paragraph.\n\nSecond one 2024年1月15日.\n\n图片列表:\n"
        "1. A big day_3.jpeg - 尺寸: 465x296\n2. A big day_7.png - 尺寸: 640x480\n\n\n视频列表:\n"
        "1. A big day_1_link.txt\n")


def model_body(value):
    """The line rule, line by line."""
    lines = value.split("\n")
    start = next((i for i, x in enumerate(lines) if x.strip()
                  and not x.startswith(("标题:", "网址:"))), 0)
    stop = next((i for i, x in enumerate(lines) if "图片列表:" in x or "视频列表:" in x), len(lines))
    return "\n".join(lines[start:stop])


CASES = [
    FULL, "", "\n", "标题: t\n网址: u\n\n", "标题: t\n网址: u", "标题: t\n\n \t\n网址: u\n   body line\nend",
    "no header\n\ntext", "标题: t\n网址: u\n\n图片列表:\n1. a", "标题: 图片列表: inside\n网址: u\n\nbody",
    "标题: t\n网址: u\n\nbody 视频列表: here\nmore", "a\n标题: later\nb", "　\n \nx\n", "标题:t\n网址:u\nz",
    "x\n图片列表:\n", "\n\n\n图片列表:\n", "body\n\n视频列表:\n1. v\n\n图片列表:\n1. i",
]


def test_body_by_lines(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "i int, v string")
    got = {r.i: r.b for r in df.select("i", T.body_by_lines(F.col("v")).alias("b")).collect()}
    assert got == {i: model_body(c) for i, c in enumerate(CASES)}


PIECES = st.sampled_from(["标题: ", "网址: ", "图片列表:", "视频列表:", "\n", "\n\n", " ", "word", "é。", "标题:"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=9).map("".join), min_size=40, max_size=60))
def test_body_by_lines_on_random_files(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = {r.i: r.b for r in df.select("i", T.body_by_lines(F.col("v")).alias("b")).collect()}
    assert got == {i: model_body(c) for i, c in enumerate(values)}


def test_many_blank_lines_do_not_overflow(one):
    assert one(T.body_by_lines, v="标题: t\n" + " \n" * 50_000 + "body") == "body"


@pytest.mark.parametrize("value, expected", [
    (FULL, "First paragraph.\n\nSecond one 2024年1月15日."),
    ("标题: t\n网址: u\n\n", ""),
    ("标题: t\n网址: u\n\nbody\n\n视频列表:\n1. v", "body\n\n视频列表:\n1. v"),
    ("标题: t\n网址: u\n\nbody\nSpecials\nmore\n", "body"),
    ("标题: t\n网址: u\n\nbody\nVideos\nmore", "body"),
    ("标题: t\n网址: u\n\nbody with Specials inside", "body with Specials inside"),
    ("标题: \n网址: u\n\nbody", "标题: \n网址: u\n\nbody"),
])
def test_content_by_rules(one, value, expected):
    assert one(lambda v: T.strip(T.content_by_rules(v)), v=value) == expected


def test_header(one):
    assert one(lambda v: T.header_title(v, F.lit("f.txt")), v=FULL) == 'A: "big" day?'
    assert one(lambda v: T.header_title(v, F.lit("f.txt")), v="no header") == "f.txt"
    assert one(T.header_url, v=FULL).endswith("/15/x.html")
    assert one(T.header_url, v="no header") == ""


def test_media_list(one):
    got = [tuple(m) for m in one(T.media_list, v=FULL)]
    assert got == [(1, "image", "A big day_3.jpeg", 465, 296), (2, "image", "A big day_7.png", 640, 480),
                   (1, "video", "A big day_1_link.txt", None, None)]
    wide = "b\n图片列表：\n1. x.jpg\n视频列表：\n1. y_link.txt"
    assert [m["file_name"] for m in one(T.media_list, v=wide)] == ["x.jpg", "y_link.txt"]
    assert one(T.media_list, v="nothing listed") == []
    swapped = "b\n视频列表:\n1. v.mp4\n\n图片列表:\n1. i.jpg - 尺寸: 1x2\n"
    assert [(m["kind"], m["pos"], m["width"]) for m in one(T.media_list, v=swapped)] == [
        ("image", 1, 1), ("video", 1, None)]


def test_names(one):
    assert one(T.safe_title, v='a\\b/c*d?e:f"g<h>i|j') == "abcdefghij"
    assert one(T.title_from_file_name, v="a.txt b.txt") == "a b"
    assert one(lambda v: T.guessed_image_url(F.lit("t"), v), v="x 图片列表: y") == "images/t_1.jpg"
    assert one(lambda v: T.guessed_image_url(F.lit("t"), v), v="x") is None


def test_article_text_is_inverse(spark):
    df = spark.sql("""select 'T' title, 'http://u' url, 'body' body,
        array(named_struct('file_name', 'T_1.jpg', 'width', 300, 'height', 200)) images,
        array(named_struct('file_name', 'T_1_link.txt')) videos,
        cast(array() as array<struct<file_name:string>>) nothing""")
    full = df.select(T.article_text(*[F.col(c) for c in ("title", "url", "body", "images", "videos")])).first()[0]
    assert full == ("标题: T\n网址: http://u\n\nbody\n\n图片列表:\n1. T_1.jpg - 尺寸: 300x200\n"
                    "\n\n视频列表:\n1. T_1_link.txt\n")
    parsed = spark.createDataFrame([(full,)], "v string").select(
        T.header_title(F.col("v"), F.lit("")), T.header_url(F.col("v")), T.body_by_lines(F.col("v")),
        T.media_list(F.col("v"))).first()
    assert parsed[0] == "T" and parsed[1] == "http://u" and parsed[2].strip() == "body" and len(parsed[3]) == 2


D1 = datetime.date(2024, 1, 15)


@pytest.mark.parametrize("text, strict, documented", [
    ("on 2024年1月15日 we", D1, D1), ("2024-1-15", D1, D1), ("2024-02-30", None, None),
    ("0000-01-01", None, None), ("01/15/2024", None, D1), ("2024.01.15", None, D1),
    ("2024年13月1日 then 2024-01-15", D1, D1), ("2024-02-30 then 2024-01-15", None, None),
    ("none", None, None), ("13/45/2024 2024.1.15", None, D1),
])
def test_date_from_text(one, text, strict, documented):
    assert one(D.date_from_text, v=text) == strict
    assert one(lambda v: D.date_from_text(v, documented=True), v=text) == documented


@pytest.mark.parametrize("url, old, any_form", [
    ("http://x/2017-02/17/content_1.htm", datetime.date(2017, 2, 17), datetime.date(2017, 2, 17)),
    ("http://x/a/202312/30/x.html", None, datetime.date(2023, 12, 30)),
    ("http://x/2017-13/45/c.htm", None, None), ("http://x/", None, None),
])
def test_date_from_url(one, url, old, any_form):
    assert one(lambda v: D.date_from_url(v, extended=False), v=url) == old
    assert one(D.date_from_url, v=url) == any_form


def test_months(spark):
    df = spark.sql("select date'2024-02-29' d").select(
        D.month_of(F.col("d")), D.month_end(F.lit("2024-02")), D.in_month(F.col("d"), "2024-02"),
        D.in_month(F.col("d"), "2024-03"))
    assert tuple(df.first()) == ("2024-02", datetime.date(2024, 2, 29), True, False)


def test_month_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "dated")
    spark.sql("select date'2024-02-29' d, 1 x").write.parquet(path)
    plan = spark.read.parquet(path).where(D.in_month(F.col("d"), "2024-02"))._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(d,2024-02-01\), LessThan\(d,2024-03-01\)", plan)
