import datetime

import pytest
from pyspark.sql import functions as F

from tagreef.functions import text


def evaluate(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("c"))).collect()]


@pytest.mark.parametrize(
    "raw, upload, folder",
    [
        ("Hello World|\n", "helloworld", "helloworld"),
        ("a\tb", "ab", "a\tb"),
        ("a\u3000b", "ab", "a\u3000b"),
        ("a\u00a0b", "ab", "a\u00a0b"),
        ("a\x1cb\x85c", "abc", "a\x1cb\x85c"),
        (" |\n", "NoTag", "NoTag"),
        ("", "NoTag", "NoTag"),
        (None, "NoTag", "NoTag"),
    ],
)
def test_tags(spark, raw, upload, folder):
    assert evaluate(spark, [raw], text.upload_tag) == [upload]
    assert evaluate(spark, [raw], text.folder_tag) == [folder]


def test_strip_space_equals_python(spark):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    kept = evaluate(spark, [f"x{c}y" for c in chars], text.strip_space)
    assert [c for c, k in zip(chars, kept) if k == "xy"] == [c for c in chars if c.isspace()]


def test_trim_equals_python(spark):
    values = ["\u3000 a b\t\x1c", "a", " \n", ""]
    assert evaluate(spark, values, text.trim_space) == [v.strip() for v in values]


def test_names(spark):
    assert evaluate(spark, ["a.b.c", "abc", "x.jpg?q=1", ""], text.last_ext) == [
        "c", "abc", "jpg?q=1", "",
    ]
    urls = ["//h/x.png", "https://h/x", "http://h/x"]
    assert evaluate(spark, urls, text.fetch_url) == [
        "https://h/x.png", "https://h/x", "https:http://h/x",
    ]
    assert evaluate(spark, urls, lambda c: text.fetch_url(c, repair=True))[2] == "http://h/x"
    words = ["表情包.png", "été", "plain"]
    assert evaluate(spark, words, text.utf8_as_latin1) == [
        w.encode("utf-8").decode("latin1") for w in words
    ]


def test_stamps(spark):
    when = datetime.datetime(2019, 4, 12, 20, 39, 19, 21146)
    row = spark.createDataFrame([(when,)], "ts timestamp").select(
        text.stamp_name(F.col("ts")), text.stamp_name(F.col("ts"), "mdy")
    ).first()
    assert tuple(row) == (when.strftime("%Y%m%d%H%M%S%f"), when.strftime("%m%d%Y%H%M%S%f"))
