import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagreef.functions.keyword import (
    compile_keyword,
    fixed_chars,
    keyword_pattern,
    keyword_regex,
    literal_chars,
    matches_keyword,
    pattern_of,
)
from tagreef.operators.search import request_sizes, search, search_batch, search_request

CATALOG = [
    ("1", "helloworld", "u1"),
    ("2", "NoTag", "u2"),
    ("3", None, "u3"),
    ("4", "a%bx", "u4"),
    ("5", "a\\zb", "u5"),
    ("6", "你好世界", "u6"),
    ("7", "cat", "u7"),
    ("8", "cat", "u7"),
    ("9", "dog😀x", None),
]
METAS = ["a%bx", "axb", "ab", "a%b", "50pct", "a\\b", "%", "x%y", "a_b", "a%_b", "xx"]


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(CATALOG, "path string, features string, binary string")


def paths(df):
    return sorted(row["path"] for row in df.collect())


@pytest.mark.parametrize(
    "keyword, expected",
    [
        ("hw", ["1"]),
        ("Hello World", ["1"]),
        ("wh", []),
        ("oag", ["2"]),
        ("notag", []),
        ("你世", ["6"]),
        ("😀", ["9"]),
        ("cat", ["7", "8"]),
        (" ", ["1", "2", "4", "5", "6", "7", "8", "9"]),
        ("", []),
    ],
)
def test_search(catalog, keyword, expected):
    assert paths(search_request(catalog, keyword, "path")) == expected


def test_search_returns_images_as_text(catalog):
    found = search(catalog, "dog")
    assert found.columns == ["binary"]
    assert [row[0] for row in found.collect()] == ["None"]
    assert search(catalog, "").count() == 8  # the library itself has no empty rule


@pytest.mark.parametrize(
    "keyword, expected",
    [
        ("a\\b", ["a%b", "a%bx"]),
        ("a_b", ["a%_b", "a%b", "a%bx", "a\\b", "a_b", "axb"]),
        ("50%", ["50pct"]),
        ("\\", ["%"]),
        ("a\\_b", ["a%_b"]),
        ("\\\\", []),
        ("a\\", []),
    ],
)
def test_metacharacters(spark, keyword, expected):
    rows = spark.createDataFrame([(m,) for m in METAS], "features string")
    by_regex = rows.filter(matches_keyword(F.col("features"), keyword))
    by_like = rows.filter(F.like("features", keyword_pattern(F.lit(keyword))))
    assert sorted(r[0] for r in by_regex.collect()) == expected
    assert sorted(r[0] for r in by_like.collect()) == expected


ALPHABET = st.text(alphabet="ab%_\\|中😀", max_size=8)


def like(text, pattern):
    """Plain matcher: the set of text positions a pattern prefix can reach."""
    reached = {0}
    for token in re.findall(r"\\.|.", pattern, re.DOTALL):
        if token == "%":
            reached = set(range(min(reached), len(text) + 1)) if reached else set()
        elif token == "_":
            reached = {i + 1 for i in reached if i < len(text)}
        else:
            reached = {i + 1 for i in reached if i < len(text) and text[i] == token[-1]}
    return len(text) in reached


def as_python(regex):
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), regex).replace(
        r"\z", r"\Z"
    )


@settings(max_examples=2000, deadline=None)
@given(ALPHABET, ALPHABET)
def test_compiled_regex_equals_like(keyword, text):
    pattern = pattern_of(keyword)
    expected = like(text, pattern)
    assert bool(re.search(as_python(compile_keyword(pattern)), text)) == expected
    if expected:
        assert all(char in text for char in fixed_chars(pattern))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ALPHABET, min_size=20, max_size=40), st.lists(ALPHABET, min_size=20, max_size=40))
def test_column_regex_equals_like(spark, keywords, texts):
    pairs = [(k, t) for k in keywords for t in texts]
    rows = spark.createDataFrame(pairs, "k string, t string")
    result = rows.select(
        "k", "t", F.rlike("t", keyword_regex(F.col("k"))).alias("hit"),
        literal_chars(F.col("k")).alias("chars"),
        keyword_pattern(F.col("k")).alias("pattern"),
    )
    for row in result.collect():
        assert row.pattern == pattern_of(row.k)
        assert row.hit == like(row.t, row.pattern), (row.k, row.t)
        assert sorted(row.chars) == sorted(fixed_chars(row.pattern))


REQUESTS = [
    (1, "hw"), (2, "H W"), (3, "cat"), (4, "cat"), (5, ""), (6, " "), (7, "a\\b"), (8, "a_b"),
    (9, "zzz"), (10, "你世"), (11, "_"), (12, "\\"),
]


@pytest.mark.parametrize("literal, slice_bytes", [(200, 1 << 20), (0, 1 << 20), (0, 64)])
def test_batch_equals_single_searches(spark, catalog, literal, slice_bytes):
    requests = spark.createDataFrame(REQUESTS, "request_id long, keyword string")
    hits = search_batch(
        catalog, requests, "path", literal_keywords=literal, slice_bytes=slice_bytes
    )
    found = sorted(tuple(row) for row in hits.collect())
    expected = sorted(
        (keyword, row["path"], row["binary"])
        for keyword in {k for _, k in REQUESTS if k != ""}
        for row in search(catalog, keyword, "path").collect()
    )
    assert found == expected
    sizes = {r["request_id"]: r["n_hits"] for r in request_sizes(requests, hits).collect()}
    assert sizes == {i: sum(f[0] == k for f in found) for i, k in REQUESTS}


def test_batch_without_keywords(spark, catalog):
    requests = spark.createDataFrame([(1, "")], "request_id long, keyword string")
    for literal in (200, 0):
        hits = search_batch(catalog, requests, "path", literal_keywords=literal)
        assert hits.columns == ["keyword", "path", "binary"]
        assert hits.count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path, catalog):
    catalog.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    plan = plan_of(search(stored, "hello"))
    assert "ReadSchema: struct<features:string,binary:string>" in plan
    requests = spark.createDataFrame(REQUESTS, "request_id long, keyword string")
    for literal in (200, 0):
        plan = plan_of(search_batch(stored, requests, "path", literal_keywords=literal))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        # Few keywords stay in the JVM; of many, the walk gets the tags and nothing else.
        python = [line for line in plan.splitlines() if "Python" in line]
        assert len(python) == (0 if literal else 1) and "binary" not in "".join(python)
        assert "Exchange hashpartitioning" not in plan


def test_all_letters_are_lowered_alike(spark):
    """Every character, as Spark lowers it, is found by every way of search."""
    codes = [c for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    odd = [c for c in codes if chr(c).lower() != chr(c) or chr(c).upper() != chr(c)]
    rows = spark.createDataFrame([(str(c), chr(c) + "y") for c in odd], "path string, text string")
    catalog = rows.select("path", F.lower("text").alias("features"), F.lit("u").alias("binary"))
    # Those that Python and Spark lower differently, and some that they do not.
    lowered = {r["path"]: r["features"] for r in catalog.collect()}
    differ = [c for c in odd if lowered[str(c)] != (chr(c) + "y").lower()]
    asked = [chr(c) + "y" for c in differ + odd[:: len(odd) // 20]]
    requests = spark.createDataFrame(list(enumerate(asked)), "request_id long, keyword string")
    literal = hits(search_batch(catalog, requests, "path", literal_keywords=len(asked)))
    assert hits(search_batch(catalog, requests, "path", literal_keywords=0)) == literal
    assert {k for k, _ in literal} == set(asked)
    for keyword in asked[:12]:
        assert paths(search(catalog, keyword, "path")) == sorted(p for k, p in literal if k == keyword)


def hits(df):
    return {(r["keyword"], r["path"]) for r in df.collect()}


def test_tags_alone_are_read_for_hits(spark, tmp_path, catalog):
    path = str(tmp_path / "c")
    catalog.write.parquet(path)
    requests = spark.createDataFrame([(1, "ct"), (2, "dog")], "request_id long, keyword string")
    found = search_batch(spark.read.parquet(path), requests, "path").select("keyword", "path")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "binary" not in plan
