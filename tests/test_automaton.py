import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagreef.functions.keyword import compile_keyword, pattern_of
from tagreef.operators import automaton
from tagreef.operators.automaton import KeywordTrie, place_after, segments_of
from tagreef.operators.search import search_batch

WORD = st.text(alphabet="abc%_\\é😀\n", max_size=7)
TEXT = st.text(alphabet="abcd%_\\é😀\n", max_size=40)


def plain(keywords, texts):
    """Every keyword's pattern on every text."""
    out = []
    for i, text in enumerate(texts):
        for k, clean in enumerate(keywords):
            regex = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), compile_keyword(pattern_of(clean)))
            if re.search(regex.replace(r"\z", r"\Z"), text):
                out.append((i, k))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(WORD, max_size=12, unique=True), st.lists(TEXT, max_size=8))
def test_walk_against_each_pattern(keywords, texts):
    text, keyword = KeywordTrie(keywords).hits(texts)
    assert list(zip(text.tolist(), keyword.tolist())) == plain(keywords, texts)


def test_batches_of_any_size(monkeypatch):
    rng = np.random.default_rng(5)
    keywords = sorted({"".join(rng.choice(list("abcde"), rng.integers(1, 6))) for _ in range(200)})
    texts = ["".join(rng.choice(list("abcdefgh"), n)) for n in rng.integers(0, 30, 150)]
    expected = plain(keywords, texts)
    for branches, chars in ((1, 1), (300, 50), (1 << 20, 1 << 20)):
        monkeypatch.setattr(automaton, "BRANCHES", branches)
        monkeypatch.setattr(automaton, "CHARS", chars)
        text, keyword = KeywordTrie(keywords).hits(texts)
        assert list(zip(text.tolist(), keyword.tolist())) == expected


def test_segments():
    assert segments_of("ab") == ([("a",), ("b",)], ())
    assert segments_of("a%b_") == ([("a",), ("b",), (None,)], ())
    assert segments_of("a\\b") == ([("a",), ("%", "b")], ())
    assert segments_of("\\") == ([], ("%",))
    assert place_after(("%", None), "a%%b", 0) == 3 and place_after(("a",), "xa", 2) == -1


def test_keywords_share_their_beginnings():
    trie = KeywordTrie([f"abcdefgh{k:03d}" for k in range(1000)])
    assert [len(level.step) for level in trie.levels] == [1] * 9 + [10, 100, 1000]


def test_slices_agree_and_tags_alone_travel(spark):
    tags = [(str(k), t, f"img{k}") for k, t in enumerate(["helloworld", None, "", "a%bx", "你好世界", "NoTag"] * 3)]
    catalog = spark.createDataFrame(tags, "path string, features string, binary string")
    words = ["hw", "Hello World", "wh", "oag", "notag", "你世", " ", "a%b", "a_b", "a\\b", "\\", "50%", "", "x", "é"]
    requests = spark.createDataFrame([(w,) for w in words] * 2, "keyword string")
    few = sorted(tuple(r) for r in search_batch(catalog, requests, "path").collect())
    for size in (1 << 20, 8, 1):
        walked = search_batch(catalog, requests, "path", literal_keywords=0, slice_bytes=size)
        assert sorted(tuple(r) for r in walked.collect()) == few
    plan = search_batch(catalog, requests, "path", literal_keywords=0)._jdf.queryExecution().executedPlan().toString()
    assert "rlike" not in plan.lower() and "Exchange hashpartitioning" not in plan
    python = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert python and "binary" not in python[0].split("[")[1].split("]")[0]


def test_no_keywords(spark):
    catalog = spark.createDataFrame([("1", "a", "i")], "path string, features string, binary string")
    requests = spark.createDataFrame([("",)], "keyword string")
    assert search_batch(catalog, requests, "path").count() == 0
    assert search_batch(catalog, requests.filter(F.lit(False)), literal_keywords=0).columns == ["keyword", "binary"]
