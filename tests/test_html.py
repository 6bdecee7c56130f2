import html
import re

import pytest
from html.entities import html5
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from html_machine import tags
from pyspark.sql import functions as F

from tagreef.functions.links import attributes_of, tags_of, unescape

PARTS = [
    "<", ">", "/", "=", "'", '"', " ", "\n", "a", "x", "<img ", "<IMG/", "<img>", "src=", "SRC", "alt", "<!--", "-->", "--!>", "-", "!",
    "<script>", "</script>", "<script ", "</SCRIPT ", "<textarea>", "</textarea", "<title>", "</title>", "<style/>", "</style>",
    "<a href=", "</a>", "<p title=\"", "<?", "</", "</ ", "<!doctype", "<plaintext", "<![CDATA[", "]]>", "é", "K",
]


def parsed(spark, pages, tag):
    """The attributes that Spark finds, references left as they are."""
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k long, html string")
    raw = F.transform(tags_of(F.col("html"), tag), attributes_of)
    found = rows.select("k", raw.alias("found")).collect()
    return [[dict(reversed(list(zip(t["names"], t["values"])))) for t in r.found] for r in sorted(found)]


@settings(max_examples=25, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), min_size=40, max_size=80), st.sampled_from(["img", "script"]))
def test_any_markup_against_the_states(spark, pages, tag):
    assert parsed(spark, pages, tag) == [tags(p, tag) for p in pages]


FOUND = [
    ("""<img alt=it's src="http://x/a.jpg">""", ["http://x/a.jpg"]),
    ("""<img alt=it's src="http://x/a.jpg"> don't <img src=b.png> isn't""", ["http://x/a.jpg", "b.png"]),
    ("<textarea><img src=a></textarea><img src=b>", ["b"]),
    ("<title><img src=a></TITLE ><img src=b>", ["b"]),
    ("<a title=\"<img src='a'>\"><img src=b>", ["b"]),
    ("<script><!-- <script></script> <img src=a> --></script><img src=b>", ["b"]),
    ("<script><!-- </script><img src=b>", ["b"]),
    ("<script>a</scripts><img src=a></script/><img src=b>", ["b"]),
    ("<!--><img src=a><!---><img src=b><!-- --!><img src=c><!-- > <img src=d>", ["a", "b", "c"]),
    ("<img src><img src=><img hidden src=a/><img src='a'src='b'><img = src = c>", ["", "", "a/", "a", "c"]),
    ("<img src=a <img src=b>", ["a"]),
    ("<img src=a><img src='b", ["a"]),
    ("<img src=a><img src=b", ["a"]),
    ("<plaintext><img src=a>", []),
    ("< img src=a></><img src=b></ x><? <img src=c>", ["b"]),
    ("<imgs src=a><img-box src=b><img\fsrc=c><img/src=d>", ["c", "d"]),
]


def test_tags(spark):
    for page, (text, links) in zip(parsed(spark, [t for t, _ in FOUND], "img"), FOUND):
        assert [t["src"] for t in page] == links, text


def standard(text):
    """References of an attribute: an old name without ";" stays before "=", a letter or a digit."""

    def one(match):
        name, semicolon = match[1], match[2]
        if name.startswith("#"):
            return html.unescape(match[0])
        if semicolon and name + ";" in html5:
            return html5[name + ";"]
        follows = text[match.end() : match.end() + 1]
        if not semicolon and name in html5 and follows != "=":
            return html5[name]
        return match[0]

    return re.sub(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)(;?)", one, text)


TEXTS = [
    "a=1&copy=2", "&copy", "&copy;", "&copy 2", "&copyx", "&amp", "&amp;amp", "x&lt/y", "&notit;", "&not;it", "&unknown;", "&", "&;", "&&amp;&",
    "&eacute&Eacute;", "&#65", "&#65;b", "&#x41g", "&fjlig;", "&AMP&LT;", "a&hellip", "?a=b&reg=c&reg", "&sect1", "&para;&para",
]


def test_references_against_the_rule(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k long, t string")
    got = [r.u for r in rows.select("k", unescape(F.col("t")).alias("u")).orderBy("k").collect()]
    assert got == [standard(t) for t in TEXTS]


@pytest.mark.parametrize("text", ["<img a='", "<script><!--", "<!--", "<img " + "x= ", "<script><!--<script>", "<title><", "</a b=", "<img \""])
def test_huge_pages_cost_no_stack(spark, text):
    page = "<img src=a>" + text * 60_000
    assert [t["src"] for t in parsed(spark, [page], "img")[0][:1]] == ["a"]
