import pytest
from brute import SF_DIR
from compare import connect, duck_rows, spark_rows

from tagreef.llm.registry import ORACLE, QUERIES
from tagreef.llm.urls import RULES, judge_urls

SCHEMA = "verdict string, host string, path string"


def test_query_equals_sql(spark):
    names, rows = spark_rows(QUERIES["op4_url_filters"](spark, SF_DIR))
    assert (names, rows) == duck_rows(connect(SF_DIR), ORACLE["op4_url_filters"])
    assert len({r[names.index("rule")] for r in rows}) > 2


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] + [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:end]


def judged(url, rules):
    host, path = split(url)
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in rules
        if None not in (v, h, p) and h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no url", "http://", "://net/", "http://x.net", "http://x.net?q=/", "http://x.net/", "http://NET/a/b",
    "http://notnet/a", "https://EXAMPLE.net/en/x", "https://a.example.net/en", "https://a.example.net/en/#/de/",
    "ftp://example.com/de/", "http://example.com//de/", "http://b.org/fr/../x", "http://org/fr/", "http://.org/fr/a",
    "http://a.net:80/x", "x://y.net/a://z.org/fr/", "http://É.net/\n/x", "http://a.b.c.d.example.com/de/x/y/z/" + "q/" * 9000,
    "http://" + "s." * 3000 + "net/a", "http://x.net/", "http://deep.example.com/a/b/c/d", "http://deep.example.com/a/b/cc",
]
MORE = (
    *RULES, ("allow", "deep.example.com", "/a/b/c/"), ("block", "com", "/"), ("allow", "com", "/"), (None, "org", "/"),
    ("block", "", "/"),
)


@pytest.mark.parametrize("rules", [RULES, MORE, ()])
def test_rules(spark, rules):
    pages = spark.createDataFrame([(k, u, "old") for k, u in enumerate(URLS)], "page_id long, url string, rule string")
    found = judge_urls(pages, spark.createDataFrame(list(rules), SCHEMA))
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {k: judged(u, rules) for k, u in enumerate(URLS)}


def test_edges(spark):
    rules = spark.createDataFrame(RULES, SCHEMA)
    pages = spark.createDataFrame([(None, "http://net/"), (None, "http://net/"), (1, None)], "page_id long, url string")
    assert judge_urls(pages, rules).count() == 3
    assert judge_urls(pages.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, spark.createDataFrame([("block", "a", "/x")], SCHEMA))


def test_pages_of_a_hot_host_do_not_move(spark):
    pages = spark.range(5000).selectExpr("id AS page_id", "concat('http://a.example.net/en/', id) AS url", "'page' AS html")
    found = judge_urls(pages, spark.createDataFrame(RULES, SCHEMA))
    assert found.filter("rule = 'example.net/en/' AND verdict = 'allow'").count() == 5000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
