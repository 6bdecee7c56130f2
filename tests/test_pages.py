import pytest
from pyspark.sql import functions as F

from tagreef.operators.pages import download_manifest, extract_image_links, extract_tags, skip_existing
from tagreef.plans.jobs import crawl_manifest

SITES = {
    "me": "http://me.me/x", "doutu": "http://doutu.com", "jandan": "http://jandan.net",
    "other": "http://x.org",
}
RULES = [
    ("me", '<img src="http://x/a.jpg">', "http://x/a.jpg"),
    ("other", '<img src="http://x/a.jpg">', "http://x/a.jpg"),
    ("doutu", '<img src="http://x/a.jpg">', None),
    ("jandan", '<img src="http://x/a.jpg">', None),
    ("me", '<img src="//x/w.jpg">', None),
    ("other", '<img src="//x/w.jpg">', None),
    ("doutu", '<img src="//x/w.jpg">', None),
    ("jandan", '<img src="//x/w.jpg">', "//x/w.jpg"),
    ("doutu", '<img src="x" data-original="http://x/b.gif">', "http://x/b.gif"),
    ("doutu", '<img data-original="//x/b.gif" src="http://x/c.png">', "http://x/c.png"),
    ("jandan", '<img src="http://x/c.gif">', None),
    ("jandan", "<img src='http://x/c.gif' org_src='//w/x.gif'>", "//w/x.gif"),
    ("jandan", '<img src="http://x/c.gif" org_src=none>', "http://x/c.gif"),
    ("other", '<img alt="http://x/a.jpg">', None),
    ("other", "no tag at all", None),
    ("other", '<IMG alt="a > b" SRC=http://x/a.jpg>', "http://x/a.jpg"),
    ("other", '<img data-src="http://x/a.jpg" src="">', None),
    ("other", '<img alt="src=\'http://x/no.jpg\'" src="http://x/a.jpg?a=1&amp;b=2">',
     "http://x/a.jpg?a=1&b=2"),
    ("other", '<!-- <img src="http://x/a.jpg"> --><script>"<img src=\'http://x/a.jpg\'>"</script>', None),
]


@pytest.fixture(scope="module")
def links(spark):
    rows = [(i, SITES[site], html) for i, (site, html, _) in enumerate(RULES)]
    return extract_image_links(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_link_rules(links):
    found = {r["page_id"]: r["link"] for r in links.collect()}
    assert found == {i: link for i, (_, _, link) in enumerate(RULES) if link is not None}


def test_order_and_missing_attributes(spark):
    page = [(1, "u", "<a HREF='1'>x</a><b href='no'><a>y</a><a class=x href=2 />")]
    rows = extract_tags(
        spark.createDataFrame(page, "page_id long, url string, html string"), "a", {"href": "href"}
    )
    assert [(r["pos"], r["href"]) for r in rows.orderBy("pos").collect()] == [
        (0, "1"), (1, None), (2, "2"),
    ]


def test_huge_broken_tags_cost_no_stack(spark):
    page = [(1, "u", "<img " + "x" * 200_000 + "'" + "<img src='http://x/a.jpg'>" + "<img \"" * 50_000)]
    rows = spark.createDataFrame(page, "page_id long, url string, html string")
    assert extract_image_links(rows).count() <= 1


def test_manifest(spark, links):
    ts = F.lit("2019-04-12 20:39:19").cast("timestamp")
    manifest = download_manifest(links, ts).orderBy("file_name").collect()
    pages = [r["page_id"] for r in manifest]
    assert pages == sorted(pages)
    assert [r["file_name"] for r in manifest][:2] == [
        "20190412203919000000.jpg", "20190412203919000001.jpg",
    ]
    assert manifest[0]["fetch_url"] == "https:http://x/a.jpg"
    names = spark.createDataFrame([("20190412203919000001.jpg",)], "name string")
    assert skip_existing(download_manifest(links, ts), names).count() == len(manifest) - 1
    rows = spark.createDataFrame([(1, SITES["other"], RULES[0][1])], "page_id long, url string, html string")
    assert crawl_manifest(rows, ts, names, repair=True).first()["fetch_url"] == "http://x/a.jpg"
