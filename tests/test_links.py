import pytest
from pyspark.sql import functions as F

from listflow.functions import text as X
from listflow.sources import payloads as P

BASE = "https://shop.example/a/b/page?x=1#top"

# Own cases, by the rules of the URL standard.
CASES = [
    ("c", BASE, "https://shop.example/a/b/c"),
    ("./c", BASE, "https://shop.example/a/b/c"),
    ("../c", BASE, "https://shop.example/a/c"),
    ("../../c", BASE, "https://shop.example/c"),
    ("../../../../c", BASE, "https://shop.example/c"),
    ("..", BASE, "https://shop.example/a/"),
    (".", BASE, "https://shop.example/a/b/"),
    ("../", BASE, "https://shop.example/a/"),
    ("c/./d/../e", BASE, "https://shop.example/a/b/c/e"),
    ("c/..?q=../z", BASE, "https://shop.example/a/b/?q=../z"),
    ("/x/../y", BASE, "https://shop.example/y"),
    ("//cdn.example/i/../j.png", BASE, "https://cdn.example/j.png"),
    ("https://else.example/a/./b/..", BASE, "https://else.example/a/"),
    ("?y=2", BASE, "https://shop.example/a/b/page?y=2"),
    ("#part", BASE, "https://shop.example/a/b/page?x=1#part"),
    ("?y=2", "https://shop.example", "https://shop.example/?y=2"),
    ("#p", "https://shop.example", "https://shop.example/#p"),
    ("c", "https://shop.example", "https://shop.example/c"),
    ("a..b/...c", BASE, "https://shop.example/a/b/a..b/...c"),
    ("mailto:a@b/../c", BASE, "mailto:a@b/../c"),
    ("https://else.example", BASE, "https://else.example/"),
    ("c", "not a page", None),
    ("", BASE, None),
    (None, BASE, None),
]


def test_links_against_a_table_of_cases(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, u string, b string, want string")
    got = {r["i"]: r["got"] for r in df.select("i", X.abs_url("u", "b").alias("got")).collect()}
    wrong = [(CASES[i], got[i]) for i in got if got[i] != CASES[i][2]]
    assert not wrong


def test_sitemaps_that_name_each_other(spark):
    index = lambda *names: "<sitemapindex>" + "".join(f"<sitemap><loc>{n}</loc></sitemap>" for n in names) + "</sitemapindex>"
    captures = spark.createDataFrame([("r.xml", index("a.xml", "b.xml", "r.xml")), ("a.xml", index("b.xml", "c.xml")), ("c.xml", index("a.xml")), ("z.xml", index("a.xml")), ("n.xml", None)], "url string, xml string")
    roots = spark.createDataFrame([("one", "r.xml"), ("two", "z.xml"), ("two", "z.xml"), ("three", "gone.xml"), ("four", None), ("five", "n.xml")], "source string, url string")
    got = {(r["source"], r["url"]): (r["depth"], r["captured"]) for r in P.crawled_sitemaps(captures, roots).collect()}
    assert got == {
        ("one", "r.xml"): (0, True), ("one", "a.xml"): (1, True), ("one", "b.xml"): (1, False), ("one", "c.xml"): (2, True),
        ("two", "z.xml"): (0, True), ("two", "a.xml"): (1, True), ("two", "b.xml"): (2, False), ("two", "c.xml"): (2, True),
        ("three", "gone.xml"): (0, False), ("five", "n.xml"): (0, True),
    }
    assert P.crawled_sitemaps(captures.limit(0), roots.limit(0)).count() == 0
