import pytest
from pyspark.sql import functions as F

from listflow.functions import selectors as S
from listflow.operators.asof import as_of
from listflow.plans import captures as C
from listflow.sources import pages as P
from listflow.sources.commits import Commits, Conflict


def test_as_of_takes_the_newest_row_not_after(spark):
    left = spark.createDataFrame([("a", 100, 1), ("a", 99, 2), ("a", 400_000, 3), ("b", 50, 4), (None, 50, 5), ("a", None, 6), ("c", 10, 7), ("a", 100, 8)], "k string, t long, n int").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([("a", 100), ("a", 100), ("a", 5), ("a", 101), ("a", 90_000), ("b", 51), (None, 1), ("c", -500_000)], "k string, u long").withColumn("u", F.timestamp_seconds("u"))
    want = {1: 100, 2: 5, 3: 90_000, 4: None, 5: None, 6: None, 7: -500_000, 8: 100}
    for width in (1, 60, 86_400, 10**9):
        got = as_of(left, right, ["k"], "t", "u", "met", width).select("n", F.unix_seconds("met").alias("met")).collect()
        assert {r["n"]: r["met"] for r in got} == want and len(got) == len(want)


def test_commits_are_all_or_nothing(spark, tmp_path):
    commits = Commits(spark, f"file://{tmp_path}/store")
    table = lambda n: spark.range(n).withColumn("x", F.lit("y"))
    assert commits.version() == 0 and commits.read("draws") is None
    assert commits.commit("r1", {"draws": table(3), "log": table(1)}, 0) == 1
    # the same run again, whatever it would write
    assert commits.commit("r1", {"draws": table(9), "log": table(9)}, 1) == 1
    assert commits.read("draws").count() == 3
    with pytest.raises(Conflict):
        commits.commit("r2", {"draws": table(4)}, 0)
    assert commits.commit("r2", {"draws": table(4)}, 1) == 2
    assert commits.read("draws").count() == 4 and commits.read("draws", 1).count() == 3 and commits.read("log").count() == 1
    # tables of a run that never got its manifest are not seen
    table(7).write.parquet(f"file://{tmp_path}/store/data/lost/draws")
    assert commits.read("draws").count() == 4


def test_newest_capture_of_a_page(spark):
    captures = spark.createDataFrame([("u", "2026-08-01 11:00:00", "old"), ("u", "2026-08-01 12:00:00", "now"), ("u", "2026-08-01 12:00:01", "late"), ("v", "2026-09-01 00:00:00", "later")], "url string, at string, html string")
    captures = captures.select("url", F.col("at").cast("timestamp").alias("captured_at"), "html")
    facts = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3), ("w", 4), (None, 5)], "entry_url string, n int")
    got = {r["n"]: r["html"] for r in C.with_pages(facts, captures, "2026-08-01 12:00:00").collect()}
    assert got == {1: "now", 2: "now", 3: "", 4: "", 5: ""}


PAGE = """<html><body><div id="top" class="box main" data-k="a-b"><p class="x">one</p><p>two</p><span lang="en-GB">three</span></div>
<ul><li>four</li><li class="on">five<b>six</b></li><li>seven</li></ul></body></html>"""


@pytest.mark.parametrize(
    "selector, want",
    [
        ("p", ["one", "two"]),
        ("P.x", ["one"]),
        ("#top > p", ["one", "two"]),
        ("body > p", []),
        ("div p + p", ["two"]),
        ("p ~ span", ["three"]),
        ("li:not(.on)", ["four", "seven"]),
        (".on b, span", ["three", "six"]),
        ("[data-k]", ["onetwothree"]),
        ("[data-k='a-b']", ["onetwothree"]),
        ("[class~=main] .x", ["one"]),
        ("[class*='ai'] [class^=x]", ["one"]),
        ("[lang|=en]", ["three"]),
        ("[data-k$=B i]", ["onetwothree"]),
        ("ul li + li > *", ["six"]),
        (".box.main#top .x", ["one"]),
    ],
)
def test_selectors(selector, want):
    nodes = list(P._Tree(PAGE).root.nodes())
    assert [n.text() for n in nodes if S.compiled(selector)(n)] == want


@pytest.mark.parametrize("selector", ["", "  ", "p >", "> p", "p:hover", "[a", ".", "a,,b", "p::before", None])
def test_what_is_no_selector_counts_as_not_given(selector):
    assert S.valid(selector) is None


def test_own_selectors_come_first(spark):
    html = '<html><body><div class="max-tickets">100 tickets</div><dl><dd class="cap">Max 2,500 tickets</dd><dd class="when">5th August 2026 at 9pm</dd><dd class="cost">Just £3.50 each</dd></dl><p>£1.00 per ticket</p><div class="draw-date">1st August 2026</div></body></html>'
    own = {"entries": "dl > .cap", "date": ".when", "price": ".cost"}
    pages = spark.createDataFrame([(1, html, own), (2, html, {"entries": "dl > ???", "date": ".none", "price": None}), (3, html, None)], "n int, html string, selectors map<string,string>")
    got = {r["n"]: r for r in P.with_regions(pages, selectors="selectors").collect()}
    assert (got[1]["cap_text"], got[1]["date_text"], got[1]["price_text"]) == ("Max 2,500 tickets", "5th August 2026 at 9pm", "Just £3.50 each")
    assert all((got[k]["cap_text"], got[k]["date_text"], got[k]["price_text"]) == ("100 tickets", "1st August 2026", None) for k in (2, 3))


def test_guard_and_plan_read_the_tables_once(spark):
    from listflow.plans import storage as ST

    prefix = "https://store.example/public/"
    objects = spark.createDataFrame([(f"a{k}.png", "2026-01-01T00:00:00Z" if k % 2 else "2026-07-31T00:00:00Z") for k in range(6)], "path string, created_at string").withColumn("updated_at", F.lit(None).cast("string"))
    table = spark.createDataFrame([(f"{prefix}a{k}.png", k) for k in (0, 1, 2, 9)], "image string, n int")
    got = {r["path"]: r["plan"] for r in ST.guarded_plan(objects, {"t": table}, prefix, "2026-08-01 00:00:00").collect()}
    assert got == {"a0.png": "keep", "a1.png": "keep", "a2.png": "keep", "a3.png": "orphan", "a4.png": "young", "a5.png": "orphan"}
    for few in (table.where("n = 0"), table.limit(0)):
        with pytest.raises(ST.ThinReferenceScan):
            ST.guarded_plan(objects, {"t": few}, prefix, "2026-08-01 00:00:00")
