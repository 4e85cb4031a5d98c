"""An operator's own link rules, and rules that do not compile."""

from pyspark.sql import functions as F

from listflow.functions import text as X
from listflow.sources import config as CFG


def test_own_link_rules(spark):
    shared = '<a href="/competition/oak-table">a</a><a href="/lot/42?x=1">b</a><a href="/lot/43">c</a><a href="/lot/43#top">d</a><a href="https://else.test/lot/9">e</a>'
    rows = [(1, None, None), (2, r"/lot/\d+$", None), (3, r"/lot/\d+$", [r"/lot/42"]), (4, r"/LOT/", [])]
    df = spark.createDataFrame(rows, "id int, draw string, exclude array<string>").withColumn("html", F.lit(shared)).withColumn("base", F.lit("https://op.test"))
    links = X.pick_draw_links(X.page_links("html", "base"), "base", None, F.col("draw"), F.col("exclude"))
    got = {r["id"]: [u.removeprefix("https://op.test") for u in r["l"]] for r in df.select("id", links.alias("l")).collect()}
    assert got == {1: ["/competition/oak-table"], 2: ["/lot/42", "/lot/43"], 3: ["/lot/43"], 4: ["/lot/42", "/lot/43"]}


def test_broken_patterns_go_to_a_side_frame(spark):
    rows = [("a", "(", ["x", "["], {"entries": r"(?<n>\d+) balls", "date": "*"}), ("b", r"/p/\d+", None, None), ("c", None, [], {})]
    config = spark.createDataFrame(rows, "slug string, drawMatch string, exclude array<string>, patterns map<string,string>")
    clean, broken = CFG.with_valid_patterns(config)
    assert sorted(tuple(r) for r in broken.collect()) == [("a", "date", "*"), ("a", "drawMatch", "("), ("a", "exclude", "[")]
    kept = {r["slug"]: (r["drawMatch"], r["exclude"], r["patterns"]) for r in clean.collect()}
    assert kept == {"a": (None, ["x"], {"entries": r"(?<n>\d+) balls"}), "b": (r"/p/\d+", None, None), "c": (None, [], {})}
