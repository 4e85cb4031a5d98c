"""Work that is done once, or only where it is needed."""

import os
import re
import time

from pyspark.sql import functions as F

from listflow.functions import base as B
from listflow.functions import extract as E
from listflow.functions import rules
from listflow.functions import selectors as S
from listflow.functions import text as X
from listflow.operators import dedupe as D
from listflow.operators import ranking as R
from listflow.operators.reconcile import ReconcileConfig, reconcile
from listflow.plans import content as C
from listflow.plans import storage as ST
from listflow.sources import pages as P


def counted(spark, df):
    """The frame, and an accumulator of how often its rows are made."""
    made = spark.sparkContext.accumulator(0)

    def each(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    return df.mapInPandas(each, df.schema), made


def test_context_of_a_date_is_sought_where_the_date_is(spark):
    """A look-behind of many lengths stands behind the pattern, not at every digit."""
    parts = str(E._parts(F.col("t"), r"\d", rules.DATE_LONG, 3))
    assert parts.index("[A-Za-z]{3,}") < parts.index("{0,29}")
    assert re.compile(E._ahead(r"(a)\((?:b)")).groups == 0
    rows = spark.createDataFrame([(" ".join(["12 34"] * 30) + " Draw 3rd August 2026 at 7pm",), ("12 34 56",), (None,)], "t string")
    assert [r[0] for r in rows.select(E.extract_date("t", 2026)).collect()] == ["2026-08-03T19:00:00+01:00", None, None]


def test_values_behind_the_first_date_are_not_read(spark):
    html = '<i data-enddate="soon" data-draw-date="2026-08-03T20:00:00" data-close-date="2026-09-09T20:00:00">'
    rows = spark.createDataFrame([(html,), ("<p>",), (None,)], "h string")
    dates = E.page_attribute_date("h", 2026)
    assert [r[0] for r in rows.select(dates).collect()] == ["2026-08-03T20:00:00+01:00", None, None]
    assert "aggregate" in str(dates) or "reduce" in str(dates)


def test_alternatives_gathered_by_letter_match_the_same():
    for table in (rules.CATEGORY_RULES, rules.LABEL_RULES):
        for pattern in table.values():
            inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
            plain, gathered = re.compile(inner), re.compile(f"(?:{B.by_first_letter(inner[1:-1])})")
            for one in B._alternatives(inner[1:-1]):
                for text in (re.sub(r"\\b|[()?:\[\]\\|]", "", one), one[:3], one[1:]):
                    assert bool(plain.fullmatch(text)) == bool(gathered.fullmatch(text))
    assert B.by_first_letter(r"cars?|c?x|cash|[ab]|van\b") == r"c(?:a(?:rs?|sh))|van\b|c?x|[ab]"
    # two groups are no single alternation
    assert B.rx_words("(a|b)x(c|d)") == r"(?<!\w)(a|b)x(c|d)(?!\w)"


def test_junk_images_are_found_by_gathered_words(spark):
    rows = [(1, "Win the Car", f"https://x.example/media/{n}.jpg", 10, 10, "img", i) for i, n in enumerate(["logo-a", "car", "sprite", "my-icon", "iconic", "flagged", "a-flag-b"])]
    frame = spark.createDataFrame(rows, "page int, title string, url string, width int, height int, hint string, seq int")
    out = C.rank_images(frame)
    assert [r["url"].rsplit("/", 1)[1] for r in out.orderBy("rank").collect()] == ["car.jpg", "iconic.jpg", "flagged.jpg"]
    assert "l(?:o(?:go" in out._jdf.queryExecution().analyzed().toString()


def test_slugs_read_their_rows_once(spark):
    listings, made = counted(spark, spark.createDataFrame([("Win A", "op", i) for i in range(5)], "title string, op_slug string, seq long"))
    stored, read = counted(spark, spark.createDataFrame([("win-a-op-2",)], "slug string"))
    got = [r["slug"] for r in D.assign_slugs(listings, stored).orderBy("seq").collect()]
    assert got == ["win-a-op", "win-a-op-3", "win-a-op-4", "win-a-op-5", "win-a-op-6"]
    assert (made.value, read.value) == (5, 1)


def test_rows_that_are_read_twice_are_made_once(spark):
    from queries.listings import _written

    frame, made = counted(spark, spark.createDataFrame([("https://a.example/x", 1), ("https://a.example/y", 2), (None, 3)], "entry_url string, n long"))
    rows = _written(frame)
    out = D.split_known(rows, rows.where("n = 2"))
    assert {r["n"]: r["known"] for r in out.collect()} == {1: False, 2: True, 3: False}
    assert made.value == 3


def test_repair_plan_sorts_nothing_by_range(spark):
    draws = spark.createDataFrame([(1, "https://a.example/p/x/", "https://dead.example/1.png", "active", "2026-08-01")], "id long, entry_url string, image_url string, status string, draw_date string")
    empty = spark.createDataFrame([], "entry_url string, html string")
    sides = [spark.createDataFrame([], "entry_url string, image_url string"), spark.createDataFrame([("https://A.example/p/x", '<meta property="og:image" content="/i.jpg">')], empty.schema), spark.createDataFrame([], "product_key string, image_url string"), empty]
    plan = ST.image_repair_plan(draws, "dead.example", ["active"], *sides)
    assert [tuple(r) for r in plan.collect()] == [(1, "page", "https://A.example/i.jpg")]
    assert "Sort [" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_a_link_is_bound_once():
    assert str(X.abs_url(F.col("link"), F.col("page"))).count("link") == 1
    assert str(X.image_from_html(F.col("html"), F.col("page"))).count("html") == 4


def test_selectors_meet_only_nodes_that_have_their_attribute():
    assert S.compiled(".a, [class*='b']").attribute == "class"
    assert S.compiled("p.a, li").attribute is None
    assert S.compiled("p [data-x]").attribute == "data-x"
    nodes = P._Nodes(P._Tree('<p class="a">1</p><div><b data-x="1">2</b></div><li>3</li>').root)
    assert [nodes.first(S.compiled(s)).text() for s in (".a", "div [data-x]", "li", "li, .a")] == ["1", "2", "3", "1"]
    assert nodes.first(S.compiled(".none")) is None
    assert P._regions('<div class="summary"><p>Long enough for a summary</p></div><aside>x</aside>', {})["summary_text"] == "Long enough for a summary"


def test_what_a_written_table_shuffled_is_deleted_with_it(spark, tmp_path):
    local = spark._jsc.sc().env().blockManager().diskBlockManager()
    left = lambda: {n for n in local.getAllFiles().mkString("\n").split("\n") if "shuffle_" in n}
    before = left()
    out = R.materialised(spark.range(5000).groupBy((F.col("id") % 77).alias("k")).count(), path=f"{tmp_path}/t")
    for _ in range(50):
        if left() <= before:
            break
        time.sleep(0.2)
    assert left() <= before and out.count() == 77
    assert spark.conf.get(R._SHUFFLES_GO, "false") == "false"


def test_a_table_in_slices_is_complete_with_its_last_slice(spark, tmp_path):
    rows = spark.createDataFrame([(str(k),) for k in range(40)] + [(None,)], "u string")
    path, marks = f"{tmp_path}/t", []

    def make(k):
        marks.append(os.path.exists(f"{path}/_SUCCESS"))
        return rows.where(R.in_slice("u", 3, k))

    out = R.written_in_slices(make, 3, path)
    assert sorted(r["u"] or "" for r in out.collect()) == sorted(r["u"] or "" for r in rows.collect())
    assert marks == [False] * 3 and os.path.exists(f"{path}/_SUCCESS")


def test_slices_of_a_reconciliation_decide_the_same(spark):
    url = lambda k: None if k % 13 == 0 else "" if k % 17 == 0 else f"https://op.example/p/{k}"
    fresh = [(k, url(k), f"Win prize {k}", "A prize", 1.0 + (k % 4 == 0), 1000, "2026-09-01T20:00:00+01:00", "https://i.example/a.webp", "cash-prizes", "A description that is long enough.") for k in range(200)]
    held = [(f"d{k}", url(k), ["draft", "active", "ended"][k % 3], f"Win prize {k}", 1.0, 1000, "2026-09-01T20:00:00+01:00", 1000.0, None, "cat", None) for k in range(0, 200, 2)]
    fresh = spark.createDataFrame(fresh, "seq long, entry_url string, title string, grand_prize string, ticket_price double, total_entries long, draw_date string, image_url string, category string, description string")
    stored = spark.createDataFrame(held, "id string, entry_url string, status string, title string, ticket_price double, total_entries long, draw_date string, total_prize_value double, prize_description string, category_id string, category_source string")
    decide = lambda n: sorted(map(str, reconcile(fresh, stored, ReconcileConfig(now="2026-08-08 12:00:00", publish_cap=7, correct_cap=5, slices=n)).collect()))
    whole = decide(1)
    assert len(whole) == 200 and decide(3) == whole
    assert sum("action='publish'" in r for r in whole) == 7 and sum("action='correct'" in r for r in whole) == 5
