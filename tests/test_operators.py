import random

import pytest
from pyspark.sql import functions as F

from listflow.operators import dedupe as D
from listflow.operators import gates as G
from listflow.operators import ranking as K
from listflow.operators import reconcile as R
from listflow.plans import content as C
from listflow.plans import reports as P
from listflow.plans import storage as ST
from listflow.sources import sinks as S

NOW = "2026-08-19 10:00:00"
LISTING = "seq bigint, op_slug string, entry_url string, title string, grand_prize string, category string, ticket_price double, total_entries bigint, draw_date string, image_url string, description string"


def listing(seq=1, **over):
    row = dict(
        seq=seq, op_slug="op", entry_url=f"https://x.co.uk/p/{seq}", title="Win a BMW", grand_prize="Win a BMW", category="car-draws", ticket_price=0.99, total_entries=20000,
        draw_date="2026-08-25T20:00:00+01:00", image_url="https://i/x.webp", description="A description that is long enough.",
    )
    row.update(over)
    return tuple(row.values())


# ---- ranks against brute force ---------------------------------------------


@pytest.fixture
def skewed(spark):
    """One key holds half of the rows."""
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(9)}", i * 3 + 1, rng.randrange(5)) for i in rng.sample(range(5000), 1200)]
    return rows, spark.createDataFrame(rows, "k string, o bigint, v bigint").repartition(5)


def test_full_rank_and_running_total(skewed):
    rows, df = skewed
    want, seen, total = {}, {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        seen[k] = seen.get(k, 0) + 1
        total[k] = total.get(k, 0) + v
        want[o] = (seen[k], total[k])
    got = K.running(K.ranked(df, ["k"], "o", "r"), ["k"], "o", "v", "t")
    assert {r["o"]: (r["r"], r["t"]) for r in got.collect()} == want


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_top_n(skewed, n):
    rows, df = skewed
    want = {(k, o) for key in {r[0] for r in rows} for k, o, _ in sorted((r for r in rows if r[0] == key), key=lambda r: r[1])[:n]}
    assert {(r["k"], r["o"]) for r in K.top_n(df, ["k"], [F.col("o")], n).collect()} == want


def test_positions_and_caps(skewed):
    rows, df = skewed
    placed = K.numbered(df, [F.col("o")])
    order = sorted(r[1] for r in rows)
    assert [r["o"] for r in placed.orderBy("position").collect()] == order
    assert placed.agg(F.max("position")).first()[0] == len(rows)
    capped = K.within_cap(df, F.col("v") > 2, "o", 10, "go").where("go")
    assert sorted(r["o"] for r in capped.collect()) == sorted(r[1] for r in rows if r[2] > 2)[:10]


def test_slugs_skip_taken_numbers(spark):
    rows = spark.createDataFrame([listing(i, title="Win a BMW" if i < 6 else "Other") for i in range(8)], LISTING)
    taken = spark.createDataFrame([("win-a-bmw-op",), ("win-a-bmw-op-2",), ("win-a-bmw-op-5",), ("else-3",)], "slug string")
    got = [r["slug"] for r in D.assign_slugs(rows, taken).orderBy("seq").collect()]
    assert got == [f"win-a-bmw-op-{n}" for n in (3, 4, 6, 7, 8, 9)] + ["other-op", "other-op-2"]


# ---- dedupe and caps -------------------------------------------------------


def test_dedupe(spark):
    rows = [
        listing(1, entry_url="https://x/p/a", total_entries=None), listing(2, entry_url="https://x/p/A/?u=1"), listing(3, entry_url="https://x/p/a#t"),
        listing(4, entry_url="https://x/p/b"), listing(5, entry_url=None, title="Solo!"), listing(6, entry_url="", title="solo"), listing(7, entry_url=None, title=None),
    ]
    df = spark.createDataFrame(rows, LISTING)
    for parts in (1, 4):
        assert sorted(r["seq"] for r in D.dedupe(df.repartition(parts)).collect()) == [2, 4, 5]
    assert {r["seq"]: r["n"] for r in D.dedupe(df, dropped="n").collect()} == {2: 2, 4: 0, 5: 1}


def test_known_rows_survive_the_cap(spark):
    rows = spark.createDataFrame([(i, "op", i >= 40) for i in range(50)], "seq bigint, op_slug string, known boolean")
    assert sorted(r["seq"] for r in D.known_first(rows, 5).collect()) == list(range(40, 50))
    assert sorted(r["seq"] for r in D.known_first(rows, 13).collect()) == [0, 1, 2, *range(40, 50)]


def test_archive_stops(spark):
    rows = [("a", 1, 100, 50), ("a", 2, 100, 60), ("a", 3, 100, 5), ("b", 1, 100, 0), ("b", 2, 100, 0), ("b", 3, 100, 9), ("c", 1, 40, 3), ("c", 2, 100, 3)]
    got = D.archive_pages(spark.createDataFrame(rows, "op_slug string, page bigint, returned bigint, live bigint"), 100, 5).collect()
    assert sorted((r["op_slug"], r["page"], r["stop"]) for r in got if r["stop"]) == [("a", 2, "target reached"), ("b", 2, "two pages with no live products"), ("c", 1, "last page")]
    assert len(got) == 5


# ---- gates -----------------------------------------------------------------


def test_gate_stages(spark):
    rows = [
        listing(1), listing(2, image_url="", total_entries=None), listing(3, ticket_price=2_000_000.0), listing(4, total_entries=400), listing(5, total_entries=60, title="Pokémon card"),
        listing(6, draw_date="2026-08-18T20:00:00+01:00"), listing(7, draw_date="2026-12-01T20:00:00+00:00"), listing(8, ticket_price=0.0), listing(9, draw_date="junk"), listing(10, category="toys", title=" x " + "y" * 300),
    ]
    out = {r["seq"]: r for r in G.gate(spark.createDataFrame(rows, LISTING), G.GateConfig(now=NOW)).collect()}
    got = {k: (r["stage"], list(r["reasons"])) for k, r in out.items()}
    assert got[1] == ("ok", []) and got[5] == ("ok", [])
    assert got[2] == ("required", ["missing total_entries", "missing image_url"])
    assert got[3] == ("schema", ["ticket_price out of range"])
    assert got[4] == ("business", ["only 400 entries — non-standard draw"])
    assert got[6] == ("business", ["already closed"]) and got[7] == ("business", ["ends >35d away"])
    assert got[8] == ("business", ["no/zero ticket price"]) and got[9] == ("required", ["missing draw_date"])
    assert out[10]["category"] is None and len(out[10]["title"]) == 200


def test_flags_need_contradiction(spark):
    rows = [(*listing(1), "car-draws"), (*listing(2), "luxury"), (*listing(3), None), (*listing(4, category=None), None), (*listing(5, ticket_price=60.5, total_entries=6_000_000, image_url="x", description="", title="abc"), None)]
    df = spark.createDataFrame(rows, LISTING + ", evidence string")
    got = {r["seq"]: list(r["f"]) for r in df.select("seq", G.field_flags(F.col("evidence")).alias("f")).collect()}
    assert got[1] == [] and got[3] == []
    assert got[2] == ["category 'car-draws' contradicts the prize, which reads as 'luxury'"]
    assert got[4] == ["no category evidence"]
    assert got[5] == ["ticket £60.5 >£50?", "6000000 entries >5M?", "pool £363000000 >£50M?", "missing/bad image", "thin description", "thin title"]
    held = df.select("seq", G.field_flags(F.col("evidence"), True).alias("f")).where("seq = 4").first()
    assert list(held["f"]) == []


# ---- agreement and lifecycle -----------------------------------------------

STORED = "id string, entry_url string, status string, title string, ticket_price double, total_entries bigint, total_prize_value double, draw_date string, prize_description string, category_id string, category_source string"


def stored(seq=1, **over):
    row = dict(id=f"d{seq}", entry_url=f"https://x.co.uk/p/{seq}", status="draft", title="Win a BMW", ticket_price=0.99, total_entries=20000, total_prize_value=19800.0, draw_date="2026-08-25T20:00:00+01:00", prize_description="x" * 30, category_id="c", category_source="rule")
    row.update(over)
    return tuple(row.values())


def decide(spark, pairs, **cfg):
    fresh = spark.createDataFrame([listing(i, **f) for i, (s, f) in enumerate(pairs)], LISTING)
    old = spark.createDataFrame([stored(i, **s) for i, (s, f) in enumerate(pairs) if s is not None], STORED)
    out = R.reconcile(fresh.repartition(3), old, R.ReconcileConfig(now=NOW, **cfg))
    return {r["seq"]: r for r in out.collect()}


def test_reconcile_table(spark):
    later, past = "2026-08-30T20:00:00+01:00", "2026-08-01T20:00:00+01:00"
    got = decide(spark, [
        (None, {}),                                                    # 0 first sighting
        ({}, {}),                                                      # 1 second agreeing read
        ({}, {"ticket_price": 0.5}),                                   # 2 price moved
        ({"draw_date": "2026-08-25T21:00:00+01:00"}, {}),              # 3 clock nudge is no drift
        ({"status": "active"}, {}),                                    # 4 nothing to correct
        ({"status": "active", "total_prize_value": 5.0}, {}),          # 5 pool only
        ({"status": "active"}, {"ticket_price": 0.49, "category": "car-draws"}),  # 6 clean drift
        ({"status": "active"}, {"ticket_price": 0.0}),                 # 7 flagged read
        ({"status": "ended", "draw_date": past}, {"draw_date": later}),  # 8 relisted
        ({"status": "ended", "draw_date": later}, {"draw_date": later}),  # 9 not run yet
        ({"category_source": "claude"}, {"total_entries": 19999}),     # 10 judged category
        ({}, {"draw_date": "2026-08-19T12:00:00+01:00"}),              # 11 too soon
    ])
    assert [got[i]["action"] for i in range(12)] == ["insert", "publish", "refresh", "publish", "skip", "correct", "correct", "skip", "relist", "skip", "refresh", "refresh"]
    assert got[0]["status"] == "draft" and got[1]["status"] == "active" and got[8]["status"] == "draft"
    assert list(got[5]["patch"]) == ["total_prize_value"]
    assert "image_url" not in got[6]["patch"] and "category_id" in got[6]["patch"]
    assert "category_id" not in got[10]["patch"] and "likely a stock counter" in got[10]["reason"]
    assert got[7]["reason"].startswith("fresh read is flagged")
    assert "closes too soon to publish" in got[11]["reason"]


def test_publish_cap_and_null_image(spark):
    pairs = [({}, {}) for _ in range(5)]
    assert [r["action"] for _, r in sorted(decide(spark, pairs, publish_cap=2).items())] == ["publish"] * 2 + ["refresh"] * 3
    fresh = spark.createDataFrame([(*listing(1), None), (*listing(2), True)], LISTING + ", image_ok boolean")
    out = R.reconcile(fresh, spark.createDataFrame([stored(1), stored(2)], STORED), R.ReconcileConfig(now=NOW))
    assert {r["seq"]: r["action"] for r in out.collect()} == {1: "refresh", 2: "publish"}


def test_match_key(spark):
    fresh = spark.createDataFrame([listing(1, entry_url="https://x.co.uk/p/1/")], LISTING)
    old = spark.createDataFrame([stored(1)], STORED)
    assert R.with_stored(fresh, old).first()["s_id"] is None
    assert R.with_stored(fresh, old, "permalink").first()["s_id"] == "d1"


def test_rule_fix(spark):
    rows = [("active", None, "cash-prizes", "luxury", "fix"), ("active", None, "luxury", "luxury", "stamp"), ("active", None, "luxury", None, "export"), ("ended", None, "luxury", None, "skip"), ("active", "claude", "x", "luxury", "skip"), ("draft", None, "luxury", None, "clear"), ("draft", "rule", "luxury", None, "skip")]
    df = spark.createDataFrame(rows, "status string, category_source string, category_slug string, verdict string, e string")
    assert R.with_rule_fix(df).where("fix <> e").count() == 0


# ---- sinks -----------------------------------------------------------------


def test_upsert_is_idempotent(spark, tmp_path):
    first = spark.createDataFrame([("2026-01-01", "reel", "draft", 1), ("2026-01-01", "story", "draft", 2)], "date string, format string, status string, n int")
    a, b, c = (str(tmp_path / n) for n in ("v0", "v1", "v2"))
    S.upsert(spark, first, ["date", "format"], a)
    change = spark.createDataFrame([("2026-01-01", "reel", "published"), ("2026-01-02", "reel", "draft")], "date string, format string, status string")
    want = {("2026-01-01", "reel", "published", 1), ("2026-01-01", "story", "draft", 2), ("2026-01-02", "reel", "draft", None)}
    for _ in range(2):
        assert {tuple(r) for r in S.upsert(spark, change, ["date", "format"], b, a).collect()} == want
    assert {tuple(r) for r in S.upsert(spark, change, ["date", "format"], c, b).collect()} == want
    with pytest.raises(ValueError):
        S.upsert(spark, change, ["date", "format"], b, b)


# ---- reports ---------------------------------------------------------------


def test_null_signals_never_fire(spark):
    signals = spark.createDataFrame([(None, None, None, None)], "active_count bigint, fresh_count bigint, expired_drafts bigint, storage_bytes bigint")
    row = P.tripwire(signals, P.TripwireConfig()).first()
    assert not row["tripped"] and list(row["warnings"]) == []
    low = spark.createDataFrame([(5, 0, 2, 1 << 30)], "active_count bigint, fresh_count bigint, expired_drafts bigint, storage_bytes bigint")
    row = P.tripwire(low, P.TripwireConfig(), "failure").first()
    assert row["tripped"] and len(row["reasons"]) == 4 and len(row["warnings"]) == 1


def test_thin_reference_scan_is_refused(spark):
    objects = spark.createDataFrame([(f"o/{i}.webp",) for i in range(10)], "path string")
    with pytest.raises(ST.ThinReferenceScan):
        ST.check_reference_ratio(objects.limit(4), objects)
    assert ST.check_reference_ratio(objects.limit(5), objects) == 0.5
    with pytest.raises(ST.ThinReferenceScan):
        ST.referenced_paths({"t": spark.createDataFrame([("x",)], "u string")}, "https://s/")


def test_value_line(spark):
    def line(rows, slug):
        df = spark.createDataFrame([(slug, float(v), p, d) for v, p, d in rows], "category_slug string, total_prize_value double, grand_prize string, prize_description string")
        return C.value_line(df).first()["line"]

    assert line([(1000, "", "")], "collectibles") == "" and line([(9000, "", "")], "collectibles") == "£9,000+"
    assert line([(15000, "", "")], "car-draws") == "" and line([(50, "", "")], "other") == ""
    rows = [(100000, "Land Rover or £40,000 tax-free cash", ""), (47830, "Jimny", ""), (18757, "Astra", ""), (19746, "S1000RR", ""), (35873, "Harley", "or £15,000 cash"), (5, "or £000 cash", "")]
    assert line(rows, "car-draws") == "£141,000+"


def test_missing_category_aborts(spark):
    from listflow.functions import rules
    from listflow.operators.lookups import MissingCategories, require_categories

    rows = [(str(i), s) for i, s in enumerate(rules.CATEGORIES)]
    require_categories(spark.createDataFrame(rows, "id string, slug string"))
    with pytest.raises(MissingCategories):
        require_categories(spark.createDataFrame(rows[1:], "id string, slug string"))
