import json
import time

import pytest

from listflow.sources import config as CFG
from listflow.sources import feeds as S
from listflow.sources import payloads as P
from listflow.streaming import observe as O
from listflow.operators.reconcile import ReconcileConfig


def raw(spark, body, **more):
    row = {"op_slug": "op", "base": "https://op.test/", "body": json.dumps(body) if not isinstance(body, str) else body, **more}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))


def test_woo_keeps_only_live_rows(spark):
    items = [
        {"id": 1, "name": "A &amp; B", "permalink": "https://op.test/p/a", "prices": {"price": "199", "currency_minor_unit": 2}, "is_purchasable": True, "images": [{"src": "i"}], "categories": [{"name": "Tech"}], "stock_availability": {"text": "1,250 in stock"}},
        {"id": 2, "name": "x", "is_purchasable": 0}, {"id": 3, "name": "y", "is_purchasable": False}, {"id": 4, "name": "old", "prices": {"price": "5"}},
    ]
    rows = S.read_woo(raw(spark, items)).collect()
    assert [(r["product_id"], r["title"], r["known_price"], r["stock"]) for r in rows] == [("1", "A & B", 1.99, 1250), ("4", "old", 0.05, None)]
    assert S.read_woo(raw(spark, "<html>blocked</html>")).count() == 0


def test_hydra_reads_pence(spark):
    body = {"hydra:member": [
        {"name": " Win a BMW ", "urlStub": "bmw", "closeTs": "2026-08-25T19:00:00+00:00", "status": "published", "category": "car_sports", "thumb": "/media-uploads/abc", "regularPrice": 9, "numTickets": 1000},
        {"name": "closed", "urlStub": "c", "closeTs": "2026-08-01T19:00:00+00:00", "status": "published"},
    ]}
    (row,) = S.read_hydra(raw(spark, body), "2026-08-19 10:00:00", "https://m/t").collect()
    assert (row["ticket_price"], row["entry_url"], row["image_url"], row["category"], row["draw_date"]) == (0.09, "https://op.test/competitions/bmw", "https://m/t/abc?w=1280", "car-draws", "2026-08-25T19:00:00+01:00")


def test_raffle_prices(spark):
    base = {"slug": "s", "title": "Rolex", "end_at": "2026-09-01T20:00:00+01:00", "is_open": True}
    items = [{**base, "offers": [{"price": "2.00", "tickets_quantity": 5}, {"price": "0.50", "tickets_quantity": 1}]}, {**base, "slug": "t", "offers": [{"price": "2.00", "tickets_quantity": 5}, {"price": "3", "tickets_quantity": 10}]}, {**base, "is_open": False}, {**base, "slug": "u", "offers": []}]
    rows = S.read_raffle_engine(raw(spark, items)).collect()
    assert {r["entry_url"][-1]: r["ticket_price"] for r in rows} == {"s": 0.5, "t": 0.3, "u": None}


def test_inertia_shapes(spark):
    item = {"id": 1, "slug": "a", "name": "TV", "price": "2.00", "sale_price": "0.00", "total_tickets": 10, "end": "2026-09-01 20:00:00", "image_path": "/i.jpg", "status": "ACTIVE", "categories": {"data": [{"name": "Tech"}]}}
    state = json.dumps({"props": {"competitions": {"data": [item]}, "featuredCompetitions": [item, {**item, "id": 2, "slug": "b"}]}}).replace('"', "&quot;")
    rows = S.read_inertia(raw(spark, f'<div data-page="{state}"></div>')).collect()
    assert sorted((r["entry_url"], r["ticket_price"], r["category"], r["draw_date"]) for r in rows) == [(f"https://op.test/competitions/{s}", 2.0, "tech-giveaways", "2026-09-01T20:00:00+01:00") for s in "ab"]


def test_inertia_reads_a_page_of_many_items_once(spark):
    item = lambda i: {"id": i if i % 3 else None, "slug": f"s{i}", "name": f"TV {i}", "price": "2", "status": "active"}
    items = [item(i) for i in range(600)]
    state = json.dumps({"props": {"competitions": items + [{"name": "neither"}, None], "featuredCompetitions": items[::-1]}}).replace('"', "&quot;")
    began = time.monotonic()
    rows = S.read_inertia(raw(spark, f'<div data-page="{state}"></div>', feed_page="1"), place="at").orderBy("at").collect()
    assert [r["title"] for r in rows] == [f"TV {i}" for i in range(600)]
    # a list that is read again for every item takes minutes
    assert time.monotonic() - began < 20


def test_unknown_styles_and_kinds(spark):
    with pytest.raises(ValueError):
        S.read_api(raw(spark, []), "gopher")
    with pytest.raises(ValueError):
        P.map_payload(raw(spark, {}), "tw_posts")
    S.register_adapter("mine", lambda frame: frame)
    assert S.read_api(raw(spark, []), "mine").count() == 1


def test_config_files(spark, tmp_path):
    ops = [{"name": "A", "slug": "a", "method": "woo"}, {"name": "B", "slug": "b", "enabled": False}, {"name": "C", "slug": "c", "aiAssist": True}]
    (tmp_path / "ops.json").write_text(json.dumps(ops))
    config = CFG.read_config(spark, str(tmp_path / "ops.json"))
    assert [r["slug"] for r in CFG.runnable(config).collect()] == ["a"]
    (tmp_path / "skip.csv").write_text("name,website_url,skip_reason,detail,added\nX,https://x.co.uk,dead,d,2026-01-01\n")
    assert CFG.read_ledger(spark, str(tmp_path / "skip.csv")).first()["website_url"] == "https://x.co.uk"
    (tmp_path / "seeds.txt").write_text("# comment\n\n https://www.Win-Big.co.uk/x \n")
    assert [r["domain"] for r in P.seed_candidates(spark.read.text(str(tmp_path / "seeds.txt"))).collect()] == ["win-big.co.uk"]
    assert CFG.valid_regex("(") is None and CFG.valid_regex(r"\d+") == r"\d+"


def test_stream_publishes_on_the_second_run(spark, tmp_path):
    def capture(run, price):
        return (run, f"2026-08-1{run} 06:00:00", 1, "op", "https://x/p/1", "Win a BMW", "Win a BMW", "car-draws", price, 20000, "2026-08-25T20:00:00+01:00", "https://i/x.webp", "A description that is long enough.", True)

    text = O.READ.replace("captured_at timestamp", "captured_at string")
    cfg = ReconcileConfig(now="2026-08-19 10:00:00")
    states = []
    for run, price in ((1, 0.99), (2, 0.5), (3, 0.5)):
        rows = spark.createDataFrame([capture(run, price)] * 2, text).selectExpr("run_id", "CAST(captured_at AS TIMESTAMP) AS captured_at", *[c.split()[0] for c in O.READ.split(", ")[2:]])
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = O.observe_stream(O.read_captures(spark, str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "state"), cfg)
        query.awaitTermination()
        store = O.latest_store(spark, str(tmp_path / "store"), 50)
        states.append([(r["status"], r["ticket_price"], r["last_run"]) for r in store.collect()])
    assert states == [[("draft", 0.99, 1)], [("draft", 0.5, 2)], [("active", 0.5, 3)]]
