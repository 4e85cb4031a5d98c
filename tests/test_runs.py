"""Rules that hold over a whole run or a whole store: caps, replays, late reads, stored repeats, unique slugs."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from listflow.operators import dedupe as D
from listflow.operators import reconcile as R
from listflow.operators.ranking import ensure_checkpoint_dir, written_in_slices
from listflow.streaming import observe as O

CFG = R.ReconcileConfig(now="2026-08-19 10:00:00", publish_cap=3)


def reads(spark, run, numbers):
    row = lambda i: (run, None, i, "op", f"https://x.test/p/{i}", f"Win a Toyota {i}", f"Toyota {i}", "car-draws", 1.5, 9000, "2026-08-28T20:00:00+01:00", "https://i.test/x.webp", "A description that is long enough.", True)
    return spark.createDataFrame([row(i) for i in numbers], O.READ)


def published(store):
    return store.where("status = 'active'").count()


@pytest.fixture(scope="module")
def first_run(spark):
    return O.apply_run(O.current_store(spark, "", -1), reads(spark, 1, range(10)), CFG).checkpoint()


def test_a_cap_counts_over_the_slices_of_a_run(spark, first_run):
    one = O.apply_run(first_run, reads(spark, 2, range(5)), CFG).checkpoint()
    two = O.apply_run(one, reads(spark, 2, range(5, 10)), CFG)
    assert published(one) == 3 and published(two) == 3
    # the next run has a cap of its own
    three = O.apply_run(two.checkpoint(), reads(spark, 3, range(10)), CFG)
    assert published(three) == 6


def test_replayed_reads_spend_no_cap(spark, first_run):
    replay = reads(spark, 1, range(3)).unionByName(reads(spark, 2, range(3, 10)))
    assert published(O.apply_run(first_run, replay, CFG)) == 3
    late = O.late_reads(first_run, replay)
    assert sorted(r["seq"] for r in late.collect()) == [0, 1, 2]


def test_the_stream_does_the_same_in_any_slices(spark, tmp_path):
    counts = []
    for files in (1, 100):
        root = tmp_path / str(files)
        stamp = lambda df, n: df.withColumn("captured_at", F.lit(f"2026-08-1{n} 06:00:00").cast("timestamp"))
        for n, (run, numbers) in enumerate([(1, range(8)), (2, range(4)), (2, range(4, 8)), (1, range(2))]):
            stamp(reads(spark, run, numbers), run).coalesce(1).write.mode("append").parquet(f"{root}/in")
        O.observe_stream(O.read_captures(spark, f"{root}/in", files), f"{root}/store", f"{root}/state", replace(CFG)).awaitTermination()
        store = O.latest_store(spark, f"{root}/store", 50)
        counts.append((store.count(), published(store)))
    assert counts[0][0] == counts[1][0] == 8 and counts[1][1] == 3 and counts[0][1] <= 3


def test_a_url_stored_twice_gives_one_action(spark):
    fresh = spark.createDataFrame([(1, "https://x.test/p/1"), (2, None), (3, ""), (4, None)], "seq long, entry_url string")
    old = spark.createDataFrame([("a", "https://x.test/p/1"), ("b", "https://x.test/p/1"), ("c", None), ("d", ""), ("e", "https://x.test/p/1/")], "id string, entry_url string")
    exact = {r["seq"]: r["s_id"] for r in R.with_stored(fresh, old).collect()}
    assert exact == {1: "b", 2: None, 3: None, 4: None}
    canonical = R.with_stored(fresh, old, "permalink").collect()
    assert sorted((r["seq"], r["s_id"]) for r in canonical if r["s_id"]) == [(1, "e")] and len(canonical) == 4


def test_slugs_differ_across_bases(spark):
    long = "y" * 130
    rows = [("Win X", "op"), ("Win X", "op"), ("Win X op", "2"), ("Win X op", "2"), (long, "op"), (long, "op"), (long, "op")]
    df = spark.createDataFrame([(i, t, o) for i, (t, o) in enumerate(rows)], "seq long, title string, op_slug string")
    cut = ("y" * 116 + "-op")[:118] + "-2"
    taken = spark.createDataFrame([("win-x-op",), (cut,)], "slug string")
    got = [r["slug"] for r in D.assign_slugs(df, taken).orderBy("seq").collect()]
    assert len(set(got)) == len(rows) and not set(got) & {"win-x-op", cut} and max(map(len, got)) <= 120
    assert got[:2] == ["win-x-op-2", "win-x-op-3"] and got[2] == "win-x-op-2-2"


def test_the_stream_leaves_two_versions_and_no_scratch(spark, tmp_path):
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    for run in range(1, 4):
        reads(spark, run, range(6)).withColumn("captured_at", F.lit(f"2026-08-1{run} 06:00:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    # a file a batch, and after them a batch without rows
    O.observe_stream(O.read_captures(spark, f"{tmp_path}/in", 1), f"{tmp_path}/store", f"{tmp_path}/state", CFG).awaitTermination()
    assert len([v for v in os.listdir(tmp_path / "store") if v.startswith("v=")]) == 2
    assert O.latest_store(spark, f"{tmp_path}/store", 50).count() == 6
    left = {n for n in set(os.listdir(shared)) - before if n.startswith(("observe-", "reconcile-"))}
    assert not left


def test_a_run_is_met_with_the_store_in_slices(spark, tmp_path, monkeypatch):
    """The versions are those of whole runs, and a batch writes no more of the compared rows than the store needs."""
    written = []
    monkeypatch.setattr(O, "SLICES", 2)
    monkeypatch.setattr(O, "SLICED_FROM", 0)
    monkeypatch.setattr(O, "written_in_slices", lambda make, slices, path: written.append((os.path.basename(path), slices)) or written_in_slices(make, slices, path))
    empty = O.current_store(spark, "", -1)
    first = O.apply_run(empty, reads(spark, 1, range(40)), CFG).checkpoint()
    second = O.apply_run(first, reads(spark, 2, range(20, 60)), CFG)
    for run, numbers in ((1, range(40)), (2, range(20, 60))):
        df = reads(spark, run, numbers).withColumn("captured_at", F.lit(f"2026-08-0{run} 00:00:00").cast("timestamp"))
        df.union(df).write.mode("overwrite").parquet(f"{tmp_path}/in")
        O.observe_stream(O.read_captures(spark, f"{tmp_path}/in"), f"{tmp_path}/store", f"{tmp_path}/state", CFG).awaitTermination()
    store = O.latest_store(spark, f"{tmp_path}/store", 9)
    assert sorted(store.collect()) == sorted(second.collect()) and published(store) == 3
    assert store.where("id = sha2(entry_url, 256)").count() == 60
    assert {s for _, s in written} == {2} and [n for n, _ in written].count("reads") == 2
    compared = R.reconcile(reads(spark, 1, range(3)), empty, replace(CFG, scratch=f"{tmp_path}/c", unread=("s_id", "captured_at")))
    assert "s_id" not in compared.columns and "s_id" not in spark.read.parquet(f"{tmp_path}/c/compared").columns
    assert [r["action"] for r in compared.collect()] == ["insert"] * 3
