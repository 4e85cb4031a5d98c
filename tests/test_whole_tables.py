"""Rules that hold for every row: references in late rows, repeats inside a list, texts without words."""

import json

import pytest
from pyspark.sql import functions as F

from listflow.plans import storage
from listflow.plans.content import description_checks
from listflow.sources.feeds import read_inertia
from queries import inputs

PREFIX = "https://store.example/object/public/pics/"


def test_references_in_late_rows_keep_their_objects(spark, monkeypatch):
    monkeypatch.setattr(storage.X, "object_path_from_url", lambda c, prefix: F.when(c.startswith(prefix), F.substring(c, F.lit(len(prefix) + 1), F.length(c))))
    late = spark.range(300).select("id", F.when(F.col("id") >= 250, F.concat(F.lit(PREFIX), "id", F.lit(".webp"))).alias("image_url"), F.lit("plain").alias("title")).coalesce(1)
    used = storage.referenced_paths({"late": late, "none": spark.range(2)}, PREFIX)
    assert sorted(r["path"] for r in used.collect()) == sorted(f"{i}.webp" for i in range(250, 300))
    objects = spark.range(240, 300).select(F.concat("id", F.lit(".webp")).alias("path"), F.lit("2020-01-01 00:00:00").alias("created_at"), F.lit(None).cast("string").alias("updated_at"), F.lit(1).alias("size"))
    plan = {r["path"]: r["plan"] for r in storage.orphan_plan(objects, used, "2026-08-08 12:00:00").collect()}
    assert all(p == ("keep" if int(k.split(".")[0]) >= 250 else "orphan") for k, p in plan.items())


def test_a_table_set_without_text_columns_is_refused(spark):
    with pytest.raises(storage.ThinReferenceScan):
        storage.referenced_paths({"none": spark.range(2)}, PREFIX)


def test_inertia_repeats_inside_a_list_count_once(spark):
    row = lambda i, name, **more: {"id": i, "slug": more.get("slug", f"s{i}"), "name": name, "status": "active", "price": "2.00", "total_tickets": 100, "end": "2026-09-01 20:00:00"}
    page = {"props": {"competitions": [row(1, "first"), row(1, "again"), row(2, "two")], "featuredCompetitions": [row(2, "two again"), row(3, "three"), row(3, "three again"), row(None, "nobody", slug=None)]}}
    body = f'<div data-page="{json.dumps(page).replace(chr(34), "&quot;")}"></div>'
    raw = spark.createDataFrame([("op-1", "https://op.example", body)], "op_slug string, base string, body string")
    assert sorted(r["title"] for r in read_inertia(raw).collect()) == ["first", "three", "two"]


def test_texts_without_words_are_no_copies(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, " 12 !"), (4, "Some words"), (5, "some WORDS 7"), (6, None)], "seq long, description string")
    assert [r["verdict"] for r in description_checks(rows).orderBy("seq").collect()] == ["ok", "ok", "ok", "ok", "copy", "ok"]


def test_rows_of_one_row_group_are_spread_however_many_splits_the_file_has(spark, tmp_path):
    spark.range(0, 40000, 1, 1).selectExpr("id", "sha2(cast(id as string), 256) AS t").write.parquet(f"{tmp_path}/one")
    spark.range(0, 40000, 1, 8).selectExpr("id", "sha2(cast(id as string), 256) AS t").write.parquet(f"{tmp_path}/eight")
    sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400k")
        spark.conf.set("spark.sql.files.openCostInBytes", "300k")
        one, eight = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("one", "eight"))
        assert one.rdd.getNumPartitions() >= 4 and sizes(one) == [40000]
        assert sizes(inputs.spread(one)) == [10000] * 4
        # splits that share the rows already are not shuffled
        assert inputs.spread(eight) is eight
        assert inputs.spread(one).select("id").distinct().count() == 40000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
