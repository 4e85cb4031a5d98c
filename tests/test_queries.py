"""A slice of the registered queries against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from queries import load
from tools.check import TABLES, table

FOLDER = "/root/testdata/sf0.001"
SOME = ["permalink_dedupe", "skip_reasons", "known_first_cap", "agreement", "reconcile_actions", "category_rules", "hydra_feed", "page_hosts", "coverage_totals", "orphan_plan", "daily_report"]


def test_every_query_has_a_counterpart():
    # the library's own; trained operators, where they are present, have no SQL
    own, sql = load()
    assert set(sql) == set(own) and len(own) > 90
    assert set(own) <= set(entry.queries()) and set(sql) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", SOME)
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    cur = duck.execute(entry.oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in cur.description], cur.fetchall())
