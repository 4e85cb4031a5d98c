import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def answers(spark):
    """Check (input, expected) pairs of one column function."""

    def check(cases, build, kind="string"):
        df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], f"i int, t string, e {kind}")
        got = {r["i"]: r["g"] for r in df.select("i", build("t").alias("g")).collect()}
        wrong = [(c[0], c[1], got[i]) for i, c in enumerate(cases) if got[i] != c[1]]
        assert not wrong, wrong

    return check
