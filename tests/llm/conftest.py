import sys

import pytest
from pyspark import cloudpickle


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with the awkward cases: null, empty, blanks, one word, ties, copies, a repeated row, a null id, an extra column with a clashing name."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(30000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "a"),
        (2, "the QUICK brown fox jumps over the lazy dog near the old river bank today", "a"),
        (3, None, "a"),
        (4, "", "b"),
        (5, " \t\n", None),
        (6, "word", "b"),
        (7, "word", "b"),
        (8, long, "a"),
        (9, long + " extra", "a"),
        (10, "Größe \U0001f600 naïve — ١٢٣", "c"),
        (10, "Größe \U0001f600 naïve — ١٢٣", "c"),
        (None, "no id here", None),
    ]
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, rep string, key int")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
