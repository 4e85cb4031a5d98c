"""Newest row not after a moment: as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a time bucket.
WIDTH = 86_400


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, out: str = "as_of", width: int = WIDTH) -> DataFrame:
    """``left`` with the greatest ``right_time`` of its keys that is not after ``left_time``, as ``out``; NULL where there is none.

    Only keys and times are shuffled, so that a wide right side is read once more for the rows that were met: join on the keys and
    ``out``.  Times are dealt into buckets of ``width`` seconds.  A row looks for its match among the right rows of its own key and
    bucket; where that has none, the last right row of the key's earlier buckets is carried over.  No window so holds more than
    a bucket of a key, or a row for each of its buckets, however many rows the key has.  NULL keys and times match nothing.
    """
    seconds = F.floor(F.unix_micros("_t") / (width * 1_000_000))
    known = F.col("_t").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    moments = lambda df, t, side: df.select(*keys, F.col(t).cast("timestamp").alias("_t")).where(known).distinct().withColumns({"_b": seconds, "_left": F.lit(side)})
    both = moments(left, left_time, True).unionByName(moments(right, right_time, False)).withColumn("_r", F.when(~F.col("_left"), F.col("_t")))
    # a right row of the same moment comes first
    inside = Window.partitionBy(*keys, "_b").orderBy("_t", "_left").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = both.withColumn("_here", F.last("_r", ignorenulls=True).over(inside)).where("_left")
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*keys, "_b").agg(F.max("_r").alias("_last")).withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
    found = here.join(carried, [*keys, "_b"]).select(*keys, "_t", F.coalesce("_here", "_carried").alias(out))
    return left.withColumn("_t", F.col(left_time).cast("timestamp")).join(found, [*keys, "_t"], "left").select(*left.columns, out)
