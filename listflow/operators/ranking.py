"""Keyed ranks, caps and running totals that never gather a whole group in one task.

One operator may own a third of all rows, so nothing here sorts a full group in a
single window.  Top-n and first-wins prune on the map side (or by salted pre-ranks), and
full ranks go through order buckets.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
BUCKETS = 1024
# Spark prunes every map task to n rows per key before the shuffle up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_RANKS = 1000


def row_hash(df: DataFrame) -> Column:
    """A hash that depends on the row's values only, so a retried task repeats it."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if f.dataType.typeName() in _HASHABLE])


def _salt(df: DataFrame) -> Column:
    return F.pmod(row_hash(df), F.lit(SALTS)).cast("int")


_HASHABLE = {"string", "long", "integer", "short", "byte", "double", "float", "boolean", "date", "timestamp", "decimal", "timestamp_ntz"}


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key by a total order.

    The rank limit is applied on the map side as well, so a key that holds a third of all
    rows sends one row per map task through the shuffle.
    """
    return top_n(df, keys, order, 1, "_first").drop("_first")


def first_per_key_counted(df: DataFrame, keys: list[str], order: list[Column], counter: str) -> DataFrame:
    """``first_per_key`` that also counts the rows of every key, in one combining aggregate."""
    rest = [n for n in df.columns if n not in keys]
    best = F.min_by(F.struct(*[F.col(f"`{n}`") for n in rest]), F.struct(*order)).alias("_row")
    out = df.groupBy(*keys).agg(best, F.count(F.lit(1)).alias(counter))
    return out.select(*[F.col("_row")[n].alias(n) if n in rest else F.col(f"`{n}`") for n in df.columns], F.col(counter))


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of every key by a total order, ranked from 1.

    Up to ``PRUNED_RANKS`` the map side keeps n rows per key and task.  Beyond it the rows
    are ranked per (key, salt) first, so that the last step sees at most ``SALTS * n``.
    """
    pre = df
    if n > PRUNED_RANKS:
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        salted = df.withColumn("_salt", _salt(df)).withColumn("_pre", F.row_number().over(part))
        pre = salted.where(F.col("_pre") <= n).drop("_pre", "_salt")
    whole = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    return pre.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= n)


def cap_cutoff(df: DataFrame, eligible: Column, order: str, cap: int) -> Column:
    """Order value of the ``cap``-th eligible row, as a scalar subquery.

    A row is within the cap when its order value does not exceed it.  ``order`` must be
    unique.  The subquery is a distributed top-k; only the order column is read for it.
    """
    head = df.where(eligible).select(order).orderBy(order).limit(cap)
    return head.agg(F.max(order).alias("cut")).scalar()


def within_cap(df: DataFrame, eligible: Column, order: str, cap: int | None, out: str) -> DataFrame:
    """Add a flag: the row is eligible and among the first ``cap`` eligible ones; without a cap, that it is eligible."""
    if cap is None:
        return df.withColumn(out, F.coalesce(eligible, F.lit(False)))
    cut = cap_cutoff(df, eligible, order, cap)
    return df.withColumn(out, F.coalesce(eligible & (F.col(order) <= cut), F.lit(False)) if cap > 0 else F.lit(False))


def order_bounds(df: DataFrame, order: str, buckets: int = BUCKETS) -> list[float]:
    """At most ``buckets - 1`` cut values of a numeric order column, from one small aggregate."""
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(order).cast("double"), shares, 10 * buckets).alias("b")).first()
    return sorted(set(row["b"] or []))


def _bucketed(df: DataFrame, order: str, bounds: list[float]) -> DataFrame:
    """Add ``_bucket``, a non-decreasing function of the order (a binary search in the JVM)."""
    if not bounds:
        return df.withColumn("_bucket", F.lit(0.0))
    splits = [-math.inf, *bounds, math.inf]
    cut = Bucketizer(splits=splits, inputCol="_order", outputCol="_bucket", handleInvalid="keep")
    return cut.transform(df.withColumn("_order", F.col(order).cast("double"))).drop("_order")


def ranked(df: DataFrame, keys: list[str], order: str, out: str = "rank", bounds: list[float] | None = None) -> DataFrame:
    """Full 1-based rank of every row within its key by a unique numeric ``order``.

    Each key is split into order buckets: ranks are counted inside a bucket, and the
    sizes of the earlier buckets of the key are added.  The hottest task holds about
    1/``BUCKETS`` of the rows however they spread over the keys.
    """
    return running(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, "_one", out, bounds).drop("_one")


def running(df: DataFrame, keys: list[str], order: str, value: str, out: str, bounds: list[float] | None = None) -> DataFrame:
    """Running total of ``value`` up to and including the row, per key, by ``order``.

    ``bounds`` may come from a cheaper frame with the same spread of order values.
    """
    cut = _bucketed(df, order, order_bounds(df, order) if bounds is None else bounds)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = cut.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_size"))
    # one row per (key, bucket): at most BUCKETS rows share a key
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    local = cut.withColumn("_inside", F.sum(value).over(inside))
    same = [local[k].eqNullSafe(offsets[k]) for k in keys] + [local["_bucket"] == offsets["_bucket"]]
    joined = local.join(offsets, _all(same), "inner")
    return joined.select(*[local[n] for n in df.columns], (F.col("_inside") + F.col("_offset")).alias(out))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def numbered(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """Global 1-based position of every row in a total order of any column types.

    The sorted rows are checkpointed, so partition and in-partition numbers are fixed;
    the offsets of the partitions are a table of one row per partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    fixed = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    fixed = fixed.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_slot", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    return fixed.join(offsets, "_part").select(*df.columns, (F.col("_slot") + F.col("_offset") + 1).alias(out))


def ensure_checkpoint_dir(spark) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local session; a cluster must name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="listflow-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark, name: str) -> str:
    """A fresh path for a written table inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Spark's own switch: what a statement shuffled is deleted when the statement ends, not when the driver collects garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark) -> Iterator[None]:
    """What the statements inside shuffle is deleted as each of them ends."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)


def in_slice(key: str, slices: int, k: int) -> Column:
    """Whether a row belongs to slice ``k`` of ``slices`` by a hash of its key; a NULL key belongs to one of them too."""
    return F.pmod(F.xxhash64(key), F.lit(slices)) == k


def written_in_slices(make: Callable[[int], DataFrame], slices: int, path: str) -> DataFrame:
    """The frames ``make(0)`` to ``make(slices - 1)`` written one after the other as one table and read back.

    Only what one slice shuffles is on disk at a time.  The table is marked as complete with its last slice.
    """
    for k in range(slices):
        out = materialised(make(k), path=path, mode="append" if k else "overwrite", complete=k == slices - 1)
    return out


def materialised(df: DataFrame, name: str = "stage", path: str | None = None, mode: str = "overwrite", complete: bool = True) -> DataFrame:
    """The frame written once as a table in the shared folder and read back.

    Cuts the lineage, survives lost executors, and later readers prune its columns; what the write
    shuffled is deleted with it.  A caller that names the ``path`` may delete it when the last reader is done.
    """
    path = path or scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        marked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": str(complete).lower()}
        df.write.mode(mode).options(compression="zstd", **marked).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark, path: str) -> None:
    """Delete a written table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
