"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch where the session does not set them.
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="listflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """Tables of one operator run, in one folder of the shared place."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back: later steps see fixed rows, whatever is lost or run again."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete one table or all."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """Scratch tables that go when the block ends; what it returns must be checkpointed inside."""
    own = Scratch(spark)
    try:
        yield own
    finally:
        own.drop()


def fixed(df: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _given_back(run: Callable) -> Callable:
    """The stage, with what its arrays took given back to the system at its end: a worker goes on to other stages."""

    def own(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(AttributeError, OSError):
                ctypes.CDLL(None).malloc_trim(0)

    return own


def in_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` in batches bounded by bytes, not by 10,000 rows of any length: sets the session's bound if it has none."""
    conf = df.sparkSession.conf
    if conf.get(_ARROW, "1b") == "1b":
        conf.set(_ARROW, str(ARROW_BYTES))
    return df.mapInArrow(_given_back(run), schema)


def rows_per_bin(total: int, per_bin: int, least: int = 1) -> int:
    """How many bins keep each to about ``per_bin`` of ``total``."""
    return max(least, -(-int(total) // per_bin))
