"""Several tables that become visible together, or not at all.

A commit writes its tables under a name of its own and then puts one small file, the manifest, in its place by a rename that
fails where that place is taken. Readers follow manifests only, so whatever a lost driver or a retried task leaves behind is
never seen. A run that is committed again, because its end was not heard of, changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "version long, run_id string, data string, tables array<string>"


class Conflict(RuntimeError):
    """Someone else committed in between."""


class Commits:
    """Versions of a set of tables under ``path``, a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifests(self) -> DataFrame:
        """(version, run_id, data, tables), a row for each commit."""
        try:
            return self.spark.read.schema(_MANIFEST).json(f"{self.path}/commits/*.json")
        except AnalysisException:  # nothing was ever committed
            return self.spark.createDataFrame([], _MANIFEST)

    def version(self) -> int:
        """The newest version, 0 before the first commit."""
        return self.manifests().agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"]

    def of_run(self, run_id: str) -> int | None:
        row = self.manifests().where(F.col("run_id") == run_id).select("version").first()
        return row["version"] if row else None

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        """A table as of a version, the newest by default; None where no commit up to there wrote it."""
        rows = self.manifests().where(F.array_contains("tables", name))
        if version is not None:
            rows = rows.where(F.col("version") <= version)
        row = rows.orderBy(F.desc("version")).select("data").first()
        return self.spark.read.parquet(f"{row['data']}/{name}") if row else None

    def commit(self, run_id: str, tables: dict[str, DataFrame], after: int) -> int:
        """Write the tables and make them version ``after`` + 1, ``after`` being the version they were made from.

        Returns the version of the run; that of its first commit where it was committed before.  Raises ``Conflict`` where
        another run has taken the version: read again, and decide again.
        """
        if (known := self.of_run(run_id)) is not None:
            return known
        data = f"{self.path}/data/{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{data}/{name}")
        line = json.dumps({"version": after + 1, "run_id": run_id, "data": data, "tables": sorted(tables)})
        self._place(f"{self.path}/staged/{uuid.uuid4().hex}.json", f"{self.path}/commits/{after + 1:012d}.json", line)
        return after + 1

    def _place(self, staged: str, final: str, line: str) -> None:
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        conf = self.spark._jsc.hadoopConfiguration()
        source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, final))
        fs = source.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        out = fs.create(source, True)
        out.write(line.encode())
        out.close()
        options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        # the context's rename fails where the target exists
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        try:
            context.rename(fs.makeQualified(source), fs.makeQualified(target), options)
        except Exception as error:
            if fs.exists(target):
                fs.delete(source, False)
                raise Conflict(f"{final} is taken") from error
            raise
