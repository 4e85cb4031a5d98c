"""Writes: keyed upsert into a new version, column patches, change log, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_rows(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target with ``rows`` merged in by key: new keys are added, known ones replaced.

    Columns that ``rows`` does not carry keep their stored value.  Both sides must be
    unique by key.  Null-safe keys, one shuffle per side.
    """
    values = [n for n in target.columns if n not in keys]
    new = rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*[n for n in values if n in rows.columns]).alias("_new"), F.lit(True).alias("_hit"))
    on = None
    for k in keys:
        term = target[k].eqNullSafe(new[f"_k_{k}"])
        on = term if on is None else on & term
    joined = target.withColumn("_old", F.lit(True)).join(new, on, "full_outer")
    key_cols = [F.when(F.col("_old"), F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys]
    value_cols = [F.when(F.col("_hit"), F.col("_new")[n]).otherwise(F.col(n)).alias(n) if n in rows.columns else F.col(n) for n in values]
    return joined.select(*key_cols, *value_cols).select(*target.columns)


def upsert(spark: SparkSession, rows: DataFrame, keys: list[str], next_path: str, current_path: str | None = None, stamped_at: str | None = None) -> DataFrame:
    """Write the merged table to ``next_path``; the version being read is never touched.

    Overwriting one version path makes a retried run repeat the same result.
    """
    if next_path == current_path:
        raise ValueError("an upsert must write a new version path")
    if stamped_at:
        rows = rows.withColumn("updated_at", F.lit(stamped_at).cast("timestamp"))
    merged = rows if current_path is None else merge_rows(spark.read.parquet(current_path), rows, keys)
    merged.write.mode("overwrite").parquet(next_path)
    return spark.read.parquet(next_path)


def apply_patches(target: DataFrame, patches: DataFrame, key: str = "id", fields: str = "patch") -> DataFrame:
    """Patch only the columns each row names in its ``patch`` array."""
    new = [n for n in patches.columns if n not in (key, fields)]
    side = patches.select(F.col(key), F.col(fields).alias("_fields"), F.struct(*new).alias("_new"))
    joined = target.join(side, key, "left")
    cols = [
        F.when(F.array_contains("_fields", n), F.col("_new")[n]).otherwise(F.col(n)).alias(n) if n in new else F.col(n)
        for n in target.columns
    ]
    return joined.select(*cols)


def change_log(before: DataFrame, after: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """One row per changed field: key, field, old and new value as text."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*[F.col(n).cast("string").alias(n) for n in columns]).alias(name))

    both = side(before, "_old").join(side(after, "_new"), key)
    moves = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"_old.{n}").alias("old"), F.col(f"_new.{n}").alias("new")) for n in columns])
    return both.select(key, F.inline(moves)).where(~F.col("old").eqNullSafe(F.col("new")))


def report_lines(df: DataFrame, columns: list[str], separator: str = " | ") -> DataFrame:
    """Markdown table lines of a report frame, one per row, without gathering it."""
    cells: list[Column] = [F.coalesce(F.col(n).cast("string"), F.lit("—")) for n in columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(separator, *cells), F.lit(" |")).alias("line"))


def write_worklist(df: DataFrame, path: str) -> None:
    """Worklists, logs and queues go out as JSON lines."""
    df.write.mode("overwrite").json(path)
