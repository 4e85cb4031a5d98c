"""From raw documents to a mixed training corpus: reject bad text, thin out near-duplicates, take out benchmark leaks, mask personal data, mix sources.

Each stage reads what the one before it has written. All but the last return the columns of ``documents``; the last one returns each
document's place in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow.llm import decontamination, mixing, near_dup, pii, quality
from listflow.llm.shared import Scratch, fixed


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives 0.5 or more."""
    return quality.keep_good(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def with_row_key(docs: DataFrame) -> DataFrame:
    """Documents with ``row_key__``: the id, or a hash of id and text above 2**62 where there is no id or another text has it.

    So only rows with equal id and text share a key; of several texts under one id the one with the least hash keeps the id.
    """
    text = F.xxhash64("text")
    # rows without an id come behind those with one
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(7)), 3).bitwiseOR(F.when(F.col("doc_id").isNull(), F.lit(3 << 61)).otherwise(F.lit(1 << 62)))
    clash = fixed(docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("low__"), F.max(text).alias("high__")).where("low__ < high__").select("doc_id", "low__"))
    if clash.isEmpty():
        return docs.withColumn("row_key__", F.coalesce(F.col("doc_id"), own))
    joined = docs.join(clash, "doc_id", "left")
    other = F.col("doc_id").isNull() | (F.col("low__").isNotNull() & (text != F.col("low__")))
    return joined.select(*docs.columns, F.when(other, own).otherwise(F.col("doc_id")).alias("row_key__"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8): the one with the smallest id, before those without an id.

    A row that repeats id and text stays once. Different texts under one id, and rows without an id, are documents of their own.
    """
    keyed = with_row_key(docs)
    gone = near_dup.near_duplicates(keyed, id_col="row_key__").where(~F.col("kept")).select(F.col("doc_id").alias("row_key__")).distinct()
    left = keyed.join(gone.hint("merge"), "row_key__", "left_anti")
    repeated = fixed(left.groupBy("row_key__").count().where("count > 1").select("row_key__"))
    if repeated.isEmpty():
        return left.select(*docs.columns)
    once = left.join(repeated, "row_key__", "left_semi").select(*docs.columns, "row_key__").dropDuplicates(["row_key__"])
    return left.join(repeated, "row_key__", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.mask_pii(docs, pii.train(pii.labelled_table(spark)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in the mixture of sources."""
    return mixing.mix(docs)


STAGES = [("quality", good), ("near_dup", distinct), ("decontamination", uncontaminated), ("pii", masked), ("mixing", mixed)]

#: SQL can't express the trained stages; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, kept = _table(spark, sf_dir, "documents"), Scratch(spark)
    try:
        for name, stage in STAGES:
            docs = kept.keep(stage(spark, docs, sf_dir), name)
        return fixed(docs)
    finally:
        kept.drop()
