"""Operator configuration, CSV ledgers and captured pages."""

from __future__ import annotations

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import c

CONFIG_SCHEMA = (
    "name string, slug string, base string, method string, apiStyle string, fetcher string, listing string, "
    "drawMatch string, drawPath string, drawUrlTemplate string, listApi string, category string, note string, "
    "exclude array<string>, selectors map<string,string>, patterns map<string,string>, maxLive int, maxPages int, "
    "lookbackDays int, wait int, enabled boolean, aiAssist boolean, insecureTLS boolean"
)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Operator configuration (one JSON array per file)."""
    return spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger of operators that were skipped, with the reason."""
    schema = "name string, website_url string, skip_reason string, detail string, added string"
    return spark.read.csv(path, schema=schema, header=True)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages ``(url, html)`` from parquet; whole texts, however long."""
    return spark.read.parquet(path).select("url", "html")


def runnable(config: DataFrame) -> DataFrame:
    """Operators that an unattended run may read."""
    return config.where(F.coalesce("enabled", F.lit(True)) & ~F.coalesce("aiAssist", F.lit(False)))


def select_operators(
    config: DataFrame,
    now: Column,
    batches: int = 1,
    methods: list[str] | None = None,
    only: list[str] | None = None,
    position: str = "position",
) -> DataFrame:
    """Operators of this run: runnable, wanted, and in the day's batch.

    ``position`` is the operator's place in the configuration; batches rotate over the
    places among the operators left after the filters.
    """
    from ..operators.ranking import ranked

    chosen = runnable(config)
    if methods:
        chosen = chosen.where(c("method").isin(*methods))
    if only:
        return chosen.where(c("slug").isin(*only))
    if batches <= 1:
        return chosen
    placed = ranked(chosen, [], position, "_place")
    return placed.where((F.col("_place") - 1) % batches == F.dayofyear(now) % batches).drop("_place")


def valid_regex(pattern: str | None) -> str | None:
    """The pattern when the engine's dialect (java.util.regex) compiles it, else None."""
    if not pattern:
        return None
    try:
        SparkSession.active()._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException:
        return None
    return pattern


def with_valid_patterns(config: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Configuration without patterns that do not compile, and those as (slug, field, pattern).

    A broken pattern counts as not given, so the operator falls back to the shared rules.  The
    driver compiles each distinct pattern once: a handful per configured operator, never per row.
    """
    named = F.concat(
        F.array(F.struct(F.lit("drawMatch").alias("field"), F.col("drawMatch").alias("pattern"))),
        F.transform(F.coalesce("exclude", F.array().cast("array<string>")), lambda p: F.struct(F.lit("exclude").alias("field"), p.alias("pattern"))),
        F.transform(F.map_entries(F.coalesce("patterns", F.create_map().cast("map<string,string>"))), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("pattern"))),
    )
    given = config.select("slug", F.inline(named)).where("pattern IS NOT NULL")
    bad = [r["pattern"] for r in given.select("pattern").distinct().toLocalIterator() if valid_regex(r["pattern"]) is None]
    broken = lambda p: p.isin(bad) if bad else F.lit(False)
    clean = config.withColumns(
        {
            "drawMatch": F.when(~broken(F.col("drawMatch")), F.col("drawMatch")),
            "exclude": F.filter("exclude", lambda p: ~broken(p)),
            "patterns": F.map_filter("patterns", lambda _, p: ~broken(p)),
        }
    )
    return clean, given.where(broken(F.col("pattern")))
