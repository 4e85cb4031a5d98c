"""Audit tables: coverage, health, tripwire, scoreboard, category mix, freshness.

Everything aggregates by key with map-side combine; no report gathers rows of a group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import at, c, days, instant, present, round2, when_text
from ..functions.dates import days_since


def _n(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def operator_stats(draws: DataFrame, now: str, op: str = "op_slug") -> DataFrame:
    """Rows per status, live rows, newest insert and latest draw of every operator."""
    live = (F.col("status") == "active") & (instant("draw_date") > at(now))
    return draws.groupBy(op).agg(
        F.count(F.lit(1)).alias("total"),
        _n(F.col("status") == "draft").alias("draft"),
        _n(F.col("status") == "ended").alias("ended"),
        _n(live).alias("live"),
        F.max("created_at").alias("last_insert"),
        F.max(F.nullif("draw_date", F.lit(""))).alias("last_draw"),
    )


def coverage(operators: DataFrame, config: DataFrame, draws: DataFrame, now: str) -> DataFrame:
    """Health bucket of every stored operator.

    ``operators``: slug.  ``config``: slug, method, enabled.  First fitting bucket:
    missing-config, disabled, never-scraped, healthy, quiet, stalled.
    """
    stats = operator_stats(draws, now).withColumnRenamed("op_slug", "slug")
    cfg = config.select("slug", "method", F.coalesce("enabled", F.lit(True)).alias("enabled"), F.lit(True).alias("_configured"))
    rows = operators.select("slug").join(cfg, "slug", "left").join(stats, "slug", "left")
    zero = F.lit(0).cast("bigint")
    rows = rows.withColumns({n: F.coalesce(F.col(n), zero) for n in ("total", "draft", "ended", "live")})
    quiet_days = days_since(F.col("last_insert").cast("string"), now)
    grace = F.when(F.col("method") == "render", 7).otherwise(4)
    bucket = (
        F.when(F.col("_configured").isNull(), F.lit("missing-config"))
        .when(~F.col("enabled"), F.lit("disabled"))
        .when(F.col("total") == 0, F.lit("never-scraped"))
        .when(F.col("live") > 0, F.lit("healthy"))
        .when(F.col("draft") > 0, F.lit("quiet"))
        .when(F.coalesce(quiet_days <= grace, F.lit(False)), F.lit("quiet"))
        .otherwise(F.lit("stalled"))
    )
    return rows.withColumn("days_since_insert", quiet_days).withColumn("configured", F.col("_configured").isNotNull()).withColumn("bucket", bucket).drop("_configured")


def config_orphans(operators: DataFrame, config: DataFrame) -> DataFrame:
    """Configured slugs without a stored operator."""
    return config.select("slug").join(operators.select("slug"), "slug", "left_anti")


def coverage_totals(rows: DataFrame, orphans: DataFrame) -> DataFrame:
    """The twelve totals of the coverage report, as (measure, n) rows."""
    bucket = lambda name: _n(F.col("bucket") == name)
    measures = {
        "db_operators": F.count(F.lit(1)),
        "configured": _n(F.col("configured")),
        "enabled": _n(F.col("enabled")),
        "with_live": _n(F.col("live") > 0),
        "live_draws": F.coalesce(F.sum("live"), F.lit(0)),
        "drafts": F.coalesce(F.sum("draft"), F.lit(0)),
        "missing_config": bucket("missing-config"),
        "never_scraped": bucket("never-scraped"),
        "stalled": bucket("stalled"),
        "quiet": bucket("quiet"),
        "disabled": bucket("disabled"),
    }
    wide = rows.agg(*[e.alias(n) for n, e in measures.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("bigint").alias("n")) for n in measures])
    lost = orphans.agg(F.count(F.lit(1)).alias("n")).select(F.lit("config_orphans").alias("measure"), "n")
    return wide.select(F.inline(pairs)).unionByName(lost)


def health_report(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Per operator and in total (slug NULL): scraped, inserted, published, held; silent ones.

    ``counts``: slug, scraped, inserted, published, held.  ``expected``: slug.
    """
    names = ["scraped", "inserted", "published", "held"]
    known = counts.groupBy("slug").agg(*[F.sum(n).alias(n) for n in names])
    wanted = expected.select("slug").distinct().withColumn("_expected", F.lit(True))
    rows = known.join(wanted, "slug", "full_outer").withColumns({n: F.coalesce(F.col(n), F.lit(0).cast("bigint")) for n in names})
    rows = rows.withColumn("_silent", F.coalesce("_expected", F.lit(False)) & (F.col("scraped") == 0))
    return rows.rollup("slug").agg(*[F.sum(n).alias(n) for n in names], _n(F.col("_silent")).alias("silent"))


def skip_reasons(gated: DataFrame, op: str = "op_slug") -> DataFrame:
    """How often each stage and reason refused a row, per operator."""
    refused = gated.where(~F.col("pass")).select(op, "stage", F.explode("reasons").alias("reason"))
    return refused.groupBy(op, "stage", "reason").agg(F.count(F.lit(1)).alias("n"))


def tally(df: DataFrame, key: str) -> DataFrame:
    """Count per key, NULL keys ignored."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def category_mix(draws: DataFrame) -> DataFrame:
    """Live rows per category, most first."""
    live = draws.where(F.col("status") == "active")
    return tally(live, "category_slug").orderBy(F.desc("n"), "category_slug")


def unclassified_drafts(draws: DataFrame) -> DataFrame:
    return draws.where((F.col("status") == "draft") & F.col("category_slug").isNull()).agg(F.count(F.lit(1)).alias("n"))


def stalled_operators(draws: DataFrame, disabled: DataFrame, now: str, quiet_days: int = 5, min_live: int = 3) -> DataFrame:
    """Operators with live rows that added nothing lately and are not switched off."""
    rows = draws.groupBy("op_slug").agg(
        _n(F.col("status") == "active").alias("live"),
        _n(F.col("created_at") >= at(now) - days(quiet_days)).alias("_recent"),
    )
    dark = rows.where((F.col("live") >= min_live) & (F.col("_recent") == 0)).drop("_recent")
    out = dark.join(disabled.select(F.col("slug").alias("op_slug")), "op_slug", "left_anti")
    return out.withColumn("days_quiet", F.lit(quiet_days)).orderBy(F.desc("live"), "op_slug")


def _one_place(value: Column) -> Column:
    """One decimal place; exact quarters round up, everything else by its binary value."""
    quarter = value * 4 == F.floor(value * 4)
    return F.format_number(F.when(quarter, F.floor(value * 10 + 0.5) / 10).otherwise(value), 1)


def scoreboard(operators: DataFrame, draws: DataFrame, now: str, stale_days: int = 60) -> DataFrame:
    """Live, added in 30 days, newest row and rating of every operator; ``PRUNE?`` first.

    ``operators``: slug, name, rating.
    """
    clock = at(now)
    stats = draws.groupBy(F.col("op_slug").alias("slug")).agg(
        _n(F.col("status") == "active").alias("live"),
        _n(F.col("created_at") >= clock - days(30)).alias("added_30d"),
        F.max("created_at").alias("_newest"),
    )
    rows = operators.join(stats, "slug", "left")
    live, newest = F.coalesce("live", F.lit(0).cast("bigint")), F.col("_newest")
    stale = newest.isNull() | (newest < clock - days(stale_days))
    return rows.select(
        F.trim(F.coalesce(F.nullif("name", F.lit("")), "slug")).alias("name"),
        live.alias("live"),
        F.coalesce("added_30d", F.lit(0).cast("bigint")).alias("added_30d"),
        F.coalesce(F.date_format(newest, "yyyy-MM-dd"), F.lit("never")).alias("newest"),
        F.coalesce(_one_place(F.col("rating").cast("double")), F.lit("—")).alias("rating"),
        F.when((live == 0) & stale, F.lit("PRUNE?")).otherwise(F.lit("")).alias("flag"),
    ).orderBy(F.desc("flag"), F.desc("live"), "name")


@dataclass(frozen=True)
class TripwireConfig:
    """Limits of the daily audit.  A signal that is NULL never fires."""

    floor: int = 150
    target: int | None = 350
    min_fresh: int = 1
    category_floors: dict = field(default_factory=lambda: {"car-draws": 10})
    quota_bytes: int = 1 << 30
    warn_pct: float = 70
    red_pct: float = 90


def tripwire_signals(draws: DataFrame, now: str, cfg: TripwireConfig = TripwireConfig()) -> DataFrame:
    """One row: active, fresh and expired-draft counts, and live rows per watched category."""
    clock = at(now)
    active = F.col("status") == "active"
    watched = [part for name in cfg.category_floors for part in (F.lit(name), _n(active & (F.col("category_slug") == name)))]
    return draws.agg(
        _n(active).alias("active_count"),
        _n(F.col("created_at") >= clock - days(1)).alias("fresh_count"),
        _n((F.col("status") == "draft") & (instant("draw_date") < clock)).alias("expired_drafts"),
        (F.create_map(*watched) if watched else F.lit(None).cast("map<string,bigint>")).alias("by_category"),
    )


def tripwire(signals: DataFrame, cfg: TripwireConfig, outcome: Column | str = "success") -> DataFrame:
    """``tripped``, ``reasons`` (red) and ``warnings`` of a one-row signal frame.

    Reads active_count, fresh_count, expired_drafts, by_category and storage_bytes (any
    may be missing or NULL).  Stalled operators come as their own rows: see
    ``stall_warnings``.
    """
    def signal(name: str, kind: str = "bigint") -> Column:
        return c(name) if name in signals.columns else F.lit(None).cast(kind)

    outcome = F.lit(outcome) if isinstance(outcome, str) else outcome
    active, fresh, expired, stored = (signal(n) for n in ("active_count", "fresh_count", "expired_drafts", "storage_bytes"))
    by_category = signal("by_category", "map<string,bigint>")
    pct = stored * 100.0 / cfg.quota_bytes
    gb = lambda v: F.format_string("%.2f", v / float(1 << 30))
    use = F.concat(F.lit("storage at "), gb(stored), F.lit(" GB of "), gb(F.lit(float(cfg.quota_bytes))), F.lit(" GB ("), F.format_string("%.0f", pct), F.lit("%)"))
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    reasons = present(
        when_text(outcome != "success", text("scrape step outcome was '", outcome, "' (expected 'success')")),
        when_text(active < cfg.floor, text("live inventory ", active, f" is under the floor of {cfg.floor}")),
        when_text(fresh < cfg.min_fresh, text("only ", fresh, f" new draw(s) in the last 24h (expected at least {cfg.min_fresh}) — the scrape ran but produced nothing")),
        when_text(pct >= cfg.red_pct, text(use, f" — past the {cfg.red_pct:g}% red line")),
    )
    below = (active >= cfg.floor) & (active < (cfg.target or 0))
    thin = []
    for category, floor in cfg.category_floors.items():
        n = F.coalesce(F.try_element_at(by_category, F.lit(category)), F.lit(0))
        thin.append(when_text(by_category.isNotNull() & (n < floor), text("only ", n, f" live {category} (floor {floor})")))
    warnings = present(
        when_text(below, text("live inventory ", active, f" is below the target of {cfg.target}")),
        when_text(expired > 0, text(expired, " draft(s) passed their draw date unpublished — scraped, never shown")),
        *thin,
        when_text((pct >= cfg.warn_pct) & (pct < cfg.red_pct), text(use, f" — over the {cfg.warn_pct:g}% warn line")),
    )
    out = signals.withColumn("reasons", reasons).withColumn("warnings", warnings)
    return out.withColumn("tripped", F.size("reasons") > 0)


def stall_warnings(stalled: DataFrame) -> DataFrame:
    """One warning line per stalled operator."""
    line = F.concat("op_slug", F.lit(" has "), F.col("live").cast("string"), F.lit(" live draw(s) but has added nothing in "), F.col("days_quiet").cast("string"), F.lit("d — parser may have broken"))
    return stalled.select("op_slug", line.alias("warning"))


def onboard_verdict(gated: DataFrame, op: str = "op_slug") -> DataFrame:
    """READY, NEEDS-CONFIG or BLOCKED per operator, from gated rows with a category.

    Operators without any row are the caller's ``expected`` minus this result: BLOCKED.
    """
    rows = gated.groupBy(op).agg(
        F.count(F.lit(1)).alias("scraped"),
        _n(F.col("pass")).alias("passed"),
        _n(F.col("pass") & F.col("category").isNull()).alias("uncategorised"),
    )
    verdict = (
        F.when(F.col("passed") == 0, F.concat(F.lit("BLOCKED(all "), F.col("scraped").cast("string"), F.lit(" scraped draw(s) failed the gate)")))
        .when((F.col("passed") < F.col("scraped")) | (F.col("uncategorised") > 0), F.lit("NEEDS-CONFIG"))
        .otherwise(F.lit("READY"))
    )
    return rows.withColumn("verdict", verdict)


def post_freshness(posts: DataFrame, now: str, limit_hours: int = 36) -> DataFrame:
    """Hours since the last published post; stale when none or past the limit."""
    last = posts.where(F.col("status") == "published").agg(F.max("posted_at").alias("last_post"))
    hours = (F.unix_timestamp(at(now)) - F.unix_timestamp("last_post")) / 3600.0
    return last.withColumn("hours", round2(hours)).withColumn("stale", F.coalesce(hours > limit_hours, F.lit(True)))


def cleanup_ready(posts: DataFrame, day: str = "date") -> DataFrame:
    """Days whose posts have all finished, with at least one published."""
    status = F.col("status")
    return posts.groupBy(day).agg(
        F.count(F.lit(1)).alias("posts"),
        (F.bool_and(status.isin("published", "skipped")) & F.bool_or(status == "published")).alias("ready"),
    )
