"""Whole jobs composed of the operators.  Each returns lazy frames by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import with_category, with_category_evidence
from ..functions.dates import week_parity
from ..functions.text import in_sample, make_slug
from ..operators import dedupe as D
from ..operators import reconcile as R
from ..operators.gates import GateConfig, field_flags, gate
from ..sources import payloads
from ..sources.sinks import apply_patches, change_log
from . import content, discovery, reports, storage


def sweep(listings: DataFrame, stored: DataFrame, now: str, cfg: R.ReconcileConfig | None = None) -> dict[str, DataFrame]:
    """Dedupe, gate, reconcile; with skip reasons, hold reasons and inserts with slugs.

    ``listings`` has the listing columns, ``op_slug`` and a unique ``seq``.
    """
    cfg = cfg or R.ReconcileConfig(now=now)
    unique = D.dedupe(listings, dropped="copies")
    gated = gate(unique, GateConfig(now=now))
    evident = with_category_evidence(gated.where("pass").drop("pass", "stage", "reasons"))
    # an insert gets its description before the flags are read
    described = evident.withColumn("slug", make_slug("title", "op_slug"))
    described = described.withColumn("description", F.coalesce("description", content.template_description())).drop("slug")
    actions = R.reconcile(described, stored, cfg, "evidence")
    inserts = D.assign_slugs(actions.where("action = 'insert'"), stored.select("slug")) if "slug" in stored.columns else actions.where("action = 'insert'")
    return {
        "gated": gated,
        "skips": reports.skip_reasons(gated),
        "actions": actions,
        "inserts": inserts,
        "holds": R.hold_summary(actions.where("s_status = 'draft'")),
    }


def ended_sweep(stored: DataFrame, operators: DataFrame, feed: DataFrame, pages: DataFrame, statuses: tuple = ("draft",)) -> DataFrame:
    """Rows to mark as ended; a NULL verdict never ends a row."""
    scope = stored.where(F.col("status").isin(*statuses))
    return R.ended_decision(scope, operators, feed, pages).where(F.col("ended"))


def patrol(draws: DataFrame, today: str) -> dict[str, DataFrame]:
    """Weekly worklists: category drift and this week's half of the live catalogue."""
    active = draws.where(F.col("status") == "active")
    evident = with_category_evidence(active, url=None)
    day = F.lit(today).cast("date")
    return {
        "drift": R.category_drift(evident),
        "sample": active.where(in_sample("id", 0).cast("int") != week_parity(day).cast("int")),
    }


def backfill_categories(draws: DataFrame, pins: DataFrame | None = None) -> dict[str, DataFrame]:
    """Rule verdicts for stored rows, the rows to judge by hand, and the change log."""
    rows = draws if pins is None else draws.join(pins.select(F.col("slug").alias("op_slug"), F.col("category").alias("pin")), "op_slug", "left")
    verdicts = with_category(rows, pinned="pin" if pins is not None else None, out="verdict")
    fixed = R.with_rule_fix(verdicts)
    patches = fixed.where(F.col("fix").isin("fix", "stamp", "clear")).select(
        "id",
        F.when(F.col("fix") == "clear", F.lit(None).cast("string")).otherwise(F.col("verdict")).alias("category_slug"),
        F.when(F.col("fix") == "clear", F.lit(None).cast("string")).otherwise(F.lit("rule")).alias("category_source"),
        F.array(F.lit("category_slug"), F.lit("category_source")).alias("patch"),
    )
    after = apply_patches(draws, patches)
    return {
        "decisions": fixed,
        "export": fixed.where(F.col("fix") == "export"),
        "patched": after,
        "log": change_log(draws, after, ["category_slug"]),
    }


def audit(draws: DataFrame, operators: DataFrame, config: DataFrame, now: str, cfg: reports.TripwireConfig | None = None) -> dict[str, DataFrame]:
    """Coverage, scoreboard, category mix, stalled operators and the tripwire."""
    cfg = cfg or reports.TripwireConfig()
    disabled = config.where(~F.coalesce("enabled", F.lit(True))).select("slug")
    stalled = reports.stalled_operators(draws, disabled, now)
    rows = reports.coverage(operators, config, draws, now)
    return {
        "coverage": rows,
        "totals": reports.coverage_totals(rows, reports.config_orphans(operators, config)),
        "scoreboard": reports.scoreboard(operators, draws, now),
        "mix": reports.category_mix(draws),
        "stalled": stalled,
        "stall_warnings": reports.stall_warnings(stalled),
        "tripwire": reports.tripwire(reports.tripwire_signals(draws, now, cfg), cfg),
    }


def discover(sources: list[DataFrame], known: DataFrame, captures: DataFrame, homes: DataFrame) -> DataFrame:
    """Ranked queue of new operators whose captured feeds show live products.

    ``captures``: domain, woo_body, shop_body.  ``homes``: domain, html.
    """
    from ..sources.feeds import probe_feeds

    fresh = discovery.new_candidates(sources, known)
    probed = probe_feeds(fresh.join(captures, "domain"))
    return discovery.approval_queue(discovery.with_trust(probed, homes))


def onboard(listings: DataFrame, now: str) -> DataFrame:
    """One verdict per operator for listings read in a trial run."""
    return reports.onboard_verdict(gate(D.dedupe(with_category(listings)), GateConfig(now=now)))


def storage_plan(objects: DataFrame, tables: dict[str, DataFrame], prefix: str, now: str) -> dict[str, DataFrame]:
    """Orphans and byte totals; refuses when the reference scan looks thin."""
    plan = storage.guarded_plan(objects, tables, prefix, now)
    return {"plan": plan, "totals": storage.plan_totals(plan)}


def content_pick(draws: DataFrame, posts: DataFrame, now: str, slides: int = 5) -> DataFrame:
    """Picks and backups of the day, history aware."""
    today = str(now)[:10]
    used = content.recent_slugs(posts, today)
    last = content.last_category(posts, today).first()
    pool = content.ending_soon(draws, now, 7, 1)
    return content.pick_category(pool, slides, used=used, avoid=last["category"] if last else None)


def insights(posts: DataFrame, payload_frames: dict[str, DataFrame], today: str) -> DataFrame:
    """Captured payloads -> metrics -> daily report."""
    parts = [payloads.map_payload(frame, kind) for kind, frame in payload_frames.items()]
    metrics = parts[0]
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    metrics = metrics.withColumn("day", F.col("day").cast("date"))
    return content.daily_report(posts, metrics, today)


def flag_listings(listings: DataFrame) -> DataFrame:
    """Listings with their suspicions, for a look before the first insert."""
    evident = with_category_evidence(listings)
    return evident.withColumn("flags", field_flags(F.col("evidence")))
