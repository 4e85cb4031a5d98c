"""Two-observation agreement and the lifecycle of stored listings.

Stored columns arrive under the prefix ``s_``; fresh columns keep their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as X
from ..functions.base import at, c, days, instant, number_text, nz, present, round2, when_text, with_once
from ..functions.dates import uk_day_key
from .gates import field_flags
from .ranking import first_per_key, in_slice, row_hash, scratch_path, within_cap, written_in_slices

COMPARED = ["ticket_price", "total_entries", "draw_date", "title"]
POOL_LIMIT = 1_000_000_000


@dataclass(frozen=True)
class ReconcileConfig:
    now: str
    auto_publish: bool = True
    correct_live: bool = True
    # None: no cap
    publish_cap: int | None = 200
    correct_cap: int | None = 100
    insert_status: str = "draft"
    min_lead_hours: float = 2
    match_key: str = "exact"  # or "permalink"
    # write the compared rows once: the two caps and the result all read them
    materialise: bool = True
    # a folder for them that the caller deletes when the actions are read; else they stay in the shared folder
    scratch: str | None = None
    # so many slices of the URLs are compared one after the other; both sides are read once for each, but only one slice is shuffled at a time
    slices: int = 1
    # columns of the result that the caller does not read: they are neither written nor returned
    unread: tuple = ()
    judged_sources: tuple = tuple(rules.JUDGED_SOURCES)


def prize_pool(price: str | Column = "ticket_price", cap: str | Column = "total_entries") -> Column:
    """Ticket price times cap, rounded and limited."""
    product = F.coalesce(c(price), F.lit(0.0)) * F.coalesce(c(cap), F.lit(0))
    return F.least(round2(product), F.lit(float(POOL_LIMIT)))


def with_stored(fresh: DataFrame, stored: DataFrame, match_key: str = "exact", columns: list[str] | None = None, part: tuple[int, int] | None = None) -> DataFrame:
    """Fresh rows left-joined to the stored row of the same URL, stored columns as ``s_*``.

    A URL that is stored more than once is represented by the row with the greatest ``id``.
    NULL and blank URLs match nothing; each such read has a join key of its own.  ``part``: how many slices of the keys there
    are, and which of them is wanted.
    """
    sliced = (lambda df: df.where(in_slice("_key", *part))) if part else (lambda df: df)
    key = (lambda u: X.permalink_key(u)) if match_key == "permalink" else (lambda u: c(u))
    names = columns or stored.columns
    held = sliced(stored.withColumn("_key", F.nullif(key("entry_url"), F.lit(""))).where(F.col("_key").isNotNull()))
    plain = [f.name for f in stored.schema if f.dataType.typeName() != "map" and f.name != "id"]
    latest = [F.desc("id")] if "id" in stored.columns else []
    one = first_per_key(held, ["_key"], [*latest, F.struct(*[F.col(f"`{n}`") for n in plain])])
    right = one.select("_key", *[F.col(n).alias(f"s_{n}") for n in names])
    own = F.concat(F.lit("\u0001"), row_hash(fresh).cast("string"))
    return sliced(fresh.withColumn("_key", F.coalesce(F.nullif(key("entry_url"), F.lit("")), own))).join(right, "_key", "left").drop("_key")


def _moved() -> dict[str, Column]:
    """Which compared fields differ between the stored and the fresh read."""
    zero = F.lit(0.0)
    stored_day, fresh_day = F.col("_stored_day"), F.col("_fresh_day")
    return {
        "ticket_price": round2(F.coalesce("s_ticket_price", zero)) != round2(F.coalesce("ticket_price", zero)),
        "total_entries": F.coalesce("s_total_entries", F.lit(0)) != F.coalesce("total_entries", F.lit(0)),
        "draw_date": stored_day.isNotNull() & fresh_day.isNotNull() & (stored_day != fresh_day),
        "title": ~F.col("_titles_agree"),
    }


def with_agreement(
    df: DataFrame,
    now: str,
    evidence: str | None = None,
    image_ok: Column | None = None,
    min_lead_hours: float = 2,
) -> DataFrame:
    """Compare a fresh read with its stored row.

    Adds ``flags`` (suspicions of the fresh read), ``reasons`` (everything that holds the
    row), ``publish`` (no reasons), and ``drift_fields``.  ``image_ok`` is three-valued and
    only a plain true counts as confirmed.
    """
    df = df.withColumns(
        {
            "_stored_day": uk_day_key("s_draw_date"),
            "_fresh_day": uk_day_key("draw_date"),
            "_fresh_at": instant("draw_date"),
            "_titles_agree": X.titles_agree("s_title", "title"),
            "_own_description": c("description") if "description" in df.columns else F.lit(None).cast("string"),
        }
    )
    if "s_prize_description" in df.columns:
        df = df.withColumn("description", F.coalesce("_own_description", "s_prize_description"))
    stored_category = F.col("s_category_id").isNotNull() & (F.col("s_category_id") != "")
    flags = field_flags(c(evidence) if evidence else F.lit(None).cast("string"), stored_category)
    df = with_once(df, {"flags": flags})
    moved = _moved()
    ok = image_ok if image_ok is not None else F.lit(True)
    no_day = F.col("_stored_day").isNull() | F.col("_fresh_day").isNull()
    own = present(
        when_text(moved["ticket_price"], F.concat(F.lit("ticket_price "), _shown("s_ticket_price"), F.lit(" → "), _shown("ticket_price"))),
        when_text(
            moved["total_entries"],
            F.concat(F.lit("total_entries "), _shown("s_total_entries"), F.lit(" → "), _shown("total_entries"), F.lit(" (a cap does not move — likely a stock counter)")),
        ),
        when_text(no_day, "unparseable draw_date"),
        when_text(moved["draw_date"], F.concat(F.lit("draw_date "), F.col("_stored_day"), F.lit(" → "), F.col("_fresh_day"))),
        when_text(moved["title"], "title changed"),
        when_text(F.col("_fresh_at").isNull(), "bad fresh draw_date"),
        when_text(F.col("_fresh_at") < at(now) + days(min_lead_hours / 24), "closes too soon to publish"),
    )
    image = present(
        when_text(
            ~F.coalesce(ok, F.lit(False)),
            F.concat(F.lit("image not confirmed ("), F.when(ok.isNull(), F.lit("unverified")).otherwise(F.lit("unreachable")), F.lit(")")),
        )
    )
    drift = present(*[when_text(moved[n], n) for n in COMPARED])
    df = with_once(df, {"reasons": F.concat(own, F.col("flags"), image), "drift_fields": drift})
    df = df.withColumn("publish", F.size("reasons") == 0)
    if "s_prize_description" in df.columns:
        df = df.withColumn("description", F.col("_own_description"))
    return df.drop("_stored_day", "_fresh_day", "_fresh_at", "_titles_agree", "_own_description")


def _shown(name: str) -> Column:
    return F.coalesce(number_text(name), F.lit("null"))


def drift_map(fields: str = "drift_fields") -> Column:
    """Map of moved field -> (old, new) as text."""
    pair = "struct<old:string,new:string>"
    entries = [
        F.struct(
            F.lit(n).alias("key"),
            F.struct(F.col(f"s_{n}").cast("string").alias("old"), F.col(n).cast("string").alias("new")).cast(pair).alias("value"),
        )
        for n in COMPARED
    ]
    return F.map_filter(F.map_from_entries(F.array(*entries)), lambda k, _: F.array_contains(F.col(fields), k))


def with_correction(df: DataFrame) -> DataFrame:
    """After ``with_agreement``: should a live row be overwritten by this single read?

    Adds ``moved`` (drift, the stored pool included), ``correct`` and ``correct_reason``.
    """
    expected = round2(F.col("ticket_price") * F.col("total_entries"))
    stale = F.abs(round2("s_total_prize_value") - expected) > 0.02
    pool = F.when(F.coalesce(stale, F.lit(False)), F.array(F.lit("total_prize_value"))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("moved", F.concat("drift_fields", pool))
    none, flagged = F.size("moved") == 0, F.size("flags") > 0
    why = (
        F.when(none, F.lit("no drift"))
        .when(flagged, F.concat(F.lit("fresh read is flagged ("), F.array_join("flags", "; "), F.lit(")")))
        .otherwise(F.concat(F.lit("clean read disagrees on "), F.array_join("moved", ", ")))
    )
    return df.withColumn("correct", ~none & ~flagged).withColumn("correct_reason", why)


def relist_reason(now: str) -> Column:
    """Why an ended row stays ended; the one reviving answer is ``relisted for a later draw``."""
    stored, fresh, clock = instant("s_draw_date"), instant("draw_date"), at(now)
    return (
        F.when(~F.col("s_status").eqNullSafe(F.lit("ended")), F.lit("not an ended row"))
        .when(fresh.isNull(), F.lit("no fresh draw date"))
        .when(fresh <= clock, F.lit("fresh date is not in the future"))
        .when(stored.isNull(), F.lit("stored row has no date to compare"))
        .when(stored > clock, F.lit("stored draw has not run yet"))
        .when(fresh <= stored, F.lit("fresh date is not later than the one that ended"))
        .otherwise(F.lit("relisted for a later draw"))
    )


def with_relist(df: DataFrame, now: str) -> DataFrame:
    out = df.withColumn("relist_reason", relist_reason(now))
    return out.withColumn("revive", F.col("relist_reason") == "relisted for a later draw")


_READ = ["title", "grand_prize", "ticket_price", "total_entries", "total_prize_value", "draw_date"]


def reconcile(fresh: DataFrame, stored: DataFrame, cfg: ReconcileConfig, evidence: str | None = None, seq: str = "seq") -> DataFrame:
    """Decide what every gated fresh read does to the store.

    Adds ``action`` (insert, refresh, publish, correct, relist, skip), ``reason``, the new
    ``status`` and the array ``patch`` of columns the action may write.  A fresh read
    without a stored row is an insert.  ``image_ok`` is read when present.

    The publish and correction caps follow the processing order ``seq``.
    """
    image_ok = F.coalesce(c("image_ok"), F.lit(False)) if "image_ok" in fresh.columns else F.lit(True)
    found, status = F.col("_found"), F.col("s_status")

    def compared(part: tuple[int, int] | None = None) -> DataFrame:
        df = with_stored(fresh, stored, cfg.match_key, part=part)
        df = with_agreement(df, cfg.now, evidence, None, cfg.min_lead_hours)
        df = with_relist(with_correction(df), cfg.now)
        df = df.withColumn("total_prize_value", prize_pool()).withColumn("_found", F.col("s_id").isNotNull())
        df = df.withColumn("_publishable", found & (status == "draft") & F.col("publish") & image_ok & F.lit(cfg.auto_publish))
        df = df.withColumn("_correctable", found & (status == "active") & F.col("correct") & F.lit(cfg.correct_live))
        return df.drop(*cfg.unread)

    if cfg.materialise:
        path = f"{cfg.scratch}/compared" if cfg.scratch else scratch_path(fresh.sparkSession, "reconcile")
        df = written_in_slices(lambda k: compared((cfg.slices, k) if cfg.slices > 1 else None), cfg.slices, path)
    else:
        df = compared()
    df = within_cap(df, F.col("_publishable"), seq, cfg.publish_cap, "_publishes")
    df = within_cap(df, F.col("_correctable"), seq, cfg.correct_cap, "_corrects")

    # a resolved category may move a row only when no one has judged that row's category
    owned = ~F.coalesce(F.col("s_category_source").isin(*cfg.judged_sources), F.lit(False))
    category = F.when((nz("category") != "") & owned, F.array(F.lit("category_id"), F.lit("category_source")))
    category = F.coalesce(category, F.array().cast("array<string>"))
    read = F.array(*[F.lit(n) for n in _READ])
    image = F.array(F.lit("image_url"))
    only_pool = F.array_except("moved", F.array(F.lit("total_prize_value")))
    no_patch = F.array().cast("array<string>")

    action = (
        F.when(~found, F.lit("insert"))
        .when((status == "ended") & F.col("revive"), F.lit("relist"))
        .when((status == "active") & F.col("_corrects"), F.lit("correct"))
        .when((status == "draft") & F.col("_publishes"), F.lit("publish"))
        .when(status == "draft", F.lit("refresh"))
        .otherwise(F.lit("skip"))
    )
    df = with_once(df, {"action": action})
    held = F.array_join("reasons", "; ")
    reason = (
        F.when(F.col("action") == "insert", F.when(F.size("flags") > 0, F.array_join("flags", "; ")).otherwise(F.lit("new")))
        .when(status == "ended", F.col("relist_reason"))
        .when((status == "active") & ~F.lit(cfg.correct_live), F.lit("corrections are off"))
        .when((status == "active") & F.col("_correctable") & ~F.col("_corrects"), F.lit("correction cap reached"))
        .when(status == "active", F.col("correct_reason"))
        .when(F.col("action") == "publish", F.lit("verified"))
        .when(~F.col("publish"), held)
        .when(~image_ok, F.lit("image not confirmed"))
        .when(~F.lit(cfg.auto_publish), F.lit("auto-publish off"))
        .when(F.col("_publishable"), F.lit("run publish cap reached"))
        .otherwise(F.concat(F.lit("status "), status))
    )
    patch = (
        F.when(F.col("action") == "relist", F.concat(read, image, F.array(F.lit("status")), category))
        .when(F.col("action") == "publish", F.concat(read, image, F.array(F.lit("status")), category))
        .when(F.col("action") == "refresh", F.concat(read, image, category))
        .when((F.col("action") == "correct") & (F.size(only_pool) == 0), F.array(F.lit("total_prize_value")))
        .when(F.col("action") == "correct", F.concat(read, category))
        .otherwise(no_patch)
    )
    new_status = (
        F.when(F.col("action") == "insert", F.when(F.size("flags") > 0, F.lit("draft")).otherwise(F.lit(cfg.insert_status)))
        .when(F.col("action") == "publish", F.lit("active"))
        .when(F.col("action") == "relist", F.lit("draft"))
        .otherwise(status)
    )
    out = df.withColumn("reason", reason).withColumn("patch", patch).withColumn("status", new_status)
    return out.drop("_found", "_publishable", "_correctable", "_publishes", "_corrects")


def hold_summary(verdicts: DataFrame) -> DataFrame:
    """How often each kind of reason held a row, most frequent first.

    Only numeric old values collapse: ``ticket_price 0.25 → 0.5`` counts as ``ticket_price``.
    """
    held = verdicts.where(~F.col("publish")).select(F.explode("reasons").alias("r"))
    kind = F.regexp_replace(F.regexp_replace("r", r"\s+[\d.]+\s*→.*$", ""), r"\s*\(.*\)$", "")
    return held.select(F.trim(kind).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def verdict_totals(verdicts: DataFrame) -> DataFrame:
    """Published and held rows for every kind of reason and, under a NULL reason, in all: (reason, published, held), one aggregate."""
    kind = F.regexp_replace(F.regexp_replace("r", r"\s+[\d.]+\s*→.*$", ""), r"\s*\(.*\)$", "")
    # a row without reasons counts in the total alone
    rows = verdicts.select("publish", F.posexplode_outer("reasons").alias("at", "r")).select("publish", F.coalesce("at", F.lit(0)).alias("at"), F.trim(kind).alias("reason"))
    whole = F.grouping("reason") == 1
    count = lambda hit: F.sum(F.when(hit, F.col("n")).otherwise(0))
    # rows of one reason, first mention of a row or not, are counted before the grouping sets double them
    rows = rows.groupBy("publish", "reason", (F.col("at") == 0).cast("int").alias("first")).agg(F.count(F.lit(1)).alias("n"))
    sets = rows.groupingSets([["reason"], []], "reason")
    every, first = (lambda hit: count(hit)), (lambda hit: count(hit & (F.col("first") == 1)))
    pick = lambda hit: F.when(whole, first(hit)).otherwise(every(hit))
    out = sets.agg(whole.alias("whole"), pick(F.col("publish")).alias("published"), pick(~F.col("publish")).alias("held"))
    return out.where(F.col("whole") | F.col("reason").isNotNull()).select("reason", "published", "held")


# ---- ended listings ------------------------------------------------------


def ended_decision(stored: DataFrame, operators: DataFrame, feed: DataFrame, pages: DataFrame) -> DataFrame:
    """Three-valued ``ended`` and ``why`` for stored rows; absence of evidence is NULL.

    ``operators``: slug, method.  ``feed``: op_slug, slug, permalink, is_purchasable,
    available, stock_text.  ``pages``: entry_url, finished.  Feed rows must be unique by
    (op_slug, slug) and (op_slug, permalink).
    """
    # a row without an address has a key of its own, which matches nothing
    own = F.concat(F.lit("\u0001"), row_hash(stored).cast("string"))
    rows = stored.withColumn("_slug", X.product_slug("entry_url")).withColumn("_permalink", F.coalesce(F.nullif(X.permalink_key("entry_url"), F.lit("")), own))
    # percent-literal slugs cannot be looked up by slug, only by permalink
    rows = rows.withColumn("_by_slug", F.when(X.is_percent_literal_slug("_slug"), F.concat(F.lit("\u0001"), "_permalink")).otherwise(F.lower("_slug")))
    rows = rows.join(operators.select(F.col("slug").alias("op_slug"), "method"), "op_slug", "left")
    product = F.struct(F.lit(True).alias("found"), "is_purchasable", "available", "stock_text")
    by_slug = feed.select("op_slug", F.lower("slug").alias("_by_slug"), product.alias("_a"))
    by_link = feed.select("op_slug", X.permalink_key("permalink").alias("_permalink"), product.alias("_b"))
    feeds = feed.select("op_slug").distinct().withColumn("_has_feed", F.lit(True))
    rows = rows.join(by_slug, ["op_slug", "_by_slug"], "left").join(by_link, ["op_slug", "_permalink"], "left")
    rows = rows.join(feeds, "op_slug", "left").join(pages.select("entry_url", "finished"), "entry_url", "left")
    p = F.coalesce("_a", "_b")
    woo, shop, text = F.col("method") == "woo", F.col("method") == "shopify", F.col("finished")
    live = X.is_purchasable(p["is_purchasable"])
    rows = rows.withColumn("_p", p).withColumn("_live", live)
    found, available = F.col("_p").isNotNull(), F.coalesce(F.col("_p.available"), F.lit(False))
    ended = (
        F.when(woo, F.when(found, ~F.col("_live")))
        .when(shop, F.when(F.col("_a").isNotNull(), ~F.coalesce(F.col("_a.available"), F.lit(False))))
        .when(F.col("method").isNotNull(), text)
    )
    why = (
        F.when(F.col("method").isNull(), F.lit("operator not in config"))
        .when(woo & ~found, F.lit("product not found in API or feed"))
        .when(woo & ~F.col("_live"), F.concat(F.lit("not purchasable (stock: "), F.coalesce(F.nullif(F.col("_p.stock_text"), F.lit("")), F.lit("?")), F.lit(")")))
        .when(woo, F.lit("purchasable"))
        .when(shop & F.col("_has_feed").isNull(), F.lit("feed unavailable"))
        .when(shop & F.col("_a").isNull(), F.lit("not in product feed (unverified)"))
        .when(shop & F.coalesce(F.col("_a.available"), F.lit(False)), F.lit("available"))
        .when(shop, F.lit("sold out / no available variant"))
        .when(text.isNull(), F.lit("page unavailable"))
        .when(text, F.lit("page says finished"))
        .otherwise(F.lit("no finished marker"))
    )
    return rows.select(*stored.columns, ended.alias("ended"), why.alias("why"))


# ---- category repair -----------------------------------------------------


def with_rule_fix(df: DataFrame, verdict: str = "verdict", judged: tuple = tuple(rules.JUDGED_SOURCES)) -> DataFrame:
    """Add ``fix``: skip, stamp, fix, export or clear.

    Reads ``category_source``, ``category_slug``, ``status`` and the rules' verdict.
    """
    v, stored = c(verdict), F.col("category_slug")
    fix = (
        F.when(F.col("category_source").isin(*judged), F.lit("skip"))
        .when(v.isNotNull() & v.eqNullSafe(stored), F.lit("stamp"))
        .when(v.isNotNull(), F.lit("fix"))
        .when(F.col("status") == "active", F.lit("export"))
        .when((F.col("status") == "draft") & F.col("category_source").isNull() & stored.isNotNull(), F.lit("clear"))
        .otherwise(F.lit("skip"))
    )
    return df.withColumn("fix", fix)


def category_drift(df: DataFrame, evidence: str = "evidence") -> DataFrame:
    """Active rows, not judged, whose evidence names another category."""
    open_source = F.col("category_source").isNull() | (F.col("category_source") == "rule")
    differs = c(evidence).isNotNull() & ~c(evidence).eqNullSafe(F.col("category_slug"))
    return df.where((F.col("status") == "active") & open_source & differs)


def category_repair(df: DataFrame, evidence: str = "evidence") -> DataFrame:
    """Rows to propose a specific category for; cash is never proposed."""
    e = c(evidence)
    return df.where(e.isNotNull() & (e != "cash-prizes") & ~e.eqNullSafe(F.col("category_slug")))


def prize_review(df: DataFrame) -> DataFrame:
    """Drafts whose prize is just the title, names no amount or cash, or is a boast."""
    prize = nz("grand_prize")
    name_only = F.trim(prize) == F.trim(nz("title"))
    no_value = ~prize.rlike(r"(?i)£\d|\bcash\b")
    boast = prize.rlike(f"(?i){rules.PRIZE_REVIEW_BOAST}")
    return df.where((F.col("status") == "draft") & (name_only | no_value | boast))


def apply_decisions(decisions: DataFrame, rows: DataFrame, categories: tuple = tuple(rules.CATEGORIES)) -> DataFrame:
    """Judged categories checked against the current rows; ``outcome`` says what happens."""
    current = rows.select("id", F.col("status").alias("_status"), F.col("category_source").alias("_source"), F.col("category_slug").alias("from_category"))
    joined = decisions.join(current, "id", "left")
    outcome = (
        F.when(~F.coalesce(F.col("category").isin(*categories), F.lit(False)), F.lit("invalid"))
        .when(F.col("_status").isNull(), F.lit("stale: not found"))
        .when(F.col("_source").isin(*rules.JUDGED_SOURCES), F.lit("stale: already judged"))
        .when(F.col("_status") == "ended", F.lit("stale: ended"))
        .otherwise(F.lit("applied"))
    )
    return joined.withColumn("outcome", outcome).drop("_status", "_source")


def confidence_patches(results: DataFrame, categories: tuple = tuple(rules.CATEGORIES)) -> DataFrame:
    """Patches from reviewed images: low confidence may only end a row, and is listed.

    Reads id, is_live, confidence, grand_prize, category, cur_prize, cur_category.
    """
    sure = F.coalesce(F.col("confidence"), F.lit("low")) != "low"
    prize = F.when(sure & (F.trim(nz("grand_prize")) != "") & ~F.col("grand_prize").eqNullSafe(F.col("cur_prize")), F.trim("grand_prize"))
    known = F.col("category").isin(*categories) & ~F.col("category").eqNullSafe(F.col("cur_category"))
    return results.select(
        "id",
        F.when(~F.col("is_live"), F.lit("ended")).alias("new_status"),
        prize.alias("new_prize"),
        F.when(sure & known, F.col("category")).alias("new_category"),
        (~sure).alias("review"),
    )
