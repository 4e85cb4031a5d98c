"""From captured bodies to stored rows: feeds, product pages and refresh maps of a run become inserts and patches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import as_of
from ..operators.lookups import attach_ids
from ..operators.ranking import discard, first_per_key, materialised, scratch_path
from ..operators.reconcile import ReconcileConfig
from ..sources import feeds as S
from ..sources.commits import Commits
from ..sources.pages import fields_from_pages
from ..sources.sinks import apply_patches, change_log
from .jobs import sweep

#: Pages of a feed and products of a page stay below these, so that a listing's number is exact as a double.
PAGES, PLACES = 100_000, 10_000
_OPERATOR = "slug string, name string, position long, base string, method string, apiStyle string, drawPath string, category string"
#: What an update may write, in the store's names.
PATCHED = ["title", "grand_prize", "ticket_price", "total_entries", "total_prize_value", "draw_date", "image_url", "status", "category_id", "category_source"]


def newest(captures: DataFrame, keys: list[str], now: str) -> DataFrame:
    """The last capture of every key that is not after ``now``; of several at one moment the one with the greatest body."""
    seen = captures.where(F.col("captured_at") <= F.lit(now).cast("timestamp"))
    return seen.groupBy(*keys).agg(F.max_by("body", F.struct("captured_at", "body")).alias("body"))


def _selected(operators: DataFrame, name: str):
    return F.col(name) if name in operators.columns else F.lit(None)


def with_pages(facts: DataFrame, pages: DataFrame, now: str) -> DataFrame:
    """Product facts with the ``html`` of the newest page capture (url, captured_at, html) not after ``now``, '' where there is none.

    Whole pages are shuffled once, and only those that some product meets.
    """
    asked = facts.withColumn("_now", F.lit(now).cast("timestamp"))
    captures = pages.select(F.col("url").alias("entry_url"), F.col("captured_at").cast("timestamp").alias("captured_at"), "html")
    met = as_of(asked, captures, ["entry_url"], "_now", "captured_at", "_captured")
    one = captures.join(met.where("_captured IS NOT NULL").select("entry_url", F.col("_captured").alias("captured_at")).distinct(), ["entry_url", "captured_at"], "left_semi")
    one = one.groupBy("entry_url").agg(F.max("html").alias("html"))
    return met.join(one, "entry_url", "left").withColumn("html", F.coalesce("html", F.lit(""))).drop("_now", "_captured")


def listings_from_captures(
    feeds: DataFrame, pages: DataFrame, zaps: DataFrame, operators: DataFrame, now: str, media_base: str = "", once: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
) -> DataFrame:
    """Uniform listings of a run, with ``op_slug`` and ``seq`` in the order of operators, feed pages and products.

    ``feeds``: op_slug, feed_page, captured_at, body.  ``pages``: url, captured_at, html.  ``zaps``: op_slug, captured_at, body.
    ``operators``: slug, name, position, base, method (woo, shopify, api), apiStyle, and where wanted drawPath, category, selectors,
    patterns.  The newest capture not after ``now`` counts.  Store and shop products take what their own page says, or their
    feed's copy where no page was captured; a refresh map fills caps and dates that are still missing.  ``once`` may write the
    frames it is given as tables and read them back, so that none is planned or computed twice.
    """
    names = [f.split(" ")[0] for f in _OPERATOR.split(", ")]
    config = operators.select(*[_selected(operators, n).cast(f.split(" ")[1]).alias(n) for n, f in zip(names, _OPERATOR.split(", "), strict=True)], *[n for n in ("selectors", "patterns") if n in operators.columns])
    config = config.withColumnsRenamed({"slug": "op_slug", "name": "op_name", "drawPath": "draw_path", "category": "pinned_category"})
    bodies = once(newest(feeds.withColumn("body", S.unwrap_pre("body")), ["op_slug", "feed_page"], now).join(config, "op_slug"), "bodies")
    of = lambda method, style=None: bodies.where((F.col("method") == method) & (F.lit(True) if style is None else F.col("apiStyle") == style)).drop("method", "apiStyle")

    facts = S.read_woo(of("woo"), place="place").unionByName(S.read_shopify(of("shopify"), place="place"))
    if "patterns" in facts.columns:
        facts = facts.withColumns({"entries_pattern": F.col("patterns")["entries"], "date_pattern": F.col("patterns")["date"]}).drop("patterns")
    met = once(with_pages(facts.withColumnRenamed("title", "known_title"), pages, now), "met")
    read = once(fields_from_pages(met, int(now[:4])).select(*S.LISTING, "product_id", "feed_page", "place"), "read")
    filled = S.fill_from_zap(read, S.read_zap(newest(zaps, ["op_slug"], now), now))
    columns = [*S.LISTING, "feed_page", "place"]
    stated = [S.read_raffle_engine(of("api", "raffle-engine"), place="place"), S.read_inertia(of("api", "inertia"), place="place"), S.read_hydra(of("api", "hydra"), now, media_base, place="place")]
    out = filled.select(*columns)
    for frame in stated:
        out = out.unionByName(frame.select(*columns))
    fits = (F.col("feed_page") < PAGES) & (F.col("place") < PLACES)
    number = (F.col("position") * PAGES + F.col("feed_page")) * PLACES + F.col("place")
    seq = F.when(fits, number).otherwise(F.raise_error(F.lit(f"more than {PAGES} feed pages or {PLACES} products on one")).cast("long"))
    return out.join(config.select("op_slug", "position"), "op_slug").withColumn("seq", seq).drop("feed_page", "place", "position")


def insert_rows(inserts: DataFrame, operators: DataFrame, categories: DataFrame) -> DataFrame:
    """Whole rows of the store for new listings; those of an unknown operator are dropped, missing categories abort."""
    named = attach_ids(inserts.drop("category_id", "operator_id"), operators, categories)
    nothing = F.lit(None)
    return named.select(
        F.md5("slug").alias("id"),
        "slug",
        "operator_id",
        "category_id",
        F.when(F.col("category_id").isNotNull(), F.lit("rule")).alias("category_source"),
        "title",
        "grand_prize",
        F.col("description").alias("prize_description"),
        "image_url",
        "ticket_price",
        "total_entries",
        "total_prize_value",
        nothing.cast("double").alias("prize_value"),
        "draw_date",
        "entry_url",
        nothing.cast("string").alias("affiliate_url"),
        "status",
        F.lit(False).alias("featured"),
    )


def update_rows(actions: DataFrame, operators: DataFrame, categories: DataFrame) -> DataFrame:
    """Patches of known rows: id, the new values, and the columns to write.  One for each stored row: of reads that share its URL the first."""
    changed = attach_ids(actions.where("action <> 'insert' AND size(patch) > 0").drop("category_id", "operator_id"), operators, categories)
    one = first_per_key(changed, ["s_id"], [F.col("seq")])
    return one.select(F.col("s_id").alias("id"), *[F.col(n) for n in PATCHED if n != "category_source"], F.lit("rule").alias("category_source"), "patch")


def sweep_listings(listings: DataFrame, stored: DataFrame, store_operators: DataFrame, categories: DataFrame, now: str, cfg: ReconcileConfig | None = None) -> dict[str, DataFrame]:
    """``sweep``'s frames for the listings of a run and, in the store's columns, new rows, patches, the store after the run, and the change log."""
    job = sweep(listings, stored, now, cfg)
    new, patches = insert_rows(job["inserts"], store_operators, categories), update_rows(job["actions"], store_operators, categories)
    patched = apply_patches(stored, patches)
    return job | {"new": new, "patches": patches, "patched": patched, "store": patched.unionByName(new, allowMissingColumns=True), "log": change_log(stored, patched, PATCHED)}


def run_and_commit(spark: SparkSession, path: str, run_id: str, captures: dict[str, DataFrame], operators: DataFrame, store_operators: DataFrame, categories: DataFrame, now: str, cfg: ReconcileConfig | None = None, media_base: str = "") -> int:
    """Sweep the captures (feeds, pages, zaps) against the newest store under ``path`` and commit store, log, skips and new rows together.

    The first store is committed by its owner under the table name ``draws``.  A run that is repeated returns its version and
    writes nothing.  What several tables need is written once, in a folder that goes with the end of the run.
    """
    commits = Commits(spark, path)
    if (known := commits.of_run(run_id)) is not None:
        return known
    version = commits.version()
    stored = commits.read("draws", version)
    scratch = scratch_path(spark, "sweep")
    once = lambda df, name: materialised(df, path=f"{scratch}/{name}")
    try:
        listings = once(listings_from_captures(captures["feeds"], captures["pages"], captures["zaps"], operators, now, media_base, once), "listings")
        own = replace(cfg or ReconcileConfig(now=now), scratch=scratch)
        out = sweep_listings(listings, stored, store_operators, categories, now, own)
        new = once(out["new"], "new")
        patched = once(out["patched"], "patched")
        tables = {"draws": patched.unionByName(new, allowMissingColumns=True), "log": change_log(stored, patched, PATCHED), "skips": out["skips"], "new": new}
        return commits.commit(run_id, tables, version)
    finally:
        discard(spark, scratch)
