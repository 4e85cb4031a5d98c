"""Dimension look-ups and prize text found by address.

No broadcast hints: Catalyst and AQE broadcast a dimension only after checking its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions import rules
from ..functions import text as X
from ..functions.base import blank_to_null, c, nz


class MissingCategories(RuntimeError):
    """The store lacks a category that the rules can assign."""


def require_categories(categories: DataFrame, needed: tuple = tuple(rules.CATEGORIES)) -> None:
    """Raise when a needed slug has no stored row; at most one row per slug is read."""
    present = {r["slug"] for r in categories.where(F.col("slug").isin(*needed)).select("slug").distinct().collect()}
    missing = [slug for slug in needed if slug not in present]
    if missing:
        raise MissingCategories(", ".join(missing))


def attach_ids(rows: DataFrame, operators: DataFrame, categories: DataFrame) -> DataFrame:
    """Add ``operator_id`` and ``category_id``; rows of an unknown operator are dropped."""
    require_categories(categories)
    ops = operators.select(F.col("slug").alias("op_slug"), F.col("id").alias("operator_id"))
    cats = categories.select(F.col("slug").alias("category"), F.col("id").alias("category_id"))
    return rows.join(ops, "op_slug").join(cats, "category", "left")


def address_key(url: str | Column) -> Column:
    """Address without scheme, ``www.``, query and trailing slash, in lower case."""
    cut = F.regexp_replace(F.regexp_replace(nz(url), r"^https?://", ""), r"^www\.", "")
    return F.lower(F.regexp_replace(F.regexp_replace(cut, r"[#?].*$", ""), r"/+$", ""))


def with_feed_text(draws: DataFrame, feed: DataFrame, out: str = "prize_copy") -> DataFrame:
    """Add the feed's prize copy: by address, else by the last path segment.

    ``feed``: op_slug, permalink, slug, prize_copy; unique per operator by address and by
    slug.  An empty text counts as not found.
    """
    keyed = draws.withColumn("_url", address_key("entry_url")).withColumn("_slug", F.substring_index("_url", "/", -1))
    by_url = feed.where(F.col("permalink").isNotNull()).select("op_slug", address_key("permalink").alias("_url"), F.col("prize_copy").alias("_a"))
    by_slug = feed.where(F.col("slug").isNotNull()).select("op_slug", F.lower("slug").alias("_slug"), F.col("prize_copy").alias("_b"))
    joined = keyed.join(by_url, ["op_slug", "_url"], "left").join(by_slug, ["op_slug", "_slug"], "left")
    return joined.select(*draws.columns, F.coalesce(blank_to_null("_a"), blank_to_null("_b")).alias(out))


def rederive_prizes(draws: DataFrame, feed: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """New prizes for stored rows whose prize names nothing: ``id old new source``.

    Reads id, op_slug, op_name, title, grand_prize, entry_url.  Only a generic prize is
    touched, and only when a concrete source says something else.  ``pages`` (entry_url,
    html) are read for rows without feed text.
    """
    from ..sources.pages import with_grand_prize, with_regions

    named = F.coalesce(blank_to_null("grand_prize"), F.col("title"))
    rows = with_feed_text(draws.where(X.is_generic_title(named, F.col("op_name"))), feed)
    rows = rows.withColumnRenamed("grand_prize", "_old")
    if pages is None:
        rows = rows.withColumn("html", F.lit(None).cast("string")).withColumn("prize_texts", F.array().cast("array<string>"))
    else:
        rows = rows.join(pages.select("entry_url", "html"), "entry_url", "left")
        rows = with_regions(rows.withColumn("html", F.when(F.col("prize_copy").isNull(), F.col("html"))))
    rows = with_grand_prize(rows.withColumn("_ld", E.json_ld_product("html")), c("prize_copy"), c("op_name"))
    better = (F.col("grand_prize_source") != "title") & ~F.col("grand_prize").eqNullSafe(F.col("_old"))
    return rows.where(better).select("id", F.col("_old").alias("old"), F.col("grand_prize").alias("new"), F.col("grand_prize_source").alias("source"))
