"""Storage plans: referenced paths, orphans, byte totals, image repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.base import at, c, days, instant, nz, with_once
from ..operators.ranking import discard, materialised, scratch_path

MIN_REF_RATIO = 0.5
MIN_AGE_DAYS = 7
MIN_REENCODE_BYTES = 250_000


class ThinReferenceScan(RuntimeError):
    """The reference scan found too little to be trusted; nothing may be deleted."""


def _references(tables: dict[str, DataFrame], prefix: str) -> DataFrame:
    """Bucket paths in any string column of any row, as often as they stand there."""
    parts = []
    for table in tables.values():
        texts = [f.name for f in table.schema if f.dataType.typeName() == "string"]
        if texts:
            paths = [F.struct(X.object_path_from_url(F.col(f"`{n}`"), prefix).alias("path")) for n in texts]
            parts.append(table.select(F.inline(F.array(*paths))))
    if not parts:
        raise ThinReferenceScan("no table has a text column")
    return reduce(DataFrame.unionByName, parts).where("path IS NOT NULL")


def referenced_paths(tables: dict[str, DataFrame], prefix: str) -> DataFrame:
    """Distinct bucket paths in any string column of any row.  Any read failure aborts."""
    found = _references(tables, prefix)
    # ends at the first path; without any, all objects would look unused
    if found.isEmpty():
        raise ThinReferenceScan("no table points into the bucket")
    return found.distinct()


def check_reference_ratio(referenced: DataFrame, objects: DataFrame, floor: float = MIN_REF_RATIO) -> float:
    """Share of referenced paths per object; raises below the floor."""
    n, total = referenced.count(), objects.count()
    ratio = n / total if total else 1.0
    if ratio < floor:
        raise ThinReferenceScan(f"only {ratio:.0%} of objects are referenced ({n}/{total}, floor {floor:.0%})")
    return ratio


def _plan(now: str, min_age_days: float) -> Column:
    created = F.coalesce(instant("created_at"), instant("updated_at"))
    young = F.coalesce(created > at(now) - days(min_age_days), F.lit(False))
    return F.when(F.col("_used"), F.lit("keep")).when(young, F.lit("young")).otherwise(F.lit("orphan"))


def orphan_plan(objects: DataFrame, referenced: DataFrame, now: str, min_age_days: float = MIN_AGE_DAYS) -> DataFrame:
    """Objects as ``keep``, ``orphan`` or ``young``; unreferenced is not the same as old."""
    used = referenced.select("path").distinct().withColumn("_used", F.lit(True))
    return objects.join(used, "path", "left").withColumn("plan", _plan(now, min_age_days)).drop("_used")


def guarded_plan(objects: DataFrame, tables: dict[str, DataFrame], prefix: str, now: str, floor: float = MIN_REF_RATIO, min_age_days: float = MIN_AGE_DAYS) -> DataFrame:
    """``orphan_plan`` over all references in the tables, each of which is read once; raises where the references look thin.

    Objects and referenced paths meet in one full join, which is written; both counts of the guard are read from that.
    """
    used = _references(tables, prefix).distinct().withColumn("_used", F.lit(True))
    path = scratch_path(objects.sparkSession, "orphan-plan")
    met = objects.withColumn("_object", F.lit(True)).join(used, "path", "full_outer")
    met = materialised(met.withColumn("plan", _plan(now, min_age_days)), path=path)
    n = met.agg(F.count("_used").alias("used"), F.count("_object").alias("objects")).first()
    if not n["used"] or n["objects"] and n["used"] / n["objects"] < floor:
        discard(objects.sparkSession, path)
        raise ThinReferenceScan(f"only {n['used']} paths are referenced, of {n['objects']} objects (floor {floor:.0%})")
    return met.where("_object").drop("_used", "_object")


def plan_totals(plan: DataFrame) -> DataFrame:
    """Objects and bytes per plan."""
    return plan.groupBy("plan").agg(F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def should_skip(min_bytes: int = MIN_REENCODE_BYTES) -> Column:
    """Objects a re-encoding pass leaves alone: no id, no size, already webp, or small."""
    small = F.col("size") < min_bytes
    return F.col("id").isNull() | F.col("size").isNull() | (F.lower(nz("mimetype")) == "image/webp") | small


def _broken(draws: DataFrame, dead_ref: str, statuses: list[str]) -> DataFrame:
    return draws.where(F.contains(nz("image_url"), F.lit(dead_ref)) & c("status").isin(*statuses) & c("entry_url").isNotNull())


def broken_images(draws: DataFrame, dead_ref: str, statuses: list[str], limit: int = 0) -> DataFrame:
    """Rows whose image points at a dead store, latest draw first."""
    ordered = _broken(draws, dead_ref, statuses).orderBy(F.desc("draw_date"), "id")
    return ordered.limit(limit) if limit else ordered


def image_key(url: str | Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(nz(url)), r"/+$", ""))


def resolve_images(rows: DataFrame, adapters: DataFrame, pages: DataFrame, products: DataFrame, archive: DataFrame) -> DataFrame:
    """First image found: feed index, own page, product record, archived page.

    ``adapters``: entry_url, image_url.  ``pages``: entry_url, html.  ``products``:
    entry_url origin + slug as ``product_key``, image_url.  ``archive``: entry_url, html.
    Each side must be unique by its key.
    """
    keyed = rows.withColumn("_k", image_key("entry_url"))
    keyed = keyed.withColumn("_pk", F.concat_ws("/", X.origin_of("entry_url"), X.product_slug("entry_url")))
    web = lambda u: F.when(u.rlike(r"(?i)^https?:"), u)
    sides = [
        (adapters.select(image_key("entry_url").alias("_k"), F.col("image_url").alias("_i0")), "_k"),
        (pages.select(image_key("entry_url").alias("_k"), X.image_from_html("html", "entry_url").alias("_i1")), "_k"),
        (products.select(F.col("product_key").alias("_pk"), web(F.col("image_url")).alias("_i2")), "_pk"),
        (archive.select(image_key("entry_url").alias("_k"), X.image_from_html("html", "entry_url").alias("_i3")), "_k"),
    ]
    for side, key in sides:
        keyed = keyed.join(side, key, "left")
    names = ["adapter", "page", "product", "archive"]
    found = [F.col(f"_i{i}") for i in range(4)]
    source = F.coalesce(*[F.when(f.isNotNull(), F.lit(n)) for f, n in zip(found, names)])
    return keyed.select(*rows.columns, F.coalesce(*found).alias("found_image"), source.alias("source"))


def image_repair_plan(draws: DataFrame, dead_ref: str, statuses: list[str], adapters: DataFrame, pages: DataFrame, products: DataFrame, archive: DataFrame) -> DataFrame:
    """A new image for every row whose image points at a dead store: (id, source, found_image), both NULL where none is known.

    Feed index, own page, product record, archived page, in this order; sides as in ``resolve_images``, but their keys may
    repeat.  All sides are one tagged union, met in one join and decided by one ``min_by``, so a source more is no join more.
    """
    web = lambda u: F.when(u.rlike(r"(?i)^https?:"), u)
    tagged = None
    for place, (source, side, kind, key, image) in enumerate(
        [
            ("adapter", adapters, "url", image_key("entry_url"), F.col("image_url")),
            ("page", pages, "url", image_key("entry_url"), X.image_from_html("html", "entry_url")),
            ("product", products, "slug", F.col("product_key"), web(F.col("image_url"))),
            ("archive", archive, "url", image_key("entry_url"), X.image_from_html("html", "entry_url")),
        ]
    ):
        part = with_once(side.select(key.alias("key"), *side.columns), {"image": image})
        part = part.select(F.lit(kind).alias("kind"), "key", F.lit(place).alias("place"), F.lit(source).alias("source"), "image")
        tagged = part if tagged is None else tagged.unionByName(part)
    broken = _broken(draws, dead_ref, statuses)  # the joins below keep no order
    slug = F.concat_ws("/", X.origin_of("entry_url"), X.product_slug("entry_url"))
    asked = broken.select("id", F.explode(F.map_from_arrays(F.array(F.lit("url"), F.lit("slug")), F.array(image_key("entry_url"), slug))).alias("kind", "key"))
    hits = asked.join(tagged.where(nz("image") != ""), ["kind", "key"])
    best = hits.groupBy("id").agg(F.min(F.struct("place", "image", "source")).alias("best"))
    return broken.select("id").join(best, "id", "left").select("id", F.col("best.source").alias("source"), F.col("best.image").alias("found_image"))
