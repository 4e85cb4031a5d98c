"""Captured metric payloads, search results, sitemaps and seed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as X
from ..functions.base import c, instant, nz, rx
from ..functions.dates import london_day

_MEDIA = "struct<data:array<struct<id:string,timestamp:string,like_count:double,comments_count:double>>>"
_REACH = "struct<data:array<struct<name:string,values:array<struct<end_time:string,value:double>>>>>"
_POSTS = (
    "struct<data:array<struct<id:string,created_time:string,reactions:struct<summary:struct<total_count:double>>,"
    "comments:struct<summary:struct<total_count:double>>,shares:struct<count:double>>>>"
)
KINDS = ("ig_media", "ig_reach", "fb_posts")


def _metric(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("metric"), F.coalesce(value, F.lit(0.0)).alias("value"))


def map_payload(raw: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """Payload -> (day, media_id, metric, value); missing numbers count as 0."""
    if kind == "ig_media":
        rows = raw.select(F.explode(F.from_json(c(body), _MEDIA)["data"]).alias("m"))
        pairs = F.array(_metric("likes", F.col("m.like_count")), _metric("comments", F.col("m.comments_count")))
        return rows.select(london_day(instant("m.timestamp")).alias("day"), F.col("m.id").alias("media_id"), F.inline(pairs))
    if kind == "ig_reach":
        rows = raw.select(F.explode(F.from_json(c(body), _REACH)["data"]).alias("e"))
        rows = rows.select(F.col("e.name").alias("name"), F.explode("e.values").alias("v"))
        return rows.select(
            london_day(instant("v.end_time")).alias("day"),
            F.lit("account").alias("media_id"),
            F.coalesce(F.nullif("name", F.lit("")), F.lit("reach")).alias("metric"),
            F.coalesce("v.value", F.lit(0.0)).alias("value"),
        )
    if kind == "fb_posts":
        rows = raw.select(F.explode(F.from_json(c(body), _POSTS)["data"]).alias("p"))
        pairs = F.array(
            _metric("fb_reactions", F.col("p.reactions.summary.total_count")),
            _metric("fb_comments", F.col("p.comments.summary.total_count")),
            _metric("fb_shares", F.col("p.shares.count")),
        )
        return rows.select(london_day(instant("p.created_time")).alias("day"), F.col("p.id").alias("media_id"), F.inline(pairs))
    raise ValueError(f"unknown kind {kind!r} (expected one of {', '.join(KINDS)})")


def serp_candidates(raw: DataFrame, body: str = "body") -> DataFrame:
    """Hosts of captured search results."""
    schema = "struct<organic_results:array<struct<link:string>>>"
    links = raw.select(F.explode(F.from_json(c(body), schema)["organic_results"]).alias("r"))
    return links.select(X.host_of("r.link").alias("domain"), F.lit("serpapi").alias("via")).where("domain IS NOT NULL")


def seed_candidates(lines: DataFrame, line: str = "value") -> DataFrame:
    """Domains of a text seed list (``spark.read.text``)."""
    return lines.select(X.seed_domain(line).alias("domain"), F.lit("seed").alias("via")).where("domain IS NOT NULL AND domain <> ''")


def sitemap_children(maps: DataFrame, xml: str = "xml", limit: int | None = None) -> DataFrame:
    """All (or the first ``limit``) child sitemaps of every sitemap index."""
    kids = F.filter(X.sitemap_locs(xml), lambda u: u.endswith(".xml"))
    kids = kids if limit is None else F.slice(kids, 1, limit)
    return maps.select(*[n for n in maps.columns if n != xml], F.explode(kids).alias("child"))


def sitemap_pages(maps: DataFrame, xml: str = "xml", limit: int | None = None) -> DataFrame:
    """Distinct page addresses of every sitemap whose path looks like an operator page, all or the first ``limit``."""
    path = lambda u: F.regexp_extract(u, r"^https?://[^/?#]+([^?#]*)", 1)
    pages = F.filter(X.sitemap_locs(xml), lambda u: ~u.endswith(".xml") & path(u).rlike(rx(rules.SITEMAP_PAGE)))
    first = F.array_distinct(pages) if limit is None else F.slice(F.array_distinct(pages), 1, limit)
    return maps.select(*[n for n in maps.columns if n != xml], F.posexplode(first).alias("position", "page"))


def crosslink_candidates(pages: DataFrame, exclude: DataFrame, html: str = "html", label: str = "op_slug", prefix: str = "crosslink") -> DataFrame:
    """Operator-like outside hosts of captured pages that are not configured already."""
    found = pages.select(label, F.explode(X.operator_hosts(html)).alias("domain")).distinct()
    return found.join(exclude, "domain", "left_anti").select("domain", F.concat(F.lit(f"{prefix}:"), c(label)).alias("via"))


def crawled_sitemaps(captures: DataFrame, roots: DataFrame) -> DataFrame:
    """Every sitemap reached from ``roots`` (source, url) through sitemap indexes: (source, url, depth, captured).

    ``captures``: url, xml.  Children are met with their captures round by round until no new one comes; a map that was seen from
    its source before is not followed again, so indexes that name each other end.  A child that was never captured is kept
    with ``captured`` false.  A row is written once, in the round that finds it.
    """
    from ..operators.ranking import discard, materialised, scratch_path

    spark = captures.sparkSession
    path = scratch_path(spark, "sitemaps")
    kids = captures.select(F.col("url").alias("parent"), F.explode(F.array_distinct(F.filter(X.sitemap_locs("xml"), lambda u: u.endswith(".xml")))).alias("url"))
    kids = materialised(kids, path=f"{path}/kids")
    known = captures.select("url").distinct().withColumn("captured", F.lit(True))
    level = materialised(roots.select("source", "url").where("url IS NOT NULL").distinct(), path=f"{path}/level-0")
    seen, depth = level.withColumn("depth", F.lit(0)), 0
    while True:
        reached = level.select("source", F.col("url").alias("parent")).join(kids, "parent").select("source", "url").distinct()
        level = materialised(reached.join(seen, ["source", "url"], "left_anti"), path=f"{path}/level-{depth + 1}")
        if level.isEmpty():
            break
        depth += 1
        seen = seen.unionByName(level.withColumn("depth", F.lit(depth)))
    out = materialised(seen.join(known, "url", "left").select("source", "url", "depth", F.coalesce("captured", F.lit(False)).alias("captured")), "crawled")
    discard(spark, path)
    return out


def crawled_pages(captures: DataFrame, roots: DataFrame, limit: int | None = None) -> DataFrame:
    """Listing pages of all sitemaps that the roots reach: (source, page), each page once for a source."""
    maps = crawled_sitemaps(captures, roots).where("captured").join(captures, "url")
    return sitemap_pages(maps.select("source", "xml"), limit=limit).select("source", "page").distinct()
