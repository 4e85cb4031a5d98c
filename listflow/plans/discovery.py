"""Candidate operators: sources, known ones removed, feeds probed, queue ranked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.base import c
from ..operators.ranking import first_per_key


def known_tokens(config: DataFrame, ledger: DataFrame | None = None, rejected: DataFrame | None = None) -> DataFrame:
    """Tokens of every operator that must not come up again (one ``token`` column)."""
    parts = [config.select(X.norm_domain(n).alias("token")) for n in ("slug", "base", "name") if n in config.columns]
    if ledger is not None:
        parts += [ledger.select(X.norm_domain(n).alias("token")) for n in ("name", "website_url")]
    if rejected is not None:
        parts.append(rejected.select(X.norm_domain("domain").alias("token")))
    return reduce(DataFrame.unionByName, parts).where("token <> ''").distinct()


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """Candidates of all sources by token; the earlier source wins, then the lesser domain."""
    ranked = [s.select("domain", "via", F.lit(i).alias("_source")) for i, s in enumerate(sources)]
    both = reduce(DataFrame.unionByName, ranked).withColumn("token", X.norm_domain("domain")).where("token <> ''")
    return first_per_key(both, ["token"], [F.col("_source"), F.col("domain"), F.col("via")]).drop("_source")


def new_candidates(sources: list[DataFrame], known: DataFrame) -> DataFrame:
    """Candidates whose token is not known."""
    return union_sources(sources).join(known, "token", "left_anti")


def approval_queue(probed: DataFrame) -> DataFrame:
    """Live candidates with slug and display name, most live first."""
    named = probed.withColumn("slug", X.slug_for("domain")).withColumn("name", X.title_for("slug"))
    return named.withColumn("base", F.concat(F.lit("https://"), "domain")).orderBy(F.desc("live"), "domain")


def with_trust(candidates: DataFrame, homes: DataFrame, reviews: DataFrame | None = None, registry: DataFrame | None = None, now=None) -> DataFrame:
    """Add evidence from captured pages; what was not captured stays NULL.

    ``homes``: domain, html.  ``reviews``: domain, html.  ``registry``: domain, body (the
    registration record).
    """
    out = candidates.join(homes.select("domain", X.trust_signals("html").alias("trust")), "domain", "left")
    if reviews is not None:
        out = out.join(reviews.select("domain", X.rating_value("html").alias("rating")), "domain", "left")
    if registry is not None:
        out = out.join(registry.select("domain", domain_age_days("body", now).alias("domain_age_days")), "domain", "left")
    return out


def domain_age_days(body: str | Column, now) -> Column:
    """Whole days since the earliest registration event of a registry record."""
    from ..functions.base import at, instant

    events = F.from_json(c(body), "struct<events:array<struct<eventAction:string,eventDate:string>>>")["events"]
    dates = F.transform(F.filter(events, lambda e: e["eventAction"] == "registration"), lambda e: instant(e["eventDate"]))
    return F.floor((F.unix_timestamp(at(now)) - F.unix_timestamp(F.array_min(dates))) / 86400)


def queue_lines(queue: DataFrame) -> DataFrame:
    """One summary line per candidate for the approval file."""
    shown = lambda col, none="none": F.coalesce(col.cast("string"), F.lit(none))
    line = F.concat_ws(
        " | ",
        F.col("slug"),
        F.concat(F.lit("found via "), F.col("via")),
        F.concat(F.col("method"), F.lit(": "), shown(F.col("live")), F.lit(" live / "), shown(F.col("total")), F.lit(" listed")),
        F.concat(F.lit("sample "), shown(F.col("sample"))),
    )
    return queue.select("slug", line.alias("line"))
