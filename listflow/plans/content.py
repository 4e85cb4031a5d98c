"""Content selection and post metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as X
from ..functions.base import at, by_first_letter, c, days, instant, let, matches, nz, rx, thousands
from ..operators.ranking import first_per_key, top_n


def ending_soon(draws: DataFrame, now: str, within_days: int = 7, min_days: int = 0, limit: int = 300) -> DataFrame:
    """Active rows with an image that close inside the range, soonest first (a top-k)."""
    closes, clock = instant("draw_date"), at(now)
    wanted = draws.where(
        (F.col("status") == "active")
        & F.col("image_url").isNotNull()
        & closes.between(clock + days(min_days), clock + days(within_days))
    )
    return wanted.orderBy(instant("draw_date"), "slug").limit(limit)


def _per_category(index: int, fallback: float) -> Column:
    out = F.lit(float(fallback))
    for slug, values in reversed(list(rules.CONTENT_CATEGORIES.items())):
        out = F.when(F.col("category_slug") == slug, F.lit(float(values[index]))).otherwise(out)
    return out


def category_scores(draws: DataFrame, slides: int = 5, avoid: str | None = None) -> DataFrame:
    """Score of every category: enough rows first, then weight by rows, then value."""
    named = draws.withColumn("category_slug", F.coalesce("category_slug", F.lit("other")))
    cents = F.floor(F.coalesce("total_prize_value", F.lit(0.0)) * 100 + 0.5).cast("bigint")
    rows = named.groupBy("category_slug").agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("_cents"))
    shown = F.least("n", F.lit(slides))
    enough = F.when(F.col("n") >= min(3, slides), 1e12).otherwise(0.0)
    score = enough + _per_category(0, rules.CONTENT_FALLBACK_WEIGHT) * shown * 1e9 + F.col("_cents") / 100
    if avoid:
        score = F.when(F.col("category_slug") == avoid, score * 0.5).otherwise(score)
    return rows.withColumn("score", score).withColumn("value", F.col("_cents") / 100).drop("_cents")


def pick_category(
    draws: DataFrame,
    slides: int = 5,
    backups: int = 3,
    used: DataFrame | None = None,
    avoid: str | None = None,
    only: str | None = None,
    order: list[str] = ["draw_date", "slug"],
) -> DataFrame:
    """Picks (role ``pick``) and backups of the best category, in closing order.

    ``used`` holds the slugs shown lately; they are left out.
    """
    pool = draws.withColumn("category_slug", F.coalesce("category_slug", F.lit("other")))
    if used is not None:
        pool = pool.join(used.select("slug").distinct(), "slug", "left_anti")
    if only:
        pool = pool.where(F.col("category_slug") == only)
    best = category_scores(pool, slides, avoid).orderBy(F.desc("score"), "category_slug").limit(1)
    mine = pool.join(best.select("category_slug"), "category_slug", "left_semi")
    ranked = top_n(mine, ["category_slug"], [F.col(n) for n in order], slides + backups, "rank")
    return ranked.withColumn("role", F.when(F.col("rank") <= slides, F.lit("pick")).otherwise(F.lit("backup")))


def claimable_value() -> Column:
    """Ticket revenue, never above a stated cash alternative."""
    revenue = F.coalesce(F.col("total_prize_value"), F.lit(0.0))
    cash = X.cash_alternative_value("grand_prize", "prize_description")
    return F.when(cash > 0, F.least(revenue, cash)).otherwise(revenue)


def value_line(draws: DataFrame) -> DataFrame:
    """The "£N+" line per category, blank below the category's bar or £1,000."""
    cents = F.floor(claimable_value() * 100 + 0.5).cast("bigint")
    rows = draws.groupBy("category_slug").agg((F.sum(cents) / 100).alias("total"))
    bar = _per_category(1, float("inf"))
    line = F.concat(F.lit("£"), thousands((F.floor(F.col("total") / 1000) * 1000).cast("bigint")), F.lit("+"))
    hidden = (F.col("total") < bar) | (F.col("total") < 1000)
    return rows.withColumn("line", F.when(hidden, F.lit("")).otherwise(line))


def archetype(day: str | Column) -> Column:
    """Text style of the day, rotating over the list."""
    styles = F.array(*[F.lit(s) for s in rules.ARCHETYPES])
    return F.get(styles, (F.dayofyear(c(day)) - 1) % len(rules.ARCHETYPES))


def soonest(draws: DataFrame, group: list[str], *seq: str) -> DataFrame:
    """The row of every group that closes first; the earliest one on a tie.

    Rows without a date are chosen only where a group has no date at all.
    """
    closes = instant("draw_date")
    return first_per_key(draws, group, [closes.isNull(), closes, *[F.col(n) for n in seq or ("seq",)]])


def newest_drafts(draws: DataFrame, limit: int | None = 200) -> DataFrame:
    """Drafts waiting for a look, newest first (a top-k; all without a limit); by id on a tie."""
    drafts = draws.where(F.col("status") == "draft").orderBy(F.desc("created_at"), "id")
    return drafts if limit is None else drafts.limit(limit)


def recent_slugs(posts: DataFrame, today: str, within_days: int = 7) -> DataFrame:
    """Distinct slugs shown in the last days, one row each."""
    recent = posts.where(F.col("date") >= F.date_sub(F.lit(today).cast("date"), within_days))
    return recent.select(F.explode("draw_slugs").alias("slug")).distinct()


def last_category(posts: DataFrame, today: str, within_days: int = 3) -> DataFrame:
    """Category of the latest post that has one; on a tie of day and format the last by name."""
    recent = posts.where((F.col("date") >= F.date_sub(F.lit(today).cast("date"), within_days)) & F.col("category").isNotNull())
    return recent.agg(F.max(F.struct("date", "format", "category"))["category"].alias("category"))


def rank_images(candidates: DataFrame, page: str = "page", limit: int = 6) -> DataFrame:
    """Best image addresses of every page.

    Reads page, title, url, width, height, hint and ``seq``.  Theme graphics go, share
    images lose, zoom links gain, and a file named after the prize wins.
    """
    looks_like_image = matches("url", rules.IMAGE_FILE) | matches("url", rules.IMAGE_HOST)
    rows = candidates.where((nz("url") != "") & ~matches("url", by_first_letter(rules.IMAGE_JUNK)) & looks_like_image)
    rows = rows.withColumn("_up", X.upgrade_image_url("url"))
    stop = F.array(*[F.lit(w) for w in rules.IMAGE_STOP_WORDS])
    words = F.split(F.regexp_replace(F.lower(nz("title")), r"[^a-z0-9 ]+", " "), r"\s+")
    words = F.filter(F.array_except(words, stop), lambda w: F.length(w) >= 3)
    path = F.lower(F.regexp_extract("_up", r"(?i)^https?://[^/?#]+([^?#]*)", 1))
    path = let(path, lambda p: F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p))
    rows = rows.withColumns({"_words": words, "_path": path, "_key": X.image_base_key("_up")})
    area = F.coalesce("width", F.lit(0)) * F.coalesce("height", F.lit(0))
    share = matches("hint", rules.IMAGE_SHARE_HINT) | matches("url", rules.IMAGE_SHARE_URL)
    # bound, as a lambda evaluates the path for every word
    named = let(F.col("_path"), lambda p: F.exists("_words", lambda w: F.contains(p, w)))
    score = (
        F.when(area > 0, area).otherwise(F.lit(450000))
        - F.when(share, 250000).otherwise(0)
        + F.when(F.col("hint").isin(*rules.IMAGE_ZOOM_HINTS), 300000).otherwise(0)
        + F.when(named, 5_000_000).otherwise(0)
    )
    rows = rows.withColumn("score", score.cast("bigint")).select(page, "seq", "hint", "score", "_key", F.col("_up").alias("url"))
    best = first_per_key(rows, [page, "_key"], [-F.col("score"), F.col("seq")]).drop("_key")
    return top_n(best, [page], [F.desc("score"), F.col("seq")], limit, "rank")


def daily_report(posts: DataFrame, metrics: DataFrame, today: str, within_days: int = 7) -> DataFrame:
    """Per day and post: format, category, account reach, likes and comments.

    Days with only posts or only metrics are kept.
    """
    since = F.date_sub(F.lit(today).cast("date"), within_days)
    p = posts.where(F.col("date") >= since).select(F.col("date").alias("day"), "format", "category", "ig_media_id")
    m = metrics.where(F.col("day") >= since)
    pick = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    reach = m.where((F.col("media_id") == "account") & (F.col("metric") == "reach")).groupBy("day").agg(F.max("value").alias("reach"))
    per_post = m.where(F.col("metric").isin("likes", "comments")).groupBy("day", F.col("media_id").alias("ig_media_id")).agg(pick("likes").alias("likes"), pick("comments").alias("comments"))
    all_days = m.select("day").distinct()
    rows = p.join(all_days, "day", "full_outer").join(per_post, ["day", "ig_media_id"], "left").join(reach, "day", "left")
    return rows.select("day", "format", "category", "ig_media_id", "reach", "likes", "comments")


def template_description() -> Column:
    """A stable per-listing blurb; the frame is picked by a hash of the slug or title."""
    from ..functions.base import let
    from ..functions.dates import long_uk_date

    prize = F.trim(F.coalesce(F.nullif("grand_prize", F.lit("")), F.nullif("title", F.lit("")), F.lit("this prize")))
    price, when = X.money_text("ticket_price"), long_uk_date("draw_date")
    part = lambda *pieces: F.coalesce(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces]), F.lit(""))
    frames = F.array(
        F.concat(F.lit("Win "), prize, F.lit(" in this UK prize draw."), part(" Tickets start from just ", price, "."), part(" The winner is drawn on ", when, ".")),
        F.concat(F.lit("Fancy winning "), prize, F.lit("?"), part(" Entries are ", price, " each"), part(", with the draw taking place on ", when), F.lit(". Enter before the tickets sell out.")),
        F.concat(F.lit("Up for grabs: "), prize, F.lit("."), part(" Grab your tickets from ", price), part(" ahead of the live draw on ", when), F.lit(".")),
        F.concat(
            F.lit("Here's your chance to win "), prize, F.lit("."), part(" With tickets from ", price, ","),
            F.coalesce(F.concat(F.lit(" the winner is announced on "), when, F.lit(".")), F.lit(" don't miss out — enter today.")),
        ),
    )
    key = F.coalesce(F.nullif("slug", F.lit("")), F.nullif("title", F.lit("")), prize)
    return F.get(frames, (X.fnv1a(key) % 4).cast("int"))


def description_checks(rows: DataFrame, text: str = "description", seq: str = "seq") -> DataFrame:
    """Descriptions to rewrite: ``template`` frames, and copies of an earlier one.

    Two descriptions are copies when they agree in all words once figures, punctuation and
    case are ignored.  Copies are found by grouping on that text, so nothing is paired up.
    A text without words has no copies.
    """
    plain = F.trim(F.regexp_replace(F.lower(nz(text)), r"[^\p{L}]+", " "))
    # a key of its own for a text without words: no evidence, and no hot key
    keyed = rows.withColumn("_print", F.when(plain != "", F.sha2(plain, 256)).otherwise(F.concat(F.lit("-"), F.col(seq).cast("string"))))
    first = keyed.groupBy("_print").agg(F.min(seq).alias("copy_of"))
    joined = keyed.join(first, "_print")
    template = matches(text, "|".join(f"(?:{p})" for p in rules.TEMPLATE_FRAMES), "")
    verdict = (
        F.when(template, F.lit("template"))
        .when(F.col("copy_of") != F.col(seq), F.lit("copy"))
        .otherwise(F.lit("ok"))
    )
    return joined.withColumn("verdict", verdict).drop("_print")
