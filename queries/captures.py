"""Captured bodies to stored rows: feeds, pages and refresh maps derived from the parts, swept and committed."""

from pyspark.sql import functions as F

from listflow.functions import rules
from listflow.operators.asof import as_of
from listflow.operators.ranking import scratch_path
from listflow.operators.reconcile import ReconcileConfig
from listflow.plans import captures as C
from listflow.sources.commits import Commits

from .inputs import spread, table
from .registry import query

NOW = "2026-08-01 12:00:00"
PAGE = 100  # products of a captured feed page

# What a listing is once its newest capture was read.
TRUTH_CTE = """k AS (SELECT *, p_partkey // 100 % 20 AS opn, p_partkey AS k FROM part),
truth AS (SELECT k, concat('op-', opn) AS op_slug, CASE WHEN opn < 10 THEN 'woo' WHEN opn < 16 THEN 'shopify' ELSE 'api' END AS m, k % 6 > 0 AS paged,
  CASE WHEN k % 4 = 1 AND opn < 16 AND k % 6 > 0 THEN 1 ELSE 0 END AS late, concat('Win ', split_part(p_name, ' ', 2), ' BMW ', k) AS title, floor(p_retailprice) / 100 AS price, p_size * 100 + 600 AS cap,
  DATE '2026-08-03' + CAST(k % 20 AS INT) AS day FROM k),
fresh AS (SELECT *, concat('https://', op_slug, '.example/product', CASE WHEN m = 'shopify' THEN 's' ELSE '' END, '/p', k, CASE WHEN m = 'woo' THEN '/' ELSE '' END) AS entry_url,
  CASE WHEN m <> 'shopify' OR paged THEN cap + 100 * late END AS entries,
  CASE WHEN m = 'api' OR paged THEN concat(strftime(day + late, '%Y-%m-%d'), 'T20:00:00+01:00') WHEN m = 'woo' THEN concat(strftime(DATE '2026-08-01' + CAST(k % 20 + 2 AS INT), '%Y-%m-%d'), 'T12:00:00Z') END AS draw_date FROM truth)"""


def _parts(spark, folder):
    """The facts of every listing, before it goes into bodies."""
    part, k = spread(table(spark, folder, "part")), F.col("p_partkey")
    opn = F.floor(k / PAGE) % 20
    slug = F.concat(F.lit("p"), k)
    rows = part.select(
        k.alias("k"), opn.alias("opn"), F.concat(F.lit("op-"), opn).alias("op_slug"), F.floor(k / PAGE).alias("feed_page"), slug.alias("handle"),
        F.concat(F.lit("Win "), F.split("p_name", " ")[1], F.lit(" BMW "), k).alias("title"), F.floor("p_retailprice").alias("pence"), (F.col("p_size") * 100 + 600).cast("bigint").alias("cap"),
        F.date_add(F.lit("2026-08-03").cast("date"), (k % 20).cast("int")).alias("day"),
    )
    rows = rows.withColumn("m", F.when(F.col("opn") < 10, "woo").when(F.col("opn") < 16, "shopify").otherwise("api"))
    base = F.concat(F.lit("https://"), "op_slug", F.lit(".example"))
    url = F.when(F.col("m") == "woo", F.concat(base, F.lit("/product/"), "handle", F.lit("/"))).when(F.col("m") == "shopify", F.concat(base, F.lit("/products/"), "handle")).otherwise(F.concat(base, F.lit("/product/"), "handle"))
    return rows.withColumn("entry_url", url)


def _feeds(parts):
    """Three captures of every feed page: an old one with other prices, the one of the run's morning, and one after the run."""
    pounds = lambda more: F.format_string("%.2f", (F.col("pence") + more) / 100)
    image = F.concat(F.lit("https://img.example/"), "k", F.lit(".jpg"))
    woo = lambda more: F.struct(
        F.col("k").alias("id"), F.col("title").alias("name"), F.col("entry_url").alias("permalink"),
        F.struct((F.col("pence") + more).cast("string").alias("price"), F.lit(2).alias("currency_minor_unit")).alias("prices"), F.array(F.struct(image.alias("src"))).alias("images"),
    )
    shop = lambda more: F.struct(F.col("title"), F.col("handle"), F.array(F.struct(pounds(more).alias("price"), F.lit(True).alias("available"))).alias("variants"), F.array(F.struct(image.alias("src"))).alias("images"))
    raffle = lambda more: F.struct(
        F.col("handle").alias("slug"), F.col("title"), F.concat(F.col("day").cast("string"), F.lit("T20:00:00")).alias("end_at"), F.col("cap").cast("string").alias("max_entries"),
        F.array(F.struct(pounds(more).alias("price"), F.lit("1").alias("tickets_quantity"))).alias("offers"), F.struct(image.alias("url")).alias("thumbnail"),
    )

    def bodies(more, at):
        item = F.when(F.col("m") == "woo", F.to_json(woo(more))).when(F.col("m") == "shopify", F.to_json(shop(more))).otherwise(F.to_json(raffle(more)))
        # PAGE items in an array
        page = parts.groupBy("op_slug", "m", "feed_page").agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("body"))
        return page.select("op_slug", "feed_page", F.lit(at).cast("timestamp").alias("captured_at"), F.when(F.col("m") == "shopify", F.concat(F.lit('{"products":'), "body", F.lit("}"))).otherwise(F.col("body")).alias("body"))

    return bodies(500, "2026-07-20 06:00:00").unionByName(bodies(0, "2026-08-01 06:00:00")).unionByName(bodies(900, "2026-08-01 12:00:01"))


def _pages(parts):
    """Up to three captures of a product page; a quarter of the pages lacks the newest one, a sixth of the products has none."""
    paged = parts.where("m <> 'api' AND k % 6 > 0")

    def capture(at, cap, days):
        day = F.date_add("day", days)
        text = F.concat(F.lit("<html><body><p>Only "), F.col("cap") + cap, F.lit(" tickets available in this competition.</p><p>Live draw will take place on "), F.date_format(day, "d"), F.lit("th "), F.date_format(day, "MMMM yyyy"), F.lit(" at 8pm.</p></body></html>"))
        return paged.select("k", F.col("entry_url").alias("url"), at.alias("captured_at"), text.alias("html"))

    first = F.lit("2026-07-01").cast("timestamp") + F.make_dt_interval(days=(F.col("k") % 5).cast("int"))
    every = capture(first, 100, 1).unionByName(capture(F.lit("2026-07-31 10:00:00").cast("timestamp"), 0, 0).where("k % 4 <> 1")).unionByName(capture(F.lit("2026-08-02 00:00:00").cast("timestamp"), 500, 2))
    return every.drop("k")


def _zaps(parts):
    """Refresh maps of the stores, before and after the run."""
    def maps(more, at):
        entry = F.struct(F.col("k").cast("string").alias("id"), F.struct((F.col("cap") + more).cast("string").alias("tickets_max"), (F.col("k") % 20 + 2).cast("string").alias("tickets_days_remaining")).alias("v"))
        rows = parts.where("m = 'woo' AND k % 6 = 0").groupBy("op_slug").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("body"))
        return rows.select("op_slug", F.lit(at).cast("timestamp").alias("captured_at"), "body")

    return maps(0, "2026-08-01 06:30:00").unionByName(maps(50, "2026-08-01 13:00:00"))


def _operators(spark):
    ops = spark.range(20).select(F.concat(F.lit("op-"), "id").alias("slug"), F.lit("Some Comps").alias("name"), F.col("id").alias("position"), F.concat(F.lit("https://op-"), "id", F.lit(".example")).alias("base"), "id")
    return ops.select("slug", "name", "position", "base", F.when(F.col("id") < 10, "woo").when(F.col("id") < 16, "shopify").otherwise("api").alias("method"), F.when(F.col("id") >= 16, "raffle-engine").alias("apiStyle"))


def _stored(parts):
    """Two of three listings are known: drafts that agree (or, a fifth, don't), and live rows with an old price."""
    late = F.when(F.expr("k % 4 = 1 AND m <> 'api' AND k % 6 > 0"), 1).otherwise(0)
    zapped = F.expr("m = 'woo' AND k % 6 = 0")
    day = F.when(zapped, F.concat(F.date_add(F.lit("2026-08-01").cast("date"), (F.col("k") % 20 + 2).cast("int")).cast("string"), F.lit("T12:00:00Z"))).otherwise(F.concat(F.date_add("day", late).cast("string"), F.lit("T20:00:00+01:00")))
    price = F.col("pence") / 100 + F.when(F.col("k") % 3 == 2, 1.0).otherwise(0.0)
    entries = F.col("cap") + 100 * late + F.when(F.expr("k % 3 = 1 AND k % 5 = 0"), 7).otherwise(0)
    nothing = F.lit(None)
    return parts.where("k % 3 > 0").select(
        F.concat(F.lit("d"), "k").alias("id"), F.concat(F.lit("s"), "k").alias("slug"), F.col("op_slug").alias("operator_id"), F.lit("c-car-draws").alias("category_id"), F.lit("rule").alias("category_source"), "title", F.col("title").alias("grand_prize"),
        F.lit("A stored description of the prize.").alias("prize_description"), F.lit("https://img.example/old.jpg").alias("image_url"), price.alias("ticket_price"), entries.cast("bigint").alias("total_entries"),
        (F.floor(price * entries * 100 + 0.5) / 100).alias("total_prize_value"), nothing.cast("double").alias("prize_value"), day.alias("draw_date"), "entry_url", nothing.cast("string").alias("affiliate_url"),
        F.when(F.col("k") % 3 == 1, "draft").otherwise("active").alias("status"), F.lit(False).alias("featured"),
    )


@query("sweep_captures", f"""
WITH {TRUTH_CTE}, s AS (SELECT *, k % 3 > 0 AS known, entries IS NOT NULL AS good,
  CASE WHEN k % 3 = 2 THEN price + 1 ELSE price END AS s_price, cap + 100 * late + CASE WHEN k % 3 = 1 AND k % 5 = 0 THEN 7 ELSE 0 END AS s_entries, concat(strftime(day + late, '%Y-%m-%d'), 'T20:00:00+01:00') AS s_date FROM fresh),
a AS (SELECT *, CASE WHEN good THEN price ELSE s_price END AS a_price, CAST(CASE WHEN good THEN entries ELSE s_entries END AS BIGINT) AS a_entries FROM s WHERE known OR good)
SELECT entry_url, CASE WHEN known THEN concat('s', k) ELSE concat(lower(replace(title, ' ', '-')), '-', op_slug) END AS slug,
  CASE WHEN NOT known THEN 'draft' WHEN k % 3 = 2 OR good AND k % 5 > 0 THEN 'active' ELSE 'draft' END AS status, title, a_price AS ticket_price, a_entries AS total_entries, floor(a_price * a_entries * 100 + 0.5) / 100 AS total_prize_value,
  CASE WHEN good THEN draw_date ELSE s_date END AS draw_date, CASE WHEN good AND NOT (known AND k % 3 = 2) THEN concat('https://img.example/', k, '.jpg') ELSE 'https://img.example/old.jpg' END AS image_url,
  'c-car-draws' AS category_id, 'rule' AS category_source, 2::BIGINT AS version FROM a""")
def sweep_captures(spark, folder):
    """The store after a sweep from captured bodies, read back from commits of which the last is repeated."""
    parts = _parts(spark, folder)
    operators = _operators(spark)
    categories = spark.createDataFrame([(f"c-{slug}", slug) for slug in rules.CATEGORIES], "id string, slug string")
    store_operators = operators.select("slug", F.col("slug").alias("id"))
    path = scratch_path(spark, "captures")
    commits = Commits(spark, path)
    commits.commit("seed", {"draws": _stored(parts)}, 0)
    captures = {"feeds": _feeds(parts), "pages": _pages(parts), "zaps": _zaps(parts)}
    cfg = ReconcileConfig(now=NOW, publish_cap=None, correct_cap=None)
    for run in ("r1", "r1"):
        C.run_and_commit(spark, path, run, captures, operators, store_operators, categories, NOW, cfg)
    draws = commits.read("draws")
    return draws.select("entry_url", "slug", "status", "title", "ticket_price", "total_entries", "total_prize_value", "draw_date", "image_url", "category_id", "category_source", F.lit(commits.version()).cast("bigint").alias("version"))


@query("as_of_events", """
WITH c AS (SELECT DISTINCT user_id, ts AS at FROM events WHERE event_type = 'click'),
 r AS (SELECT e.event_id, e.user_id, e.ts, max(c.at) AS last_click FROM events e LEFT JOIN c ON e.user_id = c.user_id AND c.at <= e.ts WHERE e.event_type = 'purchase' GROUP BY 1, 2, 3)
SELECT event_id, last_click FROM r""")
def as_of_events(spark, folder):
    """The last click before every purchase of a user."""
    events = table(spark, folder, "events")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("at"))
    return as_of(events.where("event_type = 'purchase'"), clicks, ["user_id"], "ts", "at", "last_click").select("event_id", "last_click")
