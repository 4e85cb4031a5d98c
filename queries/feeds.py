"""Feed readers: payloads are derived from the tables, read back, and compared with them."""

from pyspark.sql import functions as F

from listflow.functions import text as X
from listflow.functions.dates import normalize_uk_date
from listflow.sources import feeds as S
from listflow.sources import payloads as P

from .inputs import table
from .registry import query

PAGE = 100  # products per captured feed page
NOW = "2026-08-01 12:00:00"


def _pages(df, item, key="p_partkey"):
    """Captured bodies: arrays of at most PAGE items, with their operator."""
    page = F.floor(F.col(key) / PAGE).alias("page")
    return df.groupBy(page, F.col("op_slug")).agg(F.to_json(F.collect_list(item)).alias("body")).withColumn("base", F.concat(F.lit("https://"), "op_slug", F.lit(".example/")))


def _part(spark, folder):
    part = table(spark, folder, "part")
    return part.withColumn("op_slug", F.concat(F.lit("op-"), F.floor(F.col("p_partkey") / PAGE) % 20))




def _slug():
    return F.concat(F.lit("p"), "p_partkey")


@query("woo_feed", """
SELECT concat('op-', p_partkey // 100 % 20) AS op_slug, CAST(p_partkey AS VARCHAR) AS product_id, concat('Win ', p_name, ' & more – ', p_type) AS title,
  round(p_retailprice * 100) / 100 AS known_price, CASE WHEN p_size % 4 > 0 THEN concat('https://img.example/', p_partkey, '.jpg') END AS known_image,
  concat('https://op-', p_partkey // 100 % 20, '.example/product/p', p_partkey, '/') AS entry_url,
  CASE WHEN p_size % 3 = 0 THEN 'Long copy' ELSE concat('Short ', p_brand) END AS prize_copy,
  CASE WHEN p_size % 2 = 0 THEN concat('Live Draws|', p_type) ELSE p_type END AS labels, CAST(p_size * 1000 AS BIGINT) AS stock
FROM part WHERE p_size % 5 <> 0 AND p_size % 7 <> 0""")
def woo_feed(spark, folder):
    """Store feed with encoded names, minor units and unstable live flags."""
    part, size = _part(spark, folder), F.col("p_size")
    item = F.struct(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("Win "), "p_name", F.lit(" &amp; more &#8211; "), "p_type").alias("name"),
        _slug().alias("slug"),
        F.concat(F.lit("https://"), "op_slug", F.lit(".example/product/"), _slug(), F.lit("/")).alias("permalink"),
        F.when(size % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("Short "), "p_brand")).alias("short_description"),
        F.lit("Long copy").alias("description"),
        F.struct(F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string").alias("price"), F.lit(2).alias("currency_minor_unit")).alias("prices"),
        F.when(size % 4 > 0, F.array(F.struct(F.concat(F.lit("https://img.example/"), "p_partkey", F.lit(".jpg")).alias("src")))).otherwise(F.array().cast("array<struct<src:string>>")).alias("images"),
        F.when(size % 2 == 0, F.array(F.struct(F.lit("Live Draws").alias("name")), F.struct(F.col("p_type").alias("name")))).otherwise(F.array(F.struct(F.col("p_type").alias("name")))).alias("categories"),
        F.when(size % 5 == 0, F.lit("0")).when(size % 7 == 0, F.lit("False")).when(size % 2 == 0, F.lit("true")).alias("is_purchasable"),
        F.struct(F.concat(F.format_number(size * 1000, 0), F.lit(" in stock")).alias("text")).alias("stock_availability"),
    )
    out = S.read_woo(_pages(part, item))
    return out.select("op_slug", "product_id", "title", "known_price", "known_image", "entry_url", "prize_copy", F.array_join("labels", "|").alias("labels"), "stock")


@query("shopify_feed", """
SELECT concat('op-', p_partkey // 100 % 20) AS op_slug, concat('p', p_partkey) AS product_id, concat('Win ', p_name) AS title, p_retailprice AS known_price,
  concat('https://op-', p_partkey // 100 % 20, '.example/products/p', p_partkey) AS entry_url, concat(p_type, '|', p_brand) AS labels
FROM part WHERE p_size % 3 = 0 OR p_size % 4 = 1""")
def shopify_feed(spark, folder):
    """Shop feed; live means some variant is strictly available."""
    part, size = _part(spark, folder), F.col("p_size")
    variant = lambda available: F.struct(F.col("p_retailprice").cast("string").alias("price"), available.alias("available"))
    item = F.struct(
        F.concat(F.lit("Win "), "p_name").alias("title"), _slug().alias("handle"), F.lit("<p>copy</p>").alias("body_html"),
        F.col("p_type").alias("product_type"), F.array("p_brand").alias("tags"),
        F.array(variant(size % 4 == 1), variant(size % 3 == 0)).alias("variants"),
    )
    bodies = _pages(part, item).withColumn("body", F.concat(F.lit('{"products":'), "body", F.lit("}")))
    return S.read_shopify(bodies).select("op_slug", "product_id", "title", "known_price", "entry_url", F.array_join("labels", "|").alias("labels"))


@query("raffle_feed", """
SELECT concat('op-', p_partkey // 100 % 20) AS op_slug, concat('Win ', p_name) AS title, CASE WHEN p_size % 2 = 0 THEN concat(p_brand, ' prize') ELSE concat('Win ', p_name) END AS grand_prize,
  CASE WHEN p_size % 2 = 0 THEN 'api:end_prize_name' ELSE 'title' END AS grand_prize_source, CASE WHEN p_size % 7 = 0 THEN 'car-draws' END AS category,
  CASE WHEN p_size % 3 = 0 THEN floor(least(p_size * 0.45 / 5, p_size * 1.0 / 25) * 100 + 0.5) / 100 ELSE p_size * 0.1 END AS ticket_price,
  CAST(p_size * 100 AS BIGINT) AS total_entries, concat('2026-0', 1 + p_size % 9, '-10T09:05:00', CASE WHEN 1 + p_size % 9 BETWEEN 4 AND 9 THEN '+01:00' ELSE '+00:00' END) AS draw_date,
  concat('https://op-', p_partkey // 100 % 20, '.example/draws/p', p_partkey, '/enter') AS entry_url
FROM part WHERE p_size % 11 <> 0""")
def raffle_feed(spark, folder):
    """Raffle feed with a price ladder, a link template and restamped deadlines."""
    part, size = _part(spark, folder), F.col("p_size")
    tier = lambda price, qty: F.struct(price.cast("string").alias("price"), F.lit(qty).alias("tickets_quantity"))
    ladder = F.when(size % 3 == 0, F.array(tier(size * 0.45, 5), tier(size * 1.0, 25))).otherwise(F.array(tier(size * 0.45, 5), tier(size * 0.1, 1)))
    item = F.struct(
        _slug().alias("slug"), F.concat(F.lit(" Win "), "p_name").alias("title"),
        F.when(size % 2 == 0, F.concat("p_brand", F.lit(" prize"))).otherwise(F.lit("")).alias("end_prize_name"),
        F.concat(F.lit("2026-0"), 1 + size % 9, F.lit("-10 9:05:33+02:00")).alias("end_at"), (size * 100).alias("max_entries"),
        (size % 11 != 0).alias("is_open"), ladder.alias("offers"),
        F.when(size % 7 == 0, F.array(F.lit("car-sport"))).otherwise(F.array(F.lit("live"))).alias("category_ids"),
    )
    bodies = _pages(part, item).withColumn("draw_path", F.lit("/draws/{slug}/enter"))
    return S.read_raffle_engine(bodies).select("op_slug", "title", "grand_prize", "grand_prize_source", "category", "ticket_price", "total_entries", "draw_date", "entry_url")


@query("hydra_feed", """
SELECT concat('op-', p_partkey // 100 % 20) AS op_slug, p_name AS title, CASE WHEN p_size % 2 = 0 THEN 'car-draws' WHEN p_size % 3 = 0 THEN 'cash-prizes' END AS category,
  p_size / 100 AS ticket_price, CAST(p_size * 50 AS BIGINT) AS total_entries, concat('2026-08-', lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0'), 'T19:30:00+01:00') AS draw_date,
  concat('https://media.example/t/', CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'b' END, p_partkey, '?w=1280') AS image_url, concat('https://op-', p_partkey // 100 % 20, '.example/competitions/p', p_partkey) AS entry_url
FROM part WHERE p_size % 5 > 0""")
def hydra_feed(spark, folder):
    """Paged feed in pence; live means published and not closed."""
    part, size = _part(spark, folder), F.col("p_size")
    item = F.struct(
        F.col("p_name").alias("name"), _slug().alias("urlStub"),
        F.concat(F.lit("2026-08-"), F.lpad((1 + size % 28).cast("string"), 2, "0"), F.lit("T19:30:00+00:00")).alias("closeTs"),
        F.when(size % 5 > 0, F.lit("published")).otherwise(F.lit("draft")).alias("status"),
        F.when(size % 2 == 0, F.lit("car_sports")).when(size % 3 == 0, F.lit("other_cash")).otherwise(F.lit("")).alias("category"),
        F.when(size % 2 == 0, F.concat(F.lit("a"), "p_partkey")).alias("thumbnail"), F.concat(F.lit("/media-uploads/b"), "p_partkey").alias("thumb"),
        size.alias("regularPrice"), (size * 50).alias("numTickets"),
    )
    bodies = _pages(part, item).withColumn("body", F.concat(F.lit('{"hydra:member":'), "body", F.lit(',"hydra:view":{}}')))
    out = S.read_hydra(bodies, NOW, "https://media.example/t")
    return out.select("op_slug", "title", "category", "ticket_price", "total_entries", "draw_date", "image_url", "entry_url")


@query("inertia_feed", """
SELECT concat('op-', p_partkey // 100 % 20) AS op_slug, concat('Win "', p_name, '" & <more>') AS title, CASE WHEN p_size % 3 = 0 THEN 2.5 ELSE p_size / 4 END AS ticket_price,
  CASE WHEN p_size % 2 = 0 THEN 'tech-giveaways' END AS category, CAST(p_size * 10 AS BIGINT) AS total_entries, concat('https://op-', p_partkey // 100 % 20, '.example/img/p', p_partkey, '.jpg') AS image_url,
  '2026-12-01T18:00:00+00:00' AS draw_date FROM part WHERE p_size % 5 > 0""")
def inertia_feed(spark, folder):
    """Page state in an attribute; featured entries repeat listed ones."""
    part, size = _part(spark, folder), F.col("p_size")
    item = F.struct(
        F.col("p_partkey").alias("id"), _slug().alias("slug"), F.concat(F.lit('Win "'), "p_name", F.lit('" & <more>')).alias("name"),
        (size / 4).cast("string").alias("price"), F.when(size % 3 == 0, F.lit("2.50")).otherwise(F.lit("0.00")).alias("sale_price"),
        (size * 10).alias("total_tickets"), F.lit("2026-12-01 18:00:00").alias("end"), F.concat(F.lit("/img/"), _slug(), F.lit(".jpg")).alias("image_path"),
        F.when(size % 5 > 0, F.lit("Active")).otherwise(F.lit("closed")).alias("status"),
        F.when(size % 2 == 0, F.array(F.struct(F.lit("Gaming").alias("name")))).otherwise(F.array().cast("array<struct<name:string>>")).alias("categories"),
    )
    wrapped = F.when(F.col("page") % 2 == 0, F.concat(F.lit('{"data":'), "body", F.lit("}"))).otherwise(F.col("body"))
    state = F.concat(F.lit('{"props":{"competitions":'), wrapped, F.lit(',"featuredCompetitions":'), "body", F.lit("}}"))
    escaped = state
    for plain, coded in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(coded))
    pages = _pages(part, item).withColumn("body", F.concat(F.lit('<div id="app" data-page="'), escaped, F.lit('"></div>')))
    return S.read_inertia(pages).select("op_slug", "title", "ticket_price", "category", "total_entries", "image_url", "draw_date")


@query("zap_gap_fill", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size % 4 = 0 THEN CAST(p_size AS BIGINT) WHEN p_size % 3 > 0 THEN CAST(p_size * 7 AS BIGINT) END AS total_entries,
  CASE WHEN p_size % 2 = 0 THEN '2026-09-01T20:00:00+01:00' WHEN p_size % 5 > 0 THEN strftime(TIMESTAMP '2026-08-01 12:00:00' + to_days(CAST(p_size AS INT)), '%Y-%m-%dT%H:%M:%SZ') END AS draw_date FROM part""")
def zap_gap_fill(spark, folder):
    """Missing caps and dates come from the refresh map; stated values win."""
    part, size = _part(spark, folder), F.col("p_size")
    entry = F.struct(
        F.col("p_partkey").cast("string").alias("key"),
        F.struct(
            F.when(size % 3 > 0, (size * 7).cast("string")).otherwise(F.lit("0")).alias("tickets_max"),
            F.when(size % 5 > 0, size).otherwise(F.lit(-1)).alias("tickets_days_remaining"),
        ).alias("value"),
    )
    page = F.floor(F.col("p_partkey") / PAGE).alias("page")
    raw = part.groupBy(page, "op_slug").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("body"))
    rows = part.select(
        "op_slug", F.col("p_partkey").cast("string").alias("product_id"), F.when(size % 4 == 0, size.cast("bigint")).alias("total_entries"),
        F.when(size % 2 == 0, F.lit("2026-09-01T20:00:00+01:00")).otherwise(F.lit("")).alias("draw_date"),
    )
    return S.fill_from_zap(rows, S.read_zap(raw, NOW)).select("product_id", "total_entries", "draw_date")


@query("pre_wrapped", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('{"k": "', o_orderstatus, ' & <b>"}') WHEN 1 THEN concat('[', o_custkey, ']') WHEN 2 THEN '<p>no json</p>'
  ELSE '<html><pre>[broken</pre></html>' END AS body FROM orders""")
def pre_wrapped(spark, folder):
    """JSON a browser wrapped in its viewer is unwrapped; other texts stay."""
    k = F.col("o_orderkey")
    body = (
        F.when(k % 4 == 0, F.concat(F.lit("<html><body><pre class='j'><span>{&quot;k&quot;: &quot;"), "o_orderstatus", F.lit(" &amp; &lt;b&gt;&quot;}</span></pre></body></html>")))
        .when(k % 4 == 1, F.concat(F.lit("["), "o_custkey", F.lit("]")))
        .when(k % 4 == 2, F.lit("<p>no json</p>"))
        .otherwise(F.lit("<html><pre>[broken</pre></html>"))
    )
    return table(spark, folder, "orders").select("o_orderkey", S.unwrap_pre(body).alias("body"))


@query("feed_probe", """
WITH g AS (SELECT o_orderkey // 20 AS c, count(*) AS total, count(*) FILTER (o_orderstatus <> 'F') AS live, min(o_orderkey) FILTER (o_orderstatus <> 'F') AS first_live, min(o_orderkey) AS first_any FROM orders GROUP BY 1)
SELECT concat('shop', c, '.co.uk') AS domain, CASE WHEN c % 3 = 0 THEN 'shopify' ELSE 'woo' END AS method, CASE WHEN c % 3 = 0 THEN total ELSE live END AS live, total,
  concat('Win order ', CASE WHEN c % 3 = 0 THEN first_any ELSE first_live END) AS sample FROM g WHERE (c % 3 = 0 OR live > 0) AND c % 7 > 0""")
def feed_probe(spark, folder):
    """Live and total rows of every candidate's captured feeds."""
    orders = table(spark, folder, "orders")
    name = F.concat(F.lit("Win order "), "o_orderkey").alias("name")
    item = F.struct("o_orderkey", name, F.when(F.col("o_orderstatus") == "F", F.lit("0")).alias("is_purchasable"))
    # a captured page holds 20 consecutive orders
    rows = orders.groupBy(F.floor(F.col("o_orderkey") / 20).alias("c")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    shop = F.concat(F.lit('{"products":'), F.to_json(F.transform("items", lambda x: F.struct(x["name"].alias("title")))), F.lit("}"))
    captures = rows.where("c % 7 > 0").select(
        F.concat(F.lit("shop"), "c", F.lit(".co.uk")).alias("domain"),
        F.when(F.col("c") % 3 > 0, F.to_json("items")).alias("woo_body"), F.when(F.col("c") % 3 == 0, shop).alias("shop_body"),
    )
    return S.probe_feeds(captures)


@query("metrics_normalise", """
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(event_id AS VARCHAR) AS media_id, m.metric, CAST(CASE m.metric WHEN 'likes' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE CASE WHEN event_id % 3 > 0 THEN user_id ELSE 0 END END AS DOUBLE) AS value
FROM events, (SELECT unnest(['likes', 'comments']) AS metric) m WHERE event_type = 'view'
UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'account', CASE WHEN event_id % 2 = 0 THEN 'reach' ELSE 'views' END, value FROM events WHERE event_type = 'click'
UNION ALL SELECT strftime(ts, '%Y-%m-%d'), CAST(event_id AS VARCHAR), m.metric, CASE m.metric WHEN 'fb_reactions' THEN CAST(user_id AS DOUBLE) WHEN 'fb_comments' THEN 0.0 ELSE CASE WHEN event_id % 2 = 0 THEN value ELSE 0.0 END END
FROM events, (SELECT unnest(['fb_reactions', 'fb_comments', 'fb_shares']) AS metric) m WHERE event_type NOT IN ('view', 'click')""")
def metrics_normalise(spark, folder):
    """Three kinds of captured metric payloads as one long table."""
    events = table(spark, folder, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")
    page = F.floor(F.col("event_id") / PAGE)

    def bodies(kind, item):
        rows = events.where(kind).groupBy(page.alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("body"))
        return rows

    media = F.struct(F.col("event_id").alias("id"), stamp.alias("timestamp"), F.get_json_object("props", "$.k").cast("int").alias("like_count"), F.when(F.col("event_id") % 3 > 0, F.col("user_id")).alias("comments_count"))
    reach = F.struct(F.when(F.col("event_id") % 2 == 1, F.lit("views")).alias("name"), F.array(F.struct(stamp.alias("end_time"), F.col("value"))).alias("values"))
    count = lambda n: F.struct(F.struct(n.alias("total_count")).alias("summary"))
    posts = F.struct(F.col("event_id").alias("id"), stamp.alias("created_time"), count(F.col("user_id")).alias("reactions"), F.when(F.col("event_id") % 2 == 0, F.struct(F.col("value").alias("count"))).alias("shares"))
    parts = [P.map_payload(bodies("event_type = 'view'", media), "ig_media"), P.map_payload(bodies("event_type = 'click'", reach), "ig_reach"), P.map_payload(bodies("event_type NOT IN ('view', 'click')", posts), "fb_posts")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("serp_hosts", """
WITH h AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host FROM pages)
SELECT regexp_replace(host, '^www\\.', '') AS domain, count(*) AS n FROM h GROUP BY 1""")
def serp_hosts(spark, folder):
    """Hosts of captured search results."""
    pages = table(spark, folder, "pages")
    results = pages.select(F.to_json(F.struct(F.array(F.struct(F.col("url").alias("link")), F.struct(F.lit("not a url").alias("link"))).alias("organic_results"))).alias("body"))
    return P.serp_candidates(results).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


@query("sitemap_pages", """
WITH u AS (SELECT page_id // 50 AS map, page_id, concat(split_part(split_part(url, '#', 1), '?', 1), CASE page_id % 3 WHEN 0 THEN '/operators/a' WHEN 1 THEN '/blog' ELSE '/reviews/b' END) AS loc FROM pages),
 d AS (SELECT map, loc, min(page_id) AS first FROM u WHERE page_id % 3 <> 1 OR regexp_matches(regexp_replace(loc, '^https?://[^/]+', ''), '(?i)operator|site|review|compan') GROUP BY 1, 2)
SELECT CAST(map AS BIGINT) AS map, loc AS page FROM d""")
def sitemap_pages(spark, folder):
    """Operator-like page addresses of every sitemap."""
    pages = table(spark, folder, "pages")
    k = F.col("page_id")
    tail = F.when(k % 3 == 0, F.lit("/operators/a")).when(k % 3 == 1, F.lit("/blog")).otherwise(F.lit("/reviews/b"))
    loc = F.concat(F.lit("<url><loc> "), F.substring_index(F.substring_index("url", "#", 1), "?", 1), tail, F.lit("</loc></url>"))
    maps = pages.groupBy(F.floor(k / 50).alias("map")).agg(F.sort_array(F.collect_list(F.struct(k, loc.alias("loc")))).alias("l"))
    maps = maps.select("map", F.concat(F.lit("<urlset><loc>https://x.example/child.xml</loc>"), F.array_join(F.transform("l", lambda x: x["loc"]), ""), F.lit("</urlset>")).alias("xml"))
    return P.sitemap_pages(maps).select("map", "page")


@query("crawled_pages", """
WITH m AS (SELECT *, concat('https://s-', s_suppkey, '.example/') AS b FROM supplier)
SELECT concat('s-', s_suppkey) AS source, concat(b, 'operators/', x, '-', s_suppkey) AS page FROM m, unnest(['a', 'b', 'c', 'd']) AS t(x) WHERE x <> 'd' OR s_suppkey % 3 > 0""")
def crawled_pages(spark, folder):
    """Pages of nested sitemap indexes, some of which name each other or were never captured."""
    k = F.col("s_suppkey")
    own = table(spark, folder, "supplier").select(k, F.concat(F.lit("https://s-"), k, F.lit(".example/")).alias("b"))
    loc = lambda *parts: F.concat(F.lit("<url><loc> "), "b", *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("</loc></url>"))
    page = lambda x: loc(f"operators/{x}-", k.cast("string"))
    maps = {
        "sitemap.xml": F.concat(loc("a.xml"), loc("b.xml"), loc("about")),
        "a.xml": F.concat(loc("c.xml"), loc("sitemap.xml"), page("a")),
        "b.xml": F.when(k % 3 > 0, F.concat(page("d"), page("b"))),
        "c.xml": F.concat(loc("a.xml"), page("c"), page("b")),
    }
    rows = own.select(F.inline(F.array(*[F.struct(F.concat("b", F.lit(name)).alias("url"), xml.alias("xml")) for name, xml in maps.items()]))).where("xml IS NOT NULL")
    roots = own.select(F.concat(F.lit("s-"), k).alias("source"), F.concat("b", F.lit("sitemap.xml")).alias("url"))
    return P.crawled_pages(rows, roots)
