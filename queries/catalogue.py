"""Audit reports, discovery, storage plans, content selection and the intake stream."""

from pyspark.sql import functions as F

from listflow.functions import text as X
from listflow.functions.dates import normalize_uk_date
from listflow.operators import ranking as K
from listflow.operators.similar import near_copies
from listflow.plans import content as C
from listflow.plans import discovery as DS
from listflow.plans import reports as P
from listflow.plans import storage as ST
from listflow.sources import config as CFG
from listflow.sources import payloads as PL

from .inputs import for_duck, spread, table, view
from .registry import query

NOW = "2001-08-02 00:00:00"

# Orders as stored listings of customers-as-operators.
DRAWS = """
SELECT concat('d', o_orderkey) AS id, concat('slug-', o_orderkey) AS slug, o_custkey % 200 AS op_no, concat('op-', o_custkey % 200) AS op_slug,
  CASE WHEN o_orderstatus = 'P' OR o_custkey % 200 % 10 = 3 THEN 'ended' WHEN o_orderstatus = 'F' THEN 'draft' WHEN o_custkey % 200 % 10 = 4 THEN 'draft' ELSE 'active' END AS status,
  CASE o_orderkey % 9 WHEN 0 THEN 'car-draws' WHEN 1 THEN 'cash-prizes' WHEN 2 THEN 'house-draws' WHEN 3 THEN 'tech-giveaways' WHEN 4 THEN 'luxury' WHEN 5 THEN 'collectibles' WHEN 6 THEN 'garden' END AS category_slug,
  CAST(o_orderdate AS TIMESTAMP) AS created_at,
  CAST(CAST(DATE '2001-08-02' + CAST(o_orderkey % 20 - 4 AS INT) AS DATE) AS STRING) AS draw_day,
  CASE WHEN o_orderkey % 13 > 0 THEN concat('https://img.example/', o_orderkey) END AS image_url,
  o_totalprice AS total_prize_value, CASE WHEN o_orderkey % 6 = 0 THEN concat('Car or £', o_custkey * 10) ELSE 'Car' END AS grand_prize
FROM {orders}
"""
DRAWS_CTE = f"draws AS ({for_duck(DRAWS, 'orders')})"
# 19:00 UTC: the stored time is 20:00 with the summer offset
CLOSES = "(CAST(draw_day AS DATE) + INTERVAL 19 HOUR)"


def _draws(spark, folder):
    rows = view(spark, folder, DRAWS, "orders")
    return rows.withColumn("draw_date", normalize_uk_date("draw_day")).withColumn("created_at", F.col("created_at").cast("timestamp"))


def _operators(spark, folder):
    """Stored operators and configured ones."""
    numbers = table(spark, folder, "customer")
    slug = F.concat(F.lit("op-"), "c_custkey")
    stored = numbers.select(slug.alias("slug"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 > 0, F.round(F.col("c_acctbal") / 1000, 2)).alias("rating"))
    config = numbers.where("c_custkey % 7 > 0").select(
        slug.alias("slug"), F.when(F.col("c_custkey") % 2 == 0, F.lit("woo")).otherwise(F.lit("render")).alias("method"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(False)).alias("enabled"),
    )
    extra = spark.createDataFrame([("ghost-1", "woo", None), ("ghost-2", "woo", None)], "slug string, method string, enabled boolean")
    return stored, config.unionByName(extra)


OPS_CTE = """ops AS (SELECT c_custkey AS n, concat('op-', c_custkey) AS slug, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN round(c_acctbal / 1000, 2) END AS rating FROM customer)"""
STATS_CTE = f"""{DRAWS_CTE}, {OPS_CTE},
stats AS (SELECT op_slug AS slug, count(*) AS total, count(*) FILTER (status = 'draft') AS draft, count(*) FILTER (status = 'ended') AS ended,
   count(*) FILTER (status = 'active' AND {CLOSES} > TIMESTAMP '{NOW}') AS live, max(created_at) AS last_insert, max(draw_day) AS last_day FROM draws GROUP BY 1)"""


@query("operator_stats", f"""
WITH {STATS_CTE}
SELECT slug AS op_slug, total, draft, ended, live, strftime(last_insert, '%Y-%m-%d') AS last_insert, last_day || 'T20:00:00+01:00' AS last_draw FROM stats""")
def operator_stats(spark, folder):
    """Rows per status, live rows and newest dates of every operator."""
    out = P.operator_stats(_draws(spark, folder), NOW)
    return out.withColumn("last_insert", F.date_format("last_insert", "yyyy-MM-dd"))


COVERAGE_CTE = f"""{STATS_CTE},
cov AS (SELECT ops.slug, ops.n % 7 > 0 AS configured, CASE WHEN ops.n % 7 > 0 THEN ops.n % 11 > 0 END AS enabled, CASE WHEN ops.n % 7 > 0 THEN CASE WHEN ops.n % 2 = 0 THEN 'woo' ELSE 'render' END END AS method,
   coalesce(total, 0) AS total, coalesce(draft, 0) AS draft, coalesce(live, 0) AS live, date_diff('day', CAST(last_insert AS DATE), DATE '2001-08-02') AS quiet FROM ops LEFT JOIN stats USING (slug)),
bucketed AS (SELECT *, CASE WHEN NOT configured THEN 'missing-config' WHEN NOT enabled THEN 'disabled' WHEN total = 0 THEN 'never-scraped' WHEN live > 0 THEN 'healthy' WHEN draft > 0 THEN 'quiet'
   WHEN quiet <= CASE WHEN method = 'render' THEN 7 ELSE 4 END THEN 'quiet' ELSE 'stalled' END AS bucket FROM cov)"""


@query("coverage_buckets", f"""
WITH {COVERAGE_CTE}
SELECT slug, method, live, draft, quiet AS days_since_insert, bucket FROM bucketed""")
def coverage_buckets(spark, folder):
    """Health bucket of every operator."""
    stored, config = _operators(spark, folder)
    out = P.coverage(stored, config, _draws(spark, folder), NOW)
    return out.select("slug", "method", "live", "draft", "days_since_insert", "bucket")


@query("coverage_totals", f"""
WITH {COVERAGE_CTE}
SELECT unnest(['db_operators', 'configured', 'enabled', 'with_live', 'live_draws', 'drafts', 'missing_config', 'never_scraped', 'stalled', 'quiet', 'disabled', 'config_orphans']) AS measure,
  unnest([count(*), count(*) FILTER (configured), count(*) FILTER (enabled), count(*) FILTER (live > 0), CAST(sum(live) AS BIGINT), CAST(sum(draft) AS BIGINT), count(*) FILTER (bucket = 'missing-config'), count(*) FILTER (bucket = 'never-scraped'),
    count(*) FILTER (bucket = 'stalled'), count(*) FILTER (bucket = 'quiet'), count(*) FILTER (bucket = 'disabled'), 2]) AS n FROM bucketed""")
def coverage_totals(spark, folder):
    """The twelve totals of the coverage report."""
    stored, config = _operators(spark, folder)
    rows = P.coverage(stored, config, _draws(spark, folder), NOW)
    return P.coverage_totals(rows, P.config_orphans(stored, config))


@query("health_report", """
WITH c AS (SELECT concat('op-', o_custkey % 300) AS slug, count(*) AS scraped, count(*) FILTER (o_orderstatus <> 'P') AS inserted, count(*) FILTER (o_orderstatus = 'O') AS published, count(*) FILTER (o_orderstatus = 'F') AS held FROM orders GROUP BY 1),
 e AS (SELECT concat('op-', c_custkey) AS slug FROM customer),
 j AS (SELECT coalesce(c.slug, e.slug) AS slug, coalesce(scraped, 0) AS scraped, coalesce(inserted, 0) AS inserted, coalesce(published, 0) AS published, coalesce(held, 0) AS held, c.slug IS NULL AS silent FROM c FULL JOIN e USING (slug))
SELECT slug, CAST(sum(scraped) AS BIGINT) AS scraped, CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(published) AS BIGINT) AS published, CAST(sum(held) AS BIGINT) AS held, count(*) FILTER (silent) AS silent FROM j GROUP BY ROLLUP (slug)""")
def health_report(spark, folder):
    """Per operator and in total: scraped, inserted, published, held, silent."""
    orders = table(spark, folder, "orders")
    n = lambda *states: F.count_if(F.col("o_orderstatus").isin(*states))
    counts = orders.groupBy(F.concat(F.lit("op-"), F.col("o_custkey") % 300).alias("slug")).agg(
        F.count(F.lit(1)).alias("scraped"), n("O", "F").alias("inserted"), n("O").alias("published"), n("F").alias("held")
    )
    expected = table(spark, folder, "customer").select(F.concat(F.lit("op-"), "c_custkey").alias("slug"))
    return P.health_report(counts, expected)


@query("category_mix", f"""
WITH {DRAWS_CTE}
SELECT category_slug, count(*) AS n FROM draws WHERE status = 'active' AND category_slug IS NOT NULL GROUP BY 1
UNION ALL SELECT 'drafts without category', count(*) FROM draws WHERE status = 'draft' AND category_slug IS NULL""")
def category_mix(spark, folder):
    """Live rows per category, and drafts that still lack one."""
    draws = _draws(spark, folder)
    open_drafts = P.unclassified_drafts(draws).select(F.lit("drafts without category").alias("category_slug"), "n")
    return P.category_mix(draws).unionByName(open_drafts)


@query("stalled_operators", f"""
WITH {DRAWS_CTE}, g AS (SELECT op_slug, op_no, count(*) FILTER (status = 'active') AS live, count(*) FILTER (created_at >= TIMESTAMP '{NOW}' - INTERVAL 5 DAY) AS recent FROM draws GROUP BY 1, 2)
SELECT op_slug, live, concat(op_slug, ' has ', live, ' live draw(s) but has added nothing in 5d — parser may have broken') AS warning FROM g WHERE live >= 3 AND recent = 0 AND op_no % 11 > 0""")
def stalled_operators(spark, folder):
    """Operators with live rows that added nothing lately."""
    disabled = table(spark, folder, "customer").where("c_custkey % 11 = 0").select(F.concat(F.lit("op-"), "c_custkey").alias("slug"))
    out = P.stalled_operators(_draws(spark, folder), disabled, NOW)
    return out.join(P.stall_warnings(out), "op_slug").select("op_slug", "live", "warning")


@query("scoreboard", f"""
WITH {DRAWS_CTE}, {OPS_CTE}, g AS (SELECT op_slug AS slug, count(*) FILTER (status = 'active') AS live, count(*) FILTER (created_at >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY) AS added, max(created_at) AS newest FROM draws GROUP BY 1)
SELECT name, coalesce(live, 0) AS live, coalesce(added, 0) AS added_30d, coalesce(strftime(newest, '%Y-%m-%d'), 'never') AS newest, coalesce(printf('%.1f', CASE WHEN rating * 4 = floor(rating * 4) THEN floor(rating * 10 + 0.5) / 10 ELSE rating END), '—') AS rating,
  CASE WHEN coalesce(live, 0) = 0 AND (newest IS NULL OR newest < TIMESTAMP '{NOW}' - INTERVAL 60 DAY) THEN 'PRUNE?' ELSE '' END AS flag FROM ops LEFT JOIN g USING (slug)""")
def scoreboard(spark, folder):
    """Live, added, newest and rating of every operator, prune candidates first."""
    stored, _ = _operators(spark, folder)
    return P.scoreboard(stored, _draws(spark, folder), NOW)


@query("tripwire", f"""
WITH {DRAWS_CTE}, s AS (SELECT count(*) FILTER (status = 'active') AS a, count(*) FILTER (created_at >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY) AS f, count(*) FILTER (status = 'draft' AND {CLOSES} < TIMESTAMP '{NOW}') AS e,
  count(*) FILTER (status = 'active' AND category_slug = 'car-draws') AS cars, CAST(sum(total_prize_value) AS BIGINT) AS bytes FROM draws)
SELECT a AS active_count, f AS fresh_count, e AS expired_drafts, array_to_string(list_filter([
   CASE WHEN a < 100000 THEN concat('live inventory ', a, ' is under the floor of 100000') END,
   CASE WHEN f < 1 THEN concat('only ', f, ' new draw(s) in the last 24h (expected at least 1) — the scrape ran but produced nothing') END], lambda x: x IS NOT NULL), '; ') AS reasons,
  array_to_string(list_filter([CASE WHEN e > 0 THEN concat(e, ' draft(s) passed their draw date unpublished — scraped, never shown') END,
   CASE WHEN cars < 100000 THEN concat('only ', cars, ' live car-draws (floor 100000)') END, 'only 0 live none (floor 1)'], lambda x: x IS NOT NULL), '; ') AS warnings, true AS tripped FROM s""")
def tripwire(spark, folder):
    """Is the daily run broken, and what should be watched?"""
    cfg = P.TripwireConfig(floor=100000, category_floors={"car-draws": 100000, "none": 1})
    out = P.tripwire(P.tripwire_signals(_draws(spark, folder), NOW, cfg), cfg)
    return out.select("active_count", "fresh_count", "expired_drafts", F.array_join("reasons", "; ").alias("reasons"), F.array_join("warnings", "; ").alias("warnings"), "tripped")


@query("operator_batch", """
WITH c AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 AND s_suppkey % 2 = 0)
SELECT concat('op-', s_suppkey) AS slug FROM c WHERE i % 3 = 214 % 3""")
def operator_batch(spark, folder):
    """Operators whose batch it is today."""
    k = F.col("s_suppkey")
    config = table(spark, folder, "supplier").select(
        F.concat(F.lit("op-"), k).alias("slug"), k.alias("position"), F.when(k % 2 == 0, F.lit("woo")).otherwise(F.lit("render")).alias("method"),
        F.when(k % 5 == 0, F.lit(False)).alias("enabled"), (k % 7 == 0).alias("aiAssist"),
    )
    return CFG.select_operators(config, F.lit(NOW).cast("date"), batches=3, methods=["woo"]).select("slug")


@query("newest_drafts", f"""
WITH {DRAWS_CTE} SELECT id, created_at FROM draws WHERE status = 'draft' ORDER BY created_at DESC, id LIMIT 200""")
def newest_drafts(spark, folder):
    """The 200 newest drafts (a top-k)."""
    return C.newest_drafts(_draws(spark, folder)).select("id", "created_at")


# ---- discovery -------------------------------------------------------------

_HOST = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', '')"
_NORM = "regexp_replace(regexp_replace({}, '\\.(co\\.uk|org\\.uk|me\\.uk|com|co|uk|scot|online|net|io|shop|store|gg|win)$', ''), '[^a-z0-9]', '', 'g')"


@query("candidate_queue", f"""
WITH h AS (SELECT page_id, {_HOST} AS domain FROM pages),
 c AS (SELECT domain, 'seed' AS via, 0 AS src FROM h WHERE page_id % 5 = 0 UNION ALL SELECT domain, 'crosslink:p' || page_id % 3, 1 FROM h),
 t AS (SELECT *, {_NORM.format('domain')} AS token FROM c),
 first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY src, domain, via) AS rn FROM t WHERE token <> '') x WHERE rn = 1),
 known AS (SELECT DISTINCT {_NORM.format('domain')} AS token FROM h WHERE page_id % 6 = 0),
 live AS (SELECT domain, count(*) AS live FROM h GROUP BY 1)
SELECT f.domain, f.via, l.live FROM first f JOIN live l USING (domain) WHERE token NOT IN (SELECT token FROM known)""")
def candidate_queue(spark, folder):
    """New operators from two sources, known ones removed, most live first."""
    pages = table(spark, folder, "pages").withColumn("domain", X.host_of("url"))
    seeds = PL.seed_candidates(pages.where("page_id % 5 = 0").select(F.concat(F.lit(" https://WWW."), F.upper("domain"), F.lit("/x ")).alias("value")))
    cross = pages.select("domain", F.concat(F.lit("crosslink:p"), F.col("page_id") % 3).alias("via"))
    known = DS.known_tokens(pages.where("page_id % 6 = 0").select(F.concat(F.lit("https://"), "domain").alias("base")))
    live = pages.groupBy("domain").agg(F.count(F.lit(1)).alias("live"))
    return DS.approval_queue(DS.new_candidates([seeds, cross], known).join(live, "domain")).select("domain", "via", "live")


# ---- storage ---------------------------------------------------------------

PREFIX = "https://store.example/public/img/"
OBJECTS_CTE = """objects AS (SELECT doc_id AS id, concat(source, '/', doc_id, '.webp') AS path, n_chars * 100 AS size, CASE WHEN doc_id % 4 = 0 THEN 'image/webp' ELSE 'image/png' END AS mimetype,
   TIMESTAMP '2026-08-01' - to_days(CAST(doc_id % 20 AS INT)) AS created FROM documents),
 refs AS (SELECT DISTINCT concat(d.source, '/', d.doc_id, '.webp') AS path FROM documents d WHERE d.doc_id % 3 > 0 AND d.doc_id % 2 = 0 UNION SELECT concat(d.source, '/', d.doc_id, '.webp') FROM documents d WHERE d.doc_id % 5 > 0),
 plan AS (SELECT o.*, CASE WHEN r.path IS NOT NULL THEN 'keep' WHEN created > TIMESTAMP '2026-07-25 00:00:00' THEN 'young' ELSE 'orphan' END AS plan FROM objects o LEFT JOIN refs r USING (path))"""


def _objects(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    k = F.col("doc_id")
    path = F.concat("source", F.lit("/"), k, F.lit(".webp"))
    created = F.date_format(F.date_sub(F.lit("2026-08-01").cast("date"), (k % 20).cast("int")), "yyyy-MM-dd'T'00:00:00'Z'")
    objects = docs.select(
        F.when(k % 8 != 1, k).alias("id"), k.alias("doc_id"), path.alias("path"), F.when(k % 9 > 0, F.col("n_chars") * 100).alias("size"),
        F.when(k % 4 == 0, F.lit("image/webp")).otherwise(F.lit("image/png")).alias("mimetype"), created.alias("created_at"), F.lit(None).cast("string").alias("updated_at"),
    )
    plain, wrapped = F.concat(F.lit(PREFIX), path), F.concat(F.lit("https://images.weserv.nl/?url=ssl:"), X.percent_encode(F.concat(F.lit("store.example/public/img/"), path)), F.lit("&w=9"))
    draws = docs.where(k % 5 > 0).select(k, F.concat(plain, F.lit("?v=1")).alias("image_url"), "source")
    guides = docs.where((k % 3 > 0) & (k % 2 == 0)).select("source", wrapped.alias("cover"))
    return objects, {"draws": draws, "guides": guides}


@query("orphan_plan", f"""
WITH {OBJECTS_CTE} SELECT path, plan FROM plan""")
def orphan_plan(spark, folder):
    """Objects to keep, orphans to delete, and young ones left alone."""
    objects, tables = _objects(spark, folder)
    referenced = ST.referenced_paths(tables, PREFIX)
    ST.check_reference_ratio(referenced, objects)
    return ST.orphan_plan(objects, referenced, "2026-08-01 00:00:00").select("path", "plan")


@query("storage_totals", f"""
WITH {OBJECTS_CTE} SELECT plan, count(*) AS objects, CAST(sum(CASE WHEN id % 9 > 0 THEN size ELSE 0 END) AS BIGINT) AS bytes FROM plan GROUP BY 1""")
def storage_totals(spark, folder):
    """Objects and bytes per plan."""
    objects, tables = _objects(spark, folder)
    return ST.plan_totals(ST.orphan_plan(objects, ST.referenced_paths(tables, PREFIX), "2026-08-01 00:00:00"))


@query("compress_skip", """
SELECT doc_id, doc_id % 8 = 1 OR doc_id % 9 = 0 OR doc_id % 4 = 0 OR n_chars * 100 < 250000 AS skip FROM documents""")
def compress_skip(spark, folder):
    """Objects a re-encoding pass leaves alone."""
    objects, _ = _objects(spark, folder)
    return objects.select("doc_id", ST.should_skip().alias("skip"))


@query("broken_images", """
SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus IN ('O', 'F') AND o_orderkey % 3 > 0 ORDER BY o_orderdate DESC, o_orderkey LIMIT 300""")
def broken_images(spark, folder):
    """Rows whose picture points at a dead store, latest first (a top-k)."""
    k = F.col("o_orderkey")
    draws = table(spark, folder, "orders").select(
        k.alias("id"), F.concat(F.when(k % 4 == 0, F.lit("https://deadstore.example/")).otherwise(F.lit("https://ok.example/")), k).alias("image_url"),
        F.col("o_orderstatus").alias("status"), F.when(k % 3 > 0, F.concat(F.lit("https://op.example/"), k)).alias("entry_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("draw_date"),
    )
    return ST.broken_images(draws, "deadstore", ["O", "F"], 300).select("id")


@query("image_sources", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'adapter' WHEN o_orderkey % 3 = 0 THEN 'page' WHEN o_orderkey % 5 = 0 THEN 'product' WHEN o_orderkey % 7 = 0 THEN 'archive' END AS source,
  CASE WHEN o_orderkey % 2 = 0 THEN 'https://a.example/' WHEN o_orderkey % 3 = 0 THEN 'https://p.example/' WHEN o_orderkey % 5 = 0 THEN 'https://w.example/' WHEN o_orderkey % 7 = 0 THEN 'https://z.example/' END || o_orderkey || '.jpg' AS found_image FROM orders""")
def image_sources(spark, folder):
    """First picture found: feed index, page, product record, archive."""
    k = F.col("o_orderkey")
    orders = table(spark, folder, "orders")
    url = F.concat(F.lit("https://op.example/product/p"), k)
    picture = lambda host: F.concat(F.lit(f"https://{host}.example/"), k, F.lit(".jpg"))
    og = lambda host: F.concat(F.lit('<meta property="og:image" content="'), picture(host), F.lit('">'))
    rows = orders.select(k.alias("id"), F.concat(url, F.lit("/")).alias("entry_url"))
    adapters = orders.where(k % 2 == 0).select(F.upper(url).alias("entry_url"), picture("a").alias("image_url"))
    pages = orders.where(k % 3 == 0).select(url.alias("entry_url"), og("p").alias("html"))
    products = orders.where(k % 5 == 0).select(F.concat(F.lit("https://op.example/p"), k).alias("product_key"), picture("w").alias("image_url"))
    archive = orders.where(k % 7 == 0).select(url.alias("entry_url"), og("z").alias("html"))
    return ST.resolve_images(rows, adapters, pages, products, archive).select("id", "source", "found_image")


# ---- content ---------------------------------------------------------------


@query("ending_soon", f"""
WITH {DRAWS_CTE} SELECT slug, draw_day FROM draws WHERE status = 'active' AND image_url IS NOT NULL AND {CLOSES} BETWEEN TIMESTAMP '{NOW}' + INTERVAL 1 DAY AND TIMESTAMP '{NOW}' + INTERVAL 7 DAY ORDER BY draw_day, slug LIMIT 300""")
def ending_soon(spark, folder):
    """Live rows with a picture that close within the week (a top-k)."""
    return C.ending_soon(_draws(spark, folder), NOW, 7, 1).select("slug", "draw_day")


WEIGHT = "CASE category_slug WHEN 'car-draws' THEN 1.0 WHEN 'cash-prizes' THEN 0.4 WHEN 'house-draws' THEN 0.8 WHEN 'tech-giveaways' THEN 0.92 WHEN 'luxury' THEN 1.0 WHEN 'collectibles' THEN 0.85 ELSE 0.6 END"


@query("content_pick", f"""
WITH {DRAWS_CTE}, pool AS (SELECT slug, coalesce(category_slug, 'other') AS category_slug, draw_day, total_prize_value FROM draws WHERE status = 'active' AND CAST(substr(slug, 6) AS BIGINT) % 10 > 0),
 g AS (SELECT category_slug, count(*) AS n, CAST(sum(CAST(floor(total_prize_value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS cents FROM pool GROUP BY 1),
 s AS (SELECT category_slug, (CASE WHEN n >= 3 THEN 1e12 ELSE 0 END + {WEIGHT} * least(n, 5) * 1e9 + cents / 100) * CASE WHEN category_slug = 'luxury' THEN 0.5 ELSE 1 END AS score FROM g),
 best AS (SELECT category_slug FROM s ORDER BY score DESC, category_slug LIMIT 1),
 r AS (SELECT *, row_number() OVER (ORDER BY draw_day, slug) AS rank FROM pool WHERE category_slug IN (SELECT category_slug FROM best))
SELECT category_slug, slug, CAST(rank AS INT) AS rank, CASE WHEN rank <= 5 THEN 'pick' ELSE 'backup' END AS role FROM r WHERE rank <= 8""")
def content_pick(spark, folder):
    """Picks and backups of the strongest category, history aware."""
    draws = _draws(spark, folder).where("status = 'active'")
    used = draws.where(F.substring("slug", 6, 20).cast("bigint") % 10 == 0).select("slug")
    return C.pick_category(draws, used=used, avoid="luxury").select("category_slug", "slug", "rank", "role")


@query("value_line", f"""
WITH {DRAWS_CTE}, v AS (SELECT category_slug, CASE WHEN grand_prize LIKE '%£%' AND length(split_part(grand_prize, '£', 2)) >= 3 AND CAST(split_part(grand_prize, '£', 2) AS DOUBLE) > 0 THEN least(total_prize_value, CAST(split_part(grand_prize, '£', 2) AS DOUBLE)) ELSE total_prize_value END AS value FROM draws),
 g AS (SELECT category_slug, CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) / 100 AS total FROM v GROUP BY 1)
SELECT category_slug, total, CASE WHEN category_slug IS NULL OR category_slug = 'garden' OR total < 1000 THEN '' ELSE '£' || format('{{:,}}', CAST(floor(total / 1000) * 1000 AS BIGINT)) || '+' END AS line FROM g""")
def value_line(spark, folder):
    """The defensible "£N+" line per category."""
    draws = _draws(spark, folder).withColumn("prize_description", F.lit(None).cast("string"))
    return C.value_line(draws)


@query("image_ranking", """
WITH c AS (SELECT l_orderkey AS page, ((l_orderkey*10+l_linenumber)*100000+l_partkey)*10000+l_suppkey AS seq, l_extendedprice AS tie, l_linenumber AS n, l_partkey, l_suppkey % 30 AS f, p_name,
   CASE l_linenumber WHEN 1 THEN 'og' WHEN 2 THEN 'link' ELSE 'img' END AS hint, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 10000 END AS area FROM lineitem JOIN part ON l_partkey = p_partkey),
 s AS (SELECT page, seq, hint, CASE WHEN n = 4 THEN split_part(p_name, ' ', 2) || '-' ELSE 'f' END || f AS stem,
   CASE WHEN area > 0 THEN area ELSE 450000 END - CASE WHEN hint = 'og' THEN 250000 ELSE 0 END + CASE WHEN hint = 'link' THEN 300000 ELSE 0 END + CASE WHEN n = 4 THEN 5000000 ELSE 0 END AS score FROM c WHERE n <> 7),
 b AS (SELECT *, row_number() OVER (PARTITION BY page, stem ORDER BY score DESC, seq) AS rn FROM s),
 r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, seq) AS rank FROM b WHERE rn = 1)
SELECT page, 'https://x.example/wp-content/uploads/' || stem || '.jpg' AS url, hint, score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3""")
def image_ranking(spark, folder):
    """Best pictures of every page."""
    rows = spread(table(spark, folder, "lineitem")).join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    n = F.col("l_linenumber")
    stem = F.concat(F.when(n == 4, F.concat(F.split("p_name", " ")[1], F.lit("-"))).otherwise(F.lit("f")), F.col("l_suppkey") % 30)
    url = F.concat(F.lit("https://x.example/wp-content/uploads/"), F.when(n == 7, F.lit("logo-")).otherwise(F.lit("")), stem, F.when(n % 2 == 1, F.lit("-300x200.jpg")).otherwise(F.lit(".jpg")))
    candidates = rows.select(
        F.col("l_orderkey").alias("page"), F.expr("((l_orderkey*10+l_linenumber)*100000+l_partkey)*10000+l_suppkey").alias("seq"), F.concat(F.lit("Win the "), F.split("p_name", " ")[1]).alias("title"), url.alias("url"),
        F.when(n % 2 == 0, 0).otherwise(F.col("l_quantity").cast("bigint")).alias("width"), F.lit(10000).alias("height"),
        F.when(n == 1, F.lit("og")).when(n == 2, F.lit("link")).otherwise(F.lit("img")).alias("hint"),
    )
    return C.rank_images(candidates, limit=3).select("page", "url", "hint", "score", "rank")


POSTS = """SELECT CAST(ts AS DATE) AS date, CASE event_type WHEN 'view' THEN 'carousel' WHEN 'click' THEN 'reel' ELSE 'story' END AS format, CASE WHEN event_id % 3 > 0 THEN concat('cat-', user_id % 5) END AS category,
  concat('m', event_id) AS ig_media_id, CASE WHEN event_id % 4 = 0 AND day(ts) % 3 = 0 THEN 'pending' WHEN event_id % 4 = 1 THEN 'skipped' ELSE 'published' END AS status, ts AS posted_at, event_id FROM {events}"""
POSTS_CTE = f"posts AS ({for_duck(POSTS, 'events')})"
TODAY = "2024-01-20"


def _posts(spark, folder):
    posts = view(spark, folder, POSTS, "events").withColumn("posted_at", F.col("posted_at").cast("timestamp"))
    return posts.withColumn("draw_slugs", F.array(F.concat(F.lit("s"), F.col("event_id") % 97), F.concat(F.lit("s"), F.col("event_id") % 89)))


@query("recent_slugs", f"""
WITH {POSTS_CTE} SELECT DISTINCT unnest([concat('s', event_id % 97), concat('s', event_id % 89)]) AS slug FROM posts WHERE date >= DATE '{TODAY}' - 7 AND date <= DATE '{TODAY}'""")
def recent_slugs(spark, folder):
    """Slugs shown in the last week."""
    return C.recent_slugs(_posts(spark, folder).where(f"date <= DATE '{TODAY}'"), TODAY)


@query("last_category", f"""
WITH {POSTS_CTE} SELECT category FROM posts WHERE date <= DATE '{TODAY}' AND date >= DATE '{TODAY}' - 3 AND category IS NOT NULL ORDER BY date DESC, format DESC, category DESC LIMIT 1""")
def last_category(spark, folder):
    """Category of the latest post that has one."""
    return C.last_category(_posts(spark, folder).where(f"date <= DATE '{TODAY}'"), TODAY)


@query("daily_report", f"""
WITH {POSTS_CTE}, p AS (SELECT date AS day, format, category, ig_media_id FROM posts WHERE date >= DATE '{TODAY}' - 7),
 m AS (SELECT CAST(ts AS DATE) AS day, concat('m', event_id) AS media_id, CAST(user_id AS DOUBLE) AS likes, value AS comments FROM events WHERE CAST(ts AS DATE) >= DATE '{TODAY}' - 7),
 reach AS (SELECT CAST(ts AS DATE) AS day, max(value) AS reach FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) >= DATE '{TODAY}' - 7 GROUP BY 1),
 days AS (SELECT day FROM m UNION SELECT day FROM reach)
SELECT coalesce(p.day, days.day) AS day, format, category, ig_media_id, reach, likes, comments FROM p FULL JOIN days USING (day) LEFT JOIN m ON m.day = coalesce(p.day, days.day) AND m.media_id = p.ig_media_id LEFT JOIN reach ON reach.day = coalesce(p.day, days.day)""")
def daily_report(spark, folder):
    """Posts joined to account reach and to their likes and comments, by day."""
    events = table(spark, folder, "events")
    day, media = F.col("ts").cast("date").alias("day"), F.concat(F.lit("m"), "event_id").alias("media_id")
    pairs = F.inline(F.array(F.struct(F.lit("likes").alias("metric"), F.col("user_id").cast("double").alias("value")), F.struct(F.lit("comments").alias("metric"), F.col("value").alias("value"))))
    metrics = events.select(day, media, pairs)
    reach = events.where("event_type = 'purchase'").select(day, F.lit("account").alias("media_id"), F.lit("reach").alias("metric"), "value")
    return C.daily_report(_posts(spark, folder), metrics.unionByName(reach), TODAY)


@query("post_freshness", f"""
WITH {POSTS_CTE}, l AS (SELECT max(posted_at) AS t FROM posts WHERE status = 'published')
SELECT floor(date_diff('second', date_trunc('second', t), TIMESTAMP '2024-02-20 00:00:00') / 3600.0 * 100 + 0.5) / 100 AS hours, date_diff('second', t, TIMESTAMP '2024-02-20 00:00:00') / 3600.0 > 36 AS stale FROM l""")
def post_freshness(spark, folder):
    """Hours since the last published post."""
    return P.post_freshness(_posts(spark, folder), "2024-02-20 00:00:00").select("hours", "stale")


@query("cleanup_ready", f"""
WITH {POSTS_CTE} SELECT date, format, count(*) AS posts, bool_and(status <> 'pending') AND bool_or(status = 'published') AS ready FROM posts GROUP BY 1, 2""")
def cleanup_ready(spark, folder):
    """Days and formats whose posts are all finished, with one published."""
    posts = _posts(spark, folder).withColumn("key", F.struct("date", "format"))
    return P.cleanup_ready(posts, "key").select("key.date", "key.format", "posts", "ready")


@query("archetypes", """
SELECT o_orderkey, (['question', 'price-anchor', 'deadline', 'absurd-comparison'])[(dayofyear(CAST(o_orderdate AS DATE)) - 1) % 4 + 1] AS archetype FROM orders""")
def archetypes(spark, folder):
    """Text style of each day."""
    return table(spark, folder, "orders").select("o_orderkey", C.archetype(F.col("o_orderdate").cast("date")).alias("archetype"))


@query("near_dup_descriptions", r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM w),
 n AS (SELECT doc_id, len(s) AS n FROM s), e AS (SELECT doc_id, unnest(s) AS g FROM s),
 k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
 ends AS (SELECT a AS f, b AS t FROM l UNION ALL SELECT b, a FROM l)
SELECT n.doc_id, n.n AS n_shingles, min(t) FILTER (t < n.doc_id) AS copy_of, count(t) AS links FROM n LEFT JOIN ends ON f = n.doc_id GROUP BY 1, 2""")
def near_dup_descriptions(spark, folder):
    """Which descriptions nearly repeat another one, and the first of those."""
    return near_copies(table(spark, folder, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
