"""Whole jobs, end to end, on the given tables."""

from pyspark.sql import functions as F

from listflow.plans import jobs as J
from listflow.plans import storage as ST

from . import catalogue as C
from . import lifecycle as L
from .inputs import table
from .registry import SQL, query

TODAY = "2026-08-01"


@query("job_ended_sweep", f"""
SELECT k, why FROM ({SQL["ended_decisions"]}) WHERE ended AND k % 5 > 0""")
def job_ended_sweep(spark, folder):
    """Drafts that a sweep of feeds and pages marks as ended."""
    return J.ended_sweep(*L.ended_frames(spark, folder)).select("k", "why")


@query("job_audit", f"""
SELECT measure, n FROM ({SQL["coverage_totals"]})
UNION ALL SELECT 'scoreboard', count(*) FROM ({SQL["scoreboard"]}) UNION ALL SELECT 'prune', count(*) FILTER (flag <> '') FROM ({SQL["scoreboard"]})""")
def job_audit(spark, folder):
    """Coverage totals and the length of the scoreboard and of its prune list."""
    stored, config = C._operators(spark, folder)
    audit = J.audit(C._draws(spark, folder), stored, config, C.NOW)
    board = audit["scoreboard"].agg(F.count(F.lit(1)).alias("scoreboard"), F.count_if(F.col("flag") != "").alias("prune"))
    board = board.select(F.inline(F.array(*[F.struct(F.lit(x).alias("measure"), F.col(x).alias("n")) for x in ("scoreboard", "prune")])))
    return audit["totals"].select("measure", F.col("n").cast("bigint").alias("n")).unionByName(board)


@query("job_patrol", f"""
WITH {L.TITLES_CTE}, h AS (SELECT *, list_reduce(list_concat([0::BIGINT], list_transform(string_split(id, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda h, u: (h * 31 + u) & 4294967295) % 2 AS half FROM ruled)
SELECT 'drift' AS list, seq, tie FROM ruled WHERE status = 'active' AND coalesce(category_source, 'rule') = 'rule' AND evidence IS NOT NULL AND evidence IS DISTINCT FROM category_slug
UNION ALL SELECT 'sample', seq, tie FROM h WHERE status = 'active' AND half = ((dayofyear(DATE '{TODAY}') - 1) // 7) % 2""")
def job_patrol(spark, folder):
    """The week's worklists: drifted categories, and the half of the live rows whose turn it is."""
    lists = J.patrol(L._titles(spark, folder), TODAY)
    return lists["drift"].select(F.lit("drift").alias("list"), "seq", "tie").unionByName(lists["sample"].select(F.lit("sample").alias("list"), "seq", "tie"))


@query("job_storage_plan", SQL["storage_totals"])
def job_storage_plan(spark, folder):
    """Objects and bytes to keep and to delete, after the guard on the reference scan."""
    objects, tables = C._objects(spark, folder)
    return J.storage_plan(objects, tables, C.PREFIX, "2026-08-01 00:00:00")["totals"]


@query("image_repair_plan", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'adapter' WHEN o_orderkey % 3 = 0 THEN 'page' WHEN o_orderkey % 5 = 0 THEN 'product' WHEN o_orderkey % 7 = 0 THEN 'archive' END AS source,
  CASE WHEN o_orderkey % 2 = 0 THEN 'https://a.example/' WHEN o_orderkey % 3 = 0 THEN 'https://p.example/' WHEN o_orderkey % 5 = 0 THEN 'https://w.example/' WHEN o_orderkey % 7 = 0 THEN 'https://z.example/' END || o_orderkey || '.jpg' AS found_image
FROM orders WHERE o_orderkey % 4 > 0 AND o_orderstatus IN ('O', 'F')""")
def image_repair_plan(spark, folder):
    """New images for all rows that point at a dead store; sides name a key twice."""
    k = F.col("o_orderkey")
    orders = table(spark, folder, "orders")
    url = F.concat(F.lit("https://op.example/product/p"), k)
    picture = lambda host: F.concat(F.lit(f"https://{host}.example/"), k, F.lit(".jpg"))
    og = lambda host: F.concat(F.lit('<meta property="og:image" content="'), picture(host), F.lit('">'))
    image = F.when(k % 4 > 0, "https://dead.example/x.png").otherwise("https://img.example/x.png")
    draws = orders.select(k.alias("id"), F.concat(url, F.lit("/")).alias("entry_url"), image.alias("image_url"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("draw_date"))
    adapters = orders.where(k % 2 == 0).select(F.upper(url).alias("entry_url"), picture("a").alias("image_url"))
    pages = orders.where(k % 3 == 0).select(url.alias("entry_url"), og("p").alias("html"))
    products = orders.where(k % 5 == 0).select(F.concat(F.lit("https://op.example/p"), k).alias("product_key"), picture("w").alias("image_url"))
    archive = orders.where(k % 7 == 0).select(url.alias("entry_url"), og("z").alias("html"))
    return ST.image_repair_plan(draws, "dead.example", ["O", "F"], adapters.unionByName(adapters), pages.unionByName(pages), products, archive)
