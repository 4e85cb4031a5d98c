"""Dedupe, gates, ranks and caps over the listings view."""

from pyspark.sql import functions as F

from listflow.functions import text as X
from listflow.functions.base import number_text
from listflow.operators import dedupe as D
from listflow.operators import gates as G
from listflow.operators import ranking as K
from listflow.plans import content as C
from listflow.plans import reports as P

from .inputs import DEDUPED_CTE, GATED_CTE, LISTINGS_CTE, NOW, listings, stamped, table
from .registry import query



def _order():
    return [F.col("seq"), F.col("tie")]


def _unique(spark, folder, dropped=None):
    return D.dedupe(listings(spark, folder), seq=_order(), dropped=dropped)


def _written(rows):
    """Rows that are read several times, deduplicated once."""
    K.ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def _gated(spark, folder):
    return G.gate(stamped(_unique(spark, folder)), G.GateConfig(now=NOW))


@query("permalink_dedupe", f"""
WITH {DEDUPED_CTE}
SELECT op_slug, k AS permalink, seq, CAST(copies - 1 AS BIGINT) AS dropped FROM unique_listings""")
def permalink_dedupe(spark, folder):
    """Most complete read per operator and canonical URL, and how many it hides."""
    out = _unique(spark, folder, "dropped")
    return out.select("op_slug", X.permalink_key("entry_url").alias("permalink"), "seq", "dropped")


@query("gate_reasons", f"""
WITH {GATED_CTE}
SELECT seq, stage, stage = 'ok' AS pass, array_to_string(reasons, '; ') AS reasons FROM gated""")
def gate_reasons(spark, folder):
    """First failing stage and every reason of it."""
    return _gated(spark, folder).select("seq", "stage", "pass", F.array_join("reasons", "; ").alias("reasons"))


@query("skip_reasons", f"""
WITH {GATED_CTE}, r AS (SELECT op_slug, stage, unnest(reasons) AS reason FROM gated WHERE stage <> 'ok')
SELECT op_slug, stage, reason, count(*) AS n FROM r GROUP BY ALL""")
def skip_reasons(spark, folder):
    """Which listings survive dedupe and gates, and why the rest were skipped."""
    return P.skip_reasons(_gated(spark, folder))


@query("relaxed_gate", f"""
WITH {DEDUPED_CTE}
SELECT seq, array_to_string(list_filter([
    CASE WHEN coalesce(ticket_price, 0) <= 0 THEN 'ticket_price>0' END,
    CASE WHEN image_url = '' THEN 'image_url' END,
    CASE WHEN CAST(draw_day AS DATE) < DATE '2026-08-01' THEN 'draw_date in past' END], lambda x: x IS NOT NULL), '; ') AS refused
FROM unique_listings""")
def relaxed_gate(spark, folder):
    """Intake of hand-read listings: no cap needed, 90 days ahead."""
    out = G.relaxed_gate(stamped(_unique(spark, folder)), G.GateConfig(now=NOW))
    return out.select("seq", F.array_join("refused", "; ").alias("refused"))


@query("operator_sample", f"""
WITH {LISTINGS_CTE}, p AS (SELECT *, row_number() OVER (PARTITION BY op_slug ORDER BY seq, tie) AS rn FROM listings)
SELECT op_slug, seq, ticket_price FROM p WHERE rn <= 3""")
def operator_sample(spark, folder):
    """First three reads of every operator."""
    out = D.sample_per_group(listings(spark, folder), "op_slug", 3, _order())
    return out.select("op_slug", "seq", "ticket_price")


@query("soonest_closing", f"""
WITH {LISTINGS_CTE}, p AS (SELECT *, row_number() OVER (PARTITION BY op_slug ORDER BY draw_day, seq, tie) AS rn FROM listings)
SELECT op_slug, seq, draw_day FROM p WHERE rn = 1""")
def soonest_closing(spark, folder):
    """Listing of every operator that closes first."""
    rows = stamped(listings(spark, folder))
    out = C.soonest(rows, ["op_slug"], "seq", "tie")
    return out.select("op_slug", "seq", "draw_day")


@query("known_split", f"""
WITH {DEDUPED_CTE}, known AS (SELECT DISTINCT k FROM unique_listings WHERE total_entries >= 1800)
SELECT op_slug, k IN (SELECT k FROM known) AS known, count(*) AS n FROM unique_listings GROUP BY ALL""")
def known_split(spark, folder):
    """Already stored against new listings, by canonical URL."""
    rows = _written(_unique(spark, folder))
    out = D.split_known(rows, rows.where("total_entries >= 1800"))
    return out.groupBy("op_slug", "known").agg(F.count(F.lit(1)).alias("n"))


@query("known_first_cap", f"""
WITH {DEDUPED_CTE}, flagged AS (SELECT *, coalesce(total_entries >= 1800, false) AS known FROM unique_listings),
 placed2 AS (SELECT seq, op_slug, known, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY op_slug) AS held,
   row_number() OVER (PARTITION BY op_slug, known ORDER BY seq) AS place FROM flagged)
SELECT seq, op_slug, known FROM placed2 WHERE known OR place <= 150 - held""")
def known_first_cap(spark, folder):
    """Every known listing, then new ones up to the operator's cap."""
    rows = _unique(spark, folder).withColumn("known", F.coalesce(F.col("total_entries") >= 1800, F.lit(False)))
    return D.known_first(rows, 150).select("seq", "op_slug", "known")


SLUG_BASE = "substr(substr(trim(regexp_replace(replace(lower(title), '&', ' and '), '[^a-z0-9]+', '-', 'g'), '-'), 1, greatest(8, 119 - length(op_slug))) || '-' || op_slug, 1, 120)"


@query("slug_assignment", f"""
WITH {DEDUPED_CTE}, based AS (SELECT *, {SLUG_BASE} AS base FROM unique_listings),
 used AS (SELECT DISTINCT base, u FROM based, (SELECT unnest([1, 2, 5]) AS u) WHERE seq % 3 = 0),
 ranked AS (SELECT seq, base, row_number() OVER (PARTITION BY base ORDER BY seq) AS r FROM based),
 free AS (SELECT base, n, row_number() OVER (PARTITION BY base ORDER BY n) AS r
          FROM (SELECT DISTINCT b.base, n.n FROM (SELECT DISTINCT base FROM based) b, (SELECT unnest(range(1, 600)) AS n) n) x
          WHERE NOT EXISTS (SELECT 1 FROM used WHERE used.base = x.base AND used.u = x.n))
SELECT seq, base || CASE WHEN n = 1 THEN '' ELSE '-' || n END AS slug FROM ranked JOIN free USING (base, r)""")
def slug_assignment(spark, folder):
    """Unique slugs; numbers that stored slugs use are skipped."""
    rows = _written(_unique(spark, folder))
    base = X.make_slug("title", "op_slug")
    taken = rows.where("seq % 3 = 0").select(F.explode(F.array(base, F.concat(base, F.lit("-2")), F.concat(base, F.lit("-5")))).alias("slug")).distinct()
    return D.assign_slugs(rows, taken).select("seq", "slug")


@query("page_stop", """
WITH o AS (SELECT o_custkey % 40 AS op, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) - 1 AS pos FROM orders),
 pages AS (SELECT op, CAST(pos // 20 + 1 AS BIGINT) AS page, count(*) AS returned, count(*) FILTER (o_orderstatus = 'F' AND op % 3 > 0) AS live FROM o GROUP BY 1, 2),
 s AS (SELECT *, sum(live) OVER w AS seen, lag(live) OVER w AS prev FROM pages WHERE page <= 5 WINDOW w AS (PARTITION BY op ORDER BY page)),
 t AS (SELECT *, CASE WHEN returned < 20 THEN 'last page' WHEN seen >= 25 + op THEN 'target reached' WHEN page >= 5 THEN 'page cap'
        WHEN live = 0 AND prev = 0 THEN 'two pages with no live products' END AS stop FROM s),
 u AS (SELECT *, coalesce(max(CASE WHEN stop IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY op ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM t)
SELECT concat('op-', op) AS op_slug, page, returned, live, stop FROM u WHERE ended = 0""")
def page_stop(spark, folder):
    """Pages of a newest-first archive that a walk reads, with its stop reason."""
    orders = table(spark, folder, "orders").withColumn("op", F.col("o_custkey") % 40)
    placed = K.ranked(orders, ["op"], "o_orderkey", "pos")
    page = F.floor((F.col("pos") - 1) / 20) + 1
    live = F.count_if((F.col("o_orderstatus") == "F") & (F.col("op") % 3 > 0))
    pages = placed.groupBy("op", page.alias("page")).agg(F.count(F.lit(1)).alias("returned"), live.alias("live"))
    pages = pages.withColumn("op_slug", F.concat(F.lit("op-"), "op"))
    walked = D.archive_pages(pages, F.lit(25) + F.col("op"), 5, 20)
    return walked.select("op_slug", "page", "returned", "live", "stop")


@query("page_budget", """
WITH c AS (SELECT o_custkey AS op, count(*) AS pages FROM orders GROUP BY 1),
 r AS (SELECT *, coalesce(sum(pages) OVER (ORDER BY op ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT op, pages FROM r WHERE before < 5000""")
def page_budget(spark, folder):
    """Operators that start before the run's page budget is spent."""
    counts = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("op")).agg(F.count(F.lit(1)).alias("pages"))
    return D.page_budget(counts, 5000, "op").select("op", "pages")


@query("run_caps", f"""
WITH {LISTINGS_CTE}, e AS (SELECT seq, op_slug, row_number() OVER (ORDER BY seq) AS rn FROM listings WHERE total_entries >= 1500 AND ticket_price > 0)
SELECT seq, op_slug FROM e WHERE rn <= 200""")
def run_caps(spark, folder):
    """The first 200 publishable reads in processing order."""
    rows = listings(spark, folder)
    eligible = (F.col("total_entries") >= 1500) & (F.col("ticket_price") > 0)
    return K.within_cap(rows, eligible, "seq", 200, "go").where("go").select("seq", "op_slug")


@query("systematic_sample", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
   row_number() OVER (ORDER BY l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS rn FROM lineitem),
 n AS (SELECT greatest(1, count(*) // 12) AS k FROM lineitem)
SELECT l_partkey, l_suppkey, l_orderkey FROM p, n WHERE (rn - 1) % k = 0 AND rn <= k * 12""")
def systematic_sample(spark, folder):
    """About twelve evenly spaced rows of the ordered table."""
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    order = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return D.systematic_sample(rows, order).select("l_partkey", "l_suppkey", "l_orderkey")


@query("field_flags", f"""
WITH {LISTINGS_CTE}, f AS (SELECT *, CASE WHEN seq % 5 = 0 THEN 'house-draws' WHEN seq % 5 = 1 THEN 'car-draws' WHEN seq % 5 = 2 THEN 'toys' END AS category,
  coalesce(ticket_price, 0) * coalesce(total_entries, 0) AS pool FROM listings)
SELECT seq, array_to_string(list_filter([
  CASE WHEN ticket_price > 50 THEN concat('ticket £', CASE WHEN ticket_price = floor(ticket_price) THEN CAST(CAST(ticket_price AS BIGINT) AS VARCHAR) ELSE CAST(ticket_price AS VARCHAR) END, ' >£50?') END,
  CASE WHEN category IN ('car-draws', 'house-draws') AND pool < 5000 THEN concat(category, ' pool only £', CAST(floor(pool + 0.5) AS BIGINT)) END,
  CASE WHEN image_url = '' THEN 'missing/bad image' END,
  CASE WHEN category = 'toys' THEN 'bad category toys' END,
  'thin description',
  CASE WHEN category IS NULL THEN 'no category evidence' END], lambda x: x IS NOT NULL), '; ') AS flags, tie FROM f""")
def field_flags(spark, folder):
    """Suspicions that hold a listing as a draft."""
    rows = listings(spark, folder)
    category = F.when(F.col("seq") % 5 == 0, F.lit("house-draws")).when(F.col("seq") % 5 == 1, F.lit("car-draws")).when(F.col("seq") % 5 == 2, F.lit("toys"))
    rows = rows.withColumn("category", category).withColumn("description", F.lit(None).cast("string"))
    flags = G.field_flags(F.lit(None).cast("string"))
    return rows.select("seq", "tie", F.array_join(flags, "; ").alias("flags"))


@query("onboard_verdict", f"""
WITH {GATED_CTE}, g AS (SELECT concat(op_slug, '-', CAST(CAST(substr(draw_day, 9, 2) AS INT) % 7 AS VARCHAR)) AS op, stage = 'ok' AS pass,
   CASE WHEN seq % 9 > 0 THEN 'luxury' END AS category FROM gated),
 a AS (SELECT op AS op_slug, count(*) AS scraped, count(*) FILTER (pass) AS passed, count(*) FILTER (pass AND category IS NULL) AS uncategorised FROM g GROUP BY 1)
SELECT *, CASE WHEN passed = 0 THEN concat('BLOCKED(all ', scraped, ' scraped draw(s) failed the gate)')
  WHEN passed < scraped OR uncategorised > 0 THEN 'NEEDS-CONFIG' ELSE 'READY' END AS verdict FROM a""")
def onboard_verdict(spark, folder):
    """READY, NEEDS-CONFIG or BLOCKED per operator after a trial read."""
    rows = _gated(spark, folder)
    op = F.concat("op_slug", F.lit("-"), (F.substring("draw_day", 9, 2).cast("int") % 7).cast("string"))
    rows = rows.withColumn("category", F.when(F.col("seq") % 9 > 0, F.lit("luxury"))).withColumn("op_slug", op)
    return P.onboard_verdict(rows)
