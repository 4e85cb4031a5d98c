"""Agreement, correction, relisting, reconciliation, category and prize repair."""

from pyspark.sql import functions as F

from listflow.functions import rules
from listflow.functions import text as X
from listflow.functions.classify import with_category_evidence, with_label_category, resolve_category, with_category
from listflow.functions.dates import week_parity
from listflow.operators import gates as G
from listflow.operators import reconcile as R
from listflow.sources import sinks as S

from .inputs import OBSERVATIONS_CTE, PAIRED_CTE, for_duck, observations, table, view
from .registry import query

# Stored and fresh read side by side, as the agreement operator wants them.
PAIRS_CTE = f"""{PAIRED_CTE},
pairs AS (SELECT *, floor(s_price * 100 + 0.5) <> floor(price * 100 + 0.5) AS d_price, s_entries <> entries AS d_entries, s_day <> day AS d_day,
   CASE WHEN part_id % 2 = 0 THEN floor(s_price * s_entries * 100 + 0.5) / 100 ELSE 100.0 END AS s_pool,
   CASE WHEN part_id % 11 = 0 THEN '' ELSE concat('https://img.example/', part_id, '.webp') END AS image_url,
   CASE part_id % 4 WHEN 0 THEN 'claude' WHEN 1 THEN 'rule' END AS s_source FROM reads),
num AS (SELECT *,
   CASE WHEN s_price = floor(s_price) THEN CAST(CAST(s_price AS BIGINT) AS VARCHAR) ELSE CAST(s_price AS VARCHAR) END AS s_price_text,
   CASE WHEN price = floor(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR) ELSE CAST(price AS VARCHAR) END AS price_text,
   list_filter([CASE WHEN image_url = '' THEN 'missing/bad image' END, CASE WHEN part_id % 13 = 0 THEN 'thin description' END], lambda x: x IS NOT NULL) AS flags FROM pairs),
verdicts AS (SELECT *, list_concat(list_filter([
    CASE WHEN d_price THEN concat('ticket_price ', s_price_text, ' → ', price_text) END,
    CASE WHEN d_entries THEN concat('total_entries ', s_entries, ' → ', entries, ' (a cap does not move — likely a stock counter)') END,
    CASE WHEN d_day THEN concat('draw_date ', s_day, ' → ', day) END,
    CASE WHEN CAST(day AS DATE) + INTERVAL 19 HOUR < TIMESTAMP '2026-08-08 14:00:00' THEN 'closes too soon to publish' END], lambda x: x IS NOT NULL), flags) AS reasons,
   list_filter([CASE WHEN d_price THEN 'ticket_price' END, CASE WHEN d_entries THEN 'total_entries' END, CASE WHEN d_day THEN 'draw_date' END], lambda x: x IS NOT NULL) AS drift FROM num)"""
LATER = "2026-08-08 12:00:00"


def _sides(spark, folder):
    """Stored rows and gated fresh reads of the same parts."""
    reads = observations(spark, folder)
    image = F.when(F.col("part_id") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("https://img.example/"), "part_id", F.lit(".webp")))
    described = F.when(F.col("part_id") % 13 == 0, F.lit("short")).otherwise(F.lit("A description that is long enough."))
    pool = F.floor(F.col("ticket_price") * F.col("total_entries") * 100 + 0.5) / 100
    url = F.concat(F.lit("https://op.example/p/"), "part_id")
    stored = reads.where("obs_no = 1").select(
        "id", url.alias("entry_url"), "status", "title", "ticket_price", "total_entries", "draw_date",
        F.when(F.col("part_id") % 2 == 0, pool).otherwise(F.lit(100.0)).alias("total_prize_value"),
        described.alias("prize_description"),
        F.lit("cat").alias("category_id"),
        F.when(F.col("part_id") % 4 == 0, F.lit("claude")).when(F.col("part_id") % 4 == 1, F.lit("rule")).alias("category_source"),
    )
    fresh = reads.where("obs_no = 2").select(
        F.col("part_id").alias("seq"), url.alias("entry_url"), "title", F.col("title").alias("grand_prize"), "ticket_price", "total_entries",
        "draw_date", image.alias("image_url"), F.lit("cash-prizes").alias("category"), F.lit(None).cast("string").alias("description"),
    )
    return fresh, stored


def _compared(spark, folder):
    fresh, stored = _sides(spark, folder)
    return R.with_agreement(R.with_stored(fresh, stored), LATER)


@query("agreement", f"""
WITH {PAIRS_CTE}
SELECT id, s_status AS status, len(reasons) = 0 AS publish, array_to_string(reasons, '; ') AS reasons, array_to_string(drift, ',') AS drift FROM verdicts""")
def agreement(spark, folder):
    """Does the second read of a listing agree with the stored one, and if not, why?"""
    out = _compared(spark, folder)
    return out.select(F.col("s_id").alias("id"), F.col("s_status").alias("status"), "publish", F.array_join("reasons", "; ").alias("reasons"), F.array_join("drift_fields", ",").alias("drift"))


@query("drift_values", f"""
WITH {PAIRS_CTE}
SELECT id, 'total_entries' AS field, CAST(s_entries AS VARCHAR) AS old, CAST(entries AS VARCHAR) AS new FROM verdicts WHERE d_entries
UNION ALL SELECT id, 'draw_date', s_day || 'T20:00:00+01:00', day || 'T20:00:00+01:00' FROM verdicts WHERE d_day
UNION ALL SELECT id, 'ticket_price', CAST(s_price AS VARCHAR), CAST(price AS VARCHAR) FROM verdicts WHERE d_price""")
def drift_values(spark, folder):
    """Old and new value of every moved field."""
    out = _compared(spark, folder).select(F.col("s_id").alias("id"), F.explode(R.drift_map()).alias("field", "v"))
    return out.select("id", "field", F.col("v.old").alias("old"), F.col("v.new").alias("new"))


@query("hold_reason_summary", f"""
WITH {PAIRS_CTE}, r AS (SELECT unnest(reasons) AS r FROM verdicts)
SELECT trim(regexp_replace(regexp_replace(r, '\\s+[\\d.]+\\s*→.*$', ''), '\\s*\\(.*\\)$', '')) AS reason, count(*) AS n FROM r GROUP BY 1""")
def hold_reason_summary(spark, folder):
    """How often each kind of reason holds a listing."""
    return R.hold_summary(_compared(spark, folder))


@query("verdict_totals", f"""
WITH {PAIRS_CTE}, r AS (SELECT len(reasons) = 0 AS publish, unnest(reasons) AS r FROM verdicts)
SELECT trim(regexp_replace(regexp_replace(r, '\\s+[\\d.]+\\s*→.*$', ''), '\\s*\\(.*\\)$', '')) AS reason, count(*) FILTER (publish) AS published, count(*) FILTER (NOT publish) AS held FROM r GROUP BY 1
UNION ALL SELECT NULL, count(*) FILTER (len(reasons) = 0), count(*) FILTER (len(reasons) > 0) FROM verdicts""")
def verdict_totals(spark, folder):
    """Published and held reads, in all and by kind of reason."""
    return R.verdict_totals(_compared(spark, folder))


CORRECTION_CTE = f"""{PAIRS_CTE},
moved AS (SELECT *, list_concat(drift, CASE WHEN abs(s_pool - floor(price * entries * 100 + 0.5) / 100) > 0.02 THEN ['total_prize_value'] ELSE [] END) AS moved FROM verdicts),
corrected AS (SELECT *, len(moved) > 0 AND len(flags) = 0 AS correct,
  CASE WHEN len(moved) = 0 THEN 'no drift' WHEN len(flags) > 0 THEN concat('fresh read is flagged (', array_to_string(flags, '; '), ')')
       ELSE concat('clean read disagrees on ', array_to_string(moved, ', ')) END AS correct_reason FROM moved),
relisted AS (SELECT *, CASE WHEN s_status <> 'ended' THEN 'not an ended row'
    WHEN CAST(day AS DATE) + INTERVAL 19 HOUR <= TIMESTAMP '2026-08-08 12:00:00' THEN 'fresh date is not in the future'
    WHEN CAST(s_day AS DATE) + INTERVAL 19 HOUR > TIMESTAMP '2026-08-08 12:00:00' THEN 'stored draw has not run yet'
    WHEN day <= s_day THEN 'fresh date is not later than the one that ended'
    ELSE 'relisted for a later draw' END AS relist_reason FROM corrected)"""


@query("correction", f"""
WITH {CORRECTION_CTE}
SELECT id, correct, correct_reason AS reason FROM corrected WHERE s_status = 'active'""")
def correction(spark, folder):
    """Should a live listing be overwritten by this single read?"""
    out = R.with_correction(_compared(spark, folder)).where("s_status = 'active'")
    return out.select(F.col("s_id").alias("id"), "correct", F.col("correct_reason").alias("reason"))


@query("relist", f"""
WITH {CORRECTION_CTE}
SELECT id, relist_reason AS reason, relist_reason LIKE 'relisted%' AS revive FROM relisted""")
def relist(spark, folder):
    """Which ended listings come back for a later draw?"""
    fresh, stored = _sides(spark, folder)
    out = R.with_relist(R.with_stored(fresh, stored), LATER)
    return out.select(F.col("s_id").alias("id"), F.col("relist_reason").alias("reason"), "revive")


@query("reconcile_actions", f"""
WITH {CORRECTION_CTE},
 capped AS (SELECT *, CASE WHEN s_status = 'draft' AND len(reasons) = 0 THEN row_number() OVER (PARTITION BY s_status = 'draft' AND len(reasons) = 0 ORDER BY part_id) END AS p_rank,
   CASE WHEN s_status = 'active' AND correct THEN row_number() OVER (PARTITION BY s_status = 'active' AND correct ORDER BY part_id) END AS c_rank FROM relisted WHERE part_id % 17 > 0),
 acted AS (SELECT *, CASE WHEN s_status = 'ended' AND relist_reason LIKE 'relisted%' THEN 'relist' WHEN s_status = 'active' AND c_rank <= 100 THEN 'correct'
   WHEN s_status = 'draft' AND p_rank <= 50 THEN 'publish' WHEN s_status = 'draft' THEN 'refresh' ELSE 'skip' END AS action,
   CASE WHEN s_source = 'claude' THEN '' ELSE ',category_id,category_source' END AS cat FROM capped)
SELECT id, action,
  CASE WHEN s_status = 'ended' THEN relist_reason WHEN s_status = 'active' AND correct AND action = 'skip' THEN 'correction cap reached' WHEN s_status = 'active' THEN correct_reason
       WHEN action = 'publish' THEN 'verified' WHEN len(reasons) > 0 THEN array_to_string(reasons, '; ') ELSE 'run publish cap reached' END AS reason,
  CASE action WHEN 'publish' THEN 'active' WHEN 'relist' THEN 'draft' ELSE s_status END AS status,
  CASE WHEN action IN ('relist', 'publish') THEN 'title,grand_prize,ticket_price,total_entries,total_prize_value,draw_date,image_url,status' || cat
       WHEN action = 'refresh' THEN 'title,grand_prize,ticket_price,total_entries,total_prize_value,draw_date,image_url' || cat
       WHEN action = 'correct' AND moved = ['total_prize_value'] THEN 'total_prize_value'
       WHEN action = 'correct' THEN 'title,grand_prize,ticket_price,total_entries,total_prize_value,draw_date' || cat ELSE '' END AS patch FROM acted
UNION ALL SELECT NULL, 'insert', CASE WHEN len(list_filter(flags, lambda x: x <> 'thin description')) > 0 THEN 'missing/bad image; thin description' ELSE 'thin description' END, 'draft', '' FROM verdicts WHERE part_id % 17 = 0""")
def reconcile_actions(spark, folder):
    """What every fresh read does to the store, with caps and column patches."""
    fresh, stored = _sides(spark, folder)
    # every 17th part is not stored yet; the publish cap counts the others
    known = stored.where(F.substring("id", 2, 20).cast("bigint") % 17 > 0)
    # both sides come straight from the tables, so reading them for each slice costs little
    out = R.reconcile(fresh, known, R.ReconcileConfig(now=LATER, publish_cap=50, slices=4))
    return out.select(F.col("s_id").alias("id"), "action", "reason", "status", F.array_join("patch", ",").alias("patch"))


# ---- classification --------------------------------------------------------

# Titles that touch every rule, chosen by a line's numbers.
TITLES = """
SELECT ((l_orderkey*10+l_linenumber)*100000+l_partkey)*10000+l_suppkey AS seq, l_extendedprice AS tie,
  concat('id', l_orderkey, '-', l_linenumber, '-', l_partkey) AS id,
  concat(CASE l_linenumber % 3 WHEN 0 THEN 'Win ' WHEN 1 THEN 'WIN THIS ' ELSE '' END, p_name,
    CASE l_partkey % 13 WHEN 0 THEN ' LEGO Technic Ferrari' WHEN 1 THEN ' BMW M4' WHEN 2 THEN ' iPhone 16' WHEN 3 THEN ' Rolex Watch' WHEN 4 THEN ' Golf Clubs'
      WHEN 5 THEN ' VW Golf GTI' WHEN 6 THEN ' Dream Home' WHEN 7 THEN ' Dewalt Drill' WHEN 8 THEN ' £500 Cash' WHEN 9 THEN ' Van Gogh Print' WHEN 10 THEN ' MacBook Air M3' WHEN 11 THEN ' Mystery Box' ELSE '' END) AS title,
  CASE l_suppkey % 4 WHEN 0 THEN 'tax free cash' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'Hot Tub' END AS grand_prize,
  CASE l_suppkey % 6 WHEN 0 THEN 'Instant Wins' WHEN 1 THEN 'Cars' WHEN 2 THEN 'Live Draws' WHEN 3 THEN 'Golf & Fishing' WHEN 4 THEN 'Tech' ELSE NULL END AS label,
  CASE WHEN l_quantity > 45 THEN 'luxury' END AS pin,
  CASE l_returnflag WHEN 'R' THEN 'ended' WHEN 'A' THEN 'draft' ELSE 'active' END AS status,
  CASE l_orderkey % 4 WHEN 0 THEN 'rule' WHEN 1 THEN 'claude' WHEN 2 THEN 'manual' END AS category_source,
  CASE l_orderkey % 5 WHEN 0 THEN 'car-draws' WHEN 1 THEN 'cash-prizes' WHEN 2 THEN 'luxury' WHEN 3 THEN 'tech-giveaways' END AS category_slug
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""


def _duck_rules(table, text):
    cases = " ".join(f"WHEN regexp_matches({text}, '(?i){p}') THEN '{n}'" for n, p in ((n, p.replace("'", "''")) for n, p in table.items()))
    return f"CASE {cases} END"


def _hay(*parts):
    joined = " || ' ' || ".join(f"coalesce({p}, '')" for p in parts)
    return f"regexp_replace(regexp_replace({joined}, '(?i)van[\\s-]?gogh', 'vangogh', 'g'), '(?i)\\bmacbook\\s+(?:air\\s+|pro\\s+)?m\\d\\b', 'macbook', 'g')"


TITLES_CTE = f"""titles AS ({for_duck(TITLES, "lineitem", "part")}),
hay AS (SELECT *, {_hay("title", "grand_prize")} || ' ' AS h, lower(coalesce(label, '')) AS lab FROM titles),
ruled AS (SELECT *, {_duck_rules(rules.CATEGORY_RULES, "h")} AS evidence, {_duck_rules(rules.LABEL_RULES, "lab")} AS label_category FROM hay)"""


def _titles(spark, folder):
    return view(spark, folder, TITLES, "lineitem", "part")


@query("category_rules", f"""
WITH {TITLES_CTE}
SELECT seq, tie, evidence, label_category, coalesce(pin, nullif(label_category, 'cash-prizes'), evidence, label_category) AS category FROM ruled""")
def category_rules(spark, folder):
    """Evidence, label category and the resolved category of every title."""
    rows = with_category_evidence(_titles(spark, folder), url=None)
    rows = rows.withColumn("labels", F.when(F.col("label").isNotNull(), F.array("label")).otherwise(F.array().cast("array<string>")))
    rows = with_label_category(rows, "labels")
    category = resolve_category(F.col("pin"), F.col("label_category"), F.col("evidence"))
    return rows.select("seq", "tie", "evidence", "label_category", category.alias("category"))


@query("rule_fix", f"""
WITH {TITLES_CTE}, v AS (SELECT *, coalesce(pin, evidence) AS verdict FROM ruled)
SELECT seq, tie, verdict, CASE WHEN category_source IN ('claude', 'manual') THEN 'skip' WHEN verdict = category_slug THEN 'stamp' WHEN verdict IS NOT NULL THEN 'fix'
  WHEN status = 'active' THEN 'export' WHEN status = 'draft' AND category_source IS NULL AND category_slug IS NOT NULL THEN 'clear' ELSE 'skip' END AS fix FROM v""")
def rule_fix(spark, folder):
    """What the rules would do to every stored category."""
    rows = with_category(_titles(spark, folder), pinned="pin", out="verdict", url=None)
    return R.with_rule_fix(rows).select("seq", "tie", "verdict", "fix")


@query("category_drift", f"""
WITH {TITLES_CTE}
SELECT seq, tie, category_slug AS stored, evidence FROM ruled
WHERE status = 'active' AND coalesce(category_source, 'rule') = 'rule' AND evidence IS NOT NULL AND evidence IS DISTINCT FROM category_slug""")
def category_drift(spark, folder):
    """Live rows whose stored category the rules no longer support."""
    rows = with_category_evidence(_titles(spark, folder), url=None)
    return R.category_drift(rows).select("seq", "tie", F.col("category_slug").alias("stored"), "evidence")


@query("category_repair", f"""
WITH {TITLES_CTE}
SELECT seq, tie, category_slug AS stored, evidence AS proposed FROM ruled WHERE evidence <> 'cash-prizes' AND evidence IS DISTINCT FROM category_slug""")
def category_repair(spark, folder):
    """Specific categories to propose; cash is never proposed."""
    rows = with_category_evidence(_titles(spark, folder), url=None)
    return R.category_repair(rows).select("seq", "tie", F.col("category_slug").alias("stored"), F.col("evidence").alias("proposed"))


@query("prize_review", f"""
WITH {TITLES_CTE}
SELECT seq, tie, title, grand_prize FROM ruled WHERE status = 'draft' AND (trim(coalesce(grand_prize, '')) = trim(title)
  OR NOT regexp_matches(coalesce(grand_prize, ''), '(?i)£\\d|\\bcash\\b'))""")
def prize_review(spark, folder):
    """Drafts whose prize needs a person to look."""
    return R.prize_review(_titles(spark, folder)).select("seq", "tie", "title", "grand_prize")


@query("patrol_sample", """
SELECT o_orderkey, list_reduce(list_concat([0::BIGINT], list_transform(string_split(concat('draw-', o_orderkey), ''), lambda x: CAST(ascii(x) AS BIGINT))),
   lambda h, u: (h * 31 + u) & 4294967295) % 2 = ((dayofyear(CAST(o_orderdate AS DATE)) - 1) // 7) % 2 AS sampled FROM orders""")
def patrol_sample(spark, folder):
    """Half of the catalogue whose turn it is in the week of each date."""
    orders = table(spark, folder, "orders")
    even = X.in_sample(F.concat(F.lit("draw-"), "o_orderkey"), 0)
    parity = week_parity(F.col("o_orderdate").cast("date"))
    return orders.select("o_orderkey", (even.cast("int") != parity.cast("int")).alias("sampled"))


# ---- decisions and patches -------------------------------------------------


@query("apply_decisions", """
WITH rows AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'draft' ELSE 'ended' END AS status,
   CASE WHEN o_custkey % 5 = 0 THEN 'claude' WHEN o_custkey % 5 = 1 THEN 'rule' END AS source FROM orders WHERE o_orderkey % 7 > 0),
 d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'toys' ELSE 'luxury' END AS category FROM orders)
SELECT d.id, CASE WHEN category = 'toys' THEN 'invalid' WHEN rows.id IS NULL THEN 'stale: not found' WHEN source = 'claude' THEN 'stale: already judged'
  WHEN status = 'ended' THEN 'stale: ended' ELSE 'applied' END AS outcome FROM d LEFT JOIN rows USING (id)""")
def apply_decisions(spark, folder):
    """Judged categories checked against the current state of their rows."""
    orders = table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "O", F.lit("active")).when(F.col("o_orderstatus") == "F", F.lit("draft")).otherwise(F.lit("ended"))
    source = F.when(F.col("o_custkey") % 5 == 0, F.lit("claude")).when(F.col("o_custkey") % 5 == 1, F.lit("rule"))
    rows = orders.where("o_orderkey % 7 > 0").select(F.col("o_orderkey").alias("id"), status.alias("status"), source.alias("category_source"), F.lit("car-draws").alias("category_slug"))
    decisions = orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 11 == 0, F.lit("toys")).otherwise(F.lit("luxury")).alias("category"))
    return R.apply_decisions(decisions, rows).select("id", "outcome")


@query("confidence_patches", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'ended' END AS new_status,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 4 > 0 THEN concat('Prize ', o_orderkey % 3) END AS new_prize,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 3 = 0 THEN 'luxury' END AS new_category, o_orderstatus = 'P' AS review FROM orders""")
def confidence_patches(spark, folder):
    """Patches from reviewed pictures; unsure ones only go on a list."""
    orders = table(spark, folder, "orders")
    k = F.col("o_orderkey")
    results = orders.select(
        k.alias("id"), (k % 9 != 0).alias("is_live"),
        F.when(F.col("o_orderstatus") == "O", F.lit("high")).when(F.col("o_orderstatus") == "F", F.lit("medium")).alias("confidence"),
        F.when(k % 4 > 0, F.concat(F.lit(" Prize "), k % 3)).otherwise(F.lit("same")).alias("grand_prize"),
        F.when(k % 3 == 0, F.lit("luxury")).when(k % 3 == 1, F.lit("toys")).otherwise(F.lit("car-draws")).alias("category"),
        F.lit("same").alias("cur_prize"), F.lit("car-draws").alias("cur_category"),
    )
    return R.confidence_patches(results)


@query("patch_validation", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'disallowed fields: slug, id' WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'bad category_source' END AS refused FROM orders""")
def patch_validation(spark, folder):
    """Edits with unknown columns or an unknown source go to the rejects."""
    k = F.col("o_orderkey")
    fields = F.when(k % 5 == 0, F.array(F.lit("title"), F.lit("slug"), F.lit("id"))).when(k % 3 == 0, F.array(F.lit("category_id"), F.lit("category_source"))).otherwise(F.array(F.lit("status")))
    edits = table(spark, folder, "orders").select(k.alias("id"), fields.alias("fields"), F.when(k % 2 == 0, F.lit("guess")).otherwise(F.lit("manual")).alias("category_source"))
    return G.validate_patches(edits).select("id", "refused")


MERGED_SQL = """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 1),
 r AS (SELECT o_orderkey, 'N' AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(t.o_orderkey, r.o_orderkey) AS o_orderkey, coalesce(r.o_orderstatus, t.o_orderstatus) AS o_orderstatus, t.o_totalprice FROM t FULL JOIN r USING (o_orderkey)"""


@query("upsert_rows", MERGED_SQL)
def upsert_rows(spark, folder):
    """Rows merged in by key; columns they do not carry keep their value."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("N").alias("o_orderstatus"))
    return S.merge_rows(orders.where("o_orderkey % 3 <> 1"), rows, ["o_orderkey"])


def _patched(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice", "o_orderpriority")
    k = F.col("id")
    fields = F.when(k % 4 == 0, F.array(F.lit("o_orderstatus"))).when(k % 4 == 1, F.array(F.lit("o_totalprice"), F.lit("o_orderpriority"))).otherwise(F.array().cast("array<string>"))
    patches = orders.where(k % 5 > 0).select("id", F.lit("X").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority"), fields.alias("patch"))
    return orders, S.apply_patches(orders, patches)


@query("patch_columns", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 4 = 1 THEN 1.5 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 4 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def patch_columns(spark, folder):
    """Only the columns a patch names are written."""
    return _patched(spark, folder)[1]


@query("change_log", """
SELECT o_orderkey AS id, 'o_orderstatus' AS field, o_orderstatus AS old, 'X' AS new FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, NULL FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey % 4 = 1""")
def change_log(spark, folder):
    """Old and new value of every changed field."""
    before, after = _patched(spark, folder)
    return S.change_log(before, after, ["o_orderstatus", "o_orderpriority"])


@query("ended_decisions", """
WITH d AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'woo' WHEN 1 THEN 'shopify' WHEN 2 THEN 'render' END AS method,
   p_partkey % 9 = 0 AS percent, p_size % 5 > 0 AS listed, p_size % 2 = 0 AS dead FROM part)
SELECT k, CASE WHEN method = 'woo' AND listed THEN dead WHEN method = 'shopify' AND listed AND NOT percent THEN dead WHEN method = 'render' AND k % 3 > 0 THEN dead END AS ended,
  CASE WHEN method IS NULL THEN 'operator not in config' WHEN method = 'woo' AND NOT listed THEN 'product not found in API or feed'
    WHEN method = 'woo' AND dead THEN 'not purchasable (stock: 3 in stock)' WHEN method = 'woo' THEN 'purchasable'
    WHEN method = 'shopify' AND (NOT listed OR percent) THEN 'not in product feed (unverified)' WHEN method = 'shopify' AND dead THEN 'sold out / no available variant' WHEN method = 'shopify' THEN 'available'
    WHEN k % 3 = 0 THEN 'page unavailable' WHEN dead THEN 'page says finished' ELSE 'no finished marker' END AS why FROM d""")
def ended_decisions(spark, folder):
    """Three-valued "has it ended", from feeds and pages; absence proves nothing."""
    return R.ended_decision(*ended_frames(spark, folder)).select("k", "ended", "why")


def ended_frames(spark, folder):
    """Stored rows, operators, feed and pages of an ended sweep."""
    k, size = F.col("p_partkey"), F.col("p_size")
    part = table(spark, folder, "part")
    op = F.concat(F.lit("op-"), k % 4)
    slug = F.when(k % 9 == 0, F.concat(F.lit("%f0%9f-p"), k)).otherwise(F.concat(F.lit("p"), k))
    url = F.concat(F.lit("https://"), op, F.lit(".example/product/"), slug)
    dead = size % 2 == 0
    stored = part.select(k.alias("k"), op.alias("op_slug"), F.concat(url, F.lit("/")).alias("entry_url"), F.when(k % 5 == 0, "active").otherwise("draft").alias("status"))
    feed = part.where("p_size % 5 > 0 AND p_partkey % 4 < 2").select(
        op.alias("op_slug"), slug.alias("slug"), url.alias("permalink"),
        F.when(dead, F.lit("0")).alias("is_purchasable"), (~dead).alias("available"), F.lit("3 in stock").alias("stock_text"),
    )
    text = F.when(dead, F.lit("<p>This competition has now finished</p>")).otherwise(F.lit("<p>Enter now</p>"))
    pages = part.where("p_partkey % 4 = 2 AND p_partkey % 3 > 0").select(F.concat(url, F.lit("/")).alias("entry_url"), X.is_finished(text).alias("finished"))
    operators = spark.createDataFrame([("op-0", "woo"), ("op-1", "shopify"), ("op-2", "render")], "slug string, method string")
    return stored, operators, feed, pages


@query("prize_rederive", """
SELECT p_partkey AS id, 'Mega Daily Draw' AS old, CASE WHEN p_partkey % 4 < 3 THEN '£500 ' || p_brand || ' prize' ELSE 'Hamper for ' || p_brand END AS new, CASE WHEN p_partkey % 4 < 3 THEN 'api' ELSE 'og' END AS source
FROM part WHERE p_size % 3 = 0 AND (p_size % 2 = 0 OR p_partkey % 4 = 3)""")
def prize_rederive(spark, folder):
    """Concrete prizes for rows that store a slogan: feed by address or slug, else the page."""
    from listflow.operators.lookups import rederive_prizes

    part, k = table(spark, folder, "part"), F.col("p_partkey")
    title = F.when(F.col("p_size") % 3 == 0, F.lit("Mega Daily Draw")).otherwise(F.concat(F.lit("Win "), "p_name"))
    draws = part.select(k.alias("id"), F.lit("op").alias("op_slug"), F.lit("Op").alias("op_name"), title.alias("title"), title.alias("grand_prize"), F.concat(F.lit("https://www.op.example/product/P"), k, F.lit("/?x=1")).alias("entry_url"))
    copy = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("<b>£500 "), "p_brand", F.lit(" prize.</b> Good luck"))).otherwise(F.lit("Enter now"))
    feed = part.where(k % 4 < 3).select(
        F.lit("op").alias("op_slug"), F.when(k % 4 < 2, F.concat(F.lit("http://op.example/product/p"), k)).alias("permalink"), F.when(k % 4 == 2, F.concat(F.lit("p"), k)).alias("slug"), copy.alias("prize_copy")
    )
    html = F.concat(F.lit('<meta property="og:description" content="Hamper for '), "p_brand", F.lit('"><p>x</p>'))
    pages = part.select(F.concat(F.lit("https://www.op.example/product/P"), k, F.lit("/?x=1")).alias("entry_url"), html.alias("html"))
    return rederive_prizes(draws, feed, pages)


@query("dimension_lookup", """
WITH r AS (SELECT o_orderkey, concat('op-', o_custkey) AS op, CASE o_orderkey % 3 WHEN 0 THEN 'luxury' WHEN 1 THEN 'toys' END AS category FROM orders)
SELECT r.o_orderkey, c.c_custkey AS operator_id, CASE WHEN category = 'luxury' THEN 'c4' END AS category_id FROM r JOIN customer c ON r.op = concat('op-', c.c_custkey) WHERE c.c_custkey % 5 > 0""")
def dimension_lookup(spark, folder):
    """Operator and category ids; rows of unknown operators go, unknown categories stay NULL."""
    from listflow.operators.lookups import attach_ids

    k = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select("o_orderkey", F.concat(F.lit("op-"), "o_custkey").alias("op_slug"), F.when(k % 3 == 0, F.lit("luxury")).when(k % 3 == 1, F.lit("toys")).alias("category"))
    operators = table(spark, folder, "customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("id"), F.concat(F.lit("op-"), "c_custkey").alias("slug"))
    categories = spark.createDataFrame([(f"c{i}", slug) for i, slug in enumerate(rules.CATEGORIES)], "id string, slug string")
    return attach_ids(rows, operators, categories).select("o_orderkey", "operator_id", "category_id")
