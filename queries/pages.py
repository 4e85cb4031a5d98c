"""Page text, links, hosts, extraction round trips, and text scalars."""

from pyspark.sql import functions as F

from listflow.functions import dates as D
from listflow.functions import extract as E
from listflow.functions import rules
from listflow.functions import text as X
from listflow.functions.base import digits_of
from listflow.plans import content as C
from listflow.plans import discovery
from listflow.sources import pages as P

from .inputs import LISTINGS_CTE, listings, spread, stamped, table
from .registry import query

ENTITIES = ["lt", "gt", "quot", "apos", "nbsp", "pound", "euro", "hellip", "ndash", "mdash", "rsquo", "lsquo", "ldquo", "rdquo", "trade", "reg", "copy", "amp"]


def _duck_named(text):
    for name in ENTITIES:
        char = {"apos": "''"}.get(name, rules.ENTITIES[name])
        if name == "amp":  # unknown entities become a blank before "&" is decoded
            text = f"regexp_replace({text}, '(?i)&amp;', chr(1), 'g')"
            return f"replace(regexp_replace({text}, '(?i)&[a-z]+;', ' ', 'g'), chr(1), '&')"
        text = f"regexp_replace({text}, '(?i)&{name};', '{char}', 'g')"
    return text


PAGE_TEXT = "regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
PAGE_TEXT = f"trim(regexp_replace(regexp_replace({_duck_named(PAGE_TEXT)}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13))"


@query("page_text", f"SELECT page_id, md5({PAGE_TEXT}) AS digest, CAST(length({PAGE_TEXT}) AS BIGINT) AS chars FROM pages")
def page_text(spark, folder):
    """Visible text of every page."""
    text = spread(table(spark, folder, "pages")).withColumn("t", X.text_of("html"))
    return text.select("page_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("chars"))


LINKS_CTE = """l AS (SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') AS origin, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)) AS href,
   generate_subscripts(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), 1) AS pos FROM pages),
 a AS (SELECT page_id, origin, pos, regexp_replace(CASE WHEN href LIKE '/%' THEN origin || href ELSE href END, '[?#].*$', '') AS link FROM l)"""


@query("page_links", f"""
WITH {LINKS_CTE}, d AS (SELECT page_id, link, min(pos) AS pos FROM a WHERE starts_with(link, origin) AND regexp_matches(link, '(?i)/[a-z]{{3,}}$') AND NOT regexp_matches(link, '(?i)/(the|and)$') GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM d)
SELECT page_id, CAST(rn AS BIGINT) AS rank, link FROM r WHERE rn <= 4""")
def page_links(spark, folder):
    """First matching same-origin links of every page, in page order."""
    pages = spread(table(spark, folder, "pages"))
    links = X.pick_draw_links(X.page_links("html", "url"), "url", 4, r"/[a-z]{3,}$", (r"/(the|and)$",))
    out = pages.select("page_id", F.posexplode(links).alias("rank", "link"))
    return out.select("page_id", (F.col("rank") + 1).cast("bigint").alias("rank"), "link")


HOST_SQL = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', '')"


@query("page_hosts", f"""
WITH h AS (SELECT page_id, {HOST_SQL} AS host FROM pages),
 linked AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'win-' || host WHEN 1 THEN 'www.raffle-' || page_id % 9 || '.co.uk' ELSE host END AS domain FROM h)
SELECT DISTINCT regexp_replace(domain, '^www\\.', '') AS domain, concat('crosslink:p', page_id % 7) AS via FROM linked
WHERE regexp_matches(split_part(regexp_replace(domain, '^www\\.', ''), '.', 1), 'comp(etition)?s?|raffle|draw|giveaway|prize|win') AND domain <> 'www.raffle-4.co.uk'""")
def page_hosts(spark, folder):
    """Operator-like outside hosts that pages link to."""
    from listflow.sources.payloads import crosslink_candidates

    pages = spread(table(spark, folder, "pages"))
    k, host = F.col("page_id"), X.host_of("url")
    target = F.when(k % 3 == 0, F.concat(F.lit("win-"), host)).when(k % 3 == 1, F.concat(F.lit("www.raffle-"), k % 9, F.lit(".co.uk"))).otherwise(host)
    linked = pages.select(F.concat(F.lit("p"), k % 7).alias("op_slug"), F.concat("html", F.lit('<a href="https://'), target, F.lit('/x">y</a>')).alias("html"))
    exclude = spark.createDataFrame([("raffle-4.co.uk",)], "domain string")
    return crosslink_candidates(linked, exclude)


# ---- round trips: text is generated from columns and read back -------------


@query("price_roundtrip", f"""
WITH {LISTINGS_CTE}
SELECT seq, tie, CASE WHEN seq % 7 IN (3, 4) AND NOT (ticket_price > 0 AND ticket_price <= 100) THEN NULL WHEN seq % 7 = 4 THEN floor(ticket_price * 25 * 100 + 0.5) / 100 / 25 * 0 + floor(floor(ticket_price * 25 * 100 + 0.5) / 100 / 25 * 100 + 0.5) / 100 ELSE ticket_price END AS price
FROM listings""")
def price_roundtrip(spark, folder):
    """Ticket price read back from seven ways of writing it; free, unpriced and dear ones included."""
    rows = listings(spark, folder)
    k, p = F.col("seq") % 7, F.format_string("%.2f", F.col("ticket_price"))
    total = F.format_string("%.2f", F.floor(F.col("ticket_price") * 25 * 100 + 0.5) / 100)
    text = (
        F.when(k == 0, F.concat(F.lit("WIN A LAMBO + £2,000 CASH! Entries only £"), p, F.lit(" MAX 599,999")))
        .when(k == 1, F.concat(F.lit("Cash Alternative: £10,000. £"), p, F.lit(" per ticket")))
        .when(k == 2, F.concat(F.lit("Tickets are £"), p, F.lit(" each")))
        .when(k == 3, F.concat(F.lit("Win £5 cash. Pay £"), p, F.lit(" now")))
        .when(k == 4, F.concat(F.lit("X 25 TICKETS £"), total, F.lit(" ADD TO CART")))
        .otherwise(F.concat(F.lit("from £"), p, F.lit(" or so")))
    )
    rows = rows.withColumn("_t", text)
    return rows.select("seq", "tie", E.extract_price("_t").alias("price"))


@query("entries_roundtrip", f"""
WITH {LISTINGS_CTE}
SELECT seq, tie, CASE WHEN seq % 9 IN (5, 6) OR total_entries < 100 THEN NULL ELSE total_entries END AS entries, CASE WHEN seq % 9 IN (3, 4, 5, 6, 7) OR total_entries < 100 THEN NULL ELSE total_entries END AS strict
FROM listings""")
def entries_roundtrip(spark, folder):
    """Entry cap read back from nine ways of writing it; counters give NULL."""
    rows = listings(spark, folder)
    k, n = F.col("seq") % 9, F.format_number("total_entries", 0)
    text = (
        F.when(k == 0, F.concat(F.lit("Max of "), n, F.lit(" tickets available. Sold 12 so far.")))
        .when(k == 1, F.concat(F.lit("Total Entries: "), n))
        .when(k == 2, F.concat(F.lit("1500 Tickets Max Per Person. "), n, F.lit(" tickets in this draw")))
        .when(k == 3, F.concat(F.lit("sold: 2 of "), n))
        .when(k == 4, F.concat(F.lit("SOLD: 2/"), n))
        .when(k == 5, F.concat(F.lit("Hurry, only "), n, F.lit(" entries left!")))
        .when(k == 6, F.concat(n, F.lit(" tickets max per person")))
        .when(k == 7, F.concat(F.lit("there are "), n, F.lit(" tickets here")))
        .otherwise(F.concat(F.lit("just "), n, F.lit(" entries")))
    )
    rows = rows.withColumn("_t", text)
    return rows.select("seq", "tie", E.extract_entries("_t").alias("entries"), E.extract_entries("_t", True).alias("strict"))


@query("date_roundtrip", f"""
WITH {LISTINGS_CTE}
SELECT seq, tie, draw_day || 'T' || CASE seq % 8 WHEN 0 THEN '20:00' WHEN 1 THEN '21:00' WHEN 2 THEN '19:30' WHEN 3 THEN '20:00' WHEN 4 THEN '20:00' WHEN 5 THEN '09:15' WHEN 6 THEN '17:00' ELSE '20:00' END || ':00+01:00' AS draw_date FROM listings""")
def date_roundtrip(spark, folder):
    """Draw date read back from eight ways of writing it."""
    rows = listings(spark, folder)
    day, k = F.col("draw_day").cast("date"), F.col("seq") % 8
    long_date = F.concat(F.date_format(day, "d"), F.lit("th "), F.date_format(day, "MMMM yyyy"))
    text = (
        F.when(k == 0, F.concat(F.lit("Entry closes on 1st July 2026. The draw will take place "), long_date))
        .when(k == 1, F.concat(F.lit("Buy before 6pm. Draw 9pm on "), long_date))
        .when(k == 2, F.concat(F.lit("Drawn live at 19:30 on "), long_date))
        .when(k == 3, F.concat(F.lit("Competition closes "), long_date))
        .when(k == 4, F.concat(F.lit("due on "), "draw_day"))
        .when(k == 5, F.concat("draw_day", F.lit("T9:15")))
        .when(k == 6, F.concat(F.lit("on "), F.date_format(day, "dd/MM/yyyy"), F.lit(" at 5pm")))
        .otherwise(F.concat(F.lit("see you "), F.date_format(day, "d.M.yy"), F.lit(" then")))
    )
    rows = rows.withColumn("_t", text)
    return rows.select("seq", "tie", E.extract_date("_t", 2026).alias("draw_date"))


@query("attribute_dates", f"""
WITH {LISTINGS_CTE}
SELECT seq, tie, CASE seq % 4 WHEN 3 THEN draw_day || 'T17:00:00+01:00' ELSE draw_day || 'T20:00:00+01:00' END AS draw_date FROM listings""")
def attribute_dates(spark, folder):
    """Close date read from page attributes: seconds, millis, ISO and slashes."""
    rows = listings(spark, folder)
    noon = F.unix_timestamp(F.concat("draw_day", F.lit(" 20:00:00"))).cast("bigint")
    value = (
        F.when(F.col("seq") % 4 == 0, noon.cast("string"))
        .when(F.col("seq") % 4 == 1, (noon * 1000).cast("string"))
        .when(F.col("seq") % 4 == 2, F.concat("draw_day", F.lit("T20:00:00")))
        .otherwise(F.concat(F.replace("draw_day", F.lit("-"), F.lit("/")), F.lit(" 17:00:00")))
    )
    html = F.concat(F.lit('<h1>Win</h1><i data-enddate="soon"></i><i class="x" data-draw-date="'), value, F.lit('"></i><p>Draw 1st July 2026</p>'))
    rows = rows.withColumn("_h", html)
    return rows.select("seq", "tie", E.page_attribute_date("_h", 2026).alias("draw_date"))


@query("page_fields", f"""
WITH {LISTINGS_CTE}, one AS (SELECT *, 'Win ' || split_part(title, ' ', 2) || ' BMW' AS t FROM listings),
 k AS (SELECT *, (seq // 10) % 4 AS k FROM one)
SELECT seq, tie, CASE WHEN k = 2 THEN 'Mega Daily Draw' ELSE t END AS title, CASE WHEN k = 2 THEN '£500 Cash plus ' || t ELSE t END AS grand_prize,
  CASE WHEN k = 2 THEN 'prize-section' ELSE 'title' END AS grand_prize_source, 'car-draws' AS category, ticket_price,
  CASE WHEN k = 1 OR total_entries >= 100 THEN total_entries END AS total_entries, draw_day || CASE k WHEN 1 THEN 'T17:00:00+01:00' ELSE 'T20:00:00+01:00' END AS draw_date,
  CASE WHEN k = 0 THEN 'https://cdn.example/a.jpg' WHEN k = 3 THEN 'https://op.example/img/big.png' ELSE 'https://cdn.example/og.jpg' END AS image_url FROM k""")
def page_fields(spark, folder):
    """All listing fields of generated pages of four platforms, related blocks included."""
    rows = listings(spark, folder)
    title = F.concat(F.lit("Win "), F.split("title", " ")[1], F.lit(" BMW"))
    price = F.when(F.col("ticket_price").isNull(), "-").otherwise(F.format_string("%.2f", F.col("ticket_price")))
    cap, left = (F.coalesce(n.cast("string"), F.lit("-")) for n in (F.col("total_entries"), F.col("total_entries") - 10))
    day = F.col("draw_day").cast("date")
    long_date = F.concat(F.date_format(day, "d"), F.lit("th "), F.date_format(day, "MMMM yyyy"))
    k = F.floor(F.col("seq") / 10) % 4
    related = F.lit('<div class="related"><h3>Others</h3>99,999 tickets<div class="lottery-time-countdown" data-time="2026/07/05 20:00:00"></div></div>')
    others = F.lit('<div class="related"><h3>Others</h3>99,999 tickets</div>')
    og = F.lit('<meta property="og:image" content="https://cdn.example/og.jpg">')
    ld = F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":"WebPage"},{"@type":"Product","name":"'), title, F.lit('","image":["https://cdn.example/a.jpg"],"offers":[{"price":"'), price, F.lit('"}]}]}</script>'))
    html = (
        F.when(k == 0, F.concat(ld, others, F.lit("<p>Only "), cap, F.lit(" tickets available in this competition.</p><p>Live draw will take place on "), long_date, F.lit(" at 8pm.</p>")))
        .when(k == 1, F.concat(og, F.lit("<h1>"), title, F.lit("</h1>"), related, F.lit('<div class="summary"><div class="lottery-time-countdown" data-time="'), F.replace("draw_day", F.lit("-"), F.lit("/")), F.lit(' 17:00:00"></div><p>Entries only £'), price, F.lit('</p><div><b class="lty-progress-bar"></b>10 Tickets Sold '), left, F.lit(" remaining</div></div>")))
        .when(k == 2, F.concat(og, F.lit('<h1>Mega Daily Draw</h1><span class="max-tickets">Max Tickets: '), cap, F.lit('</span><h3>Prize Description</h3><p>£500 Cash plus '), title, F.lit('. Good luck!</p><i data-enddate="'), "draw_day", F.lit('T20:00:00"></i><p>from £'), price, F.lit("</p>"), related))
        .otherwise(F.concat(F.lit("<h1>"), title, F.lit('</h1><img width="10" height="10" src="/img/small.png"><img width="800" height="600" src="/img/big.png"><p>£'), price, F.lit(" per ticket. Prizes galore for everyone.</p><p>12 sold of "), cap, F.lit(" </p><p>Closes "), long_date, F.lit("</p>"), others))
    )
    pages = rows.select("seq", "tie", "op_slug", F.lit("Some Comps").alias("op_name"), F.lit("https://op.example").alias("base"), F.lit("https://op.example/product/x").alias("entry_url"), F.concat(F.lit("<html><body>"), html, F.lit("</body></html>")).alias("html"))
    out = P.fields_from_pages(pages, 2026)
    return out.select("seq", "tie", "title", "grand_prize", "grand_prize_source", "category", "ticket_price", "total_entries", "draw_date", "image_url")


@query("realised_entries", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(1000 + o_custkey AS BIGINT) WHEN 1 THEN CAST(2000 + o_custkey AS BIGINT) END AS entries FROM orders""")
def realised_entries(spark, folder):
    """Cap confirmed by sold plus remaining, else a labelled total."""
    k, n = F.col("o_orderkey"), F.col("o_custkey")
    text = (
        F.when(k % 3 == 0, F.concat(F.lit("Other 12 / 5000 and 400/"), 1000 + n, F.lit(" here")))
        .when(k % 3 == 1, F.concat(F.lit("Get "), 2000 + n, F.lit(" Max Tickets today")))
        .otherwise(F.concat(2000 + n, F.lit(" max tickets per person")))
    )
    rows = table(spark, folder, "orders").withColumn("_t", text).withColumn("_left", F.when(k % 3 == 0, 601 + n))
    return rows.select("o_orderkey", E.realised_entries("_t", "_left").alias("entries"))


@query("prize_copy", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN concat('3 × £', o_custkey, ' Cash') WHEN 1 THEN concat('£', o_custkey, ' Cash') WHEN 2 THEN concat('£', o_custkey, ' Cash') WHEN 3 THEN concat('BMW Model ', o_custkey) END AS prize FROM orders""")
def prize_copy(spark, folder):
    """Main prize named by a description."""
    k, n = F.col("o_orderkey"), F.col("o_custkey")
    text = (
        F.when(k % 5 == 0, F.concat(F.lit("We have 3 x £"), n, F.lit(" main prizes")))
        .when(k % 5 == 1, F.concat(F.lit("£"), n, F.lit(" end prize")))
        .when(k % 5 == 2, F.concat(F.lit("The main prize is £"), n))
        .when(k % 5 == 3, F.concat(F.lit("You could win a BMW Model "), n, F.lit("! Hurry")))
        .otherwise(F.lit("Win an Instant Win every day."))
    )
    rows = table(spark, folder, "orders").withColumn("_t", text)
    return rows.select("o_orderkey", E.prize_from_copy("_t").alias("prize"))


@query("detail_facts", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE CAST(1000 + o_custkey AS BIGINT) END AS entries, strftime(o_orderdate, '%d/%m/%Y') || ' 10:00pm' AS draw, '2026-07-01 10:00' || CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN strftime(o_orderdate, ',%Y-%m-%d') || 'T20:00' ELSE '' END AS dates
FROM orders""")
def detail_facts(spark, folder):
    """Cap, draw sentence and date candidates that live in the raw page."""
    orders = table(spark, folder, "orders")
    n, k = 1000 + F.col("o_custkey"), F.col("o_orderkey")
    cap = (
        F.when(k % 4 == 0, F.concat(F.lit('"numTickets":'), n)).when(k % 4 == 1, F.concat(F.lit("a maximum number of "), F.format_number(n, 0), F.lit(" entries")))
        .when(k % 4 == 2, F.concat(F.lit("Total Entries: "), n)).otherwise(F.lit("12 tickets left"))
    )
    seconds = F.unix_timestamp(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 20:00:00")))
    html = F.concat(cap, F.lit("<b>2026-07-01 10:00</b> The draw date for this competition is "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(' at 10:00 pm <i data-end-date="'), F.lpad(seconds.cast("string"), 10, "0"), F.lit('">'))
    rows = orders.withColumn("_h", html)
    return rows.select("o_orderkey", E.detail_entries("_h").alias("entries"), E.detail_draw("_h").alias("draw"), F.array_join(E.iso_candidates("_h"), ",").alias("dates"))


@query("blob_slugs", """
SELECT o_orderkey, concat('https://op.example/win/real-', o_custkey, ',https://op.example/competitions/slug-', o_orderkey) AS links FROM orders""")
def blob_slugs(spark, folder):
    """Links of a page, then links made from slugs in its data blob."""
    blob = F.concat(F.lit('<a href="/win/real-'), "o_custkey", F.lit('?x=1">x</a><a href="https://other.example/win/abcdef">y</a><script>{"slug":"slug-'), "o_orderkey", F.lit('","handle":"abc","slug":"slug-'), "o_orderkey", F.lit('"}</script><a href="/cart/">c</a>'))
    rows = spread(table(spark, folder, "orders")).select("o_orderkey", blob.alias("html"), F.lit("https://op.example").alias("base"), F.lit("/competitions/{slug}").alias("draw_url_template"))
    return P.blob_links(rows).select("o_orderkey", F.array_join("links", ",").alias("links"))


@query("platform_classes", """
SELECT CASE WHEN page_id % 7 = 0 THEN 'woo' WHEN page_id % 7 = 1 THEN 'shopify' WHEN page_id % 7 = 2 THEN 'blocked' WHEN page_id % 7 IN (3, 4) THEN 'render' WHEN page_id % 7 = 5 THEN 'data-blob' ELSE 'dead' END AS platform, count(*) AS n FROM pages GROUP BY 1""")
def platform_classes(spark, folder):
    """Platform of every captured home page."""
    pages = spread(table(spark, folder, "pages"))
    k = F.col("page_id") % 7
    extra = (
        F.when(k == 2, F.lit("<p>Just a moment</p>"))
        .when(k.isin(3, 4), F.lit('<a href="https://op.example/draw/aaaa">a</a><a href="/raffle/bbbb/">b</a><a href="/raffle/bbbb?x">b</a>'))
        .when(k == 5, F.lit('<script>{"numTickets": 5}</script>'))
        .otherwise(F.lit(""))
    )
    homes = pages.select(F.lit("https://op.example/").alias("base"), F.concat("html", extra).alias("html"), F.when(k == 0, 5).alias("woo_rows"), F.when(k == 1, 3).alias("shop_rows"))
    return P.platform_class(homes).groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@query("blocked_texts", """
SELECT doc_id, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) < 80 OR regexp_matches(text, '(?i)just a moment|attention required|cf-browser-verification|enable javascript and cookies|verifying you are human|checking your browser|access denied|request blocked') AS blocked,
  regexp_matches(text, '(?i)this competition has (?:now )?finished|competition (?:has )?finished|competition is (?:now )?closed|this draw has (?:now )?(?:ended|closed)') AS finished FROM documents""")
def blocked_texts(spark, folder):
    """Texts that show a challenge or nothing, and texts that say "finished"."""
    docs = spread(table(spark, folder, "documents"))
    return docs.select("doc_id", X.looks_blocked("text").alias("blocked"), X.is_finished("text").alias("finished"))


# ---- text scalars ----------------------------------------------------------


@query("entity_text", """
SELECT p_partkey, concat(p_name, ' & ', p_brand, ' – £5 é &unknown; &lt;') AS text FROM part""")
def entity_text(spark, folder):
    """Named, decimal and hexadecimal entities decoded once; unknown ones kept."""
    coded = F.concat(F.lit("  "), "p_name", F.lit(" &amp; "), "p_brand", F.lit("\n &#8211; &pound;5 &#xE9; &unknown; &amp;lt; "))
    return table(spark, folder, "part").select("p_partkey", X.decode_entities(coded).alias("text"))


@query("domain_names", f"""
WITH h AS (SELECT page_id, {HOST_SQL} AS domain, url FROM pages),
 s AS (SELECT *, regexp_replace(domain, '\\.(co\\.uk|org\\.uk|me\\.uk|com|co|uk|scot|online|net|io|shop|store|gg|win)$', '') AS stem FROM h)
SELECT page_id, domain, regexp_replace(stem, '[^a-z0-9]', '', 'g') AS token, trim(regexp_replace(stem, '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM s""")
def domain_names(spark, folder):
    """Host, comparable token and slug of every address."""
    rows = table(spark, folder, "pages").withColumn("domain", X.host_of("url"))
    return rows.select("page_id", "domain", X.norm_domain("domain").alias("token"), X.slug_for("domain").alias("slug"))


@query("domain_guesses", """
WITH s AS (SELECT p_partkey, replace(p_name, ' ', '-') AS slug, replace(p_name, ' ', '') AS flat FROM part)
SELECT p_partkey, concat_ws(',', flat || '.co.uk', flat || '.com', slug || '.co.uk', slug || '.com', flat || '.uk', flat || '.competitions.co.uk') AS guesses, upper(substr(split_part(slug, '-', 1), 1, 1)) || substr(split_part(slug, '-', 1), 2) || ' ' || upper(substr(split_part(slug, '-', 2), 1, 1)) || substr(split_part(slug, '-', 2), 2) AS name FROM s""")
def domain_guesses(spark, folder):
    """Likely hosts and display name of a bare slug."""
    rows = table(spark, folder, "part").withColumn("slug", F.replace("p_name", F.lit(" "), F.lit("-")))
    return rows.select("p_partkey", F.array_join(X.domains_for("slug"), ",").alias("guesses"), X.title_for("slug").alias("name"))


@query("candidate_slugs", """
SELECT slug, count(*) AS n FROM (SELECT lower(trim(unnest(string_split(regexp_replace(substr(text, 1, 100000000), '\\s+', ' ', 'g'), ' ')))) AS slug FROM documents) WHERE regexp_matches(slug, '^[a-z0-9][a-z0-9-]{2,}$') GROUP BY 1""")
def candidate_slugs(spark, folder):
    """Tokens of a text that can be operator slugs."""
    docs = spread(table(spark, folder, "documents"))
    words = docs.select(F.explode(F.split(F.regexp_replace("text", r"\s+", " "), " ")).alias("w"))
    return words.select(X.candidate_slug("w").alias("slug")).where("slug IS NOT NULL").groupBy("slug").agg(F.count(F.lit(1)).alias("n"))


@query("generic_titles", """
WITH t AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Mega Daily Draw' WHEN 1 THEN 'Win 500 Cash' WHEN 2 THEN p_name || ' raffle' WHEN 3 THEN 'Dream Comps Weekly Prize' WHEN 4 THEN 'Instant Win #12' WHEN 5 THEN '' WHEN 6 THEN '£5 Spin' ELSE 'Site Credit' END AS title FROM part)
SELECT p_partkey, title, CASE p_partkey % 8 WHEN 1 THEN false WHEN 2 THEN false WHEN 6 THEN false ELSE true END AS generic FROM t""")
def generic_titles(spark, folder):
    """Titles that name no prize."""
    k = F.col("p_partkey") % 8
    title = (
        F.when(k == 0, F.lit("Mega Daily Draw")).when(k == 1, F.lit("Win 500 Cash")).when(k == 2, F.concat("p_name", F.lit(" raffle"))).when(k == 3, F.lit("Dream Comps Weekly Prize"))
        .when(k == 4, F.lit("Instant Win #12")).when(k == 5, F.lit("")).when(k == 6, F.lit("£5 Spin")).otherwise(F.lit("Site Credit"))
    )
    rows = table(spark, folder, "part").withColumn("title", title)
    return rows.select("p_partkey", "title", X.is_generic_title("title", F.lit("Dream Comps")).alias("generic"))


@query("prize_lines", """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Win ' || source || ' now!' WHEN 1 THEN '£50 ' || lang || ' prize' WHEN 2 THEN 'A ' || source || ' hamper' END AS line FROM documents""")
def prize_lines(spark, folder):
    """First clean line of a block of prize copy."""
    k = F.col("doc_id") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit("Win "), "source", F.lit(" now!  "), "text"))
        .when(k == 1, F.concat(F.lit("£50 "), "lang", F.lit(" prize - Guaranteed draw "), F.replace("text", F.lit("."), F.lit(" "))))
        .when(k == 2, F.concat(F.lit("A "), "source", F.lit(" hamper;: ")))
        .otherwise(F.lit("Hi."))
    )
    return spread(table(spark, folder, "documents")).select("doc_id", X.clean_prize_line(raw).alias("line"))


@query("slide_labels", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name AS title, CASE WHEN l_discount = 0 THEN NULL WHEN l_discount < 1 THEN CAST(floor(l_discount * 100 + 0.5) AS BIGINT) || 'p' END AS price,
  '1 IN ' || format('{:,}', CAST(l_quantity * 100 AS BIGINT)) AS odds, CASE WHEN l_linenumber = 1 THEN '£' || (1000 + l_suppkey) || ' TAX-FREE CASH' END AS cash,
  CASE WHEN l_orderkey % 5 <= 1 THEN 'CLOSES TONIGHT' WHEN l_orderkey % 5 = 2 THEN 'CLOSES TOMORROW (SUN)' WHEN l_orderkey % 5 = 3 THEN 'CLOSES MON 3 AUG' ELSE 'CLOSES TUE 4 AUG' END AS closes, 'CAR' AS category
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def slide_labels(spark, folder):
    """Clean title, price, odds, cash alternative and closing labels."""
    rows = spread(table(spark, folder, "lineitem")).join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    title = F.concat(F.lit("WIN this "), "p_name", F.lit(" - or £2,000 cash + extras (today)!!"))
    copy = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("Car or £"), 1000 + F.col("l_suppkey"))).otherwise(F.lit("Car"))
    closes = F.concat(F.lit("2026-07-31T"), F.lit("20:00:00+01:00"))
    date = F.concat(F.date_format(F.date_add(F.lit("2026-07-31").cast("date"), (F.col("l_orderkey") % 5).cast("int")), "yyyy-MM-dd"), F.lit("T20:00:00+01:00"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.clean_title(title).alias("title"), X.price_label("l_discount").alias("price"),
        X.odds_label((F.col("l_quantity") * 100).cast("bigint")).alias("odds"), X.cash_alternative(copy).alias("cash"),
        D.closes_label(date, "2026-08-01 12:00:00").alias("closes"), X.category_label(F.lit("Car Draws")).alias("category"),
    )


@query("template_description", f"""
WITH {LISTINGS_CTE}, h AS (SELECT seq, tie, title, ticket_price, CAST(draw_day AS DATE) AS d,
   list_reduce(list_concat([2166136261::BIGINT], list_transform(string_split(title, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda h, u: (xor(h, u) * 16777619) & 4294967295) % 4 AS f FROM listings),
 s AS (SELECT *, '£' || regexp_replace(printf('%.2f', ticket_price), '\\.00$', '') AS p, strftime(d, '%A %-d %B %Y') AS w FROM h)
SELECT seq, tie, CASE f WHEN 0 THEN 'Win ' || title || ' in this UK prize draw.' || coalesce(' Tickets start from just ' || p || '.', '') || ' The winner is drawn on ' || w || '.'
  WHEN 1 THEN 'Fancy winning ' || title || '?' || coalesce(' Entries are ' || p || ' each', '') || ', with the draw taking place on ' || w || '. Enter before the tickets sell out.'
  WHEN 2 THEN 'Up for grabs: ' || title || '.' || coalesce(' Grab your tickets from ' || p, '') || ' ahead of the live draw on ' || w || '.'
  ELSE 'Here''s your chance to win ' || title || '.' || coalesce(' With tickets from ' || p || ',', '') || ' the winner is announced on ' || w || '.' END AS description FROM s""")
def template_description(spark, folder):
    """A stable blurb per listing, its frame picked by a hash."""
    rows = stamped(listings(spark, folder)).withColumn("grand_prize", F.col("title")).withColumn("slug", F.lit(""))
    return rows.select("seq", "tie", C.template_description().alias("description"))


@query("object_paths", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE concat('op-', o_custkey % 20, '/a b+', o_orderkey, '.webp') END AS path,
  CASE WHEN o_orderkey % 5 = 4 THEN concat('https://images.weserv.nl/?url=else.example%2Fx%20', o_orderkey, '.png&w=1280&output=webp&q=75&we') END AS proxied FROM orders""")
def object_paths(spark, folder):
    """Bucket path of every stored address form, and the proxy address of the others."""
    k = F.col("o_orderkey") % 5
    path = F.concat(F.lit("op-"), F.col("o_custkey") % 20, F.lit("/a%20b+"), "o_orderkey", F.lit(".webp"))
    prefix = "https://store.example/public/img/"
    plain = F.concat(F.lit(prefix), path)
    double = F.replace(F.replace(F.concat(F.lit("store.example/public/img/"), path), F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))
    url = (
        F.when(k == 0, plain).when(k == 1, F.concat(plain, F.lit("?v=2#x"))).when(k == 2, F.concat(F.lit("https://images.weserv.nl/?w=9&url="), double, F.lit("&output=webp")))
        .when(k == 3, F.concat(F.lit("https://images.weserv.nl/?url=ssl:"), double)).otherwise(F.concat(F.lit("https://else.example/x "), "o_orderkey", F.lit(".png")))
    )
    rows = table(spark, folder, "orders").withColumn("url", url)
    return rows.select("o_orderkey", X.object_path_from_url("url", prefix).alias("path"), F.when(k == 4, X.proxy_url("url")).alias("proxied"))


@query("image_urls", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'https://x.example/cdn/shop/f.jpg?v=' || o_custkey || '&width=1600' WHEN 1 THEN 'https://x.example/wp-content/uploads/f' || o_custkey || '.jpg' ELSE 'https://x.example/i/f.png' END AS url,
  CASE o_orderkey % 3 WHEN 0 THEN '/cdn/shop/f' WHEN 1 THEN '/wp-content/uploads/f' || o_custkey ELSE '/i/f' END AS image_key FROM orders""")
def image_urls(spark, folder):
    """Largest version of an image, and the key that ignores its size."""
    k = F.col("o_orderkey") % 3
    raw = (
        F.when(k == 0, F.concat(F.lit("//x.example/cdn/shop/f.jpg?v="), "o_custkey", F.lit("&height=3&width=20")))
        .when(k == 1, F.concat(F.lit("/wp-content/uploads/f"), "o_custkey", F.lit("-300x200.jpg"))).otherwise(F.lit("i/f.png"))
    )
    url = X.abs_url(raw, F.lit("https://x.example/page?x=1"))
    rows = table(spark, folder, "orders").withColumn("_u", url).withColumn("url", X.upgrade_image_url("_u"))
    return rows.select("o_orderkey", "url", X.image_base_key("url").alias("image_key"))


@query("trust_signals", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN lpad(CAST(page_id AS VARCHAR), 8, '1') WHEN 1 THEN lpad(CAST(page_id AS VARCHAR), 8, '2') END AS company_number, page_id % 2 = 0 AS has_terms,
  CASE WHEN page_id % 4 > 0 THEN 'https://facebook.com/p' || page_id || ',https://www.tiktok.com/@a' ELSE '' END AS socials, CASE WHEN page_id % 5 = 0 THEN CAST(4.5 AS DOUBLE) END AS rating FROM pages""")
def trust_signals(spark, folder):
    """Evidence on captured home pages."""
    pages = spread(table(spark, folder, "pages"))
    k = F.col("page_id")
    extra = F.concat(
        F.when(k % 3 == 0, F.concat(F.lit("Company No: "), F.lpad(k.cast("string"), 8, "1"))).when(k % 3 == 1, F.concat(F.lit("Registered in\nEngland as "), F.lpad(k.cast("string"), 8, "2"))).otherwise(F.lit("")),
        F.when(k % 2 == 0, F.lit('<a class="x" href="/terms-and-conditions">t</a>')).otherwise(F.lit("")),
        F.when(k % 4 > 0, F.concat(F.lit('<a href="https://facebook.com/p'), k, F.lit('/">f</a><a href="https://www.tiktok.com/@a?x">t</a><a href="https://facebook.com/p'), k, F.lit('">f</a>'))).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit('{"ratingValue": "4.5"}')).otherwise(F.lit("")),
    )
    rows = pages.select("page_id", F.concat("html", extra).alias("html")).select("page_id", X.trust_signals("html").alias("t"), X.rating_value("html").alias("rating"))
    return rows.select("page_id", "t.company_number", "t.has_terms", F.array_join("t.socials", ",").alias("socials"), "rating")


@query("origin_images", """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://cdn.example/a&b.jpg' WHEN 1 THEN 'https://cdn.example/r.jpg' WHEN 2 THEN 'https://cdn.example/t.jpg' WHEN 3 THEN 'https://cdn.example/j.png?x' END AS image FROM pages""")
def origin_images(spark, folder):
    """The product image a page itself names."""
    k = F.col("page_id") % 5
    extra = (
        F.when(k == 0, F.lit('<meta name="x" property="og:image" content="https://cdn.example/a&amp;b.jpg">')).when(k == 1, F.lit('<meta content="https://cdn.example/r.jpg" property="og:image">'))
        .when(k == 2, F.lit('<meta name="twitter:image" content="//cdn.example/t.jpg">')).when(k == 3, F.lit('{"image": "https://cdn.example/j.png?x"}')).otherwise(F.lit(""))
    )
    pages = spread(table(spark, folder, "pages")).select("page_id", F.concat("html", extra).alias("html"))
    return pages.select("page_id", X.image_from_html("html", F.lit("https://op.example/p")).alias("image"))


@query("description_checks", """
WITH t AS (SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'Up for grabs: ' || source || '.' ELSE text END AS d FROM documents),
 p AS (SELECT doc_id, d, trim(regexp_replace(lower(d), '[^\\p{L}]+', ' ', 'g')) AS print FROM t)
SELECT doc_id, min(doc_id) OVER (PARTITION BY print) AS copy_of, CASE WHEN doc_id % 10 = 0 THEN 'template' WHEN min(doc_id) OVER (PARTITION BY print) <> doc_id THEN 'copy' ELSE 'ok' END AS verdict FROM p""")
def description_checks(spark, folder):
    """Template-like descriptions and copies of an earlier one."""
    docs = spread(table(spark, folder, "documents"))
    text = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("Up for grabs: "), "source", F.lit("."))).otherwise(F.col("text"))
    return C.description_checks(docs.withColumn("description", text), seq="doc_id").select("doc_id", "copy_of", "verdict")


@query("own_selectors", r"""
WITH t AS (SELECT page_id, html, replace(regexp_extract(html, '<nav><ul><li><a[^>]*>[^<]*</a></li><li><a[^>]*>([^<]*)</a>', 1), '&amp;', '&') AS second, replace(regexp_extract(html, '<article>\s*<h1>([^<]*)</h1>', 1), '&amp;', '&') AS head,
  regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) AS foot FROM pages)
SELECT page_id, nullif(trim(second, chr(32) || chr(9) || chr(10) || chr(13)), '') AS date_text, nullif(trim(head, chr(32) || chr(9) || chr(10) || chr(13)), '') AS cap_text,
  nullif(trim(replace(replace(replace(foot, '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), chr(32) || chr(9) || chr(10) || chr(13)), '') AS price_text FROM t""")
def own_selectors(spark, folder):
    """Texts under an operator's own selectors on every captured page."""
    own = {"date": "nav li + li > a", "entries": "body > article > h1", "price": "footer"}
    pages = spread(table(spark, folder, "pages")).withColumn("selectors", F.create_map(*[F.lit(x) for pair in own.items() for x in pair]))
    pages = pages.withColumn("selectors", F.map_concat("selectors", F.create_map(F.lit("note"), F.lit("unused")))).drop("url")
    return P.with_regions(pages, selectors="selectors").select("page_id", "date_text", "cap_text", "price_text")
