"""Captured product feeds -> uniform listings.

Input of every reader: a frame with the raw body and the operator's columns
``op_slug base`` (and optional ``draw_path``, ``pinned_category``).  Output of every
reader: the listing columns below plus the operator's slug.  Bodies are parsed with a
fixed schema; a body that is not the expected JSON yields no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.base import at, blank_to_null, c, digits_of, instant, let, number_of, nz, round2, trim_ws, with_once
from ..functions.classify import with_category
from ..functions.dates import normalize_uk_date

LISTING = [
    "op_slug",
    "title",
    "grand_prize",
    "grand_prize_source",
    "category",
    "ticket_price",
    "total_entries",
    "draw_date",
    "image_url",
    "entry_url",
    "description",
]

WOO_SCHEMA = (
    "array<struct<id:string,name:string,slug:string,permalink:string,short_description:string,description:string,"
    "prices:struct<price:string,currency_minor_unit:int>,images:array<struct<src:string>>,"
    "categories:array<struct<name:string>>,is_purchasable:string,is_in_stock:string,stock_availability:struct<text:string>>>"
)
SHOPIFY_SCHEMA = (
    "struct<products:array<struct<title:string,handle:string,body_html:string,product_type:string,tags:array<string>,"
    "variants:array<struct<price:string,available:boolean>>,images:array<struct<src:string>>>>>"
)
RAFFLE_SCHEMA = (
    "array<struct<id:string,slug:string,title:string,end_prize_name:string,end_at:string,max_entries:string,is_open:string,"
    "offers:array<struct<price:string,tickets_quantity:string>>,thumbnail:struct<url:string,big:string>,category_ids:array<string>>>"
)
HYDRA_SCHEMA = (
    "struct<`hydra:member`:array<struct<name:string,urlStub:string,closeTs:string,status:string,category:string,"
    "thumb:string,thumbnail:string,regularPrice:string,numTickets:string>>>"
)
_INERTIA_ROW = (
    "struct<id:string,slug:string,name:string,price:string,sale_price:string,total_tickets:string,end:string,"
    "image_path:string,status:string,categories:string>"
)
ZAP_SCHEMA = "map<string,struct<tickets_max:string,tickets_days_remaining:string>>"


def _base() -> Column:
    return F.regexp_replace(nz("base"), r"/+$", "")


def _optional(df: DataFrame, name: str) -> Column:
    return c(name) if name in df.columns else F.lit(None).cast("string")


def _listings(df: DataFrame, fields: dict[str, Column], labels: Column, url_hint: Column, keep: tuple = ()) -> DataFrame:
    """Project the listing columns and resolve the category once for all readers."""
    base = df.select(
        "op_slug",
        _optional(df, "pinned_category").alias("_pin"),
        *keep,
        *[e.alias(n) for n, e in fields.items()],
        labels.alias("_labels"),
        url_hint.alias("_hint"),
    )
    if "description" not in fields:
        base = base.withColumn("description", F.lit(None).cast("string"))
    return with_category(base, "_labels", "_pin", url="_hint").select(*LISTING, *keep)


def _each(raw: DataFrame, items: Column, name: str, place: str | None) -> DataFrame:
    """A row per item; ``place`` names a column for its position in the feed."""
    if place is None:
        return raw.withColumn(name, F.explode(items))
    return raw.select("*", F.posexplode(items).alias(place, name))


def _kept(place: str | None) -> tuple:
    return () if place is None else (place, "feed_page")


def woo_products(raw: DataFrame, body: str = "body", place: str | None = None) -> DataFrame:
    """One row per live product of a captured store feed, nested as delivered."""
    rows = _each(raw, F.from_json(c(body), WOO_SCHEMA), "p", place)
    return rows.where(X.is_purchasable("p.is_purchasable")).drop(body)


def woo_fields(products: DataFrame) -> DataFrame:
    """The facts a store record states: id, title, price, image, labels, copy, stock."""
    minor = F.coalesce(F.col("p.prices.currency_minor_unit"), F.lit(2))
    price = number_of(F.col("p.prices.price")) / F.pow(F.lit(10.0), minor)
    copy = F.concat_ws("\n", nz("p.name"), nz("p.short_description"), nz("p.description"))
    stock = F.regexp_extract(nz("p.stock_availability.text"), r"(?i)([\d,]+)\s*in\s*stock", 1)
    return products.select(
        *[n for n in products.columns if n != "p"],
        F.col("p.id").alias("product_id"),
        X.decode_entities("p.name").alias("title"),
        round2(price).alias("known_price"),
        F.get("p.images", F.lit(0))["src"].alias("known_image"),
        F.col("p.permalink").alias("entry_url"),
        copy.alias("copy"),
        F.coalesce(blank_to_null("p.short_description"), blank_to_null("p.description")).alias("prize_copy"),
        F.filter(F.transform("p.categories", lambda x: x["name"]), lambda n: nz(n) != "").alias("labels"),
        digits_of(blank_to_null(stock)).cast("bigint").alias("stock"),
    )


def read_woo(raw: DataFrame, body: str = "body", place: str | None = None) -> DataFrame:
    """Store feed -> product facts, live products only (``plans.captures`` joins the pages)."""
    return woo_fields(woo_products(raw, body, place))


def read_shopify(raw: DataFrame, body: str = "body", place: str | None = None) -> DataFrame:
    """Shop feed -> product facts; a product is live when some variant is available."""
    rows = _each(raw, F.from_json(c(body), SHOPIFY_SCHEMA)["products"], "p", place).drop(body)
    live = rows.where(X.has_available_variant("p.variants"))
    labels = F.concat(F.array("p.product_type"), F.coalesce("p.tags", F.array().cast("array<string>")))
    return live.select(
        *[n for n in live.columns if n != "p"],
        F.col("p.handle").alias("product_id"),
        X.decode_entities("p.title").alias("title"),
        number_of(F.get("p.variants", F.lit(0))["price"]).alias("known_price"),
        F.get("p.images", F.lit(0))["src"].alias("known_image"),
        F.concat(_base(), F.lit("/products/"), "p.handle").alias("entry_url"),
        F.concat_ws("\n", nz("p.title"), nz("p.body_html")).alias("copy"),
        blank_to_null("p.body_html").alias("prize_copy"),
        F.filter(labels, lambda n: nz(n) != "").alias("labels"),
        F.lit(None).cast("bigint").alias("stock"),
    )


def unit_price(offers: str | Column) -> Column:
    """Price of the single ticket, else the least price per ticket of the ladder."""
    rows = F.transform(
        F.coalesce(c(offers), F.array().cast("array<struct<price:string,tickets_quantity:string>>")),
        lambda o: F.struct(number_of(o["price"]).alias("p"), number_of(o["tickets_quantity"]).alias("q")),
    )
    single = F.get(F.filter(rows, lambda o: o["q"] == 1), F.lit(0))["p"]
    units = F.transform(F.filter(rows, lambda o: (o["q"] > 0) & o["p"].isNotNull()), lambda o: o["p"] / o["q"])
    return F.coalesce(single, round2(F.array_min(units)))


def read_raffle_engine(raw: DataFrame, body: str = "body", place: str | None = None) -> DataFrame:
    """Bare array of raffles; closed ones are dropped, prices come as a ladder."""
    rows = _each(raw, F.from_json(c(body), RAFFLE_SCHEMA), "r", place).drop(body)
    title, slug = trim_ws(nz("r.title")), F.col("r.slug")
    rows = rows.where((nz("r.is_open") != "false") & (title != "") & (nz(slug) != ""))
    path = F.coalesce(_optional(rows, "draw_path"), F.lit("/product/{slug}"))
    prize = blank_to_null(trim_ws(nz("r.end_prize_name")))
    fields = {
        "title": title,
        "grand_prize": F.coalesce(prize, title),
        "grand_prize_source": F.when(nz("r.end_prize_name") != "", F.lit("api:end_prize_name")).otherwise(F.lit("title")),
        "ticket_price": unit_price("r.offers"),
        "total_entries": number_of(F.col("r.max_entries")).cast("bigint"),
        "draw_date": normalize_uk_date("r.end_at"),
        "image_url": F.coalesce(blank_to_null("r.thumbnail.url"), blank_to_null("r.thumbnail.big")),
        "entry_url": F.concat(_base(), F.replace(path, F.lit("{slug}"), slug)),
    }
    return _listings(rows, fields, F.coalesce("r.category_ids", F.array().cast("array<string>")), slug, _kept(place))


def read_hydra(raw: DataFrame, now: str, media_base: str, body: str = "body", place: str | None = None) -> DataFrame:
    """Paged linked-data feed; prices are whole pence, live means published and not closed."""
    rows = _each(raw, F.from_json(c(body), HYDRA_SCHEMA)["hydra:member"], "r", place).drop(body)
    title, stub = trim_ws(nz("r.name")), F.col("r.urlStub")
    live = (F.col("r.status") == "published") & (instant("r.closeTs") > at(now))
    rows = rows.where(live & (title != "") & (nz(stub) != ""))
    image_id = F.coalesce(blank_to_null("r.thumbnail"), blank_to_null(F.regexp_extract(nz("r.thumb"), r"([^/]+)/*$", 1)))
    label = F.replace("r.category", F.lit("_"), F.lit(" "))
    fields = {
        "title": title,
        "grand_prize": title,
        "grand_prize_source": F.lit("api:name"),
        "ticket_price": F.floor(number_of(F.col("r.regularPrice")) + 0.5) / 100,
        "total_entries": number_of(F.col("r.numTickets")).cast("bigint"),
        "draw_date": normalize_uk_date("r.closeTs"),
        "image_url": F.concat(F.lit(f"{media_base}/"), image_id, F.lit("?w=1280")),
        "entry_url": F.concat(_base(), F.lit("/competitions/"), stub),
    }
    labels = F.when(nz(label) != "", F.array(label)).otherwise(F.array().cast("array<string>"))
    return _listings(rows, fields, labels, stub, _kept(place))


def data_page(html: str | Column) -> Column:
    """JSON text held by the page's ``data-page`` attribute."""
    value = F.nullif(F.regexp_extract(nz(html), r'(?s)data-page="([^"]*)"', 1), F.lit(""))
    for coded, plain in (("&quot;", '"'), ("&#039;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def array_of(json: Column, schema: str) -> Column:
    """Array given either plainly or wrapped as ``{data: [...]}``."""
    inner = F.when(F.ltrim(json).startswith("["), json).otherwise(F.get_json_object(json, "$.data"))
    return F.coalesce(F.from_json(inner, f"array<{schema}>"), F.array().cast(f"array<{schema}>"))


def read_inertia(pages: DataFrame, html: str = "body", place: str | None = None) -> DataFrame:
    """Page-state attribute; the main list, then the featured one.  The first of an id (or slug) wins, rows with neither go."""
    staged = pages.withColumn("_state", data_page(html)).drop(html)
    lists = {"_main": F.get_json_object("_state", "$.props.competitions"), "_featured": F.get_json_object("_state", "$.props.featuredCompetitions")}
    staged = with_once(staged, lists).drop("_state")
    main, featured = (array_of(F.col(n), _INERTIA_ROW) for n in ("_main", "_featured"))
    # both lists are one page's own, so the repeat check stays inside the row
    key = lambda r: F.coalesce(r["id"], r["slug"])
    # they are read once, and repeats found beside each other in key order, not by a search per item
    by_key = lambda rows: F.array_sort(F.filter(F.transform(rows, lambda r, i: F.struct(key(r).alias("k"), i.alias("at"), r.alias("r"))), lambda x: x["k"].isNotNull()))
    firsts = lambda xs: F.filter(xs, lambda x, i: (i == 0) | (F.get(xs, i - 1)["k"] != x["k"]))
    in_place = lambda xs: F.array_sort(F.transform(xs, lambda x: F.struct(x["at"].alias("at"), x["r"].alias("r"))))
    once = F.transform(in_place(let(by_key(F.concat(main, featured)), firsts)), lambda x: x["r"])
    rows = _each(staged, once, "r", place).drop(*lists)
    title, slug = trim_ws(nz("r.name")), F.col("r.slug")
    rows = rows.where((F.lower("r.status") == "active") & (title != "") & (nz(slug) != ""))
    sale, full = number_of(F.col("r.sale_price")), number_of(F.col("r.price"))
    price = F.when(sale > 0, sale).otherwise(full)
    names = F.transform(array_of(F.col("r.categories"), "struct<name:string>"), lambda x: x["name"])
    fields = {
        "title": title,
        "grand_prize": title,
        "grand_prize_source": F.lit("api:name"),
        "ticket_price": round2(price),
        "total_entries": number_of(F.col("r.total_tickets")).cast("bigint"),
        "draw_date": normalize_uk_date(F.replace("r.end", F.lit(" "), F.lit("T"))),
        "image_url": X.abs_url("r.image_path", F.concat(_base(), F.lit("/"))),
        "entry_url": F.concat(_base(), F.lit("/competitions/"), slug),
    }
    return _listings(rows, fields, F.filter(names, lambda n: nz(n) != ""), slug, _kept(place))


def read_zap(raw: DataFrame, now: str, body: str = "body") -> DataFrame:
    """Refresh map -> product id, cap and close date, both only where stated."""
    rows = raw.select("op_slug", F.explode(F.from_json(c(body), ZAP_SCHEMA)).alias("product_id", "r"))
    cap = number_of(F.col("r.tickets_max"))
    left = number_of(F.col("r.tickets_days_remaining"))
    closes = at(now) + F.make_dt_interval(secs=(left * 86400).cast("decimal(18,6)"))
    return rows.select(
        "op_slug",
        "product_id",
        F.when(cap > 0, cap.cast("bigint")).alias("zap_entries"),
        F.when(left >= 0, F.date_format(closes, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("zap_date"),
    )


def fill_from_zap(listings: DataFrame, zap: DataFrame) -> DataFrame:
    """Fill a missing cap or date; a value the page stated always wins."""
    joined = listings.join(zap, ["op_slug", "product_id"], "left")
    return (
        joined.withColumn("total_entries", F.coalesce("total_entries", "zap_entries"))
        .withColumn("draw_date", F.coalesce(blank_to_null("draw_date"), "zap_date"))
        .select(*listings.columns)
    )


def unwrap_pre(text: str | Column) -> Column:
    """JSON that a browser wrapped in ``<pre>``; any other text is returned unchanged."""
    t = c(text)
    inner = F.regexp_extract(nz(t), r"(?is)<pre[^>]*>(.*?)</pre>", 1)
    inner = trim_ws(F.regexp_replace(inner, r"<[^>]+>", ""))
    for coded, plain in (("&quot;", '"'), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        inner = F.replace(inner, F.lit(coded), F.lit(plain))
    wrapped = trim_ws(nz(t)).startswith("<") & inner.rlike(r"^[\[{]")
    parsed = F.try_parse_json(inner).isNotNull()
    return F.when(wrapped & parsed, inner).otherwise(t)


# ---- probing ---------------------------------------------------------------


def probe_feeds(captures: DataFrame) -> DataFrame:
    """Platform, live and total counts and a sample name of each candidate's feeds.

    Input: ``domain``, ``woo_body``, ``shop_body`` (either may be NULL).  Everything is
    counted inside the row.  A candidate with nothing live is not in the result.
    """
    woo = F.from_json("woo_body", WOO_SCHEMA)
    live = F.filter(woo, lambda p: X.is_purchasable(p["is_purchasable"]) & X.is_purchasable(p["is_in_stock"]))
    shop = F.from_json("shop_body", SHOPIFY_SCHEMA)["products"]
    staged = captures.withColumn("_woo", woo).withColumn("_live", live).withColumn("_shop", shop)
    is_woo, is_shop = F.size("_live") > 0, F.size("_shop") > 0
    pick = lambda a, b: F.when(is_woo, a).when(is_shop, b)
    return staged.where(F.coalesce(is_woo, F.lit(False)) | F.coalesce(is_shop, F.lit(False))).select(
        *[n for n in captures.columns if n not in ("woo_body", "shop_body")],
        pick(F.lit("woo"), F.lit("shopify")).alias("method"),
        pick(F.size("_live"), F.size("_shop")).cast("bigint").alias("live"),
        pick(F.size("_woo"), F.size("_shop")).cast("bigint").alias("total"),
        F.substring(nz(pick(F.get("_live", F.lit(0))["name"], F.get("_shop", F.lit(0))["title"])), 1, 50).alias("sample"),
    )


# ---- adapter registry ------------------------------------------------------

ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "raffle-engine": read_raffle_engine,
    "hydra": read_hydra,
    "inertia": read_inertia,
}


def register_adapter(api_style: str, reader: Callable[..., DataFrame]) -> None:
    """Add a reader for another feed style."""
    ADAPTERS[api_style] = reader


def read_api(raw: DataFrame, api_style: str, **options) -> DataFrame:
    if api_style not in ADAPTERS:
        raise ValueError(f"unknown feed style {api_style!r}")
    return ADAPTERS[api_style](raw, **options)
