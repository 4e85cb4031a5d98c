"""Text scalars: keys, slugs, entities, titles, prize lines, URLs, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .base import (
    all_groups,
    blank_to_null,
    c,
    digits_of,
    first_group,
    let,
    matches,
    number_text,
    nz,
    rx,
    squash_ws,
    sub,
    thousands,
    trim_ws,
    whole_of,
)

# ---- identity ------------------------------------------------------------


def permalink_key(url: str | Column) -> Column:
    """Canonical key of a URL: no query or fragment, no trailing slash, lower case."""
    cut = F.regexp_replace(nz(url), r"[#?].*$", "")
    return F.lower(F.regexp_replace(cut, r"/+$", ""))


def product_slug(url: str | Column) -> Column:
    """Last path segment, kept exactly as written (never percent-decoded)."""
    cut = F.regexp_replace(F.regexp_replace(nz(url), r"[#?].*$", ""), r"/+$", "")
    return F.substring_index(cut, "/", -1)


def is_percent_literal_slug(slug: str | Column) -> Column:
    return matches(slug, r"%[0-9a-f]{2}")


def alnum(text: str | Column) -> Column:
    return F.regexp_replace(F.lower(nz(text)), r"[^a-z0-9]", "")


def slugify(text: str | Column) -> Column:
    spelled = F.replace(F.lower(nz(text)), F.lit("&"), F.lit(" and "))
    dashed = F.regexp_replace(spelled, r"[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(dashed, r"^-+|-+$", "")
    return F.when(trimmed == "", F.lit("draw")).otherwise(trimmed)


def make_slug(title: str | Column, op_slug: str | Column, limit: int = 120) -> Column:
    """``<title>-<operator>`` within ``limit`` characters."""
    op = c(op_slug)
    room = F.greatest(F.lit(8), F.lit(limit - 1) - F.length(op))
    return F.substring(F.concat(F.substring(slugify(title), F.lit(1), room), F.lit("-"), op), 1, limit)


def numbered_slug(base: str | Column, n: Column, limit: int = 120) -> Column:
    """Base slug with ``-n`` for n >= 2; the base is cut so the suffix always fits."""
    suffix = F.concat(F.lit("-"), n.cast("string"))
    cut = F.substring(c(base), F.lit(1), F.lit(limit) - F.length(suffix))
    return F.when(n < 2, c(base)).otherwise(F.concat(cut, suffix))


def norm_domain(text: str | Column) -> Column:
    """Comparable token of a slug, a domain, a URL or a name."""
    host = F.regexp_replace(F.lower(nz(text)), r"^https?://", "")
    host = F.regexp_replace(host, r"^www\.", "")
    host = F.substring_index(host, "/", 1)
    return F.regexp_replace(F.regexp_replace(host, rules.DOMAIN_SUFFIX, ""), r"[^a-z0-9]", "")


def seed_domain(line: str | Column) -> Column:
    """Host named by one line of a seed list; NULL for comments and blanks."""
    text = F.lower(trim_ws(nz(line)))
    host = F.regexp_replace(F.regexp_replace(text, r"^https?://", ""), r"^www\.", "")
    return F.when((text != "") & ~text.startswith("#"), F.substring_index(host, "/", 1))


def slug_for(domain: str | Column) -> Column:
    stem = F.regexp_replace(nz(domain), rules.DOMAIN_SUFFIX, "")
    return F.regexp_replace(F.regexp_replace(stem, r"[^a-z0-9]+", "-"), r"^-|-$", "")


def title_for(slug: str | Column) -> Column:
    return F.initcap(F.replace(c(slug), F.lit("-"), F.lit(" ")))


def domains_for(slug: str | Column) -> Column:
    """Likely hosts of a bare slug, best guess first, without repeats."""
    dashed, flat = c(slug), F.replace(c(slug), F.lit("-"), F.lit(""))
    endings = [(flat, ".co.uk"), (flat, ".com"), (dashed, ".co.uk"), (dashed, ".com"), (flat, ".uk"), (flat, ".competitions.co.uk")]
    return F.array_distinct(F.array(*[F.concat(stem, F.lit(end)) for stem, end in endings]))


# ---- entities and visible text -------------------------------------------


def _code_point(number: Column) -> Column:
    raw = F.unhex(F.lpad(F.hex(number), 8, "0"))
    return F.decode(raw, "UTF-32")


def _numeric_entities(text: Column, pattern: str, base: int, invalid: Column | None) -> Column:
    def decode_one(acc: Column, entity: Column) -> Column:
        digits = F.regexp_replace(entity, r"^&#[xX]?|;$", "")
        fallback = entity if invalid is None else invalid

        def char(number: Column) -> Column:
            known = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
            return F.when(known, _code_point(number)).otherwise(fallback)

        return F.replace(acc, entity, let(whole_of(F.conv(digits, base, 10)), char))

    def decode_all(t: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
        return F.when(F.contains(t, F.lit("&#")), F.aggregate(found, t, decode_one)).otherwise(t)

    return let(text, decode_all)


def _named_entities(text: Column) -> Column:
    def decode(t: Column) -> Column:
        out = t
        for name, char in rules.ENTITIES.items():  # "amp" is last, so nothing is decoded twice
            out = F.regexp_replace(out, f"(?i)&{name};", char)
        return F.when(F.contains(t, F.lit("&")), out).otherwise(t)

    return let(text, decode)


def decode_entities(text: str | Column) -> Column:
    """Decode numeric and the known named entities; unknown ones stay as they are."""
    value = _numeric_entities(c(text), r"&#[xX][0-9a-fA-F]+;", 16, None)
    value = _numeric_entities(value, r"&#[0-9]+;", 10, None)
    return trim_ws(squash_ws(_named_entities(value)))


def text_of(html: str | Column) -> Column:
    """Visible text of an HTML fragment; unknown entities become a blank."""
    value = F.regexp_replace(nz(html), r"(?is)<script.*?</script>", " ")
    value = F.regexp_replace(value, r"(?is)<style.*?</style>", " ")
    value = F.regexp_replace(value, r"<[^>]+>", " ")
    value = _numeric_entities(value, r"&#[xX][0-9a-fA-F]+;", 16, F.lit(" "))
    value = _numeric_entities(value, r"&#[0-9]+;", 10, F.lit(" "))
    unknown = "|".join(rules.ENTITIES)
    value = F.regexp_replace(value, rf"(?i)&(?!(?:{unknown});)[a-z]+;", " ")
    value = _named_entities(value)
    value = F.regexp_replace(value, r"[ \t]+", " ")
    return trim_ws(F.regexp_replace(value, r"\n{3,}", "\n\n"))


def looks_blocked(text: str | Column) -> Column:
    """Empty, nearly empty, or showing a challenge phrase."""
    short = F.length(trim_ws(squash_ws(nz(text)))) < 80
    return short | matches(text, rules.BLOCKED)


def is_finished(text: str | Column) -> Column:
    return matches(text, rules.FINISHED)


def detect_zap(html: str | Column) -> Column:
    return matches(html, rules.ZAP_MARK, "")


# ---- liveness ------------------------------------------------------------


def is_purchasable(flag: str | Column) -> Column:
    """A missing flag is no evidence of closure; false, 0, no and off are."""
    value = c(flag).cast("string")
    return value.isNull() | ~F.lower(trim_ws(value)).isin(rules.NOT_LIVE)


def has_available_variant(variants: str | Column) -> Column:
    """Some variant is available, strictly true."""
    found = F.exists(c(variants), lambda v: F.coalesce(v["available"], F.lit(False)))
    return F.coalesce(found, F.lit(False))


# ---- titles and prizes ---------------------------------------------------


def titles_agree(a: str | Column, b: str | Column) -> Column:
    x, y = alnum(a), alnum(b)
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))


def _words(text: Column) -> Column:
    return F.split(F.regexp_replace(F.lower(nz(text)), r"[^a-z0-9 ]+", " "), r"\s+")


def is_generic_title(title: str | Column, op_name: str | Column | None = None) -> Column:
    """The title names no prize: no amount, and nothing but filler or the operator's name."""
    own = _words(c(op_name)) if op_name is not None else F.array().cast("array<string>")
    filler = F.array(*[F.lit(w) for w in rules.FILLER_WORDS])

    def generic(text: Column) -> Column:
        rest = F.concat_ws(" ", F.array_except(_words(text), F.array_union(own, filler)))
        has_content = rest.rlike(r"(?:^| )(?!\d+(?: |$))[a-z0-9]{3,}")
        return (text == "") | (~matches(text, rules.PRIZE_HAS_VALUE) & ~has_content)

    return let(decode_entities(nz(title)), generic)


def clean_prize_line(raw: str | Column) -> Column:
    """One clean headline out of a block of prize copy, NULL when nothing is left."""
    boiler = rx(rules.PRIZE_BOILERPLATE)

    def cut(line: Column) -> Column:
        # keep the text before the first boilerplate phrase, unless it starts too early
        head = F.regexp_extract(line, rf"(?s)^(.{{4,}}?)(?={boiler})", 1)
        starts_early = line.rlike(rf"(?s)^.{{0,3}}?{boiler}")
        return F.when((head != "") & ~starts_early, trim_ws(head)).otherwise(line)

    def fit(line: Column) -> Column:
        short = F.concat(trim_ws(F.regexp_replace(F.substring(line, 1, 157), r"\s+\S*$", "")), F.lit("…"))
        return F.when(F.length(line) > 160, short).when(F.length(line) >= 4, line)

    sentence = F.get(F.split(decode_entities(nz(raw)), r"(?<=[.!?])\s+", 2), F.lit(0))
    tidy = trim_ws(F.regexp_replace(let(sentence, cut), r"[\s.\-–—:;,]+$", ""))
    return let(tidy, fit)


def is_good_prize(candidate: str | Column, title: str | Column, op_name: str | Column | None) -> Column:
    """The candidate names a prize: no label, no terms, no boast, no slogan, not the title."""
    cand = c(candidate)
    slogan = is_generic_title(cand, op_name) & ~matches(cand, rules.PRIZE_HAS_VALUE)
    same = F.lower(cand) == F.lower(decode_entities(nz(title)))
    refused = matches(cand, rules.PRIZE_LABEL) | matches(cand, rules.PRIZE_TERMS) | matches(cand, rules.PRIZE_BOAST)
    return cand.isNotNull() & (F.length(cand) >= 4) & ~refused & ~same & ~slogan


_TITLE_CUTS = [
    (r"^win\s+(this|a|an|the)\s+", "i"),
    (r"^win\s+", "i"),
    (r"\s*[-–|]\s+.*$", ""),
    (r"\s*\+\s.*$", ""),
    (r"\s*&\s*£.*$", "i"),
    (r"\s*\(.*$", ""),
    (r"\s+or\s+£[\d,]+.*$", "i"),
    (r"\s+for\s+just\s+.*$", "i"),
]


def clean_title(title: str | Column) -> Column:
    """Display name of the prize: marketing lead-ins and tails removed."""
    original = trim_ws(nz(title))
    text = original
    for pattern, flags in _TITLE_CUTS:
        text = sub(text, pattern, "", flags)
    # only the first "competition" goes
    text = F.regexp_replace(text, r"(?is)^(.*?)" + rx(r"\bcompetition\b", ""), "$1")
    text = trim_ws(squash_ws(F.regexp_replace(text, r"[!\s]+$", "")))
    return F.coalesce(blank_to_null(text), original)


def cash_alternative(*texts: str | Column) -> Column:
    """First stated cash alternative, as ``£N TAX-FREE CASH``."""
    amounts = []
    for text in texts:
        amounts.append(first_group(text, r"£\s?([\d,]{3,})\s*(?:tax[-\s]?free\s*)?(?:cash|alternative)"))
        amounts.append(first_group(text, r"\bor\s*£\s?([\d,]{3,})"))
    return F.concat(F.lit("£"), F.coalesce(*amounts), F.lit(" TAX-FREE CASH"))


def cash_alternative_value(*texts: str | Column) -> Column:
    return digits_of(first_group(cash_alternative(*texts), r"£([\d,]+)"))


# ---- labels --------------------------------------------------------------


def price_label(price: str | Column) -> Column:
    p = c(price).cast("double")
    pence = F.concat(F.floor(p * 100 + 0.5).cast("string"), F.lit("p"))
    whole = F.concat(F.lit("£"), number_text(p))
    full = F.concat(F.lit("£"), F.format_string("%.2f", p))
    return F.when(p.isNull() | (p <= 0), F.lit(None).cast("string")).when(p < 1, pence).when(p == F.floor(p), whole).otherwise(full)


def odds_label(entries: str | Column) -> Column:
    return F.when(c(entries) != 0, F.concat(F.lit("1 IN "), thousands(entries)))


def category_label(name: str | Column) -> Column:
    text = F.upper(F.coalesce(c(name), F.lit("PRIZE")))
    for word in (" DRAWS", " PRIZES", " GIVEAWAYS"):
        text = F.regexp_replace(text, rf"^(.*?){word}", "$1")
    return trim_ws(text)


def money_text(value: str | Column) -> Column:
    """£ with two places, a ``.00`` ending removed."""
    v = c(value).cast("double")  # a NULL would be formatted as text
    return F.when(v.isNotNull(), F.concat(F.lit("£"), F.regexp_replace(F.format_string("%.2f", v), r"\.00$", "")))


# ---- hashes --------------------------------------------------------------


def _utf16_units(text: Column) -> Column:
    chars = F.regexp_extract_all(nz(text), F.lit(r"(?s)."), F.lit(0))

    def units(ch: Column) -> Column:
        point = F.ascii(ch).cast("bigint")
        high = F.lit(0xD7C0) + F.shiftright(point, 10)
        low = F.lit(0xDC00) + point.bitwiseAND(F.lit(0x3FF))
        return F.when(point > 0xFFFF, F.array(high.cast("bigint"), low.cast("bigint"))).otherwise(F.array(point))

    return F.transform(chars, units)


def fnv1a(text: str | Column) -> Column:
    """32-bit FNV-1a over UTF-16 units."""
    return F.aggregate(
        F.flatten(_utf16_units(c(text))),
        F.lit(2166136261).cast("bigint"),
        lambda h, u: (h.bitwiseXOR(u) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF)),
    )


def poly31(text: str | Column) -> Column:
    """32-bit ``h*31 + unit`` over the leading UTF-16 unit of every character."""
    return F.aggregate(
        F.transform(_utf16_units(c(text)), lambda pair: pair[0]),
        F.lit(0).cast("bigint"),
        lambda h, u: (h * F.lit(31) + u).bitwiseAND(F.lit(0xFFFFFFFF)),
    )


def in_sample(row_id: str | Column, parity: int) -> Column:
    """Stateless half of the catalogue: id-hash parity against the week's parity."""
    return poly31(c(row_id).cast("string")) % 2 == parity


# ---- URLs ----------------------------------------------------------------


def origin_of(url: str | Column) -> Column:
    return F.lower(first_group(url, r"^(https?://[^/?#]+)"))


def host_of(url: str | Column) -> Column:
    """Lower-case host without ``www.``; NULL for anything that is not a web URL."""
    host = first_group(url, r"^https?://(?:[^/?#@]*@)?([^/?#:]+)(?::\d+)?(?:[/?#]|$)")
    return blank_to_null(F.regexp_replace(F.lower(host), r"^www\.", ""))


def folded_path(url: Column) -> Column:
    """An http address without ``.`` and ``..`` steps in its path; others, and those without such steps, as they are."""
    origin = F.regexp_extract(url, r"^(?i:https?)://[^/?#]+", 0)
    path = F.regexp_extract(url, r"^(?i:https?)://[^/?#]+([^?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^[^?#]*(.*)$", 1)
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    # the first step, before the leading slash, stays
    up = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
    fold = F.aggregate(steps, F.array().cast("array<string>"), lambda done, x: F.when(x == "..", up(done)).when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    ended = F.when(last.isin(".", ".."), F.concat(fold, F.array(F.lit("")))).otherwise(fold)
    dotted = url.rlike(r"^(?i:https?)://[^/?#]+/(?:[^?#]*/)?\.\.?(?:[/?#]|$)")
    return F.when(dotted, F.concat(origin, F.array_join(ended, "/"), rest)).otherwise(url)


def abs_url(url: str | Column, base: str | Column) -> Column:
    """Resolve a link against its page: absolute, ``//host``, ``/path``, ``?query``, ``#part``, or relative; ``.`` and ``..`` steps are folded."""
    # each step is bound once, as an expression that is named twice is evaluated twice
    return let(c(url), lambda raw: let(trim_ws(raw), lambda u: let(_resolved(raw, u, c(base)), folded_path)))


def _resolved(raw: Column, u: Column, b: Column) -> Column:
    origin = F.regexp_extract(nz(b), r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(nz(b), r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    # the page itself, with a path and without, or with, its query
    page = F.regexp_extract(nz(b), r"^https?://[^/?#]+([^?#]*)", 1)
    page = F.concat(origin, F.when(page == "", F.lit("/")).otherwise(page))
    query = F.regexp_extract(nz(b), r"^[^?#]*(\?[^#]*)", 1)
    bare = u.rlike(r"(?i)^https?://[^/?#]+$")
    return (
        F.when(nz(raw) == "", F.lit(None).cast("string"))
        .when(bare, F.concat(u, F.lit("/")))
        .when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), u)
        .when(origin == "", F.lit(None).cast("string"))
        .when(u.startswith("//"), F.concat(F.regexp_extract(b, r"^(https?:)", 1), u))
        .when(u.startswith("/"), F.concat(origin, u))
        .when(u.startswith("?"), F.concat(page, u))
        .when(u.startswith("#"), F.concat(page, query, u))
        .otherwise(F.concat(folder, u))
    )


def _path_under(url: Column, prefix: Column) -> Column:
    tail = F.regexp_replace(F.substring(url, F.length(prefix) + 1, F.length(url)), r"[?#].*$", "")
    path = F.when(tail != "", F.coalesce(_percent_decode(tail), tail))
    return F.when(F.startswith(url, prefix), path)


def _percent_decode(text: Column) -> Column:
    # url_decode also turns "+" into a blank; protect it
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def object_path_from_url(url: str | Column, prefix: str, proxy_host: str = "weserv.nl") -> Column:
    """Path inside our bucket that a stored URL points at, NULL when it points elsewhere.

    A URL wrapped by the image proxy (``?url=``) is unwrapped once.
    """
    def unwrap(inner: Column) -> Column:
        scheme_less = F.concat(F.lit("https://"), F.regexp_replace(inner, r"(?i)^ssl:", ""))
        return F.when(inner.rlike(r"(?i)^https?://"), inner).otherwise(scheme_less)

    u = c(url)
    wrapped = F.when(F.contains(nz(u), F.lit(proxy_host)), _percent_decode(first_group(u, r"[?&]url=([^&]+)", 1, "")))
    return let(F.coalesce(let(wrapped, unwrap), u), lambda full: _path_under(full, F.lit(prefix)))


def percent_encode(text: str | Column) -> Column:
    """Component encoding: blanks as %20, and ``!'()*~`` left alone."""
    value = F.url_encode(c(text))
    for coded, plain in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def proxy_url(url: str | Column, proxy: str = "https://images.weserv.nl/", width: int = 1280, quality: int = 75) -> Column:
    """Proxy address that serves the image resized; NULL for anything but a web URL."""
    target = percent_encode(F.regexp_replace(c(url), r"(?i)^https?://", ""))
    link = F.concat(F.lit(f"{proxy}?url="), target, F.lit(f"&w={width}&output=webp&q={quality}&we"))
    return F.when(c(url).rlike(r"(?i)^https?://"), link)


_SIZE = r"-\d{2,4}x\d{2,4}"


def upgrade_image_url(url: str | Column) -> Column:
    """Largest version of an image: shop CDN width 1600, or no ``-WxH`` suffix."""
    u = c(url)
    base = F.regexp_replace(u, r"[?#].*$", "")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(width|height|crop)="))
    had_width = query.rlike(r"(?:^|&)width=")
    first_width = F.transform(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(height|crop)=")),
        lambda p: F.regexp_replace(p, r"^width=.*$", "width=1600"),
    )
    params = F.when(had_width, F.array_distinct(first_width)).otherwise(F.concat(kept, F.array(F.lit("width=1600"))))
    shop = F.concat(base, F.lit("?"), F.array_join(params, "&"))
    plain = F.regexp_replace(u, rf"(?is)^(.*?){_SIZE}(\.(?:jpe?g|png|webp))", "$1$2")
    return F.when(u.rlike(r"cdn/shop/|cdn\.shopify\.com"), shop).otherwise(plain)


def image_base_key(url: str | Column) -> Column:
    """Same image whatever its size suffix, query or type."""
    path = F.lower(F.regexp_extract(F.regexp_replace(nz(url), r"[?#].*$", ""), r"(?i)^https?://[^/]+(/.*)?$", 1))
    return F.regexp_replace(F.regexp_replace(path, rf"{_SIZE}(?=\.\w+$)", ""), r"\.(jpe?g|png|webp)$", "")


def image_from_html(html: str | Column, base: str | Column) -> Column:
    """The page's own product image: og, og reversed, twitter, then JSON-LD."""
    patterns = [
        r"""<meta[^>]+property=["']og:image["'][^>]+content=["']([^"']+)["']""",
        r"""<meta[^>]+content=["']([^"']+)["'][^>]+property=["']og:image["']""",
        r"""<meta[^>]+name=["']twitter:image["'][^>]+content=["']([^"']+)["']""",
        r'''"image"\s*:\s*"([^"]+\.(?:jpe?g|png|webp)[^"]*)"''',
    ]
    found = []
    for pattern in patterns:
        link = abs_url(F.replace(first_group(html, pattern), F.lit("&amp;"), F.lit("&")), base)
        found.append(let(link, lambda x: F.when(x.rlike(r"(?i)^https?:"), x)))
    return F.coalesce(*found)


# ---- links and hosts -----------------------------------------------------


def pick_draw_links(
    links: str | Column, base: str | Column, cap: int | None, draw: str | Column = rules.DRAW_LINK, exclude: tuple | Column = (rules.BAD_LINK, rules.CATEGORY_TAIL)
) -> Column:
    """Distinct same-origin links that look like a listing, in page order, all or the first ``cap``.

    ``draw`` (a pattern) and ``exclude`` (an array of patterns) may be columns: an operator's own
    rules, replaced by the shared ones where they are NULL or empty.
    """
    origin = origin_of(base)
    cut = F.transform(c(links), lambda u: F.regexp_replace(u, r"(?s)[?#].*$", ""))
    shared = "|".join(f"(?:{p})" for p in ((rules.BAD_LINK, rules.CATEGORY_TAIL) if isinstance(exclude, Column) else exclude))
    by_shared = (lambda u: u.rlike(rx(shared))) if shared else (lambda u: F.lit(False))

    def fits(u: Column) -> Column:
        if not isinstance(draw, Column):
            return u.rlike(rx(draw))
        return F.when(F.nullif(draw, F.lit("")).isNull(), u.rlike(rx(rules.DRAW_LINK))).otherwise(F.rlike(u, F.concat(F.lit("(?i)"), draw)))

    def refused(u: Column) -> Column:
        if not isinstance(exclude, Column):
            return by_shared(u)
        own = F.exists(exclude, lambda p: F.rlike(u, F.concat(F.lit("(?i)"), p)))
        return F.when(F.size(exclude) > 0, F.coalesce(own, F.lit(False))).otherwise(by_shared(u))

    kept = F.array_distinct(F.filter(cut, lambda u: F.startswith(u, origin) & fits(u) & ~refused(u)))
    return kept if cap is None else F.slice(kept, 1, cap)


def page_links(html: str | Column, base: str | Column) -> Column:
    """Absolute href values of a page, in page order."""
    hrefs = all_groups(html, r"""<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']""")
    return F.filter(F.transform(hrefs, lambda h: abs_url(h, base)), lambda u: u.isNotNull())


def operator_hosts(html: str | Column, exclude: list[str] | None = None) -> Column:
    """Distinct outside hosts of a page whose first label smells like an operator."""
    hosts = F.transform(all_groups(html, r'href="(https?://[^"]+)"'), host_of)
    named = F.filter(hosts, lambda h: F.substring_index(h, ".", 1).rlike(rx(rules.OPERATOR_HOST)))
    if exclude:
        named = F.filter(named, lambda h: ~h.isin(list(exclude)))
    return F.array_distinct(named)


def sitemap_locs(xml: str | Column) -> Column:
    return all_groups(xml, r"<loc>\s*([^<\s]+)\s*</loc>")


def mine_slugs(html: str | Column) -> Column:
    """Distinct product slugs or handles found in a data blob."""
    return F.array_distinct(all_groups(html, r'"(?:slug|handle)"\s*:\s*"([a-z0-9][a-z0-9-]{4,})"'))


def candidate_slug(text: str | Column) -> Column:
    value = F.lower(trim_ws(nz(text)))
    return F.when(value.rlike(r"^[a-z0-9][a-z0-9-]{2,}$"), value)


def trust_signals(html: str | Column, limit: int | None = None) -> Column:
    """Evidence on a home page: company number, terms link, all (or the first ``limit``) social links."""
    number = F.coalesce(
        first_group(html, r"company\s*(?:no|number|registration)[.:\s#]*(\d{8})"),
        first_group(html, r"registered .{0,60}?(\d{8})", 1, "is"),
    )
    terms = matches(html, r'<a[^>]+href="[^"]*(terms(?:-and-conditions)?|t&amp;cs|t&cs)[^"]*"')
    links = all_groups(html, r'href="(https?://(?:www\.)?(?:facebook|instagram|tiktok)\.com/[^"?#]+)')
    socials = F.array_distinct(F.transform(links, lambda u: F.regexp_replace(u, r"/$", "")))
    socials = socials if limit is None else F.slice(socials, 1, limit)
    return F.struct(number.alias("company_number"), terms.alias("has_terms"), socials.alias("socials"))


def rating_value(html: str | Column) -> Column:
    return first_group(html, r'"ratingValue"\s*:\s*"?(\d(?:\.\d+)?)"?', 1, "").cast("double")
