from pyspark.sql import functions as F

from listflow.functions import classify, dates, text as X


def test_permalink_key(answers):
    answers(
        [("https://X.co.uk/p/Bmw/", "https://x.co.uk/p/bmw"), ("https://x.co.uk/p/bmw?utm=1#a", "https://x.co.uk/p/bmw"), (None, ""), ("https://x/p//#t", "https://x/p")],
        X.permalink_key,
    )


def test_entities_are_decoded_once(answers):
    answers(
        [("a &amp; b &#8211; c", "a & b – c"), ("&AMP;lt; x", "&lt; x"), ("&#x1F600; &unknown;", "😀 &unknown;"), ("  a \n b ", "a b"), ("&#0; &#55555555;", "&#0; &#55555555;")],
        X.decode_entities,
    )


def test_text_of_drops_code_and_unknown_entities(answers):
    answers([("<p>Hi</p><SCRIPT>a<b</SCRIPT><style>p{}</style>&middot;x", "Hi x"), (None, ""), ("a\n\n\n\nb", "a\n\nb")], X.text_of)


def test_slugs(spark, answers):
    answers([("Tea & Cake: £9?", "tea-and-cake-9"), ("", "draw"), ("!?", "draw")], X.slugify)
    long = "x" * 130
    slug = spark.range(1).select(X.numbered_slug(F.lit("y" * 120), F.lit(12)), X.make_slug(F.lit(long), F.lit("op"))).first()
    assert slug[0] == "y" * 117 + "-12" and len(slug[1]) == 120


def test_generic_titles(spark):
    rows = [("ACORN WEEKLY DRAW", "Acorn Draws", True), ("Win an Audi Q2", "x", False), ("£350 Tax Free Cash", "x", False), ("", "x", True)]
    df = spark.createDataFrame(rows, "t string, o string, e boolean")
    assert df.where(X.is_generic_title("t", F.col("o")) != F.col("e")).count() == 0


def test_prize_line(answers):
    answers(
        [("Win £1200 top prize! Good luck.", "Win £1200 top prize!"), ("Oak table – guaranteed draw on Sunday", "Oak table"), ("No", None), ("z" * 190, "z" * 157 + "…")],
        X.clean_prize_line,
    )


def test_labels(spark):
    row = spark.range(1).select(
        X.price_label(F.lit(0.35)), X.price_label(F.lit(2.0)), X.price_label(F.lit(2.5)), X.price_label(F.lit(None).cast("double")), X.money_text(F.lit(None).cast("double")),
        X.clean_title(F.lit("Win this Kia Picanto + £900 Cash!")), X.cash_alternative(F.lit("x"), F.lit("or £31,000")), X.odds_label(F.lit(7500)),
    ).first()
    assert tuple(row) == ("35p", "£2", "£2.50", None, None, "Kia Picanto", "£31,000 TAX-FREE CASH", "1 IN 7,500")


def test_hashes(spark):
    row = spark.range(1).select(X.fnv1a(F.lit("hello")), X.poly31(F.lit("abc")), X.fnv1a(F.lit("🎰"))).first()
    units = [0xD83C, 0xDFB0]
    h = 2166136261
    for u in units:
        h = ((h ^ u) * 16777619) & 0xFFFFFFFF
    assert tuple(row) == (0x4F9F2CAB, 96354, h)


def test_liveness(spark):
    rows = [(None, True), ("true", True), ("1", True), ("0", False), ("False", False), (" no ", False)]
    df = spark.createDataFrame(rows, "f string, e boolean")
    assert df.where(X.is_purchasable("f") != F.col("e")).count() == 0


def test_dates(answers):
    answers(
        [("2026-08-01 9:30:11Z", "2026-08-01T09:30:00+01:00"), ("2026-01-15", "2026-01-15T20:00:00+00:00"), ("2026-07-23T17:00:00+02:00", "2026-07-23T17:00:00+01:00"), ("soon", "soon"), ("", None)],
        dates.normalize_uk_date,
    )
    answers([("2026-08-01T23:30:00Z", "2026-08-02"), ("2026-01-01T23:30:00Z", "2026-01-01"), ("", None), ("x", None)], dates.uk_day_key)
    answers(
        [("2026-08-01T20:00:00+01:00", "CLOSES TONIGHT"), ("2026-08-02T20:00:00+01:00", "CLOSES TOMORROW (SUN)"), ("2026-08-03T20:00:00+01:00", "CLOSES MON 3 AUG")],
        lambda c: dates.closes_label(c, "2026-08-01 12:00:00"),
    )


def test_bucket_paths(answers):
    prefix = "https://s.co/pub/"
    answers(
        [("https://s.co/pub/a%20b.jpg?v=1", "a b.jpg"), ("https://images.weserv.nl/?url=ssl%3As.co%2Fpub%2Fc.png&w=1", "c.png"), ("https://images.weserv.nl/?url=s.co/pub/d.png", "d.png"), ("https://else/x", None), (None, None), ("https://s.co/pub/", None)],
        lambda c: X.object_path_from_url(c, prefix),
    )


def test_categories(spark):
    cases = {
        "Win an Audi Q2": "car-draws", "Win our 2-bed cottage": "house-draws", "iPhone 15 in blue": "tech-giveaways", "Something nice": None, "Garden Hot Tub for six": "home-garden",
        "Apple Watch in silver": "tech-giveaways", "A Rolex for her": "luxury", "£90 Gift Card": "cash-prizes", "LEGO Ferrari with box": "collectibles",
        "MacBook Pro M2": "tech-giveaways", "VW Golf estate": "car-draws", "Golf Clubs and bag": "sports-outdoors", "Van Gogh poster": None,
    }
    df = classify.with_category_evidence(spark.createDataFrame(list(cases.items()), "title string, e string"), prize=None, url=None)
    assert [tuple(r) for r in df.where(~F.col("e").eqNullSafe(F.col("evidence"))).collect()] == []
    labels = spark.createDataFrame([(["Draws", "Warhammer"],), (["cars and bikes"],), (["Instant Wins"],), ([],)], "l array<string>")
    assert [r[1] for r in classify.with_label_category(labels, "l").collect()] == ["collectibles", "car-draws", "cash-prizes", None]
