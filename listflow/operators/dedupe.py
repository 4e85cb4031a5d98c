"""Duplicate collapse, known-first caps, slugs and archive paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.base import nz
from .ranking import discard, ensure_checkpoint_dir, first_per_key, first_per_key_counted, materialised, ranked, row_hash, running, scratch_path, top_n


def listing_key() -> Column:
    """Canonical URL, else the title's letters and digits, else NULL."""
    by_title = X.alnum("title")
    key = F.when(nz("entry_url") != "", X.permalink_key("entry_url")).otherwise(by_title)
    return F.nullif(key, F.lit(""))


def completeness() -> Column:
    """2 for a cap, 1 for a date, 1 for a price."""
    cap = F.when(F.col("total_entries") > 0, 2).otherwise(0)
    date = F.when(nz("draw_date") != "", 1).otherwise(0)
    price = F.when(F.col("ticket_price") > 0, 1).otherwise(0)
    return cap + date + price


def dedupe(df: DataFrame, op: str = "op_slug", seq: list[Column] | None = None, dropped: str | None = None) -> DataFrame:
    """One row per operator and canonical key: the most complete, the earliest on a tie.

    Rows with neither URL nor title go.  ``dropped`` adds how many rows each kept one hides.
    """
    keyed = df.withColumn("_key", listing_key()).withColumn("_score", -completeness()).where(F.col("_key").isNotNull())
    order = [F.col("_score"), *(seq or [F.col("seq")])]
    if dropped:
        out = first_per_key_counted(keyed, [op, "_key"], order, "_copies").withColumn(dropped, F.col("_copies") - 1).drop("_copies")
    else:
        out = first_per_key(keyed, [op, "_key"], order)
    return out.drop("_key", "_score")


def split_known(df: DataFrame, known: DataFrame, url: str = "entry_url") -> DataFrame:
    """Add ``known``: the canonical URL is already stored (one shuffle on the key).  Rows without a URL are unknown, each under a key of its own."""
    keys = known.select(X.permalink_key(url).alias("_key")).where(F.col("_key") != "").distinct().withColumn("_hit", F.lit(True))
    own = F.concat(F.lit("\u0001"), row_hash(df).cast("string"))
    keyed = df.withColumn("_key", F.coalesce(F.nullif(X.permalink_key(url), F.lit("")), own))
    return keyed.join(keys, "_key", "left").withColumn("known", F.coalesce("_hit", F.lit(False))).drop("_key", "_hit")


def known_first(df: DataFrame, cap: int, op: str = "op_slug", seq: str = "seq") -> DataFrame:
    """Every known row, then new rows up to what is left of the operator's cap.

    The cap bounds new intake and never the re-reading of a stored row.
    """
    fresh = top_n(df.where(~F.col("known")), [op], [F.col(seq)], cap, "_rank")
    held = df.where("known").groupBy(op).agg(F.count(F.lit(1)).alias("_held"))
    room = F.greatest(F.lit(0), F.lit(cap) - F.coalesce("_held", F.lit(0)))
    taken = fresh.join(held, op, "left").where(F.col("_rank") <= room).select(*df.columns)
    return df.where("known").unionByName(taken)


def assign_slugs(df: DataFrame, taken: DataFrame, op: str = "op_slug", seq: str = "seq", out: str = "slug", bounds: list[float] | None = None) -> DataFrame:
    """Unique slugs: the base for the first row, ``-2``, ``-3`` … after it.

    Numbers that stored slugs already use are skipped.  ``taken`` has a ``slug`` column.
    Different bases can spell the same slug ("Win X" numbered 2, and "Win X" of an operator
    called 2; or long bases that are cut).  The row with the smaller ``seq`` keeps it; the other
    base loses that number for good and is numbered again, until all slugs differ.  Each round
    retires numbers, and only so many spell one slug, so the rounds end.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # written once: the ranks read the rows three times, and every round the stored slugs
    based = df.withColumn("_base", X.make_slug("title", op)).checkpoint()
    taken = taken.select("slug").distinct().checkpoint()
    placed = ranked(based, ["_base"], seq, "_rank", bounds).checkpoint()
    used = _used_numbers(placed, taken).checkpoint()
    stored = taken.select(F.col("slug").alias("_slug"))
    while True:
        named = _skip_taken(placed, used).withColumn("_slug", X.numbered_slug("_base", F.col("_n"))).checkpoint()
        keys = named.select("_slug", "_base", "_n", F.col(seq).alias("_seq"))
        firsts = keys.groupBy("_slug").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
        later = keys.join(firsts, "_slug").where(F.col("_seq") > F.col("_first")).select("_base", "_n")
        lost = later.unionByName(keys.join(stored, "_slug", "left_semi").select("_base", "_n")).distinct().checkpoint()
        if lost.isEmpty():
            return named.withColumn(out, F.col("_slug")).drop("_base", "_rank", "_n", "_slug")
        used = used.unionByName(lost.withColumnRenamed("_n", "_u")).distinct().checkpoint()


def _used_numbers(placed: DataFrame, taken: DataFrame) -> DataFrame:
    """Numbers (``_base``, ``_u``) that the stored slugs use, for the bases of ``placed``."""
    tail = F.regexp_extract("slug", r"-(\d{1,9})$", 1)
    stem = F.regexp_replace("slug", r"-\d{1,9}$", "")
    readings = F.array(
        F.struct(F.col("slug").alias("_base"), F.lit(1).cast("bigint").alias("_u")),
        F.struct(stem.alias("_base"), F.nullif(tail, F.lit("")).cast("bigint").alias("_u")),
    )
    # "-1" and "-02" are no numbers that a base gets
    read = taken.select("slug", F.inline(readings)).where((F.col("_u") >= 1) & (X.numbered_slug("_base", F.col("_u")) == F.col("slug")))
    return read.select("_base", "_u").distinct().join(placed.select("_base").distinct(), "_base", "left_semi")


def _skip_taken(placed: DataFrame, used: DataFrame) -> DataFrame:
    """Add ``_n``: the ``_rank``-th number of the base that ``used`` (``_base``, ``_u``) leaves free.

    The k-th used number u of a base has ``u - k`` free numbers before it.  A row of rank r
    therefore stands behind exactly the used numbers with fewer than r free ones before
    them, which is a running count over the two ordered lists merged.
    """
    if used.isEmpty():
        return placed.withColumn("_n", F.col("_rank"))
    marks = ranked(used, ["_base"], "_u", "_k").select("_base", ((F.col("_u") - F.col("_k")) * 2).alias("_at"), F.lit(None).cast("bigint").alias("_rank"))
    marks = marks.groupBy("_base", "_at", "_rank").agg(F.count(F.lit(1)).alias("_w"))
    asks = placed.select("_base", (F.col("_rank") * 2 - 1).alias("_at"), "_rank", F.lit(0).cast("bigint").alias("_w"))
    asks = asks.join(used.select("_base").distinct(), "_base", "left_semi")
    counted = running(marks.unionByName(asks), ["_base"], "_at", "_w", "_before").where("_rank IS NOT NULL")
    joined = placed.join(counted.select("_base", "_rank", "_before"), ["_base", "_rank"], "left")
    return joined.withColumn("_n", F.col("_rank") + F.coalesce("_before", F.lit(0))).drop("_before")


def archive_pages(pages: DataFrame, target: int, max_pages: int, page_size: int = 100, op: str = "op_slug") -> DataFrame:
    """Pages a newest-first walk reads before it stops, with the stop reason on the last.

    Input: operator, ``page`` from 1, ``returned`` rows, ``live`` rows.  A walk stops on a
    short page, at the target, at the page cap, or after two pages with nothing live.  At
    most ``max_pages`` rows per operator are ever looked at.
    """
    upto = Window.partitionBy(op).orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(op).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    ordered = Window.partitionBy(op).orderBy("page")
    seen = F.sum("live").over(upto)
    quiet = (F.col("live") == 0) & (F.lag("live").over(ordered) == 0)
    stop = (
        F.when(F.col("returned") < page_size, F.lit("last page"))
        .when(seen >= target, F.lit("target reached"))
        .when(F.col("page") >= max_pages, F.lit("page cap"))
        .when(quiet, F.lit("two pages with no live products"))
    )
    walked = pages.where(F.col("page") <= max_pages).withColumn("stop", stop)
    ended = F.coalesce(F.max(F.col("stop").isNotNull()).over(before), F.lit(False))
    return walked.withColumn("_ended", ended).where(~F.col("_ended")).drop("_ended")


def page_budget(counts: DataFrame, budget: int, order: str = "position", pages: str = "pages") -> DataFrame:
    """Operators that start before the budget is spent (the last one may overrun it)."""
    total = running(counts, [], order, pages, "_upto")
    return total.where(F.col("_upto") - F.col(pages) < budget).drop("_upto")


def sample_per_group(df: DataFrame, group: str, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of every group."""
    return top_n(df, [group], order, n, "_rank").drop("_rank")


def systematic_sample(df: DataFrame, order: list[str], size: int = 12) -> DataFrame:
    """Every k-th row by the ``order`` columns, about ``size`` of them.

    Only the order columns are dealt into ranges and written; the ranges' counts tell which of them hold a wanted place, and
    only those are put in order.  The rows are then met in the table by a join with ``size`` rows.  Of rows that are equal
    in all order columns, the ones with the least row hash stand first.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    dealt = materialised(df.select(*order).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), path=path)
    # a row for each range
    sizes = [(r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()]
    total = sum(n for _, n in sizes)
    step = max(1, total // size)
    wanted, before = [], 0
    for part, n in sizes:
        wanted += [(part, p - before + 1) for p in range(-(-before // step) * step, min(before + n, step * size), step)]
        before += n
    at = spark.createDataFrame(wanted, "_part int, _at int")
    inside = dealt.where(F.col("_part").isin([p for p, _ in wanted])).withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    # at most ``size`` rows
    picked = inside.join(at, ["_part", "_at"]).groupBy(*[F.col(n).alias(f"_k_{n}") for n in order]).agg(F.count(F.lit(1)).alias("_times"))
    picked = spark.createDataFrame(picked.collect(), picked.schema)
    same = F.lit(True)
    for n in order:
        same = same & df[n].eqNullSafe(picked[f"_k_{n}"])
    met = df.withColumn("_hash", row_hash(df)).join(F.broadcast(picked), same)
    discard(spark, path)
    met = met.withColumn("_copy", F.row_number().over(Window.partitionBy(*order).orderBy("_hash")))
    return met.where(F.col("_copy") <= F.col("_times")).select(*df.columns)
