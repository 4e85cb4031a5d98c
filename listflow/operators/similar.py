"""Near copies among texts: a set-similarity join by prefix filter, in Spark expressions."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import discard, in_slice, materialised, scratch_path, written_in_slices

# the values of all sets are counted one slice of the hashes after the other, so that a fraction of them is on disk at a time
SLICES = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shingles(text: str | Column, width: int) -> Column:
    """Distinct runs of ``width`` words as ascending 64-bit hashes; a shorter text is one run, a text without words has none.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.
    """
    words = F.filter(F.split(F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # one struct so that the words are split once
    bound = F.transform(F.array(words), lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(w, i, width), " "))))
    return F.when(F.size(words) > 0, F.array_sort(F.array_distinct(F.get(bound, F.lit(0))))).otherwise(F.array().cast("array<bigint>"))


def _linkable(rows: DataFrame, percent: int, path: str) -> DataFrame:
    """Ids (id) of the rows (id, n, s) that may have a near copy: ``percent`` / 100 of their values stand in another row too.

    A value of one row only is known by its count; it is told to its row by the least id, so that values are never joined.
    """
    values = rows.select("id", F.explode("s").alias("g"))

    def single(k: int) -> DataFrame:
        counts = values.where(in_slice("g", SLICES, k)).groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id"))
        return counts.where("c = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))

    own = written_in_slices(single, SLICES, path).groupBy("id").agg(F.sum("own").alias("own"))
    # an id of several rows says nothing about any of them
    sizes = rows.where("n > 0").groupBy("id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    few = F.col("n") - F.coalesce("own", F.lit(0)) >= F.ceil(F.col("n") * percent / 100)
    return sizes.join(own, "id", "left").where((F.col("rows") > 1) | few).select("id")


def _links(sets: DataFrame, percent: int, path: str | None = None) -> DataFrame:
    """Pairs (a, b) of sets (rep, n, s) whose Jaccard index is at least ``percent`` / 100.

    Two such sets share one of the rarest n - ceil(n * percent / 100) + 1 values of either, and their sizes differ by that
    share at most: rows meet on a rare value and a class of sizes, so that a value that many sets have splits by size.
    Under a ``path`` every step is written once, so that what it shuffled goes before the next one shuffles.
    """
    written = (lambda df, name: materialised(df, path=f"{path}/{name}")) if path else (lambda df, _: df)
    values = sets.select("rep", "n", F.explode("s").alias("g"))
    # values of one set only are its rarest and meet nothing: they are counted, never sorted or shuffled by set
    often = written(values.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "often")
    ranked = values.join(often, "g").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("c", "g"))).alias("by_rarity"))
    keep = F.greatest(F.size("by_rarity") - F.ceil(F.col("n") * percent / 100) + 1, F.lit(0)).cast("int")
    prefix = ranked.select("rep", "n", F.explode(F.slice("by_rarity", F.lit(1), keep)).alias("v")).select("rep", "n", F.col("v.g").alias("g"))
    prefix = written(prefix, "prefix")
    level = F.floor(F.log(F.col("n").cast("double")) / log(100 / percent) + 1e-9).cast("int") if percent < 100 else F.col("n").cast("int")
    low = prefix.select(F.col("rep").alias("a"), F.col("n").alias("na"), "g", F.explode(F.array(level, level + 1)).alias("level"))
    high = prefix.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "g", level.alias("level"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    near = low.join(high, ["g", "level"]).where(smaller & (F.col("na") * 100 >= F.col("nb") * percent)).select("a", "b").distinct()
    near = written(near, "near")
    sides = [sets.select(F.col("rep").alias(x), F.col("s").alias(f"s{x}")) for x in "ab"]
    both = near.join(sides[0], "a").join(sides[1], "b")
    k = F.size(F.array_intersect("sa", "sb"))
    return both.where(k * 100 >= (F.size("sa") + F.size("sb") - k) * percent).select("a", "b")


def near_copies(df: DataFrame, id_col: str, text_col: str, width: int = 5, percent: int = 80) -> DataFrame:
    """A row for each row of ``df``, whose ids are unique: (id, n_shingles, copy_of, links).

    Two texts are linked when their shingle sets have a Jaccard index of ``percent`` / 100 or more.  ``links`` is how many other
    texts a text is linked with, ``copy_of`` the least id among them if it is less than its own.  Texts with equal sets are compared
    once for all of them.  NULL, empty and blank texts have no shingles and no links; rows without an id are left out.  The
    sets are written once to the shared folder, and removed with the returned frame written beside them: see ``materialised``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "copies")
    rows = df.select(F.col(id_col).alias("id"), shingles(text_col, width).alias("s")).where("id IS NOT NULL")
    rows = materialised(rows.select("id", F.size("s").cast("bigint").alias("n"), F.xxhash64("s").alias("h"), F.xxhash64("s", F.lit(1)).alias("h2"), "s"), path=f"{path}/sets")
    groups = rows.where("n > 0").groupBy("h", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = materialised(groups, path=f"{path}/groups")
    # what follows reads the sets that may have a near copy, one of equal ones, many times
    reps = groups.select("rep").join(_linkable(rows, percent, f"{path}/single"), F.col("rep") == F.col("id"), "left_semi")
    sets = materialised(rows.join(reps, rows["id"] == reps["rep"]).select("rep", "n", "s"), path=f"{path}/linkable")
    links = materialised(_links(sets, percent, path), path=f"{path}/links")
    ends = links.union(links.select("b", "a")).toDF("rep", "other")
    met = ends.join(groups.select(F.col("rep").alias("other"), F.col("copies").alias("theirs")), "other").groupBy("rep").agg(F.min("other").alias("least"), F.sum("theirs").alias("theirs"))
    own = rows.select("id", "n", "h", "h2").join(groups, ["h", "h2"], "left").join(met, "rep", "left")
    least = F.least(F.col("least"), F.col("rep"))
    out = own.select("id", F.col("n").alias("n_shingles"), F.when(least < F.col("id"), least).alias("copy_of"), (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("theirs", F.lit(0))).alias("links"))
    done = materialised(out, "near-copies")
    discard(spark, path)
    return done
