"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are dealt into blocks in an order drawn by hash. Block k of a source of weight w is released at
slot floor(k / w) and due by slot ceil((k + 1) / w); a slot emits one block, the released one with the earliest deadline.
With weights that sum to 1 no deadline is missed, so at every slot each source is within one block of its share. Weights
are whole numbers over one sum of 2**60 or so, and blocks are as large as it takes for the whole schedule to be at most so many slots: it
is worked out once, from nothing but the sources' counts, and every block finds its slot by a join.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import fixed

#: Documents of a source are ranked in runs of about so many.
RUN = 250


def whole(weights: dict) -> dict:
    """The weights as positive whole numbers, exact to 2**-60 of their sum."""
    total = sum(weights.values())
    return {s: max(1, round(w / total * (1 << 60))) for s, w in weights.items()}


def schedule(share: dict, blocks: dict) -> tuple[list[tuple[object, int, int, int, int]], int]:
    """Every block as (source, k, slot, release, deadline), and the first slot at which some source has run out.

    Earliest deadline first among released blocks, ties by source. Once a source has run out, nothing waits for its release any more.
    """
    total = sum(share.values())
    waiting = [(0, str(s), s, 0) for s in share if blocks[s]]  # by release
    heapq.heapify(waiting)
    ready, out, horizon, slot = [], [], None, 0
    while waiting or ready:
        while waiting and (waiting[0][0] <= slot or horizon is not None):
            release, name, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // share[s]), name, release, s, k))
        deadline, name, release, s, k = heapq.heappop(ready)
        out.append((s, k, slot, min(release, slot), deadline))
        slot += 1
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, ((k + 1) * total // share[s], name, s, k + 1))
        elif horizon is None:
            horizon = slot
    return out, horizon or 0


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, block: int = 32, most_blocks: int = 1 << 17, most_sources: int = 100_000, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Every document once, with its place in the mixture: (doc_id, source, block, release, deadline, slot, place, on_target).

    ``weights`` names target weights by source; sources without one, and all if it is None, get the share of their count
    to the power ``power``. Documents of a source are ordered by a hash of their id; ``block`` of them make a block, or more where there would
    be over ``most_blocks`` blocks. ``place`` is the document's number within its slot, so ordering by slot and place is the mixture.
    ``on_target`` holds until some source has run out: up to there, every source is within one block of its weight at every slot.
    Nothing is dropped or repeated: what is left of larger sources follows by deadline. Sources must number at most
    ``most_sources`` (an error beyond, as the schedule, a row for each block, is worked out on the driver and broadcast). A null source is a source of its own; null ids and
    repeated rows are documents like others and share a hash. An empty table gives an empty one. Other columns are not read.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(id_col).cast("long"), F.lit(41)).alias("h"))
    total = [(r["source"], r["n"]) for r in named.groupBy("source").agg(F.count(F.lit(1)).alias("n")).limit(most_sources + 1).collect()]
    if len(total) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    given = weights or {}
    natural = {s: n**power for s, n in total}
    free = max(0.0, 1 - sum(given.get(s, 0) for s, _ in total)) if given else 1.0
    rest = sum(natural[s] for s, _ in total if s not in given) or 1.0
    weight = {s: max(1e-12, given.get(s, free * natural[s] / rest)) for s, _ in total}
    block = max(block, -(-sum(n for _, n in total) // most_blocks))
    plan, horizon = schedule(whole(weight) if total else {}, {s: -(-n // block) for s, n in total})
    slots = spark.createDataFrame([(s, int(k), int(t), int(r), int(d)) for s, k, t, r, d in plan], "s2 string, k long, t long, r long, d long")

    # rank within a source: documents before its bucket of the hash, and its place in the bucket
    bits = spark.createDataFrame([(s, max(0, (n // RUN).bit_length())) for s, n in total], "s3 string, bits int")
    named = named.join(F.broadcast(bits), named["source"].eqNullSafe(F.col("s3"))).drop("s3")
    bucket = F.when(F.col("bits") == 0, F.lit(0)).otherwise(F.expr("shiftrightunsigned(h, 64 - bits)"))
    filled = fixed(named.groupBy("source", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")))
    # counts of buckets in two levels, so that no window holds all buckets of a large source
    high = F.shiftright("b", 12)
    over = filled.groupBy("source", high.alias("hi")).agg(F.sum("n").alias("m"))
    before = Window.partitionBy("source").orderBy("hi").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("source", "hi").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    over = over.withColumn("up", F.coalesce(F.sum("m").over(before), F.lit(0)))
    ahead = filled.withColumn("hi", high).withColumn("in", F.coalesce(F.sum("n").over(within), F.lit(0)))
    null_safe = [ahead["source"].eqNullSafe(over["source"]), ahead["hi"] == over["hi"]]
    ahead = fixed(ahead.join(over, null_safe).select(ahead["source"].alias("s2"), F.col("b").alias("b2"), (F.col("in") + F.col("up")).alias("ahead")))
    rows = named.withColumn("b", bucket).withColumn("at", F.row_number().over(Window.partitionBy("source", "b").orderBy("h", "doc_id")) - 1)
    rows = rows.join(ahead, rows["source"].eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")))
    rank = F.col("at") + F.col("ahead")
    rows = rows.select("doc_id", "source", F.floor(rank / block).alias("block"), (rank % block).alias("place"))
    # at most most_blocks + most_sources rows
    joined = rows.join(F.broadcast(slots), rows["source"].eqNullSafe(F.col("s2")) & (F.col("block") == F.col("k")))
    return joined.select(
        "doc_id",
        "source",
        F.col("block").cast("long").alias("block"),
        F.col("r").alias("release"),
        F.col("d").alias("deadline"),
        F.col("t").alias("slot"),
        F.col("place").cast("long").alias("place"),
        (F.col("t") < horizon).alias("on_target"),
    )
