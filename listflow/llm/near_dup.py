"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

Documents whose sets of word shingles are equal form a class, found by grouping; one of each class goes on. Its set is
hashed once; the hash's top bits choose a bin and the least value of each bin is the signature. Empty bins take the
value of a filled bin drawn by a hash of (bin, attempt) alone. Bands of bins are bucket keys. Each bucket proposes edges
to its most popular member (the one in the largest buckets, so the original rather than one of its copies); a bucket of
up to ``SMALL`` proposes all its pairs. Candidates are confirmed on the full shingle sets, and links are closed to
components. Large buckets that still hold several components are finished exactly: their members are dealt into blocks,
and every two blocks that hold different components are compared on the full sets, all pairs of them.

A link at the threshold shares no band with probability below (1 - 0.8**4)**32 = 5e-8. Pairs grow with bucket sizes and
never with their squares, but for the exact finish: there the comparisons of members of different components do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, fixed, in_batches, scratch
from .words import hashes, mix, shingles, slices, utf8

U64 = np.uint64
#: Buckets of up to so many documents propose all their pairs.
SMALL = 8
#: Documents and shingles that a block of the exact finish holds on average.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20


def _draws(bins: int) -> np.ndarray:
    """For every attempt and bin, the bin to copy from. The last attempts visit every bin."""
    tries = mix(np.arange(4 * bins, dtype=U64)[:, None] * U64(bins) + np.arange(bins, dtype=U64) + U64(99)) % U64(bins)
    rest = (np.arange(bins)[:, None] + np.arange(bins)) % bins
    return np.concatenate([tries.astype(np.int64), rest])


def signature(value: np.ndarray, doc: np.ndarray, n: int, bins: int) -> np.ndarray:
    """Densified one-permutation MinHash of ``n`` sets given as ascending hashes; a row per set, zeros for empty sets."""
    shift = U64(64 - (bins.bit_length() - 1))
    where = (value >> shift).astype(np.int64)
    cell = doc * bins + where
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    out = np.zeros(n * bins, U64)
    filled = np.zeros(n * bins, bool)
    out[cell[new]], filled[cell[new]] = value[new], True
    out, filled = out.reshape(n, bins), filled.reshape(n, bins)
    row, col = np.nonzero(~filled & filled.any(1)[:, None])
    for draw in _draws(bins):
        if not len(row):
            break
        good = filled[row, draw[col]]
        out[row[good], col[good]] = out[row[good], draw[col[good]]]
        row, col = row[~good], col[~good]
    return out


def _signed(width: int, bins: int, rows: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            for part in slices(texts):
                h, counts = hashes(texts[part])
                value, doc, size = shingles(h, counts, width)
                n = len(size)
                some = size > 0
                first = (np.cumsum(size) - size)[some]
                sums = np.zeros((2, n), U64)
                if len(value):
                    sums[0, some], sums[1, some] = np.add.reduceat(value, first), np.add.reduceat(mix(value + U64(1)), first)
                bands = signature(value, doc, n, bins).reshape(n, bins // rows, rows)
                key = np.broadcast_to(np.arange(bins // rows, dtype=U64), bands.shape[:2]).copy()
                for k in range(rows):
                    key = mix(key * U64(0xD6E8FEB86659FD93) + bands[:, :, k])
                keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * key.shape[1], pa.int32()), pa.array(key.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(part.start, n), pa.array(size), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), keys], ["id", "n", "h1", "h2", "keys"])

    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), utf8(batch.column(1))
            for part in slices(texts):
                value, _, size = shingles(*hashes(texts[part]), width)
                ends = np.cumsum(size)
                blobs = [value[e - s : e].tobytes() for s, e in zip(size, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(part.start, len(size)), pa.array(blobs, pa.binary())], ["id", "shingles"])

    return run


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if len(a) > len(b):
                    a, b = b, a
                both = 0
                if 100 * len(a) >= percent * len(b):
                    at = np.searchsorted(b, a)
                    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["m", "c"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every id in ``edges`` (m, c): (id, component). Labels are lowered and jumped until none changes."""
    ends = fixed(edges.select(F.col("m").alias("id"), F.col("c").alias("to")).union(edges.select("c", "m")).distinct())
    labels = fixed(ends.groupBy("id").agg(F.least("id", F.min("to")).alias("component")))
    while True:
        other = labels.select(F.col("id").alias("to"), F.col("component").alias("theirs"))
        near = fixed(ends.join(other, "to").groupBy("id").agg(F.min("theirs").alias("theirs")))
        low = labels.join(near, "id").select("id", F.least("component", "theirs").alias("component"), F.col("component").alias("was"))
        jump = fixed(low.select(F.col("id").alias("component"), F.col("component").alias("jumped")))
        step = fixed(fixed(low).join(jump, "component").select("id", F.least("component", "jumped").alias("component"), "was"))
        labels = step.drop("was")
        if step.where("component < was").isEmpty():
            return labels


def _proposed(kept: Scratch, rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Buckets of two and more as (key, id, size, pop), and the edges (m, c) that they propose."""
    sizes = kept.keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), f"{name}-sizes")
    hits = kept.keep(rows.join(sizes, "key"), f"{name}-hits")
    pop = kept.keep(hits.groupBy("id").agg(F.sum("size").alias("pop")), f"{name}-pop")
    hits = kept.keep(hits.join(pop, "id"), f"{name}-ranked")
    rank = F.struct("pop", (-F.col("id")).alias("minus"))
    centre = kept.keep(hits.where(F.col("size") > SMALL).groupBy("key").agg(F.max(rank).alias("top")), f"{name}-centres")
    star = hits.where(F.col("size") > SMALL).join(centre, "key").select(F.col("id").alias("m"), (-F.col("top.minus")).alias("c"))
    # at most SMALL structs in an array
    few = hits.where(F.col("size") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list(rank)).alias("own"))
    pairs = few.select(F.posexplode("own").alias("k", "low"), "own").select("low", F.explode(F.slice("own", F.col("k") + 2, SMALL)).alias("high"))
    pairs = pairs.select((-F.col("low.minus")).alias("m"), (-F.col("high.minus")).alias("c"))
    return hits, kept.keep(star.where("m <> c").union(pairs).distinct(), f"{name}-edges")


def _confirmed(kept: Scratch, docs: DataFrame, edges: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    ids = edges.select(F.col("m").alias("id")).union(edges.select("c")).distinct()
    # one plan at every size: texts are dealt by id, once in a round, and only those of candidates are read again
    sets = kept.keep(docs.join(ids.hint("merge"), "id", "left_semi").transform(in_batches, _sets(width), "id long, shingles binary"), f"{name}-sets")
    sets = sets.dropDuplicates(["id"]) if not sets.groupBy("id").count().where("count > 1").isEmpty() else sets
    one = edges.join(sets.select(F.col("id").alias("m"), F.col("shingles").alias("x")), "m")
    two = one.join(sets.select(F.col("id").alias("c"), F.col("shingles").alias("y")), "c").select("m", "c", "x", "y")
    return kept.keep(two.transform(in_batches, _linked(percent), "m long, c long"), f"{name}-links")


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many values every set of ``x`` shares with every set of ``y``. Sets are ascending."""
    both = np.zeros((len(x), len(y)))
    vx, vy = np.concatenate(x), np.concatenate(y)
    shared = np.intersect1d(vx, vy)
    if not len(shared):
        return both

    def cells(values, sets):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        good = shared[at] == values
        order = np.argsort(at[good], kind="stable")
        return at[good][order], owner[good][order]

    (ax, ox), (ay, oy) = cells(vx, x), cells(vy, y)
    nx, ny = np.bincount(ax, minlength=len(shared)), np.bincount(ay, minlength=len(shared))
    # values of few sets go pair by pair, the others through matrices of so many columns
    rare = nx * ny <= 64
    many, first = ny[ax] * rare[ax], np.cumsum(ny) - ny
    for low in range(0, len(ax), 1 << 16):
        n = many[low : low + (1 << 16)]
        row = np.repeat(ox[low : low + (1 << 16)], n)
        col = oy[np.repeat(first[ax[low : low + (1 << 16)]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        both += np.bincount(row * len(y) + col, minlength=both.size).reshape(both.shape)
    often = np.flatnonzero(~rare)
    for low in range(0, len(often), 2048):
        part = often[low : low + 2048]
        sides = []
        for at, owner, n in ((ax, ox, len(x)), (ay, oy, len(y))):
            k = np.searchsorted(part, at)
            good = part[np.minimum(k, len(part) - 1)] == at
            side = np.zeros((n, len(part)), np.float32)
            side[owner[good], k[good]] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    return both


def _compared(percent: int):
    """Links between different components of two blocks, as many as join the components that links join."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, names, right = (np.asarray(table.column(c)) for c in ("id", "component", "right"))
        sets = [np.frombuffer(x.as_buffer(), U64) for x in table.column("shingles")]
        left, right = np.flatnonzero(~right.astype(bool)), np.flatnonzero(right.astype(bool))
        right = right if len(right) else left
        out = []
        if len(left):
            both = _overlaps([sets[i] for i in left], [sets[i] for i in right])
            size = np.array([len(s) for s in sets])
            hit = 100 * both >= percent * (size[left][:, None] + size[right] - both)
            root: dict[int, int] = {}

            def find(k):
                while (up := root.setdefault(k, k)) != k:
                    root[k] = k = root[up]
                return k

            for i, j in zip(*np.nonzero(hit & (names[left][:, None] != names[right])), strict=True):
                m, c = find(names[left[i]]), find(names[right[j]])
                if m != c:
                    root[m] = c
                    out.append((ids[left[i]], ids[right[j]]))
        return pa.table({"m": pa.array([m for m, _ in out], pa.int64()), "c": pa.array([c for _, c in out], pa.int64())})

    return run


def _finished(kept: Scratch, docs: DataFrame, large: DataFrame, sizes: DataFrame, labels: DataFrame, width: int, percent: int) -> DataFrame:
    """Every link between different components within the buckets of ``large`` (key, id), or as many as join the same components.

    Buckets that overlap form a family. A family is compared as a whole where that is less than bucket by bucket.
    """
    named = large.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = kept.keep(named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("low < high").select("key", "first", "n"), "mixed")
    if mixed.isEmpty():
        return labels.limit(0).select(F.col("id").alias("m"), F.col("component").alias("c"))
    named = kept.keep(named.join(mixed, "key"), "mixed-members")
    # buckets stand for their first members here, joined through the least of them that a document knows
    least = named.groupBy("id").agg(F.min("first").alias("c"))
    family = components(kept.keep(named.join(least, "id").select(F.col("first").alias("m"), "c").where("m <> c").distinct(), "bucket-links"))
    buckets = mixed.join(family.withColumnRenamed("id", "first"), "first", "left").select("key", "n", F.coalesce("component", "first").alias("family"))
    buckets = kept.keep(buckets, "buckets")
    apart = buckets.groupBy("family").agg(F.sum(F.col("n") * F.col("n")).alias("apart"))
    whole = named.select("key", "id").join(buckets, "key").select("family", "id").distinct().groupBy("family").agg(F.count(F.lit(1)).alias("all"))
    whole = whole.join(apart, "family").select("family", (F.col("all") * F.col("all") <= F.col("apart")).alias("whole"))
    group = F.when(F.col("whole"), F.struct(F.lit(0).alias("of"), F.col("family").alias("no"))).otherwise(F.struct(F.lit(1).alias("of"), F.col("key").alias("no")))
    groups = kept.keep(buckets.join(whole, "family").select("key", group.alias("group")), "groups")
    members = named.join(groups, "key").select("group", "id", "component").distinct()
    members = kept.keep(members.join(sizes, "id"), "group-members")

    # a component that fills blocks has its own, which are not compared with each other; the others share blocks
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK), F.ceil(F.col("held") / BLOCK_SHINGLES))
    held = members.groupBy("group", "component").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("held")).withColumn("own", blocks)
    held = kept.keep(held, "group-components")
    rest = held.where("own = 1").groupBy("group").agg(F.sum("docs").alias("docs"), F.sum("held").alias("held")).select("group", blocks.alias("shared"))
    dealt = members.join(held.select("group", "component", "own"), ["group", "component"]).join(rest, "group", "left")
    # no nulls in a block's name, as hashes skip them
    own = F.struct(F.lit(1).alias("full"), F.col("component").alias("only"), F.pmod(F.xxhash64("id"), "own").alias("no"))
    shared = F.struct(F.lit(0).alias("full"), F.lit(0).cast("long").alias("only"), F.pmod(F.xxhash64("component", F.lit(1)), "shared").alias("no"))
    block = F.when(F.col("own") > 1, own).otherwise(shared)
    dealt = kept.keep(dealt.select("group", "id", "component", block.alias("block")), "blocks")
    some = dealt.select("group", "block").distinct()
    pairs = some.withColumnRenamed("block", "low").join(some.withColumnRenamed("block", "high"), "group").where("low < high and not (low.full = 1 and high.full = 1 and low.only = high.only) or low = high and low.full = 0")
    pairs = kept.keep(pairs, "block-pairs")
    lows = dealt.join(pairs.withColumn("block", F.col("low")), ["group", "block"]).withColumn("right", F.lit(False))
    highs = dealt.join(pairs.where("low < high").withColumn("block", F.col("high")), ["group", "block"]).withColumn("right", F.lit(True))
    rows = lows.unionByName(highs).select("group", "low", "high", "right", "id", "component")
    sets = kept.keep(docs.join(dealt.select("id").distinct().hint("merge"), "id", "left_semi").transform(in_batches, _sets(width), "id long, shingles binary"), "group-sets")
    sets = sets.dropDuplicates(["id"]) if not sets.groupBy("id").count().where("count > 1").isEmpty() else sets
    full = rows.join(sets, "id").select(F.xxhash64("group", "low", "high").alias("pair"), "right", "id", "component", "shingles")
    return kept.keep(full.groupBy("pair").applyInArrow(_compared(percent), "m long, c long"), "finished")


def near_duplicates(docs: DataFrame, id_col: str | Column = "doc_id", text_col: str | Column = "text", width: int = 5, percent: int = 80, bins: int = 128, rows: int = 4) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard index of at least ``percent`` / 100.

    Returns (doc_id, n_shingles, component_id, kept), a row for each row of ``docs``. Words are ``[^\\x20\\x09-\\x0D]+``
    after A-Z are lower-cased, of whole texts. A null or blank text has no shingles and links with nothing; a text of
    fewer than ``width`` words has one. Rows that repeat a doc_id are one document and must repeat its text. A null
    doc_id is its own group: component_id null, kept true. An empty table gives an empty table; other columns are
    not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id") if isinstance(id_col, str) else id_col.cast("long").alias("id"), (F.col(text_col) if isinstance(text_col, str) else text_col).alias("text"))
    with scratch(docs.sparkSession) as kept:
        signed = kept.keep(docs.transform(in_batches, _signed(width, bins, rows), "id long, n long, h1 long, h2 long, keys array<long>"), "signed")
        some = signed.where("n > 0 and id is not null")
        classes = kept.keep(some.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"), "classes")
        members = kept.keep(some.join(classes, ["h1", "h2"], "left").select("id", F.coalesce("rep", "id").alias("rep"), "keys"), "members")
        reps = members.where("id = rep").select("id", "keys")

        found, edges = _proposed(kept, reps.select("id", F.explode("keys").alias("key")), "r0")
        large = found.where(F.col("size") > SMALL).select("key", "id")
        links = _confirmed(kept, docs, edges, width, percent, "r0")
        labels = components(links)
        fresh = _finished(kept, docs, large, signed.select("id", "n").dropDuplicates(["id"]), labels, width, percent)
        if not fresh.isEmpty():
            labels = components(links.union(fresh))
        # a class's representative stands for its members, which may have smaller components than their own ids
        labels = labels.withColumnRenamed("id", "rep")
        named = members.join(labels, "rep", "left").select("id", F.coalesce("component", "rep").alias("component")).distinct()
        named = kept.keep(named, "named")
        out = signed.select("id", "n").join(named, "id", "left")
        out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        return fixed(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
