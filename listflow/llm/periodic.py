"""Runs of words that repeat with a period, by string synchronising sets.

At scale t (1, 2, 4 and so on) every t words have a hash; a position is in the synchronising set if the least hash among it and
the t next ones is its own or the last one's. Whether it is depends on the 2 t words behind it alone, so a passage that comes
back brings its positions with it. Two positions of the set with the same 2 t words, 3 t to 6 t apart, propose their distance as a
period; equality is carried on to both sides by comparing hashes of 2 t words, then of half as many, and so on.

Stretches whose period is a third of t or less are left out of the minimum, as all their hashes come back at once; they are runs of
smaller scales, which were found before. Periods 1 and 2, below all scales, are found by comparing neighbours.

Why no run is missed: let a run have period p of 3 or more and 3 p words, and t the power of two in (p / 6, p / 3]. Among its first p
places one begins 3 t - 1 words without a period of t / 3, else all of them, and so the run, would have a smaller period than p.
Among the next t places there is one of the set. It and the place p further lie in the run with their 2 t words. Hashes have
64 bits: two of n different stretches share one with probability about n * n / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_batches
from .subwords import by_bytes, words
from .words import mix

U64 = np.uint64
_NONE = np.iinfo(U64).max
#: Text that is searched at a time, in bytes.
BATCH = 2 << 20


def _doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of 2 t words from those of t; where the words end, of one value for each place."""
    out = mix(np.arange(len(h), dtype=U64) + U64(1 << 62))
    if len(h) > t:
        out[:-t] = mix(h[:-t] * U64(0x9E3779B97F4A7C15) + h[t:])
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values, for places that have so many."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def _synchronising(h: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Places of the set at scale t. ``periodic``: places whose t words have a period of t / 3 or less."""
    own = np.where(periodic, _NONE, h)
    if len(own) <= t:
        return np.empty(0, np.int64)
    least = _least(own, t + 1)
    return np.flatnonzero((least != _NONE) & ((own[: len(least)] == least) | (own[t : t + len(least)] == least)))


def _proposed(at: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of all pairs of the set 3 t to 6 t apart with equal contexts."""
    places, distances = [], []
    first, k = np.arange(len(at)), 1
    while True:
        first = first[first + k < len(at)]
        apart = at[first + k] - at[first]
        near = apart < 6 * t
        first, apart = first[near], apart[near]
        if not len(first):
            break
        same = (apart >= 3 * t) & (context[first] == context[first + k])
        places.append(at[first[same]])
        distances.append(apart[same])
        k += 1
    return np.concatenate([np.empty(0, np.int64), *places]), np.concatenate([np.empty(0, np.int64), *distances])


def _joined(place: np.ndarray, apart: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches [low, high) of equality at a distance, from places that begin ``length`` equal words and adjoin or overlap."""
    order = np.lexsort((place, apart))
    place, apart = place[order], apart[order]
    new = np.ones(len(place), bool)
    new[1:] = (apart[1:] != apart[:-1]) | (place[1:] > place[:-1] + length)
    first = np.flatnonzero(new)
    return place[first], place[np.append(first[1:], len(place))[: len(first)] - 1] + length, apart[first]


def _extended(low: np.ndarray, high: np.ndarray, apart: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equality carried on as far as it goes; levels[k] has the hashes of 2**k words."""
    low, high = low.copy(), high.copy()
    for k in [len(levels) - 1, *range(len(levels) - 1, -1, -1)]:
        h, step = levels[k], 1 << k
        for forth in (True, False):
            left = np.arange(len(low))
            while len(left):
                if forth:
                    here = high[left]
                    good = h[here] == h[here + apart[left]]
                    high[left[good]] += step
                else:
                    here = low[left] - step
                    good = here >= 0
                    here = np.maximum(here, 0)
                    good &= h[here] == h[here + apart[left]]
                    low[left[good]] -= step
                # below the top level a step is taken once at most
                left = left[good]
    return low, high


def _neighbours(h: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [low, high) of words that equal those ``period`` further."""
    same = np.zeros(len(h) + 2, np.int8)
    if len(h) > period:
        same[1 : len(h) - period + 1] = h[:-period] == h[period:]
    turn = np.diff(same)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def _searched(h: np.ndarray, longest: int) -> np.ndarray:
    """Runs (start, end, period) of at least three periods in words given as hashes; texts of up to ``longest`` words, a value of its own behind each and before all."""
    found = []
    for period in (1, 2):
        low, high = _neighbours(h, period)
        found.append(np.stack([low, high + period, np.full(len(low), period)], 1)[high - low >= 2 * period])
    levels, t = [h], 1
    while 9 * t <= longest:
        levels.append(_doubled(levels[-1], t))
        inside = np.zeros(len(h) + 1, np.int32)
        for runs in found:
            held = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
            np.add.at(inside, held[:, 0], 1)
            np.add.at(inside, held[:, 1] - t + 1, -1)
        at = _synchronising(levels[-2], t, np.cumsum(inside[:-1]) > 0)
        place, apart = _proposed(at, levels[-1][at], t)
        if len(place):
            low, high, apart = _joined(place, apart, 2 * t)
            low, high = _extended(low, high, apart, levels)
            runs = np.stack([low, high + apart, apart], 1)[high - low >= 2 * apart]
            found.append(np.unique(runs, axis=0))
        t *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # a multiple of a run's period gives the same stretch
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def runs_of(code: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs (text, start, length, period) of at least ``least`` words, by text, start and period, in words given as codes; and which words stand behind a run's first period."""
    first = np.cumsum(counts) - counts
    scale = np.zeros(len(counts), np.int64)
    scale[counts >= 9] = np.floor(np.log2(counts[counts >= 9] / 9)).astype(np.int64)
    repeated = np.zeros(len(code) + 1, np.int32)
    out = []
    for s in np.unique(scale[counts >= max(3, least)]):
        # texts that go to the same scale together
        own = np.flatnonzero((scale == s) & (counts >= max(3, least)))
        size = counts[own] + 1
        begin = np.cumsum(size) - size + 1
        h = mix(np.arange(int(size.sum()) + 1, dtype=U64) + U64(1 << 63))
        into = np.arange(int(counts[own].sum())) + np.repeat(begin - (np.cumsum(counts[own]) - counts[own]), counts[own])
        from_ = np.arange(len(into)) + np.repeat(first[own] - (np.cumsum(counts[own]) - counts[own]), counts[own])
        h[into] = mix(code[from_].astype(U64))
        runs = _searched(h, int(counts[own].max()))
        length = runs[:, 1] - runs[:, 0]
        runs, length = runs[length >= least], length[length >= least]
        text = np.searchsorted(begin, runs[:, 0], "right") - 1
        start = runs[:, 0] - begin[text]
        text = own[text]
        out.append(np.stack([text, start, length, runs[:, 2]], 1))
        np.add.at(repeated, first[text] + start + runs[:, 2], 1)
        np.add.at(repeated, first[text] + start + length, -1)
    rows = np.concatenate([np.empty((0, 4), np.int64), *out])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))], np.cumsum(repeated[:-1]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(least: int):
    def run(batches):
        for batch in batches:
            for low, high in by_bytes(batch.column(1), BATCH):
                parts, counts = words(batch.column(1).slice(low, high - low))
                code = parts.indices.to_numpy().astype(np.int64)
                rows, repeated = runs_of(code, counts, least)
                ends = np.cumsum(np.append(0, np.bincount(rows[:, 0], minlength=high - low)))
                runs = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in (1, 2, 3)], fields=list(_RUN)))
                kept = np.bincount(np.repeat(np.arange(high - low), counts)[~repeated], minlength=high - low)
                left = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))), parts.dictionary.take(pa.array(code[~repeated])))
                shown = pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), runs, shown], ["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24) -> DataFrame:
    """Runs of every whole text, a row for each row of ``docs``: (doc_id, runs, collapsed).

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of at least ``least`` words and of three times its smallest
    period, words one period apart being equal, that no neighbouring word extends. ``runs``: array of structs (start, length, period)
    by start, then period. ``collapsed``: the words that stand in no run, or in the first period of all runs they are in, with blanks between.
    A null, empty or blank text has no runs and collapses to ''. Repeated rows and null ids are rows like others; an empty
    table gives an empty one. Other columns are not looked at. No exchange: texts stay where they are read.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.transform(in_batches, _found(least), "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Figures of ``periodic_runs``: how many runs, the one with the greatest length / period, and digests of the runs and of the collapsed text."""
    best = F.expr("aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (a, b) -> if(b.length * a.period > a.length * b.period, b, a))")
    shown = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period")))), "\n")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{x}").alias(x) for x in ("start", "length", "period")),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(shown, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
