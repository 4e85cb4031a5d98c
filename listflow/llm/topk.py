"""Exact top-k inner products with multi-resolution segment statistics.

Every vector is described by the mean and deviation of its segments, 4 and then 16 of them. For two vectors
|q - x|**2 >= sum over segments of length * ((mean difference)**2 + (deviation difference)**2), so with the norms known
q * x <= sum of length * (mean * mean + deviation * deviation): lower-bound distances, coarse to fine, as two matrix
products. Only candidates whose bound reaches the k-th best exact score so far get their exact score.

Queries and candidates are packed into blocks of fixed size; a cell of the join is one block of each, dealt by its own
key. A cell returns its k best, so what meets for a query is k rows for each block of candidates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, BASE_BLOCK = 1024, 16384
LEVELS = (4, 16)


def segments(x: np.ndarray, parts: int) -> np.ndarray:
    """Means and deviations of ``parts`` segments of every row, scaled so that a dot product bounds the inner product."""
    cuts = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
    size = np.diff(cuts)
    total = np.add.reduceat(x, cuts[:-1], axis=1)
    spread = np.sqrt(np.maximum(np.add.reduceat(x * x, cuts[:-1], axis=1) - total * total / size, 0))
    return np.hstack([total / np.sqrt(size), spread])


def _dot(q: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """x[at] @ q; over all rows if most are asked for, which spares the copy."""
    return (x @ q)[at] if 2 * len(at) > len(x) else x[at] @ q


def _exact(q: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; beyond 2**53 with Python's integers, held to the range of a long."""
    if float(np.abs(q).max()) * float(np.abs(x).max()) * x.shape[1] < 2**53:
        return _dot(q, x, at)
    return np.array([max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(q, x[i], strict=True)))) for i in at], dtype=object)


def best(q_id: np.ndarray, q: np.ndarray, x_id: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(query row, candidate row, score) of each query's k best in one cell, its own id left out; ties to smaller ids."""
    order = np.argsort(x_id, kind="stable")
    x_id, x = x_id[order], x[order]
    slack = 1 + 1e-9 * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1]
    coarse = segments(q, LEVELS[0]) @ segments(x, LEVELS[0]).T + slack
    fine_q, fine_x = segments(q, LEVELS[1]), segments(x, LEVELS[1])
    rows, found, scores = [], [], []
    for i in range(len(q)):
        own = coarse[i]
        own[np.searchsorted(x_id, q_id[i], "left") : np.searchsorted(x_id, q_id[i], "right")] = -np.inf
        many = min(4 * k, len(own))
        seeds = np.argpartition(-own, many - 1)[:many]
        seeds = seeds[own[seeds] > -np.inf]
        score = _exact(q[i], x, seeds)
        # nothing below the k-th best exact score so far can be among the k best
        floor = np.sort(score)[-k] if len(score) >= k else -np.inf
        left = np.flatnonzero((own >= floor) & (own > -np.inf))
        left = left[_dot(fine_q[i], fine_x, left) + slack >= floor]
        score = _exact(q[i], x, left)
        good = np.flatnonzero(score >= floor)
        good = good[np.lexsort((x_id[left[good]], -score[good]))[:k]] if score.dtype != object else sorted(good, key=lambda j: (-score[j], x_id[left[j]]))[:k]
        rows += [i] * len(good)
        found += [order[left[j]] for j in good]
        scores += [int(score[j]) for j in good]
    return np.array(rows, int), np.array(found, int), scores


def _cell(k: int):
    def run(key, queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or base.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        # copies of a row would take each other's places among the k best
        queries, base = (df.loc[~df.assign(v=df["v"].map(lambda v: v.tobytes()))[["id", "v"]].duplicated()] if df["id"].duplicated().any() else df for df in (queries, base))
        q, x = np.stack(queries["v"].to_numpy()), np.stack(base["v"].to_numpy())
        q_id, x_id = queries["id"].to_numpy(), base["id"].to_numpy()
        i, j, score = best(q_id, q, x_id, x, k)
        return pd.DataFrame({"query_id": q_id[i], "vec_id": x_id[j], "score": score})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of every query: (query_id, rank, vec_id, score).

    Components become floor(scale * x). Vectors that are null, empty, or hold null or non-finite components take no part,
    nor do rows without an id. A query meets vectors of its own length only and no row of its own id. Ties go to the
    smaller vec_id; a row that is repeated counts once, and a query id with several vectors gets the best of all. An empty
    table gives an empty table; other columns are not looked at. Scores beyond a long count as its nearest value.
    """

    def whole(df: DataFrame) -> DataFrame:
        x = F.col(vector_col)
        good = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))), F.lit(False)))
        return df.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("v"))

    base, asked = whole(vectors), whole(queries)
    n, m = (max(1, -(-df.select(id_col).count() // block)) for df, block in ((vectors, BASE_BLOCK), (queries, QUERY_BLOCK)))
    # cells of a few blocks still give every core work
    n = max(n, min(12, vectors.sparkSession.sparkContext.defaultParallelism * 2))
    part = F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    left = asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(m)).cast("int").alias("qp"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bp"), F.size("v").alias("dims"))
    right = base.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("qp"), part.alias("bp"), F.size("v").alias("dims"))
    cells = left.groupBy("qp", "bp", "dims").cogroup(right.groupBy("qp", "bp", "dims")).applyInPandas(_cell(k), "query_id long, vec_id long, score long").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
