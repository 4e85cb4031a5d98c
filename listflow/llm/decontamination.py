"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages: windows of ``WINDOW`` segments of ``SEGMENT`` words, one begun at every segment. Terms are the
words of the benchmark (other words add nothing to an inner product with an item); terms in more than ``COMMON`` of all
segments carry no weight. A distributed randomised SVD of the TF-IDF passages (one pass: B = A'(A Omega), then Nystroem's
decomposition of A'A from B and Omega) gives the latent space. A passage whose projection points along an item's and covers
enough of it is a candidate. Candidates are checked where they are found: longest common subsequence of words, and how much of
the item's last words, its answer, the subsequence holds. Beside this, every run of ``RUN`` consecutive words of an item (of all
its words, if it has fewer) is looked up by hash, wherever it stands in text and item; it needs no projection and no answer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_batches, scratch
from .words import hashes, slices, utf8

SEGMENT, WINDOW, PIECE = 32, 3, 64
COMMON, FEW = 0.001, 3
ANSWER = 8
COSINE, COVER, LCS, ANSWERED, SURE = 0.25, 0.3, 0.6, 0.5, 0.8
#: Consecutive words of an item that are a leak by themselves.
RUN = 13
TERMS = 256
_GAPS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, where everything but letters and figures is a gap."""
    return hashes([t.translate(_GAPS) for t in texts])


@dataclass
class Items:
    """Benchmark pieces of at most PIECE words: the item of each, its words, and the distinct terms of all; and runs by their lengths."""

    item: list[int]
    words: list[np.ndarray]
    terms: np.ndarray
    runs: dict[int, tuple[np.ndarray, np.ndarray]]  # ascending hashes, and a piece that holds each


def run_hashes(h: np.ndarray, sizes) -> dict[int, np.ndarray]:
    """For every size the hashes of so many consecutive words, by the first of them. Texts that follow each other are not kept apart."""
    out, value = {}, np.zeros(len(h), np.uint64)
    for k in range(min(max(sizes, default=0), len(h))):
        value = (value[: len(h) - k] + h[k:]) * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
        if k + 1 in sizes:
            out[k + 1] = value
    return out


def read_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", most_bytes: int = 64 << 20) -> Items:
    """The benchmark on the driver; more than ``most_bytes`` of text is an error. Null and blank items, and items without an id, are left out."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    size = rows.select(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text, more than {most_bytes}")
    own = sorted({(r["i"], r["t"]) for r in rows.collect()})
    h, counts = words([t.encode() for _, t in own])
    ends = np.cumsum(counts)
    item, pieces, runs = [], [], {}
    for (i, _), end, n in zip(own, ends, counts, strict=True):
        if not n:
            continue
        cuts = np.cumsum([0] + [len(x) for x in np.array_split(np.empty(n), -(-n // PIECE))])
        middle = (cuts[1:] + cuts[:-1]) // 2
        # the parts, and others from the middle of one to the middle of the next
        parts = [*zip(cuts[:-1], cuts[1:], strict=True), *zip(middle[:-1], middle[1:], strict=True)]
        size = int(min(n, RUN))
        value = run_hashes(h[end - n : end], {size})[size]
        first = np.arange(len(value))
        where = np.zeros(len(value), np.int64)
        for low, high in parts:
            where[(first >= low) & (first + size <= high)] = len(pieces)
            item.append(i)
            pieces.append(h[end - n + low : end - n + high])
        runs.setdefault(size, []).append((value, where))
    for size, found in runs.items():
        value, where = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(value, kind="stable")
        runs[size] = value[order], where[order]
    return Items(item, pieces, np.unique(np.concatenate(pieces)) if pieces else np.empty(0, np.uint64), runs)


def segmented(texts: list[bytes], terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, words and segments of each text, and for the words that are terms their segment and term number."""
    h, counts = words(texts)
    parts = -(-counts // SEGMENT)
    # most words are ruled out by 16 bits of their hash
    maybe = np.zeros(1 << 16, bool)
    maybe[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True
    hit = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(terms, h[hit]), len(terms) - 1)
    good = terms[at] == h[hit]
    hit, at = hit[good], at[good]
    inside = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
    segment = np.repeat(np.cumsum(parts) - parts, counts) + inside // SEGMENT
    return h, counts, parts, segment[hit], at


def _counted(terms: np.ndarray):
    def run(batches):
        total, n = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            texts = utf8(batch.column(0))
            for part in slices(texts):
                _, _, parts, segment, term = segmented(texts[part], terms)
                n += int(parts.sum())
                total += np.bincount(np.unique(segment * len(terms) + term) % len(terms), minlength=len(terms))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["term", "n"])

    return run


def _neighbours(x: np.ndarray, parts: np.ndarray, ahead: bool) -> np.ndarray:
    """Sums of each segment's row with the WINDOW - 1 after it (or before it) in its text."""
    out = x.copy()
    left = np.repeat(np.cumsum(parts), parts) - np.arange(len(x)) - 1
    before = np.arange(len(x)) - np.repeat(np.cumsum(parts) - parts, parts)
    for k in range(1, WINDOW):
        i = np.flatnonzero((left if ahead else before) >= k)
        out[i] += x[i + k] if ahead else x[i - k]
    return out


def _summed(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by number."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        out[at[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _sketched(terms: np.ndarray, weight: np.ndarray, omega: np.ndarray):
    """B = A'(A omega) of a task's passages, in rows of TERMS terms."""

    def run(batches):
        total, scaled = np.zeros(omega.shape), (omega * weight[:, None]).astype(np.float32)
        for batch in batches:
            texts = utf8(batch.column(0))
            for part in slices(texts):
                _, _, parts, segment, term = segmented(texts[part], terms)
                if not len(term):
                    continue
                y = _summed(scaled[term], segment, int(parts.sum()))
                # a word stands in all windows begun at its segment or the ones before
                z = _neighbours(_neighbours(y, parts, True), parts, False)
                total += _summed(z[segment], term, len(terms)) * weight[:, None]
        cut = range(0, len(terms), TERMS)
        yield pa.RecordBatch.from_pydict({"salt": pa.array([TaskContext.get().partitionId() // 64] * len(cut), pa.int64()), "at": pa.array(list(cut), pa.int64()), "data": pa.array([total[k : k + TERMS].tobytes() for k in cut], pa.binary())})

    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x) for x in pdf["data"])
    return pd.DataFrame({"salt": pdf["salt"].iloc[:1] // 64, "at": pdf["at"].iloc[:1], "data": [total.tobytes()]})


def nystroem(b: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """Orthonormal directions of the positive matrix M of which b = M omega is known."""
    shift = 1e-10 * np.linalg.norm(b)
    b = b + shift * omega
    core = omega.T @ b
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > 1e-12 * max(value.max(initial=0), 1e-300)
    u, s, _ = np.linalg.svd(b @ (vector[:, good] / np.sqrt(value[good])), full_matrices=False)
    return u[:, s > 1e-7 * s.max(initial=0)]


@dataclass
class Space:
    """What a task needs: the pieces, the weighted terms, and the projections of terms and pieces."""

    item: np.ndarray
    words: list[np.ndarray]
    terms: np.ndarray
    project: np.ndarray  # (terms, k): weight times direction
    pieces: np.ndarray  # (pieces, k)
    runs: dict[int, tuple[np.ndarray, np.ndarray]]


def fit(docs: DataFrame, items: Items, text_col: str = "text", extra: int = 32, most_rank: int = 512, seed: int = 11) -> Space:
    """Term counts and the randomised SVD over all passages of ``docs``. Rank: a direction for each piece and ``extra`` more, up to ``most_rank``."""
    texts, terms = docs.select(F.col(text_col).alias("text")), items.terms
    if not len(terms):
        return Space(np.empty(0, int), [], terms, np.zeros((0, 1)), np.zeros((0, 1)), {})
    found = {r["term"]: r["n"] for r in texts.transform(in_batches, _counted(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n = max(1, found.get(-1, 0))
    df = np.array([found.get(k, 0) for k in range(len(terms))])
    idf = np.log1p(n / (1 + df))
    use = df <= max(1, COMMON * n)
    for own in items.words:
        k = np.searchsorted(terms, np.unique(own))
        if use[k].sum() < FEW:
            # an item of common words only is found by its rarest
            use[k[np.argsort(df[k], kind="stable")[: 2 * FEW]]] = True
    terms, idf = terms[use], idf[use]
    rows = np.zeros((len(items.words), len(terms)))
    for i, own in enumerate(items.words):
        k = np.searchsorted(terms, own)
        k = k[(k < len(terms)) & (terms[np.minimum(k, len(terms) - 1)] == own)]
        np.add.at(rows[i], k, idf[k])
    rank = min(len(terms), most_rank, len(items.words) + extra)
    omega = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(terms), rank)))[0]
    with scratch(docs.sparkSession) as kept:
        kind = "salt long, at long, data binary"
        parts = texts.transform(in_batches, _sketched(terms, idf, omega), kind).groupBy("at", "salt").applyInPandas(_added, kind)
        parts = kept.keep(parts.groupBy("at", "salt").applyInPandas(_added, kind).groupBy("at").applyInPandas(_added, kind), "sketch").orderBy("at").collect()
    b = np.vstack([np.frombuffer(r["data"]).reshape(-1, rank) for r in parts]) if parts else np.zeros(omega.shape)
    # the items are passages too
    basis = nystroem(b + rows.T @ (rows @ omega), omega)
    return Space(np.array(items.item), items.words, terms, (idf[:, None] * basis).astype(np.float32), (rows @ basis).astype(np.float32), items.runs)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` stand in a longest common subsequence with ``b``; bit-parallel over the words of ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    v = every
    for x in b.tolist():
        if m := masks.get(x):
            u = v & m
            v = ((v + u) | (v - u)) & every
    # zero bits of v are the words that lengthen the subsequence
    return np.array([not v >> i & 1 for i in range(len(a))], bool)


def found_runs(h: np.ndarray, counts: np.ndarray, runs: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """First words of all runs of items in the texts, and the pieces that hold them."""
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(h))
    at, piece = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size, value in run_hashes(h, set(runs)).items():
        known, where = runs[size]
        # most places are ruled out by 20 bits of their hash
        maybe = np.zeros(1 << 20, bool)
        maybe[(known >> np.uint64(44)).astype(np.int64)] = True
        hit = np.flatnonzero(maybe[(value >> np.uint64(44)).astype(np.int64)] & (left[: len(value)] >= size))
        low = np.searchsorted(known, value[hit])
        n = np.searchsorted(known, value[hit], "right") - low
        at.append(np.repeat(hit, n))
        piece.append(where[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])
    return np.concatenate(at), np.concatenate(piece)


def leaks(texts: list[bytes], space: Space) -> list[dict[int, tuple[float, float, float]]]:
    """Of every text the items in it, with cosine, share of the item in the common subsequence, and share of its answer."""
    out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
    if not len(space.terms):
        return out
    h, counts, parts, segment, term = segmented(texts, space.terms)
    begin, first = np.cumsum(counts) - counts, np.cumsum(parts) - parts
    place, piece = found_runs(h, counts, space.runs)
    if not len(term) and not len(place):
        return out
    size = np.linalg.norm(space.pieces, axis=1)
    owner = np.repeat(np.arange(len(texts)), parts)
    rows = _neighbours(_summed(space.project[term], segment, int(parts.sum())), parts, True)

    def judge(window: int, j: int, cosine: float, run: bool) -> None:
        text = owner[window]
        start = begin[text] + (window - first[text]) * SEGMENT
        region = h[start : min(start + WINDOW * SEGMENT, begin[text] + counts[text])]
        held = common_subsequence(space.words[j], region)
        share, answer = float(held.mean()), float(held[-ANSWER:].mean())
        if run or share >= LCS and (answer >= ANSWERED or share >= SURE):
            now = (round(cosine, 3), round(share, 4), round(answer, 4))
            item = int(space.item[j])
            if item not in out[text] or out[text][item][1:] < now[1:]:
                out[text][item] = now

    some = np.flatnonzero(rows.any(1))
    for low in range(0, len(some), 4096):
        at = some[low : low + 4096]
        p = rows[at]
        dot = p @ space.pieces.T
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = dot / (np.linalg.norm(p, axis=1)[:, None] * size)
            cover = dot / size**2
        for i, j in zip(*np.nonzero((cosine >= COSINE) & (cover >= COVER)), strict=True):
            judge(at[i], j, float(cosine[i, j]), False)
    text = np.searchsorted(np.cumsum(counts), place, "right")
    window = first[text] + (place - begin[text]) // SEGMENT
    for i, j in np.unique(np.stack([window, piece], axis=1), axis=0):
        norm = float(np.linalg.norm(rows[i]) * size[j])
        judge(i, j, float(rows[i] @ space.pieces[j]) / norm if norm else 0.0, True)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Benchmark items in documents: (doc_id, item_id, cosine, lcs, answer), a row for each document and item.

    Whole texts are searched. A run of ``RUN`` consecutive words of an item, or a whole item of fewer words, is a leak whatever its lcs and
    answer are; those are of the piece that holds the run. Null and empty texts hold nothing; an empty benchmark gives no rows. Repeated rows give one row; a null
    doc_id stays null. Other columns are not looked at.
    """
    space = fit(docs, read_items(benchmark), text_col)

    def run(batches):
        for batch in batches:
            texts, ids = utf8(batch.column(1)), batch.column(0).to_pylist()
            for part in slices(texts):
                found = [(i, item, *x) for i, own in zip(ids[part], leaks(texts[part], space), strict=True) for item, x in own.items()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), *[pa.float64()] * 3), strict=True)], ["doc_id", "item_id", "cosine", "lcs", "answer"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).transform(in_batches, run, "doc_id long, item_id long, cosine double, lcs double, answer double")
    return rows.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark item, with all their columns."""
    space = fit(docs, read_items(benchmark), text_col)

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index(text_col)))
            keep = [not own for part in slices(texts) for own in leaks(texts[part], space)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.transform(in_batches, run, docs.schema)
