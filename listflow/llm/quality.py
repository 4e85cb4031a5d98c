"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters slide over the embedded
bytes of each chunk, and each filter's largest response in a chunk is kept. The maximum and the mean of these over the
chunks make one probability by a logistic layer. Training is plain gradient descent (Adam) with the gradient flowing
through the winning positions only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_batches
from .words import slices, utf8

#: Bytes embedded in DIM numbers; filters of WIDTH bytes every STRIDE bytes; a chunk is STEP bytes and shares its last ones with the next.
DIM, WIDTH, STRIDE, STEP = 8, 8, 2, 512
FILTERS = 24
CHUNK = STEP + WIDTH - STRIDE
PLACES = STEP // STRIDE


@dataclass
class Net:
    embed: np.ndarray  # (256, DIM)
    filters: np.ndarray  # (WIDTH * DIM, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,)
    shift: np.ndarray  # (1,)


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all chunks, and the text of each chunk. Every text has one at least; behind its end stand zeros."""
    count = np.array([max(1, -(-len(t) // STEP)) for t in texts], np.int64)
    buffer = np.zeros(int(count.sum()) * STEP + CHUNK, np.uint8)
    raw = np.zeros((int(count.sum()), CHUNK), np.uint8)
    at = 0
    for text, n in zip(texts, count, strict=True):
        here = buffer[: n * STEP + CHUNK]
        here[:] = 0
        here[: len(text)] = np.frombuffer(text, np.uint8)
        raw[at : at + n] = np.lib.stride_tricks.sliding_window_view(here, CHUNK)[: n * STEP : STEP]
        at += n
    return raw, np.repeat(np.arange(len(texts)), count)


def _windows(raw: np.ndarray, net: Net) -> np.ndarray:
    """The embedded windows of chunks, a row each."""
    x = net.embed[raw].reshape(len(raw), CHUNK * DIM)
    view = np.lib.stride_tricks.sliding_window_view(x, WIDTH * DIM, axis=1)[:, :: STRIDE * DIM]
    return view.reshape(-1, WIDTH * DIM)


def pooled(raw: np.ndarray, net: Net, group: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and where it is."""
    top, where = np.empty((len(raw), FILTERS), np.float32), np.empty((len(raw), FILTERS), np.int32)
    for low in range(0, len(raw), group):
        part = raw[low : low + group]
        y = (_windows(part, net) @ net.filters).reshape(len(part), PLACES, FILTERS)
        where[low : low + group] = y.argmax(1)
        top[low : low + group] = np.take_along_axis(y, where[low : low + group][:, None], 1)[:, 0]
    return top, where


def _fast(raw: np.ndarray, net: Net, group: int = 48) -> np.ndarray:
    out = np.empty((len(raw), FILTERS), np.float32)
    for low in range(0, len(raw), group):
        part = raw[low : low + group]
        out[low : low + group] = (_windows(part, net) @ net.filters).reshape(len(part), PLACES, FILTERS).max(1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(texts: list[bytes], net: Net) -> np.ndarray:
    """Probability of label 1 of every text."""
    raw, owner = chunks(texts)
    act = np.maximum(_fast(raw, net) + net.bias, 0)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    mean = np.add.reduceat(act, first) / np.bincount(owner)[:, None]
    return _sigmoid(np.hstack([np.maximum.reduceat(act, first), mean]).astype(np.float64) @ net.out + net.shift[0])


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 14, rate: float = 0.01, batch: int = 64, seed: int = 3) -> Net:
    """A net fitted to whole texts, classes weighted alike."""
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.5, (256, DIM)).astype(np.float32), rng.normal(0, 0.15, (WIDTH * DIM, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), np.zeros(1, np.float32))
    if not len(texts):
        return net
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    weight = weight / weight.mean()
    names = ("embed", "filters", "bias", "out", "shift")
    m1, m2 = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    turn = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            pick = order[low : low + batch]
            # a piece of a good text is good: short ones teach the net that little evidence is no evidence
            cut = np.where((labels[pick] == 1) & (rng.random(len(pick)) < 0.3), rng.integers(8, 300, len(pick)), 1 << 40)
            raw, owner = chunks([texts[i][:n] for i, n in zip(pick, cut, strict=True)])
            top, where = pooled(raw, net)
            act = np.maximum(top + net.bias, 0)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            n = np.bincount(owner)
            most = np.maximum.reduceat(act, first)
            x = np.hstack([most, np.add.reduceat(act, first) / n[:, None]])
            error = ((_sigmoid(x @ net.out + net.shift[0]) - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
            g = {"out": x.T @ error + 1e-4 * net.out, "shift": error.sum(keepdims=True)}
            dx = error[:, None] * net.out
            won = act == most[owner]
            won &= np.cumsum(won, 0) - np.where(first[owner][:, None] > 0, np.cumsum(won, 0)[np.maximum(first[owner] - 1, 0)], 0) == 1
            d = dx[owner, :FILTERS] * won + dx[owner, FILTERS:] / n[owner][:, None]
            d = np.where(act > 0, d, 0).astype(np.float32)
            g["bias"] = d.sum(0)
            # each filter sees the window that won in each chunk
            at = where[:, :, None] * STRIDE + np.arange(WIDTH)
            seen = np.take_along_axis(raw[:, None, :], at, 2)
            g["filters"] = np.einsum("cfwd,cf->wdf", net.embed[seen], d, optimize=True).reshape(WIDTH * DIM, FILTERS)
            back = np.einsum("wdf,cf->cfwd", net.filters.reshape(WIDTH, DIM, FILTERS), d, optimize=True).reshape(-1, DIM)
            flat = seen.ravel()
            g["embed"] = np.stack([np.bincount(flat, back[:, k], 256) for k in range(DIM)], 1).astype(np.float32)
            turn += 1
            pace = rate * (1 - epoch / epochs)
            for k in names:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
                getattr(net, k)[...] -= pace * (m1[k] / (1 - 0.9**turn)) / (np.sqrt(m2[k] / (1 - 0.99**turn)) + 1e-8)
    return net


def held_out(doc_id) -> F.Column:
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 800, most_bytes: int = 32_768) -> Net:
    """Fit on a bounded sample of the labelled rows outside the held-out third, on the driver.

    Sample: of each label, the ``per_class`` documents with the least hash of their id among those of at most ``most_bytes``
    bytes, so never more than 2 * per_class * most_bytes bytes. Without labelled rows the net is a fixed one of random weights.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where((F.octet_length("text") <= most_bytes) & (F.length("text") > 0) & F.col("id").isNotNull())
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(~held_out(F.col("id")) & F.col("label").isin(0, 1))
    named = texts.select("id").join(marked, "id", "left_semi").join(marked, "id").select("id", "label").distinct()
    named = named.persist()
    few = [named.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_class).select("id", "label") for k in (0, 1)]
    chosen = {(r["id"], r["label"]) for part in few for r in part.collect()}
    named.unpersist()
    if not chosen:
        return fit([], np.empty(0))
    ids = docs.sparkSession.createDataFrame(sorted(chosen), "id long, label int")
    # at most 2 * per_class ids
    rows = sorted({(r["id"], r["label"], r["text"]) for r in texts.join(F.broadcast(ids), "id").select("id", "label", "text").collect()})
    return fit([r[2].encode() for r in rows], np.array([r[1] for r in rows]))


def score_docs(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text, a row for each row. Null and empty texts score as no bytes; ids may be null or repeat; other columns are not looked at."""

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in slices(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start), pa.array(score(texts[part], net))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(in_batches, run, "doc_id long, score double")


def keep_good(docs: DataFrame, net: Net, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text scores ``least`` or more, with all their columns."""

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index(text_col)))
            keep = [score(texts[part], net) >= least for part in slices(texts)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.empty(0, bool), pa.bool_()))

    return docs.transform(in_batches, run, docs.schema)
