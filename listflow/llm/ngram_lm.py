"""Language-model scores from an n-gram trie in Elias-Fano levels, trained and queried shard by shard.

The model is a bigram one: P(w|b) = (c(bw) + m(c(b)) P(w)) / (c(b) + m(c(b))) with m(c) = SPREAD * c**POWER, the mass that a
context gives to words not seen behind it, and P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). It needs counts only, so a
context that holds a third of the corpus can be split over shards by its next word without changing a figure.

1. Texts become blocks of about ``BLOCK`` tokens: distinct word hashes and the texts as numbers into them.
2. Blocks ask for the counts of their words: words are dealt by hash, summed, numbered, and answered to the blocks.
3. A block sends each distinct pair (b, w), with its training count and the texts it stands in, to the pair's shard.
4. A shard sums the pairs, builds its trie (contexts, monotone pointers, successors, 16-bit quantised log
   probabilities), maps it into memory, looks all its pairs up, and returns a sum per text.

Every exchange carries distinct words or pairs of a block, so its volume follows the corpus, and no task holds more than a
block or a shard.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fixed, in_batches, scratch
from .words import hashes, mix, slices, utf8

U64 = np.uint64
BLOCK = 2_000_000
SHARD = 1_500_000
WORDS = 1_000_000
SPREAD, POWER = 2.0, 0.95
#: Log probabilities are kept as 16-bit numbers: STEPS to a unit of log10, from -LOWEST.
STEPS, LOWEST = 1200, 40
END = U64(0x5EED0FE2D0000001)


def pack(x: np.ndarray) -> bytes:
    """An array as compressed bytes, all first bytes first."""
    kind = np.min_scalar_type(int(x.max(initial=0)))
    x = np.ascontiguousarray(x.astype(kind))
    return bytes([x.itemsize]) + zstandard.ZstdCompressor(level=3).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(f"u{size}").astype(np.int64)


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((log10 + LOWEST) * STEPS), 0, 65535).astype(np.uint16)


class EliasFano:
    """A non-descending sequence: low bits packed, high bits in unary. Searches expand the high parts once."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.bits, self.low, self.high = n, low_bits, low, high
        ones = np.flatnonzero(np.unpackbits(np.asarray(high), bitorder="little"))[:n]
        self.tops = ones - np.arange(len(ones))
        self._window = np.lib.stride_tricks.as_strided(low.view(np.uint8), (max(0, len(low) - 7), 8), (1, 1))

    @staticmethod
    def arrays(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        """Length, low bits, and the two bit vectors of a sequence."""
        n = len(values)
        last = int(values[-1]) if n else 0
        bits = max(0, (last // max(1, n)).bit_length() - 1)
        v = values.astype(U64)
        low = np.zeros(0, np.uint8)
        if bits and n:
            low = np.packbits(((v[:, None] >> np.arange(bits, dtype=U64)) & U64(1)).astype(np.uint8), bitorder="little")
        high = np.zeros((last >> bits) + n + 1, np.uint8)
        high[(v >> U64(bits)).astype(np.int64) + np.arange(n)] = 1
        return n, bits, np.concatenate([low, np.zeros(8, np.uint8)]), np.packbits(high, bitorder="little")

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at positions."""
        top = self.tops[i] << self.bits
        if not self.bits:
            return top
        bit = i * self.bits
        word = np.ascontiguousarray(self._window[bit >> 3]).view("<u8").ravel()
        return top | ((word >> (bit & 7).astype(U64)) & U64((1 << self.bits) - 1)).astype(np.int64)

    def successor(self, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Within positions [low, high) of each key, the first whose value is not less; ``high`` if none is."""
        top = key >> self.bits
        start = np.maximum(low, np.searchsorted(self.tops, top, side="left"))
        stop = np.maximum(start, np.minimum(high, np.searchsorted(self.tops, top, side="right")))
        while (open_ := np.flatnonzero(start < stop)).size:
            mid = (start[open_] + stop[open_]) >> 1
            less = self.at(mid) < key[open_]
            start[open_] = np.where(less, mid + 1, start[open_])
            stop[open_] = np.where(less, stop[open_], mid)
        return np.minimum(start, high)


class Trie:
    """Contexts, where their successors begin, successors, and a code for each successor, over one mapped buffer.

    A successor is kept as context * universe + word, so that the level is one monotone sequence; a search stays within the
    positions that the context's pointers name.
    """

    def __init__(self, buffer):
        head = np.frombuffer(buffer, np.int64, 14)
        self.universe, at, parts = int(head[0]), 14 * 8, []
        for n, bits, low, high in head[1:13].reshape(3, 4):
            parts.append(EliasFano(int(n), int(bits), np.frombuffer(buffer, np.uint8, int(low), at), np.frombuffer(buffer, np.uint8, int(high), at + int(low))))
            at += int(low + high)
        self.contexts, self.pointers, self.successors = parts
        self.codes = np.frombuffer(buffer, np.uint8, int(head[13]) * 2, at).view(np.uint16)

    @staticmethod
    def levels(context: np.ndarray, word: np.ndarray, code: np.ndarray) -> bytes:
        """Levels of pairs given in ascending order, each once."""
        own, first = np.unique(context, return_index=True)
        universe = int(word.max(initial=0)) + 1
        rank = np.searchsorted(own, context)
        parts = [EliasFano.arrays(x) for x in (own, np.append(first, len(context)), rank * universe + word)]
        head = np.array([universe, *(y for n, bits, low, high in parts for y in (n, bits, len(low), len(high))), len(code)], np.int64)
        return head.tobytes() + b"".join(x.tobytes() for _, _, low, high in parts for x in (low, high)) + code.astype(np.uint16).tobytes()

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of pairs, -1 where the trie has none."""
        out = np.full(len(context), -1, np.int64)
        if not self.contexts.n:
            return out
        every = np.zeros(len(context), np.int64)
        c = np.minimum(self.contexts.successor(context, every, every + self.contexts.n), self.contexts.n - 1)
        have = np.flatnonzero((self.contexts.at(c) == context) & (word < self.universe))
        c, key = c[have], c[have] * self.universe + word[have]
        low, high = self.pointers.at(c), self.pointers.at(c + 1)
        at = self.successors.successor(key, low, high)
        good = at < high
        good[good] = self.successors.at(at[good]) == key[good]
        out[have[good]] = self.codes[at[good]]
        return out


def mapped(levels: bytes) -> mmap.mmap:
    """The levels in an unnamed file of this task, mapped: the system pages them as it needs. Lost with the task, made anew by its retry."""
    with tempfile.TemporaryFile() as f:
        f.write(levels)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


_BLOCKS = "block long, ids array<long>, held binary, sizes binary, vocabulary binary, words long, ending long, tokens binary"


def _blocks(batches):
    """Blocks of whole documents: an end token follows each document's words."""
    number = TaskContext.get().partitionId() << 32
    ids, held, sizes, parts, total = [], [], [], [], 0

    def made():
        words, tokens = np.unique(np.concatenate(parts), return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in (pack(np.array(held)), pack(np.array(sizes)), words.tobytes())), pa.array([len(words)]), pa.array([int(np.searchsorted(words, END))]), pa.array([pack(tokens)], pa.binary())],
            ["block", "ids", "held", "sizes", "vocabulary", "words", "ending", "tokens"],
        )

    for batch in batches:
        texts, keys, out = utf8(batch.column(2)), batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for part in slices(texts):
            h, counts = hashes(texts[part])
            stop = np.cumsum(counts)
            parts.append(np.insert(h, stop, END))
            ids += keys[part]
            held += out[part]
            sizes += (counts + 1).tolist()
            total += len(h) + len(counts)
            if total >= BLOCK:
                yield made()
                number += 1
                ids, held, sizes, parts, total = [], [], [], [], 0
    if ids:
        yield made()


def _tokens(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: tokens, text of each token, whether each text is held out, texts' sizes."""
    sizes = unpack(row["sizes"])
    return unpack(row["tokens"]), np.repeat(np.arange(len(sizes)), sizes), unpack(row["held"]).astype(bool), sizes


def _asked(shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens, text, held, _ = _tokens(row)
                words = np.frombuffer(row["vocabulary"], U64)
                count = np.bincount(tokens[~held[text]], minlength=len(words))
                shard = (words >> U64(32)).astype(np.int64) * shards >> 32
                cut = np.searchsorted(shard, np.arange(shards + 1))
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_pydict({"shard": pa.array(some.astype(np.int32)), "block": pa.array([row["block"]] * len(some), pa.int64()), "words": pa.array([words[cut[s] : cut[s + 1]].tobytes() for s in some], pa.binary()), "counts": pa.array([pack(count[cut[s] : cut[s + 1]]) for s in some], pa.binary())})

    return run


def _answered(shards: int):
    """Sums counts of a shard of words and answers each block; the row without a block has the shard's totals."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(x, U64) for x in pdf["words"]]
        known, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, at, np.concatenate([unpack(x) for x in pdf["counts"]]))
        shard = int(pdf["shard"].iloc[0])
        cut = np.cumsum([0, *map(len, words)])
        rows = [(b, shard, pack(at[i:j] * shards + shard), pack(total[at[i:j]]), 0, 0) for b, i, j in zip(pdf["block"], cut, cut[1:], strict=False)]
        return pd.DataFrame([*rows, (None, shard, None, None, int(total.sum()), int((total > 0).sum()))], columns=["block", "shard", "ids", "counts", "n", "v"]).astype({"block": "Int64"})

    return run


def _sent(shards: int, n: int, v: int):
    """Of a block whose words are answered: its pairs by shard, and under a negative shard of its own the ids and base figures of its texts."""
    share = max(1, n // (4 * shards))

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        tokens, text, held, sizes = _tokens(row)
        right = right.sort_values("shard")
        n_words = int(row["words"])
        ids = np.concatenate([unpack(x) for x in right["ids"]])
        count = np.concatenate([unpack(x) for x in right["counts"]])
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
        first = np.cumsum(sizes) - sizes
        at_base = np.add.reduceat(base[tokens], first)
        n_known = np.add.reduceat((count > 0)[tokens].astype(np.int64), first)
        doc = [None if i is None or i != i else int(i) for i in row["ids"]]
        figures = (at_base, n_known, sizes, held, [i is None for i in doc], [i or 0 for i in doc])
        out = [(int(row["block"]), -1 - int(row["block"]), b"".join(np.asarray(x, np.float64 if x is at_base else np.int64).tobytes() for x in figures))]

        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[first] = int(row["ending"])  # a text begins behind an end
        order = np.argsort(before * n_words + tokens, kind="stable")
        pair = (before * n_words + tokens)[order]
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        where = text[order]
        seen = np.add.reduceat((~held[where]).astype(np.int64), start)
        size = np.diff(np.append(start, len(pair)))
        b, w = np.divmod(pair[start], n_words)
        # a context with many tokens is split by its next word
        split = 1 + count[b] // share
        part = mix(ids[w].astype(U64) + U64(1)) % split.astype(U64)
        shard = (mix(ids[b].astype(U64) * U64(0x9E3779B97F4A7C15) + part) % U64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[by], np.arange(shards + 1))
        free = SPREAD * np.maximum(count[b], 1) ** POWER
        lone = quantised(np.log10(free / (count[b] + free)) + base[w])
        for s in np.flatnonzero(np.diff(cut)):
            i = by[cut[s] : cut[s + 1]]
            spot = np.repeat(start[i] - np.cumsum(size[i]) + size[i], size[i]) + np.arange(size[i].sum())
            fields = [pack(x) for x in (ids[b[i]], ids[w[i]], seen[i], count[b[i]], lone[i], size[i], where[spot])]
            head = np.array([len(sizes), *map(len, fields)], np.int64).tobytes()
            out.append((int(row["block"]), int(s), head + b"".join(fields)))
        return pd.DataFrame(out, columns=["block", "shard", "data"])

    return run


def _fields(data: bytes) -> tuple[int, list[np.ndarray]]:
    head = np.frombuffer(data, np.int64, 8)
    cut = np.cumsum([64, *head[1:]])
    return int(head[0]), [unpack(data[i:j]) for i, j in zip(cut, cut[1:], strict=False)]


def _scored(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard: sum its pairs, build and map its trie, look the pairs of each block up, and sum codes by text. A block's own figures pass."""
    if pdf["shard"].iloc[0] < 0:
        return pdf
    read = [_fields(x) for x in pdf["data"]]
    b, w, seen, count, lone = (np.concatenate([f[k] for _, f in read]) for k in range(5))
    order = np.lexsort((w, b))
    new = np.flatnonzero((np.diff(b[order], prepend=-1) != 0) | (np.diff(w[order], prepend=-1) != 0))
    total = np.add.reduceat(seen[order], new)
    one = order[new]
    kept = total > 0
    one, total = one[kept], total[kept]
    # words of the shard as numbers in their order, so that the successor level has a small universe
    known = np.unique(w[one])
    free = SPREAD * np.maximum(count[one], 1) ** POWER
    spare = 10.0 ** (lone[one] / STEPS - LOWEST)
    code = quantised(np.log10(total / (count[one] + free) + spare))
    held = mapped(Trie.levels(b[one], np.searchsorted(known, w[one]), code))
    trie = Trie(held)
    out = []
    for block, (texts, f) in zip(pdf["block"], read, strict=True):
        rank = np.searchsorted(known, f[1])
        rank = np.where((rank < len(known)) & (known[np.minimum(rank, len(known) - 1)] == f[1]), rank, trie.universe) if len(known) else np.full(len(f[1]), trie.universe)
        code = trie.find(f[0], rank)
        code = np.where(code < 0, f[4], code) - LOWEST * STEPS
        sums = np.zeros(texts, np.int64)
        np.add.at(sums, f[6], np.repeat(code, f[5]))
        some = np.flatnonzero(sums)
        low = int(sums.min())
        fields = [pack(np.diff(some, prepend=0)), pack(sums[some] - low)]
        out.append((int(block), pdf["shard"].iloc[0], np.array([low, len(fields[0])], np.int64).tobytes() + b"".join(fields)))
    return pd.DataFrame(out, columns=["block", "shard", "data"])


def _gathered(train_tokens: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        figures = pdf["data"].iloc[0]
        texts = len(figures) // 48
        base = np.frombuffer(figures, np.float64, texts)
        n_known, sizes, held, none, ids = np.frombuffer(figures, np.int64, offset=8 * texts).reshape(5, texts)
        total = np.zeros(texts, np.int64)
        for data in pdf["data"].iloc[1:]:
            low, size = np.frombuffer(data, np.int64, 2)
            total[np.cumsum(unpack(data[16 : 16 + size]))] += unpack(data[16 + size :]) + low
        return pd.DataFrame({"doc_id": pd.array(ids, "Int64").copy() if not none.any() else pd.Series(pd.array(ids, "Int64")).mask(none.astype(bool)), "held_out": held.astype(bool), "n_tokens": sizes, "n_known": n_known, "train_tokens": train_tokens, "base_score": base, "score": total / STEPS})

    return run


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 5, is 1. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def score_corpus(docs: DataFrame, held: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows that are not ``held`` and score all: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Words are ``[^\\x20\\x09-\\x0D]+`` of whole texts after A-Z are lower-cased; an end token follows. A null or empty text is an
    end token alone. ``base_score`` is the add-half unigram log10 probability, ``score`` the model's. Rows repeat and ids may be null: a row
    for each row. If every row is held out, every count is zero. An empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    held = held_out(F.col(id_col)) if held is None else held
    named = docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held"), F.col(text_col).alias("text"))
    with scratch(spark) as kept:
        blocks = kept.keep(named.transform(in_batches, _blocks, _BLOCKS), "blocks")
        sizes = blocks.select(F.sum(F.octet_length("vocabulary") / 8)).first()[0] or 0
        tokens = blocks.count() * BLOCK
        few = max(12, int(sizes) // WORDS)
        asked = blocks.transform(in_batches, _asked(few), "shard int, block long, words binary, counts binary")
        answers = kept.keep(asked.groupBy("shard").applyInPandas(_answered(few), "block long, shard int, ids binary, counts binary, n long, v long"), "answers")
        n, v = answers.where("block is null").select(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
        shards = max(12, tokens // SHARD)
        own = blocks.select("block", "ids", "held", "sizes", "words", "ending", "tokens").groupBy("block")
        message = "block long, shard long, data binary"
        sent = own.cogroup(answers.where("block is not null").groupBy("block")).applyInPandas(_sent(shards, int(n), int(v)), message)
        parts = sent.groupBy("shard").applyInPandas(_scored, message)
        kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return fixed(parts.groupBy("block").applyInPandas(_gathered(int(n)), kind))
