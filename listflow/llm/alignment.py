"""Token alignment of two tokenizers by lockstep merging.

Both token lists of a text end where the text ends, so two pointers that walk them are all the state of a text. The
pointers of all texts of a batch are two numpy vectors: a step emits a link for every text, moves the pointer whose token
ends first, or both, which is a cut, and now and then lets finished texts go. Long texts enter as several lanes, between
blanks at which either tokenizer begins anew (see ``subwords``).

How often an id pair is linked is counted over all texts first: a task sums its pairs and stores its texts' tokens, Spark
sums the tasks' sums. A second walk over the stored tokens looks every link's count up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, in_batches
from .subwords import Remembered, by_bytes, chunks, gathered, in_strings, one_thread

#: Tokens of the first tokenizer in a lane, about.
LANE = 256
#: Text of a batch in bytes.
BATCH = 1 << 20
#: A table of up to so many id pairs (16 bytes each) goes to every task; links beyond it meet their counts in a join.
TABLE = 1 << 22
#: Different pairs that a task holds before it hands them on.
HELD = 1 << 20


def byte_values() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Side:
    """One tokenizer: how it encodes many chunks that begin with a blank, and the bytes of every id."""

    encode: Callable
    tokens: list[bytes]


def byte_level(path: str) -> Side:
    """A byte-level tokenizer of the tokenizers library. Special tokens' strings are plain text."""
    from tokenizers import Tokenizer

    one_thread()
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    value = byte_values()
    tokens = [b""] * own.get_vocab_size()
    for name, k in own.get_vocab().items():
        known = all(c in value for c in name)
        tokens[k] = bytes(value[c] for c in name) if known else name.encode()
    return Side(in_strings(lambda texts: [x.ids for x in own.encode_batch_fast(texts, add_special_tokens=False)]), tokens)


def pieces(path: str) -> Side:
    """A sentencepiece model, which puts the first blank before a text itself."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for k in range(own.get_piece_size()):
        name = own.id_to_piece(k)
        if any(a != "▁" and b == "▁" for a, b in zip(name, name[1:], strict=False)):
            raise ValueError(f"piece {k} holds a blank behind another character: texts can't be cut at blanks")
        tokens.append(bytes([int(name[3:5], 16)]) if own.is_byte(k) else name.replace("▁", " ").encode())
    # the model puts the blank before a string itself
    return Side(in_strings(lambda texts: own.encode([x.removeprefix(" ") for x in texts], num_threads=1)), tokens)


@dataclass
class Tokens:
    """Tokens of a batch of texts: the ids of both sides one text after the other, how many each text has, and where lanes begin."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    lane_a: np.ndarray
    lane_b: np.ndarray
    lane_text: np.ndarray


@dataclass
class Walk:
    """What the pointers met: every link's text and pair (id of A * ids of B + id of B), and the last tokens of every group."""

    text: np.ndarray
    pair: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray


def lockstep(end_a: np.ndarray, end_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Walk all lanes at once: the linked tokens (a, b), and whether both end there.

    A lane begins at tokens ``at_a`` and ``at_b`` and is finished at token ``stop`` of A; tokens end at bytes ``end_a``, ``end_b``.
    """
    links_a, links_b, cuts = [], [], []
    while len(at_a):
        x, y = end_a[at_a], end_b[at_b]
        on_a, on_b = x <= y, y <= x
        links_a.append(at_a)
        links_b.append(at_b)
        cuts.append(on_a & on_b)
        at_a, at_b = at_a + on_a, at_b + on_b
        left = at_a < stop
        if not left.all():
            at_a, at_b, stop = at_a[left], at_b[left], stop[left]
    if not cuts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


def tokens_of(texts: pa.Array, sides: tuple[Side, Side], known: tuple[Remembered, Remembered]) -> Tokens:
    """Texts whose bytes do not come back from both sides have no tokens."""
    n = len(texts)
    parts, per_text = chunks(texts)
    code = parts.indices.to_numpy()
    owner = np.repeat(np.arange(n), per_text)
    slot = [k.slots(parts.dictionary) for k in known]
    exact = known[0].exact[slot[0]] & known[1].exact[slot[1]]
    whole, gone = np.zeros(n, bool), np.zeros(n, bool)
    whole[owner[~exact[code]]] = True
    for k in np.flatnonzero(whole):
        own = code[owner == k]
        text = (" " + texts[k].as_py()).encode()
        for side, memory, at in zip(sides, known, slot, strict=True):
            ids = memory.flat[gathered(memory.start[at[own]], memory.size[at[own]])]
            gone[k] |= b"".join([side.tokens[i] for i in ids]) != text
    keep = ~gone[owner]
    code, owner = code[keep], owner[keep]
    ids, first, count = [], [], []
    for memory, at in zip(known, slot, strict=True):
        size = memory.size[at[code]]
        ids.append(memory.flat[gathered(memory.start[at[code]], size)].astype(np.int64))
        first.append(np.cumsum(size) - size)
        count.append(np.bincount(owner, weights=size, minlength=n).astype(np.int64))
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    lane = (first[0] - first[0][new][np.cumsum(new) - 1]) // LANE if len(owner) else first[0]
    # chunks that are not exact may not end together
    new[1:] |= (lane[1:] != lane[:-1]) & ~whole[owner[1:]]
    return Tokens(*ids, *count, first[0][new], first[1][new], owner[new])


def walk(t: Tokens, long: tuple[np.ndarray, np.ndarray]) -> Walk:
    """All texts in lockstep; ``long`` has the bytes of every id of either side."""
    stop = np.append(t.lane_a[1:], len(t.a))[: len(t.lane_a)]
    link_a, link_b, cut = lockstep(np.cumsum(long[0][t.a]), np.cumsum(long[1][t.b]), t.lane_a, t.lane_b, stop)
    text = np.repeat(np.arange(len(t.n_a)), t.n_a)
    return Walk(text[link_a], t.a[link_a] * len(long[1]) + t.b[link_b], link_a[cut], link_b[cut])


class Shown:
    """Groups of ids as text."""

    def __init__(self, width: int):
        self.width = width
        #: every id before a comma, a bar, a semicolon and nothing
        self.ids = pa.array([f"{k}{mark}" for mark in (",", "|", ";", "") for k in range(width)])

    def __call__(self, t: Tokens, w: Walk) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        cut_a, cut_b = np.zeros(len(t.a), np.int64), np.zeros(len(t.b), np.int64)
        cut_a[w.last_a], cut_b[w.last_b] = 1, 1
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        of_a, of_b = np.bincount(group_a, minlength=len(w.last_a)), np.bincount(group_b, minlength=len(w.last_a))
        mark = 2 * cut_b
        mark[np.cumsum(t.n_b)[t.n_b > 0] - 1] = 3
        out = np.empty(len(t.a) + len(t.b), np.int64)
        out[np.arange(len(t.a)) + (np.cumsum(of_b) - of_b)[group_a]] = t.a + self.width * cut_a
        out[np.arange(len(t.b)) + np.cumsum(of_a)[group_b]] = t.b + self.width * mark
        taken = self.ids.take(pa.array(out))
        offsets = np.frombuffer(taken.buffers()[1], np.int32)[np.append(0, np.cumsum(t.n_a + t.n_b))]
        return pa.StringArray.from_buffers(len(t.n_a), pa.py_buffer(offsets.astype(np.int32)), taken.buffers()[2])


def _summed(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, at = np.unique(pair, return_inverse=True)
    return names, np.bincount(at, weights=n, minlength=len(names)).astype(np.int64)


STORED = "doc_id long, tokens_a binary, tokens_b binary, lanes_a binary, lanes_b binary"
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((x, pa.binary()) for x in ("tokens_a", "tokens_b", "lanes_a", "lanes_b")), *((x, pa.int64()) for x in ("a", "b", "n"))])


def _blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The values of each text as bytes."""
    offsets = np.append(0, np.cumsum(counts)) * values.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(blobs: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``_blobs``."""
    size = np.dtype(kind).itemsize
    count = pc.binary_length(blobs).to_numpy(zero_copy_only=False) // size
    offsets = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset :]
    return np.frombuffer(blobs.buffers()[2] or b"", kind, int(count.sum()), int(offsets[0])).astype(np.int64), count.astype(np.int64)


def _encoded(a_path: str, b_path: str):
    """A row for each text with its tokens and lanes; and a row for each id pair that a task holds, with its links."""

    def run(batches):
        sides = byte_level(a_path), pieces(b_path)
        known = tuple(Remembered(s.encode, s.tokens) for s in sides)
        long = tuple(np.array([len(x) for x in s.tokens], np.int64) for s in sides)
        kinds, width = [id_kind(len(s.tokens)) for s in sides], len(sides[1].tokens)
        found, held = [], 0
        pair, n = np.empty(0, np.int64), np.empty(0, np.int64)

        def row(cols, size):
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(size, f.type) for f in _SCHEMA], schema=_SCHEMA)

        def sums():
            return row({"a": pair // width, "b": pair % width, "n": n}, len(pair))

        for batch in batches:
            for low, high in by_bytes(batch.column(1), BATCH):
                t = tokens_of(batch.column(1).slice(low, high - low), sides, known)
                w = walk(t, long)
                lanes = np.bincount(t.lane_text, minlength=high - low)
                sizes = [np.diff(np.append(x, len(y))) for x, y in ((t.lane_a, t.a), (t.lane_b, t.b))]
                ids = batch.column(0).slice(low, high - low)
                yield row({"doc_id": ids, "tokens_a": _blobs(t.a.astype(kinds[0]), t.n_a), "tokens_b": _blobs(t.b.astype(kinds[1]), t.n_b), "lanes_a": _blobs(sizes[0].astype("<i4"), lanes), "lanes_b": _blobs(sizes[1].astype("<i4"), lanes)}, high - low)
                found.append(np.unique(w.pair, return_counts=True))
                held += len(found[-1][0])
                if held > HELD:
                    pair, n = _summed(np.concatenate([pair, *(x for x, _ in found)]), np.concatenate([n, *(x for _, x in found)]))
                    found, held = [], 0
                    if len(pair) > HELD:
                        yield sums()
                        pair, n = pair[:0], n[:0]
        pair, n = _summed(np.concatenate([pair, *(x for x, _ in found)]), np.concatenate([n, *(x for _, x in found)]))
        if len(pair):
            yield sums()

    return run


def id_kind(ids: int) -> str:
    return "<u2" if ids <= 1 << 16 else "<u4"


def _read(batches, kinds: list[str]):
    """Ids of the texts and their tokens, about BATCH bytes at a time."""
    for batch in batches:
        for low, high in by_bytes(batch.column(1), BATCH):
            part = batch.slice(low, high - low)
            (a, n_a), (b, n_b) = (_values(part.column(k + 1), kinds[k]) for k in range(2))
            (lane_a, lanes), (lane_b, _) = (_values(part.column(k), "<i4") for k in (3, 4))
            yield part.column(0), Tokens(a, b, n_a, n_b, np.cumsum(lane_a) - lane_a, np.cumsum(lane_b) - lane_b, np.repeat(np.arange(len(lanes)), lanes))


WALKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"


def _columns(ids: pa.Array, t: Tokens, w: Walk, shown: Shown) -> dict:
    n = len(t.n_a)
    groups = np.bincount(np.repeat(np.arange(n), t.n_a)[w.last_a], minlength=n)
    return {"doc_id": ids, "n_a": t.n_a, "n_b": t.n_b, "n_groups": groups, "n_links": np.bincount(w.text, minlength=n), "groups": shown(t, w)}


def _aligned(long: tuple[np.ndarray, np.ndarray], table):
    """A row for each text with the sums of its links' counts."""

    def run(batches):
        shown = Shown(max(map(len, long)))
        names, counts, best = table.value
        for ids, t in _read(batches, [id_kind(len(x)) for x in long]):
            w = walk(t, long)
            at, n = np.searchsorted(names, w.pair), len(t.n_a)
            total = np.zeros(n, np.int64)
            np.add.at(total, w.text, counts[at])
            cols = _columns(ids, t, w, shown) | {"n_best": np.bincount(w.text[best[at]], minlength=n), "count_sum": total}
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols.values()], list(cols))

    return run


def _linked(long: tuple[np.ndarray, np.ndarray]):
    """A row for each text under a name of its own, and a row for each of its pairs, which has the name and the pair alone."""
    import uuid

    schema = pa.schema([("row", pa.string()), ("doc_id", pa.int64()), *((x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string()), *((x, pa.int64()) for x in ("a", "b", "links"))])

    def run(batches):
        shown = Shown(max(map(len, long)))
        width, task, row = len(long[1]), uuid.uuid4().hex, 0
        for ids, t in _read(batches, [id_kind(len(x)) for x in long]):
            w, n = walk(t, long), len(t.n_a)
            names = np.array([f"{task}-{row + k}" for k in range(n)])
            row += n
            pair, at = np.unique(w.pair, return_inverse=True)
            cell, links = np.unique(w.text * max(1, len(pair)) + at, return_counts=True)
            text, pair = cell // max(1, len(pair)), pair[cell % max(1, len(pair))]
            for cols, rows in ((_columns(ids, t, w, shown) | {"row": names}, n), ({"row": names[text], "a": pair // width, "b": pair % width, "links": links}, len(links))):
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(rows, f.type) for f in schema], schema=schema)

    return run


def align(docs: DataFrame, a_path: str, b_path: str, kept: Scratch, id_col: str = "doc_id", text_col: str = "text", table: int = TABLE) -> tuple[DataFrame, DataFrame]:
    """Tokens of a byte-level tokenizer (A, a tokenizers file) and a sentencepiece model (B) side by side.

    A encodes each text with a blank before it, B puts that blank itself; strings of special tokens are plain text. The
    first frame has a row for each row of ``docs``: (doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum): tokens,
    groups between byte offsets where both end, pairs of tokens whose bytes overlap, the groups as ``a1,a2|b1;a3|b2,b3`` in
    ids, links whose id pair is linked as often as any of its B id, and the sum of the links' counts. The second frame has
    every linked id pair (a, b), its links in all texts (n), and whether no pair of its B id has more (best).

    Null and empty texts, and texts whose tokens' bytes are not the text's, have no tokens and count nowhere: zeros and ''.
    Repeated rows and null ids are rows like others. An empty table gives empty frames; other columns are not looked at. Both
    frames read tables of ``kept``, which the caller drops.

    Up to ``table`` different pairs are collected (17 bytes each) and sent to every task; beyond that a text's links meet
    their counts in a join, whose hot pairs Spark splits.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encoded = kept.keep(named.transform(in_batches, _encoded(a_path, b_path), f"{STORED}, a long, b long, n long"), "tokens")
    tokens = encoded.where("a is null").select("doc_id", "tokens_a", "tokens_b", "lanes_a", "lanes_b")
    counts = kept.keep(encoded.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("n")), "sums")
    # a row for each id of B at most
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = kept.keep(counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    long = tuple(np.array([len(x) for x in side.tokens], np.int64) for side in (byte_level(a_path), pieces(b_path)))
    if counts.count() <= table:
        rows = counts.toArrow()
        key = rows["a"].to_numpy() * len(long[1]) + rows["b"].to_numpy()
        order = np.argsort(key)
        sent = docs.sparkSession.sparkContext.broadcast((key[order], rows["n"].to_numpy()[order], rows["best"].to_numpy()[order]))
        return tokens.transform(in_batches, _aligned(long, sent), f"{WALKED}, n_best long, count_sum long"), counts
    walked = kept.keep(tokens.transform(in_batches, _linked(long), f"row string, {WALKED}, a long, b long, links long"), "walked")
    links = walked.where("a is not null").select("row", "a", "b", "links").join(counts.hint("merge"), ["a", "b"])
    zero = F.lit(0).cast("long")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(zero)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
    out = walked.where("a is null").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum")), counts
