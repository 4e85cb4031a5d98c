"""Token ids in files of Simple-8b words.

A 64-bit word holds a selector in its top four bits and 60 bits of ids: the selector says how many ids of how many bits.
The greatest value of a width is an escape: the id itself stands among the block's escapes, as 32 bits. A block is 1,024 ids, its
words before its escapes; the file's index has every block's place and sizes, so that blocks are decoded by themselves and many
at a time. Documents stand one after the other, across blocks; the index has their names and sizes.

    b"S8BLOCKS" | blocks | doc ids | their nulls | doc sizes | block index | number of docs, number of blocks, b"S8BLOCKS"
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import in_batches
from .subwords import Remembered, by_bytes, gathered, in_strings, one_thread, words

U64 = np.uint64
MAGIC = b"S8BLOCKS"
BLOCK = 1024
#: Bits of an id and ids in a word, by selector.
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNT = 60 // BITS
#: Ids that are coded at a time, and that a file holds before the next one begins.
GROUP, FILE = 1 << 18, 1 << 24
#: Text that is tokenized at a time, in bytes.
BATCH = 4 << 20
#: Documents of about so many ids are handed on together.
OUT = 1 << 18
_INDEX = np.dtype([("at", "<u8"), ("words", "<u4"), ("escapes", "<u4"), ("ids", "<u4")])


def _fits(bits: int) -> int:
    """Ids below this stand in ``bits`` bits; it is itself the escape."""
    return (1 << min(int(bits), 32)) - (bits <= 32)


def packed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids (below 2**32) in blocks of BLOCK: words, escapes, and how many words, escapes and ids each block has.

    From every place the word is taken that costs the fewest bits an id, escapes counted; all blocks go on word by word together.
    """
    ids = ids.astype(np.int64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    low = np.arange(blocks) * BLOCK
    end = np.minimum(low + BLOCK, n)
    stop = np.repeat(end, end - low)
    table = np.zeros((blocks, BLOCK), np.uint32)
    table.ravel()[:n] = ids
    best, chosen = np.full((blocks, BLOCK), np.inf, np.float32), np.full((blocks, BLOCK), len(BITS) - 1, np.int8)
    most = int(ids.max(initial=0))
    over = np.zeros((blocks, BLOCK + 1), np.int16)
    for s, (bits, count) in enumerate(zip(BITS.tolist(), COUNT.tolist(), strict=True)):
        if bits < 32:
            np.cumsum(table >= _fits(bits), axis=1, dtype=np.int16, out=over[:, 1:])
            if bits < 20 and 4 * int(over[:, -1].sum()) > 3 * n:
                continue  # most ids would be escapes
        else:
            over[:] = 0
        cost = np.empty((blocks, BLOCK), np.float32)
        cost[:, : BLOCK + 1 - count] = over[:, count:] - over[:, : BLOCK + 1 - count]
        cost[:, BLOCK + 1 - count :] = over[:, -1:] - over[:, BLOCK + 1 - count : BLOCK]
        cost *= 32 / count
        cost += 64 / count
        better = cost < best
        np.copyto(best, cost, where=better)
        chosen[better] = s
        if most < _fits(bits):
            break  # wider words hold fewer ids and spare no escape
    chosen = chosen.ravel()[:n].astype(np.int64)
    begins = np.zeros(n, bool)
    at = low
    while len(at):
        begins[at] = True
        at = at + COUNT[chosen[at]]
        left = at < end
        at, end = at[left], end[left]
    start = np.flatnonzero(begins)
    selector = chosen[start]
    size = np.minimum(start + COUNT[selector], stop[start]) - start
    out = selector.astype(U64) << U64(60)
    mark = np.array([_fits(b) for b in BITS])[np.repeat(selector, size)]
    escaped = ids >= mark
    shown = np.append(np.where(escaped, mark, ids).astype(U64), np.zeros(60, U64))
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        first, held = start[own], size[own]
        for k in range(COUNT[s]):
            out[own] |= np.where(k < held, shown[first + k], U64(0)) << U64(k * BITS[s])
    of = np.arange(blocks + 1) * BLOCK
    n_words = np.diff(np.searchsorted(start, of))
    escapes = np.flatnonzero(escaped)
    return out, ids[escapes].astype("<u4"), n_words, np.diff(np.searchsorted(escapes, of)), np.minimum(of[1:], n) - of[:-1]


def unpacked(coded: np.ndarray, escapes: np.ndarray, n_words: np.ndarray, n_ids: np.ndarray) -> np.ndarray:
    """The ids of many blocks."""
    total = int(n_ids.sum())
    selector = (coded >> U64(60)).astype(np.int64)
    count = COUNT[selector]
    upto = np.cumsum(count)
    # ids before a word within its block
    first = np.cumsum(n_words) - n_words
    begun = np.append(0, upto)[first]
    inside = upto - count - np.repeat(begun, n_words)
    size = np.minimum(count, np.repeat(n_ids, n_words) - inside)
    at = inside + np.repeat(np.cumsum(n_ids) - n_ids, n_words)
    out, escaped = np.empty(total, np.int64), np.zeros(total, bool)
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        mask = U64((1 << int(BITS[s])) - 1)
        for k in range(COUNT[s]):
            some = own[k < size[own]]
            value = (coded[some] >> U64(k * BITS[s]) & mask).astype(np.int64)
            out[at[some] + k] = value
            escaped[at[some] + k] = value == _fits(BITS[s])
    out[escaped] = escapes
    return out


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _File:
    """A file that is being written."""

    def __init__(self, path: str):
        files, base = _files(path)
        self.name = f"ids-{uuid.uuid4().hex}.s8b"
        self.out = files.open_output_stream(f"{base}/{self.name}", compression=None)
        self.at = self.out.write(MAGIC)
        self.left = np.empty(0, np.int64)
        self.docs, self.sizes, self.index, self.ids = [], [], [], 0

    def add(self, docs: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs)
        self.sizes.append(sizes)
        self.ids += len(ids)
        self.left = np.append(self.left, ids)
        if len(self.left) >= GROUP:
            whole = len(self.left) // BLOCK * BLOCK
            self._write(self.left[:whole])
            self.left = self.left[whole:]

    def _write(self, ids: np.ndarray) -> None:
        coded, escapes, *counts = packed(ids)
        rows = np.zeros(len(counts[0]), _INDEX)
        rows["words"], rows["escapes"], rows["ids"] = counts
        size = 8 * counts[0] + 4 * counts[1]
        rows["at"] = self.at + np.cumsum(size) - size
        parts, w, e = [], 0, 0
        coded, escapes = coded.astype("<u8").view(np.uint8), escapes.view(np.uint8)
        for n, m in zip((8 * counts[0]).tolist(), (4 * counts[1]).tolist(), strict=True):
            parts += [coded[w : w + n], escapes[e : e + m]]
            w, e = w + n, e + m
        self.at += self.out.write(np.concatenate(parts).tobytes())
        self.index.append(rows)

    def close(self) -> tuple[str, int, int]:
        if len(self.left):
            self._write(self.left)
        docs = pa.concat_arrays(self.docs)
        null = docs.is_null().to_numpy(zero_copy_only=False)
        index = np.concatenate(self.index) if self.index else np.zeros(0, _INDEX)
        for x in (docs.fill_null(0).to_numpy().astype("<i8"), null.astype(np.uint8), np.concatenate(self.sizes).astype("<i8"), index):
            self.out.write(x.tobytes())
        self.out.write(struct.pack("<QQ8s", len(docs), len(index), MAGIC))
        self.out.close()
        return self.name, len(docs), self.ids


#: Latin letters (to U+00FF, composed) and ASCII signs behind them, without the apostrophe, which may begin an ending.
_PLAIN = r"^(?P<core>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


def encoder(path: str):
    """A function from texts to their ids and sizes, by a file of the tokenizers library that puts texts into lower case, drops
    white space, and begins anew between letters and signs.

    Words of Latin letters with signs behind them are taken apart there and are in normal form once they are in lower case.
    """
    from tokenizers import Tokenizer

    one_thread()
    own, bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
    bare.normalizer = None
    whole, split = (Remembered(in_strings(lambda texts, t=t: [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)], " ")) for t in (own, bare))

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts, per_text = words(texts)
        found = pc.extract_regex(parts.dictionary, _PLAIN)
        plain = found.is_valid()
        two = [pc.struct_field(found, k).filter(plain) for k in range(2)]
        two = pa.concat_arrays([pc.utf8_lower(two[0]), two[1]]).dictionary_encode()
        plain = plain.to_numpy(zero_copy_only=False)
        slot = split.slots(two.dictionary)[two.indices.to_numpy()].reshape(2, -1).T
        rest = whole.slots(parts.dictionary.filter(pa.array(~plain)))
        # a word is two runs of ids, the second one mostly empty
        start, size = np.zeros((len(plain), 2), np.int64), np.zeros((len(plain), 2), np.int64)
        start[plain], size[plain] = split.start[slot], split.size[slot]
        start[~plain, 0], size[~plain, 0] = len(split.flat) + whole.start[rest], whole.size[rest]
        code = parts.indices.to_numpy()
        ids = np.append(split.flat, whole.flat)[gathered(start[code].ravel(), size[code].ravel())]
        owner = np.repeat(np.arange(len(texts)), per_text)
        return ids.astype(np.int64), np.bincount(owner, weights=size.sum(1)[code], minlength=len(texts)).astype(np.int64)

    return encode


def _written(path: str, tokenizer: str, end_id: int | None):
    """Write the rows of a task in their order; a row for each file."""

    def run(batches):
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        files, base = _files(path)
        files.create_dir(base, recursive=True)
        file, number = None, 0

        def row():
            name, docs, ids = file.close()
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": name, "docs": docs, "ids": ids}])

        for batch in batches:
            for low, high in by_bytes(batch.column(1), BATCH):
                ids, sizes = encode(batch.column(1).slice(low, high - low))
                if end_id is not None:
                    ids, sizes = np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
                file = file or _File(path)
                file.add(batch.column(0).slice(low, high - low), sizes, ids)
                if file.ids >= FILE:
                    yield row()
                    file, number = None, number + 1
        if file:
            yield row()

    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The ids of all texts in files under ``path``, in ascending order of the id column, and a list of the files (``path``/files, Parquet).

    ``tokenizer`` is a file of the tokenizers library that drops white space and never joins what stands on both sides of it;
    special tokens are not added, but those in texts are found. ``end_id`` follows every document. A null text is empty. Null ids come first; rows of one id follow
    each other in the order of a hash of their text. An empty table gives an empty list. Other columns are not read. Files that are
    not on the list come from failed tasks and are never read. The path must be new: a list that exists is an error.

    One range exchange of ids and texts, split within an id by text; every task writes its own range.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.transform(in_batches, _written(path, tokenizer, end_id), "part long, number long, file string, docs long, ids long").write.parquet(f"{path}/files")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The files (file, docs, ids) with the ids in all files before (start)."""
    rows = spark.read.schema("part long, number long, file string, docs long, ids long").parquet(f"{path}/files").withColumn("high", F.shiftright("part", 10))

    def before(*keys):
        return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)

    def upto(window, total="ids"):
        return F.coalesce(F.sum(total).over(window), F.lit(0))

    # 1,024 parts at a time, so that no window holds them all
    parts = rows.groupBy("high").agg(F.sum("ids").alias("all")).withColumn("over", upto(before(F.lit(0)).orderBy("high"), "all"))
    rows = rows.withColumn("inside", upto(before("high").orderBy("part", "number")))
    return rows.join(parts, "high").select("file", "docs", "ids", (F.col("over") + F.col("inside")).alias("start"))


def documents(file, size: int):
    """Document ids, sizes and ids of a file, as many documents at a time as whole groups of blocks hold."""
    n_docs, n_blocks, magic = struct.unpack("<QQ8s", file.read_at(24, size - 24))
    if magic != MAGIC:
        raise ValueError("not a file of token ids, or cut short")
    tail = 17 * n_docs + _INDEX.itemsize * n_blocks
    raw = file.read_at(tail, size - 24 - tail)
    docs = np.frombuffer(raw, "<i8", n_docs)
    null = np.frombuffer(raw, np.uint8, n_docs, 8 * n_docs).astype(bool)
    sizes = np.frombuffer(raw, "<i8", n_docs, 9 * n_docs)
    index = np.frombuffer(raw, _INDEX, n_blocks, 17 * n_docs)
    ends = np.cumsum(sizes)
    done, given, left = 0, 0, np.empty(0, np.int64)
    for low in range(0, n_blocks, OUT // BLOCK):
        own = index[low : low + OUT // BLOCK]
        length = (8 * own["words"].astype(np.int64) + 4 * own["escapes"]).astype(np.int64)
        data = np.frombuffer(file.read_at(int(length.sum()), int(own["at"][0])), np.uint8)
        n_words = own["words"].astype(np.int64)
        at = np.cumsum(length) - length
        coded = data[gathered(at, 8 * n_words)].view("<u8")
        escapes = data[gathered(at + 8 * n_words, 4 * own["escapes"].astype(np.int64))].view("<u4")
        left = np.append(left, unpacked(coded.astype(U64), escapes, n_words, own["ids"].astype(np.int64)))
        last = int(np.searchsorted(ends, given + len(left), "right"))
        if last > done:
            take = int(ends[last - 1] - given)
            yield pa.array(docs[done:last], mask=null[done:last]), sizes[done:last], left[:take]
            done, given, left = last, given + take, left[take:]
    if done < n_docs:  # documents without ids
        yield pa.array(docs[done:], mask=null[done:]), sizes[done:], left


def _read(path: str, as_bytes: bool):
    def run(batches):
        files, base = _files(path)
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{base}/{row['file']}"
                start = row["start"]
                with files.open_input_file(at) as file:
                    for docs, sizes, ids in documents(file, file.size()):
                        ends = np.append(0, np.cumsum(sizes))
                        if as_bytes:
                            shown = pa.BinaryArray.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                        else:
                            shown = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                        yield pa.RecordBatch.from_arrays([docs, pa.array(start + ends[:-1]), shown], ["doc_id", "start", "ids"])
                        start += int(ends[-1])

    return run


def read_token_ids(spark: SparkSession, path: str, as_bytes: bool = False) -> DataFrame:
    """Documents of the files under ``path``: (doc_id, start, ids), start being the ids of all documents before.

    ``ids`` is an array of longs or, with ``as_bytes``, unsigned 32-bit little-endian integers in one binary. A task reads
    whole files, some blocks at a time.
    """
    files = listed(spark, path)
    files = files.repartition(max(1, files.count()), "file")
    return files.transform(in_batches, _read(path, as_bytes), f"doc_id long, start long, ids {'binary' if as_bytes else 'array<long>'}")
