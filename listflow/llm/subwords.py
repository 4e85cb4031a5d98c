"""Whole texts through a tokenizer, each different piece once.

A text is cut where the tokenizer surely begins anew, so the ids of a text are the ids of its pieces one after the other.
The pieces of many texts are mostly the same few: the tokenizer encodes those it has not met, numpy copies the rest.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A remembered piece costs an entry and its bytes; a memory that is full is emptied.
MOST_PIECES, MOST_BYTES = 1 << 18, 32 << 20
#: Pieces in one string, and what stands between them there.
TOGETHER, MARK = 512, "\x01"
#: What some library may take for white space beside the blank, at either end of a part.
_SPACE = "\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}"
_ODD = f"^$|^[{_SPACE}]|[{_SPACE}]$"


def gathered(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices of all ranges [start, start + size), one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _flat(ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), size


def one_thread() -> None:
    """A task has a core; the tokenizers library takes them all unless told otherwise."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def in_strings(encode: Callable[[list[str]], Sequence[Sequence[int]]], blank: str = ""):
    """An encoder of many pieces from ``encode``, which takes texts: pieces go in strings of TOGETHER, with U+0001 after each.

    The tokenizer must have one token with that character (checked), and none that joins it to others: ``blank`` on both sides
    parts them where it would. Pieces that hold the character or end in white space go alone. Returns flat ids, starts, sizes.
    """
    after = blank + MARK + blank
    (*_, mark), again = encode([f"a{after}", f"1{after}1{after}"])
    if list(again).count(mark) != 2:
        raise ValueError("the tokenizer has no single token for U+0001")

    def run(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        alone = pc.match_substring_regex(pieces, f"\\x{{1}}|[{_SPACE}]$")
        plain = pieces.filter(pc.invert(alone)) if pc.any(alone).as_py() else pieces
        # the marked pieces stand one after the other in Arrow's buffer
        marked = pc.binary_join_element_wise(plain, pa.scalar(after, pa.large_string()), pa.scalar("", pa.large_string()))
        cuts = np.frombuffer(marked.buffers()[1], np.int64)[[*range(0, len(marked), TOGETHER), len(marked)]].tolist() if len(marked) else []
        ids, _ = _flat(encode([str(memoryview(marked.buffers()[2])[x:y], "utf-8") for x, y in pairwise(cuts)]))
        ends = np.flatnonzero(ids == mark)
        if len(ends) != len(plain):
            raise ValueError("U+0001 does not part the pieces")
        rest, rest_size = _flat(encode(pieces.filter(alone).to_pylist()) if len(plain) < len(pieces) else [])
        alone = alone.to_numpy(zero_copy_only=False)
        start, size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        start[~alone], size[~alone] = np.append(0, ends + 1)[: len(ends)], np.diff(ends, prepend=-1) - 1
        start[alone], size[alone] = len(ids) + np.cumsum(rest_size) - rest_size, rest_size
        return np.append(ids, rest), start, size

    return run


class Remembered:
    """Ids of pieces, as encoded by ``encode(pieces) -> flat ids, starts, sizes``, in one flat array.

    With ``tokens``, the bytes of every id, ``exact`` says of each piece whether its tokens' bytes are its own.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]], tokens: list[bytes] | None = None):
        self.encode, self.tokens = encode, None if tokens is None else pa.array(tokens, pa.large_binary())
        self.clear()

    def clear(self) -> None:
        self.names = pa.array([], pa.large_string())
        self.flat, self.start, self.size, self.exact = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def slots(self, pieces: pa.Array) -> np.ndarray:
        """Where ``start``, ``size`` and ``exact`` hold each of these different pieces; valid until the next call."""
        found = pc.index_in(pieces, self.names)
        fresh = pieces.filter(found.is_null())
        if not len(fresh):
            return found.to_numpy().astype(np.int64)
        if len(self.names) > MOST_PIECES or self.names.nbytes > MOST_BYTES:
            self.clear()
            found, fresh = pa.nulls(len(pieces), pa.int32()), pieces
        flat, start, size = self.encode(fresh)
        before = len(self.names)
        self.start = np.append(self.start, len(self.flat) + start)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, flat)
        self.names = pa.concat_arrays([self.names, fresh])
        if self.tokens is not None:
            taken = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), self.tokens.take(pa.array(flat[gathered(start, size)])))
            self.exact = np.append(self.exact, pc.equal(pc.binary_join(taken, pa.scalar(b"", pa.large_binary())), fresh.cast(pa.large_binary())).to_numpy(zero_copy_only=False))
        found = found.to_numpy(zero_copy_only=False)
        miss = np.isnan(found) if found.dtype.kind == "f" else np.zeros(len(found), bool)
        out = np.where(miss, 0, found).astype(np.int64)
        out[miss] = before + np.arange(len(fresh))
        return out


def by_bytes(texts: pa.Array, limit: int) -> list[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each."""
    if not len(texts):
        return []
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    cuts = np.flatnonzero(np.diff((np.cumsum(size) - size) // limit)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True))


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The parts ``[^\\x20\\x09-\\x0D]+`` of all texts, and how many each has. Null is empty."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = parts.flatten()
    empty = pc.equal(flat, "")
    sizes = np.diff(parts.offsets.to_numpy())
    if pc.any(empty).as_py():  # blanks at either end give empty parts
        gone = np.repeat(np.arange(len(sizes)), sizes)[empty.to_numpy(zero_copy_only=False)]
        sizes = sizes - np.bincount(gone, minlength=len(sizes))
        flat = flat.filter(pc.invert(empty))
    return flat.dictionary_encode(), sizes.astype(np.int64)


def chunks(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Every text with a blank before it, cut before blanks that stand alone between two other characters: the chunks, and
    how many each text has. Each chunk begins with a blank. Null and empty texts have none.

    A byte-level pre-tokenizer begins anew at such a blank, as does a tokenizer none of whose pieces holds a blank after
    another character.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.split_pattern(texts, " ")
    flat = parts.flatten().dictionary_encode()
    sizes = np.diff(parts.offsets.to_numpy()).astype(np.int64)
    sizes[pc.equal(texts, "").to_numpy(zero_copy_only=False)] = 0
    odd = pc.match_substring_regex(flat.dictionary, _ODD).to_numpy(zero_copy_only=False)
    code = flat.indices.to_numpy().astype(np.int64)
    named = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), flat.dictionary, pa.scalar("", pa.large_string()))
    begins = parts.offsets.to_numpy()[:-1] - parts.offsets.to_numpy()[0]
    owner = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    if not odd[code].any():
        return pa.DictionaryArray.from_arrays(flat.indices, named), sizes
    names = named.to_pylist()
    out, done, at = [], 0, dict(zip(names, range(len(names)), strict=True))
    for k in np.unique(owner[odd[code]]):  # texts with an odd part are joined again around it
        own, before = [], True
        for i in code[begins[k] : begins[k] + sizes[k]].tolist():
            if own and (odd[i] or before):
                own[-1] += names[i]
            else:
                own.append(names[i])
            before = odd[i]
        out.append(code[done : begins[k]])
        out.append(np.fromiter((at.setdefault(x, len(at)) for x in own), np.int64, len(own)))
        done, sizes[k] = begins[k] + (sizes[k] or 1), len(own)
    out.append(code[done:])
    # the one part of an empty text is odd, so that none of its codes is left
    return pa.DictionaryArray.from_arrays(pa.array(np.concatenate(out)), pa.array(list(at), pa.large_string())), sizes
