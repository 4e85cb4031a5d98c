"""Words and shingles of whole texts as 64-bit hashes, in numpy, a few megabytes at a time.

A word's lower-cased bytes are taken eight at a time and mixed into its hash, beginning with its length. Two of n different
words share a hash with probability about n * n / 2**65.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Bytes taken at a time; longer texts are cut between words.
PIECE = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
#: Longer words are hashed one by one.
LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Buffers of about PIECE bytes, between a space and a space with eight zeros: their bytes, the texts in them, and where each begins."""
    parts, owners, starts, size = [], [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE:
                gap = _GAP.search(text, at + PIECE)
                end = gap.start() if gap else end
            part = text[at:end]
            at = end
            parts.append(part)
            owners.append(k)
            starts.append(size)
            size += len(part) + 1
            if size >= PIECE:
                yield b" ".join([b"", *parts, bytes(8)]), owners, starts
                parts, owners, starts, size = [], [], [], 0
    if parts:
        yield b" ".join([b"", *parts, bytes(8)]), owners, starts


def _hashed(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a buffer that begins with a space and ends with a space and eight zeros."""
    buffer = buffer.translate(_LOWER)
    raw = np.frombuffer(buffer, np.uint8)
    text = raw[:-8]
    gap = (text == 32) | ((text - np.uint8(9)) < 5)
    start = np.flatnonzero(gap[:-1] > gap[1:]) + 1
    size = np.flatnonzero(gap[:-1] < gap[1:]) + 1 - start
    lanes = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
    h = size.astype(U64) * U64(0x9E3779B97F4A7C15)
    left, at, some = size, start, np.arange(len(start))
    for k in range(min(int(size.max(initial=0)), LONG) + 7 >> 3):
        if k:
            keep = np.flatnonzero(left > 8)
            some, at, left = some[keep], at[keep] + 8, left[keep] - 8
        lane = np.ascontiguousarray(lanes[at]).view("<u8").ravel() & _MASK[np.minimum(left, 8)]
        h[some] = mix(h[some] + lane)
    for i in np.flatnonzero(size > LONG):
        h[i] = int.from_bytes(hashlib.blake2b(buffer[start[i] : start[i] + size[i]], digest_size=8).digest(), "little")
    return h, start - 1


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z lower-cased, and how many each text has."""
    out, counts = [], np.zeros(len(texts), np.int64)
    for buffer, owners, starts in _pieces(texts):
        h, at = _hashed(buffer)
        out.append(h)
        np.add.at(counts, owners, np.diff(np.append(np.searchsorted(at, starts), len(h))))
    return (np.concatenate(out) if out else np.empty(0, U64)), counts


def word_hash(word: str) -> int:
    """The hash of one word."""
    return int(hashes([word.encode()])[0][0])


def shingles(h: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text in ascending order: values, texts, and how many each text has.

    A text of fewer than ``width`` words has its whole sequence as one shingle; one without words has none.
    """
    n = len(counts)
    doc = np.repeat(np.arange(n), counts)
    if not len(h):
        return np.empty(0, U64), doc, np.zeros(n, np.int64)
    first = np.cumsum(counts) - counts
    inside = np.arange(len(h)) - np.repeat(first, counts)
    left = np.repeat(counts, counts) - inside
    value = np.zeros(len(h), U64)
    for k in range(width):
        here = np.flatnonzero(left > k)
        value[here] = (value[here] + h[here + k]) * U64(0xD6E8FEB86659FD93 + 2 * k)
    keep = (left >= width) | (inside == 0)
    value, doc = mix(value[keep]), doc[keep]
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, doc, np.bincount(doc, minlength=n).astype(np.int64)


def utf8(column) -> list[bytes]:
    """Texts of an Arrow column as bytes; null is empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]


def slices(texts: list[bytes], limit: int = 2 * PIECE) -> Iterator[slice]:
    """Runs of texts of about ``limit`` bytes, so that numpy's temporary arrays stay small."""
    low, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text) + 1
        if size >= limit:
            yield slice(low, k + 1)
            low, size = k + 1, 0
    if low < len(texts):
        yield slice(low, len(texts))
