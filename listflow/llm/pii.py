"""Personal data: fixed patterns, and a linear-chain conditional random field over word-shape features.

The field adds names and secrets to what the patterns find. It is trained on a small labelled table (sentence, position,
word, tag) by gradient ascent on the conditional likelihood, and decoded by Viterbi over all lines of a batch at once: one
numpy step for the t-th word of every line that has one. Features of a word are factors of its shape, of its neighbours'
shapes, and the identity of it and of the two words before where the labelled table knows them.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import in_batches
from .words import PIECE

# The patterns of the base kinds, in their order.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "person", "secret")
TAGS = ("O", "B-person", "I-person", "B-secret")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIM = "\"'`.,;:!?()[]{}<>*&$#%|"

_MARK = np.zeros(128, bool)
_MARK[[ord(c) for c in _TRIM]] = True
_LOWERED = np.arange(128, dtype=np.uint8)
_LOWERED[65:91] += 32


def _luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str, figures: bool = True) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, leftmost and non-overlapping within a kind, in linear time. ``figures``: whether the text may hold 0-9."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        # the longest run of local characters before the sign, not reaching into the match before
        start = at
        while start > free and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if not figures:
        return out
    for m in IP.finditer(text):
        if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Word shapes. Factors of a shape and how many values each has.
FACTORS = (("case", 4), ("figures", 3), ("mark", 4), ("length", 5), ("turns", 4), ("end", 3))
SHAPES = int(np.prod([n for _, n in FACTORS]))
_GAP = np.zeros(128, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_FIGURE = np.zeros(128, bool)
_FIGURE[48:58] = True
_UPPER = np.zeros(128, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def shapes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, shape and line number of every word of a text given as code points."""
    plain = np.minimum(code, 127).astype(np.uint8)
    edge = np.flatnonzero(np.diff(_GAP[plain], prepend=True, append=True))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return start, end, np.empty(0, np.int64), start
    line = np.searchsorted(np.flatnonzero(plain == 10), start)
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])[np.stack([start, end])], axis=0)[0]
    size = end - start
    digit = _FIGURE[plain]
    digits, uppers = total(digit), total(_UPPER[plain])
    swap = np.zeros(len(plain), bool)
    swap[1:] = digit[1:] & _LETTER[plain[:-1]] | digit[:-1] & _LETTER[plain[1:]]
    first, last = plain[start], plain[end - 1]
    case = np.where(uppers >= size - 1, 3, np.where(_UPPER[first], np.where(uppers == 1, 1, 2), 0)) * (uppers > 0)
    figures = (digits > 0).astype(int) + (digits == size)
    mark = np.where(total(code == 64) > 0, 3, np.where(total(code == 61) > 0, 1, np.where(total(code == 58) > 0, 2, 0)))
    length = np.searchsorted([2, 4, 8, 16], size, side="right")
    turns = np.minimum(total(swap), 3)
    stop = np.where((last == 46) | (last == 33) | (last == 63), 2, np.where(last == 44, 1, 0))
    shape = np.zeros(len(start), np.int64)
    for (_, n), value in zip(FACTORS, (case, figures, mark, length, turns, stop), strict=True):
        shape = shape * n + value
    return start, end, shape, line


def _factor_rows() -> np.ndarray:
    """For every shape, the rows of its factor values in a table of all factor values."""
    out, rest, base = [], np.arange(SHAPES), np.cumsum([0, *(n for _, n in FACTORS)])
    for k in range(len(FACTORS) - 1, -1, -1):
        out.append(base[k] + rest % FACTORS[k][1])
        rest = rest // FACTORS[k][1]
    return np.stack(out[::-1], 1)


ROWS = _factor_rows()
N_FACTOR = int(sum(n for _, n in FACTORS))


def word_key(word: str) -> str:
    """A word as the field knows it: lower case, without marks around it."""
    return word.lower().strip(_TRIM)


@dataclass
class Field:
    """Scores of the tags: by shape of the word, of the one before and after; by identity of the word and the two before."""

    words: dict[str, int]
    shape: np.ndarray  # (3, SHAPES + 1, K); the last row is a missing neighbour
    word: np.ndarray  # (3, words + 1, K); row 0 is any other word
    step: np.ndarray  # (K, K)
    first: np.ndarray  # (K,)


def _emit(shape3: list[np.ndarray], word3: list[np.ndarray], shape: np.ndarray, word: np.ndarray) -> np.ndarray:
    return sum(shape[k][shape3[k]] for k in range(3)) + sum(word[k][word3[k]] for k in range(3))


def _context(shape: np.ndarray, word: np.ndarray, line: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of every word: shapes of itself, the one before and after; identities of itself and the two before, within its line."""

    def moved(x: np.ndarray, by: int, none: int) -> np.ndarray:
        out = np.full(len(x), none, x.dtype)
        if by > 0:
            ok = line[by:] == line[:-by]
            out[by:][ok] = x[:-by][ok]
        else:
            ok = line[-by:] == line[:by]
            out[:by][ok] = x[-by:][ok]
        return out

    return [shape, moved(shape, 1, SHAPES), moved(shape, -1, SHAPES)], [word, moved(word, 1, 0), moved(word, 2, 0)]


def viterbi(emit: np.ndarray, line: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags of all lines; ``line`` numbers the words' lines in ascending order. One step decodes a word of each line."""
    n, k = emit.shape
    begin = np.flatnonzero(np.diff(line, prepend=-1))
    size = np.diff(np.append(begin, n))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    live = len(begin) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), side="right")
    back = np.zeros((n, k), np.uint8)
    best = first + emit[begin]
    done = np.zeros(n, np.uint8)
    for t in range(1, len(live)):
        here = begin[: live[t]] + t
        score = best[: live[t], :, None] + step
        back[here] = score.argmax(1)
        best[: live[t]] = score.max(1) + emit[here]
    tag = best.argmax(1).astype(np.uint8)
    for t in range(len(live) - 1, -1, -1):
        here = begin[: live[t]] + t
        done[here] = tag[: live[t]]
        tag[: live[t]] = back[here, tag[: live[t]]]
    return done


def labelled_table(spark: SparkSession, seed: int = 5) -> DataFrame:
    """The small labelled table: made-up sentences with names and secrets behind their cues, and plain, noisy and capitalised ones."""
    rng = np.random.default_rng(seed)
    names = "Anna Berg Carlos Diaz Emma Fuchs Greta Hansen Ivan Jones Karin Lopez Marie Novak Omar Petit Rosa Schmidt Tom Weber John Smith Laura Martin".split()
    parts = "an ber ch de ing er st tion le ra ou que en ha th li mo ne re".split()
    cues = [["my", "name", "is"], ["My", "name", "is"], ["name:"], ["Name:"], ["Mr."], ["Mrs."], ["Dr."], ["Ms."], ["Sincerely,"]]
    keys = ["password=", "passwd=", "pwd=", "secret=", "token=", "api_key=", "apikey=", "key="]
    split = [["password:"], ["token:"], ["secret:"], ["api_key", "="], ["password", "is"]]
    hexes = "0123456789abcdef"
    word = lambda: "".join(rng.choice(parts, rng.integers(1, 5)))
    code = lambda: "".join(rng.choice(list(hexes if rng.random() < 0.7 else hexes + "ghijklmnopqrstuvwxyzABCDEFGHIJKLMN"), rng.integers(10, 33)))

    def filler(n: int, begins: bool = True) -> list[tuple[str, str]]:
        style, out = rng.integers(0, 5), []
        for k in range(n):
            w = word()
            w = w.upper() + "!!" * int(rng.random() < 0.5) if style == 0 else w + "*&$#%"[rng.integers(5)] * 3 if style == 1 else w
            w = w.capitalize() if style > 1 and (k == 0 and begins or rng.random() < 0.08) else w
            w = str(rng.integers(1, 99999)) if rng.random() < 0.03 else w + rng.choice(["", "", "", ",", "."])
            out.append((w, "O"))
        return out

    rows = []
    for s in range(900):
        kind, line = s % 4, filler(int(rng.integers(1, 9)))
        if kind == 0:
            who = list(rng.choice(names, rng.integers(1, 3)))
            line += [(w, "O") for w in cues[rng.integers(len(cues))]] + [(w, "I-person" if i else "B-person") for i, w in enumerate(who)]
        elif kind == 1 and rng.random() < 0.7:
            line += [(str(rng.choice(keys)) + code(), "B-secret")]
        elif kind == 1:
            line += [(w, "O") for w in split[rng.integers(len(split))]] + [(code(), "B-secret")]
        elif kind == 2 and rng.random() < 0.5:
            # a cue that ends a sentence, or stands alone, says nothing of the next word
            cue = str(rng.choice(["is.", "is,", "is", "by.", "by", "name.", "name", "my", "signed.", "Is", "By", "Is.", "token.", "password.", "secret,"]))
            line += [(cue, "O"), (word().capitalize(), "O")]
        elif rng.random() < 0.3:
            line += [(str(x), "O") for x in rng.choice(["x=1", "user@mail.example.com", "+1", "(555)", "555-1234", "10.0.0.1", "page=2", "12:30", "name", "the", "key", "note:", "is", "my", "by"], 3)]
        line += filler(int(rng.integers(0, 7)), not line[-1][0][-1].isalnum())
        rows += [(s, i, w, t) for i, (w, t) in enumerate(line)]
    return spark.createDataFrame([(int(s), int(i), str(w), t) for s, i, w, t in rows], "sentence long, position long, word string, tag string")


def train(labelled: DataFrame, steps: int = 150, rate: float = 0.1, decay: float = 0.01, most: int = 100_000) -> Field:
    """Fit the field to a labelled table of at most ``most`` words (an error beyond: it is fitted on the driver)."""
    rows = labelled.orderBy("sentence", "position", "word").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the labelled table has more than {most} words")
    line = np.unique([r["sentence"] for r in rows], return_inverse=True)[1]
    gold = np.array([TAGS.index(r["tag"]) for r in rows])
    # identities that stand by a tagged word again and again; names and secrets themselves stay unknown
    near = [word_key(r["word"]) for i, r in enumerate(rows) if r["tag"] == "O" and any(gold[j] and line[j] == line[i] for j in range(i + 1, min(i + 4, len(rows))))]
    known = Counter(word_key(r["word"]) for r in rows)
    words = {w: k + 1 for k, w in enumerate(sorted(w for w, n in Counter(near).items() if w and n >= 8 and 4 * n >= known[w]))}
    shape = np.concatenate([shapes(codes(r["word"]))[2][:1] for r in rows])
    word = np.array([words.get(word_key(r["word"]), 0) for r in rows])
    shape3, word3 = _context(shape, word, line)
    n, k, width = len(rows), len(TAGS), N_FACTOR + 1
    factor = np.vstack([ROWS, np.full((1, len(FACTORS)), N_FACTOR)])
    sizes = [3 * width * k, 3 * (len(words) + 1) * k, k * k, k]
    cuts = np.cumsum(sizes)[:-1]
    theta, m1, m2 = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros(sum(sizes))
    begin = np.flatnonzero(np.diff(line, prepend=-1))
    size = np.diff(np.append(begin, n))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    live = [int((size > t).sum()) for t in range(size[0])]

    def unpack(x):
        a, b, c, d = np.split(x, cuts)
        return a.reshape(3, width, k), b.reshape(3, -1, k), c.reshape(k, k), d

    def log_sum(x, axis):
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for turn in range(1, steps + 1):
        by_factor, by_word, step, first = unpack(theta)
        emit = _emit(shape3, word3, by_factor[:, factor].sum(2), by_word)
        ahead, behind = np.zeros((n, k)), np.zeros((n, k))
        ahead[begin] = first + emit[begin]
        for t in range(1, len(live)):
            at = begin[: live[t]] + t
            ahead[at] = log_sum(ahead[at - 1][:, :, None] + step, 1) + emit[at]
        pair = np.zeros((k, k))
        total = np.zeros(n)
        total[begin + size - 1] = log_sum(ahead[begin + size - 1], 1)
        for t in range(len(live) - 1, 0, -1):
            at = begin[: live[t]] + t
            total[at - 1] = total[at]
            behind[at - 1] = log_sum(step + (emit[at] + behind[at])[:, None, :], 2)
            pair += np.exp(ahead[at - 1][:, :, None] + step + (emit[at] + behind[at])[:, None, :] - total[at][:, None, None]).sum(0)
        error = -np.exp(ahead + behind - total[:, None])
        error[np.arange(n), gold] += 1
        g_factor, g_word = np.zeros((3, width, k)), np.zeros_like(by_word)
        for c in range(3):
            for f in range(len(FACTORS)):
                np.add.at(g_factor[c], factor[shape3[c], f], error)
            np.add.at(g_word[c], word3[c], error)
        g_step, inner = -pair, np.flatnonzero(line[1:] == line[:-1])
        np.add.at(g_step, (gold[inner], gold[inner + 1]), 1)
        g = np.concatenate([g_factor.ravel(), g_word.ravel(), g_step.ravel(), error[begin].sum(0)]) - decay * theta
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta += rate * (m1 / (1 - 0.9**turn)) / (np.sqrt(m2 / (1 - 0.99**turn)) + 1e-8)
    by_factor, by_word, step, first = unpack(theta)
    return Field(words, by_factor[:, factor].sum(2).astype(np.float32), by_word.astype(np.float32), step.astype(np.float32), first.astype(np.float32))


def identities(text: str, code: np.ndarray, start: np.ndarray, end: np.ndarray, known: dict[str, int]) -> np.ndarray:
    """Rows of the known words, 0 for others. Length and first two characters rule most words out before any is cut out."""
    out = np.zeros(len(start), np.int64)
    plain = _LOWERED[np.minimum(code, 127)]
    low, high = start.copy(), end.copy()
    for _ in range(3):
        low += (low < high - 1) & _MARK[plain[low]]
        high -= (low < high - 1) & _MARK[plain[high - 1]]
    maybe = np.zeros((128, 128, 32), bool)
    for w in known:
        if w.isascii() and len(w) < 32:
            maybe[ord(w[0]), ord(w[1 % len(w)]), len(w)] = True
    size = high - low
    second = np.where(size > 1, plain[np.minimum(low + 1, len(plain) - 1)], plain[low])
    for i in np.flatnonzero((size < 32) & maybe[plain[low], second, np.minimum(size, 31)]):
        out[i] = known.get(word_key(text[start[i] : end[i]]), 0)
    return out


def field_spans(texts: list[str], field: Field, joined: str, code: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """Names and secrets of every text; ``joined`` is all of them by lines, ``code`` its code points."""
    start, end, shape, line = shapes(code)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not len(start):
        return out
    word = identities(joined, code, start, end, field.words)
    emit = _emit(*_context(shape, word, line), field.shape, field.word)
    tags = viterbi(emit, line, field.step, field.first)
    offset = np.cumsum([0, *(len(t) + 1 for t in texts)])
    for i in np.flatnonzero((tags == 1) | (tags == 3)):
        low, high, kind = int(start[i]), int(end[i]), "person" if tags[i] == 1 else "secret"
        j = i + 1
        while kind == "person" and j < len(tags) and tags[j] == 2 and line[j] == line[i]:
            high = int(end[j])
            j += 1
        if kind == "secret" and (m := re.search(r"[=:]", joined[low:high])):
            low += m.end()
        while low < high and joined[low] in _TRIM:
            low += 1
        while low < high and joined[high - 1] in _TRIM:
            high -= 1
        if low < high:
            k = int(np.searchsorted(offset, low, side="right")) - 1
            out[k].append((kind, low - int(offset[k]), high - int(offset[k])))
    return out


def spans_of(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """All spans by start and kind; a span of the field that touches a base span is left out."""
    joined = "\n".join(texts)
    code = codes(joined)
    ends = np.cumsum([len(t) + 1 for t in texts])
    figures = np.zeros(len(texts) + 1, bool)
    figures[np.searchsorted(ends, np.flatnonzero((code >= 48) & (code < 58)), side="right")] = True
    out = []
    for text, more, some in zip(texts, field_spans(texts, field, joined, code), figures, strict=False):
        base = base_spans(text, bool(some))
        extra = [x for x in more if not any(x[1] < e and s < x[2] for _, s, e in base)]
        out.append(sorted(base + extra, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))
    return out


def _runs(texts: list[str]):
    low, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= PIECE:
            yield low, k + 1
            low, size = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


def find_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every whole text: (doc_id, spans array of kind, start, end in code points), a row for each row.

    A null or empty text has none. A null id stays null; repeated rows each give their row; other columns are not looked at.
    """

    def run(batches):
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for low, high in _runs(texts):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in spans_of(texts[low:high], field)]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).transform(in_batches, run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def mask_pii(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span of the text replaced by its kind in brackets; overlapping spans make one. Null texts stay null."""

    def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
        out, at = [], 0
        for kind, start, end in spans:
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            done = []
            for low, high in _runs([x or "" for x in texts]):
                part = [x or "" for x in texts[low:high]]
                done += [None if old is None else masked(x, s) if s else x for old, x, s in zip(texts[low:high], part, spans_of(part, field), strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(done, batch.schema.field(at).type))

    return docs.transform(in_batches, run, docs.schema)


def summary(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as kind:start:end."""
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
