"""Licence scans: Aho-Corasick over the words of whole texts, and a shunting-yard parser for licence expressions.

A text's words (runs of letters and figures, everything else being a gap) are joined by single spaces, in which one
automaton finds notice phrases and identifier tags at word boundaries. Behind a tag stands an expression of licence
identifiers with and, or, with and parentheses.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_batches
from .words import utf8

# The base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices of this scan, with the weight each adds to the score.
NOTICES = {
    "permission is hereby granted free of charge to any person": ("mit", 0.9),
    "gnu general public license": ("gpl", 0.8),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "creative commons attribution": ("cc-by", 0.7),
    "all rights reserved": ("all-rights-reserved", 0.5),
}
TAG = "spdx license identifier"
_TAG_LINE = re.compile(rb"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.I)
_ITEM = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
#: Identifiers under which text may be used for training, compared in lower case.
ALLOWED = ("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "cc-by-4.0", "unlicense", "zlib")
_RANK = {"or": 1, "and": 2, "with": 3}
_GAPS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def parse(text: str) -> list[str] | None:
    """A licence expression in postfix order, or None if it isn't one. ``with`` binds closest, then ``and``, then ``or``."""
    out: list[str] = []
    held: list[str] = []
    operand = False
    for item in _ITEM.findall(text.lower()):
        if item in _RANK:
            if not operand:
                return None
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[item]:
                out.append(held.pop())
            held.append(item)
            operand = False
        elif item == "(":
            if operand:
                return None
            held.append(item)
        elif item == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held or not operand:
                return None
            held.pop()
        else:
            if operand:
                return None
            out.append(item)
            operand = True
    while held:
        if held[-1] == "(":
            return None
        out.append(held.pop())
    return out if operand else None


def beginning(text: str) -> str:
    """The longest beginning that is a licence expression, '' if there is none.

    The whole text, if it is one. Else prose or a comment may follow, so that identifiers behind an operator must look like one:
    a capital, a figure or a sign, or one of ``ALLOWED``.
    """
    if parse(text):
        return text
    depth, operand, at, upto = 0, False, 0, 0
    for item in _ITEM.finditer(text):
        word, name = item[0], item[0].lower()
        if text[at : item.start()].strip():
            break
        if name in _RANK:
            if not operand:
                break
            operand = False
        elif word == ")":
            if not operand or not depth:
                break
            depth -= 1
        elif operand or word != "(" and upto and word.isalpha() and word.islower() and name not in ALLOWED:
            break
        elif word == "(":
            depth += 1
        else:
            operand = True
        at = item.end()
        if operand and not depth:
            upto = at
    return text[:upto]


def permitted(postfix: list[str], allowed: tuple[str, ...] = ALLOWED) -> bool:
    """Whether the expression lets the text be used: a choice needs one allowed side, a conjunction both; an exception only widens."""
    stack: list[bool] = []
    for item in postfix:
        if item in _RANK:
            right, left = stack.pop(), stack.pop()
            stack.append(left if item == "with" else left and right if item == "and" else left or right)
        else:
            stack.append(item in allowed)
    return stack[0]


def automaton(phrases) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(raw: bytes, find: ahocorasick.Automaton, allowed: tuple[str, ...] = ALLOWED) -> tuple[int, list[dict], list[dict]]:
    """Number of words, notices as label, kind and first word, and expressions with what they say."""
    words = raw.translate(_GAPS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    notices, expressions = [], []
    tagged, at, seen = False, 0, 0
    for end, phrase in find.iter(line):
        if phrase == TAG:
            tagged = True
            continue
        # a word's number is the number of spaces before it, counted on from the last notice
        start = end - len(phrase) - 1
        if start >= at:
            seen += line.count(" ", at, start)
            place, at = seen, start
        else:
            place = line.count(" ", 0, start)
        kind, label = ("base", BASE_PHRASES[phrase]) if phrase in BASE_PHRASES else ("notice", NOTICES[phrase][0])
        notices.append({"label": label, "kind": kind, "word": place, "weight": 0.9 if kind == "base" else NOTICES[phrase][1]})
    for text in (m[1].decode("utf-8", "replace") for m in _TAG_LINE.finditer(raw) if tagged):
        text = text.split("*/")[0].split("-->")[0].strip()
        text = beginning(text) or text
        postfix = parse(text)
        names = sorted({x for x in postfix if x not in _RANK}) if postfix else []
        expressions.append({"text": text, "valid": postfix is not None, "permitted": bool(postfix) and permitted(postfix, allowed), "names": names})
    return len(words), notices, expressions


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("notices", pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("word", pa.int64()), ("weight", pa.float64())]))),
        ("expressions", pa.list_(pa.struct([("text", pa.string()), ("valid", pa.bool_()), ("permitted", pa.bool_()), ("names", pa.list_(pa.string()))]))),
    ]
)


def _scanned(allowed: tuple[str, ...]):
    def run(batches):
        find = automaton([*BASE_PHRASES, *NOTICES, TAG])
        for batch in batches:
            rows = [scan(x, find, allowed) for x in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], _OUT.field(k + 1).type) for k in range(3))], schema=_OUT)

    return run


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Notices and licence expressions of every whole text: (doc_id, n_words, notices, expressions).

    A row for each row; a null or empty text has no words and no notices. Overlapping and repeated notices all count. Behind a
    tag the longest beginning of the line that is an expression counts; a tag without one is kept as not valid. A null id stays null; other columns are not looked at.
    """
    kind = "doc_id long, n_words long, notices array<struct<label:string,kind:string,word:long,weight:double>>, expressions array<struct<text:string,valid:boolean,permitted:boolean,names:array<string>>>"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).transform(in_batches, _scanned(tuple(allowed)), kind)


def summary(scans: DataFrame) -> DataFrame:
    """Counts, first and last base place, labels and a score from 0 (nothing found) towards 1 (several strong notices or a tag)."""
    base = F.filter("notices", lambda x: x["kind"] == "base")
    tags = F.transform(F.flatten(F.transform(F.filter("expressions", lambda e: e["valid"]), lambda e: e["names"])), lambda n: F.concat(F.lit("spdx:"), n))
    label = lambda a: F.transform(a, lambda x: x["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    doubt = F.aggregate("notices", F.lit(1.0), lambda s, x: s * (1 - x["weight"])) * F.pow(F.lit(0.05), F.size(tags))
    return scans.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["word"])).alias("last_word"),
        joined(label(base)).alias("base_labels"),
        joined(F.concat(label(F.col("notices")), tags)).alias("labels"),
        (1 - doubt).alias("score"),
    )
