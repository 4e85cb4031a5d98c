import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listflow.llm import chat, licences, ngram_lm, pii, quality, queries
from listflow.llm.words import hashes, shingles

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_words_match_the_pattern():
    texts = ["", "A b\tC\x0bd", "  x  ", "é É ß" * 50, "long" * 200 + " end", "\x85nel\xa0nbsp", "a" * 8 + " " + "a" * 9 + " " + "a" * 300]
    h, counts = hashes([t.encode() for t in texts])
    want = [words_of(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    names = {}
    for word, value in zip((w for ws in want for w in ws), h.tolist(), strict=True):
        assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)
    value, doc, size = shingles(h, counts, 3)
    assert size.tolist() == [len({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}) if w else 0 for w in want]
    assert (np.diff(doc) >= 0).all()


def plain_base(text):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda t: 14 <= len(d := re.sub("[^0-9]", "", t)) <= 19 and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(d[::-1])) % 10 == 0),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 10 <= len(re.sub("[^0-9]", "", t)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans_are_those_of_the_patterns():
    rng = np.random.default_rng(1)
    pieces = ["a.b@c.de", "@", "x@y", "1.2.3.4", "1.2.3", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-0100", "+1", "+", "_", ".", "-", " ", "7", "foo", "\n", "é", "a@b.c_d@e.f", "00012.3.4.5"]
    texts = ["".join(rng.choice(pieces, rng.integers(1, 14))) for _ in range(3000)]
    for t in texts:
        assert sorted(pii.base_spans(t)) == sorted(plain_base(t)), t
    assert pii.base_spans("9" * 100000 + " " + "a" * 100000) == []


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.labelled_table(spark))


def test_field_finds_names_and_secrets_and_leaves_prose(spark, field, docs):
    text = "Hello. My name is Rosa Weber and the password=ab12cd34ef56ab78 works.\nThe. And Then is. Other"
    found = {(k, text[s:e]) for k, s, e in pii.spans_of([text], field)[0]}
    assert found == {("person", "Rosa Weber"), ("secret", "ab12cd34ef56ab78")}
    rows = pii.find_pii(docs, field).collect()
    assert len(rows) == docs.count() and not any(r["spans"] for r in rows)
    masked = pii.mask_pii(docs.limit(1).withColumn("text", F.lit(text + " x@y.org")), field).first()
    assert masked["text"].endswith("[EMAIL]") and "Rosa" not in masked["text"] and masked["rep"] == "x"
    # held-out sentences of the same kind
    fresh = pii.labelled_table(spark, seed=77).orderBy("sentence", "position").collect()
    lines, gold = {}, {}
    for r in fresh:
        lines.setdefault(r["sentence"], []).append(r["word"])
        gold.setdefault(r["sentence"], []).append(r["tag"])
    hit = sum(any(k in ("person", "secret") for k, _, _ in s) == any(t != "O" for t in gold[i]) for i, s in zip(lines, pii.spans_of([" ".join(w) for w in lines.values()], field), strict=True))
    assert hit >= 0.95 * len(lines)


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(0)
    line = np.array([0, 0, 0, 1, 2, 2])
    emit, step, first = rng.normal(size=(6, 4)), rng.normal(size=(4, 4)), rng.normal(size=4)
    got = pii.viterbi(emit, line, step, first)
    for k in range(3):
        at = np.flatnonzero(line == k)
        value = lambda p, at=at: first[p[0]] + sum(emit[i, t] for i, t in zip(at, p, strict=True)) + sum(step[a, b] for a, b in zip(p, p[1:], strict=False))
        assert tuple(got[at]) == max(itertools.product(range(4), repeat=len(at)), key=value)


def test_op1_digest(spark):
    rows = {r["doc_id"]: r for r in queries.op1_pii(spark, SMALL).collect()}
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        spans = sorted(plain_base(d["text"] or ""), key=lambda s: (s[1], pii.BASE.index(s[0])))
        r = rows[d["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]


def test_quality_on_held_out_labels(spark, docs):
    folder = "/root/testdata/sf0.1"
    rows = queries.op2_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    net = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score_docs(docs, net).count() == docs.count()
    assert quality.score_docs(docs.limit(0), net).count() == 0


def test_chunks_cover_the_text():
    texts = [b"", b"a", bytes(range(256)) * 9, b"x" * quality.STEP, b"y" * (quality.STEP + 1)]
    raw, owner = quality.chunks(texts)
    for k, t in enumerate(texts):
        own = raw[owner == k]
        assert b"".join(bytes(r[: quality.STEP]) for r in own).rstrip(b"\0") == t.rstrip(b"\0")
        assert all((a[quality.STEP :] == b[: quality.CHUNK - quality.STEP]).all() for a, b in zip(own, own[1:], strict=False))


def test_elias_fano_and_trie():
    rng = np.random.default_rng(2)
    for top in (1, 50, 10**6, 10**12):
        v = np.sort(rng.integers(0, top, 400))
        ef = ngram_lm.EliasFano(*ngram_lm.EliasFano.arrays(v))
        assert (ef.at(np.arange(400)) == v).all()
        low, high = np.sort(rng.integers(0, 401, (2, 300)), axis=0)
        key = rng.integers(0, top + 2, 300)
        assert ef.successor(key, low, high).tolist() == [next((i for i in range(a, b) if v[i] >= k), b) for k, a, b in zip(key, low, high, strict=True)]
    pairs = np.unique(rng.integers(0, 60, (500, 2)), axis=0)
    code = rng.integers(0, 65536, len(pairs))
    trie = ngram_lm.Trie(ngram_lm.mapped(ngram_lm.Trie.levels(pairs[:, 0] * 10**9, pairs[:, 1], code)))
    known = {(a * 10**9, b): c for (a, b), c in zip(pairs.tolist(), code.tolist(), strict=True)}
    asked = [(a * 10**9, b) for a in range(62) for b in range(62)]
    got = trie.find(*(np.array(x) for x in zip(*asked, strict=True)))
    assert got.tolist() == [known.get(x, -1) for x in asked]


@pytest.mark.parametrize("which", ["small", "given"])
def test_lm_against_plain_counts(spark, docs, which):
    from collections import Counter
    from math import log10

    table = docs if which == "small" else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], [*words_of(r["text"]), None]) for r in table.collect()]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    one = Counter(w for i, ws in rows if not held(i) for w in ws)
    two = Counter(p for i, ws in rows if not held(i) for p in zip([None, *ws], ws, strict=False))
    n, v = sum(one.values()), len(one)
    p1 = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))

    def p2(b, w):
        free = ngram_lm.SPREAD * max(one[b], 1) ** ngram_lm.POWER
        return (two[b, w] + free * p1(w)) / (one[b] + free)

    want = sorted(((i is None, i or 0), held(i), len(ws), sum(one[w] > 0 for w in ws), n, sum(log10(p1(w)) for w in ws), sum(log10(p2(b, w)) for b, w in zip([None, *ws], ws, strict=False))) for i, ws in rows)
    got = sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in ngram_lm.score_corpus(table).collect())
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for a, b in zip(got, want, strict=True):
        assert abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 0.0006 * b[2]
    if which == "small":
        assert ngram_lm.score_corpus(docs.limit(0)).count() == 0


def test_chat_round_trip(spark):
    said = ["", "\\", "<|user|>\n", "\n</turn>\n", "\n<+>\n", "\\l\\s\\p#|<", "ü\U0001f600", " x ", None]
    rows = [(c, t, r, said[(c * 3 + t) % len(said)], "k") for c in range(9) for t, r in enumerate(["system", "user", "user", "assistant", "assistant", "a|b<\n"])]
    rows += [(50, 1, "user", "tie b", "k"), (50, 1, "user", "tie a", "k"), (50, None, None, None, "k"), (None, 0, "user", "no id", "k")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    formatted = chat.format_chats(table)
    assert "Python" not in formatted._jdf.queryExecution().executedPlan().toString()
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_chats(formatted).collect()}
    want = {}
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[0] or -1, r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert got == want
    assert chat.read_chats(chat.format_chats(table.limit(0))).count() == 0


@pytest.mark.parametrize(
    "text, valid, ok",
    [("MIT", True, True), ("GPL-3.0-only OR (Apache-2.0 AND MIT)", True, True), ("MIT AND GPL-2.0", True, False), ("GPL-2.0 WITH Classpath-exception-2.0", True, False), ("Apache-2.0 WITH LLVM-exception or GPL-2.0", True, True), ("MIT OR", False, False), ("(MIT", False, False), ("MIT)", False, False), ("MIT BSD", False, False), ("", False, False), ("MIT or GPL-2.0 and GPL-3.0", True, True)],
)
def test_licence_expressions(text, valid, ok):
    postfix = licences.parse(text)
    assert (postfix is not None) == valid and (bool(postfix) and licences.permitted(postfix)) == ok


def test_licences_against_plain_search(spark, docs):
    extra = spark.createDataFrame([(100, "Under the MIT License, under  the-mit\nlicense! apache license version 2 cc by nc cc by nc\n# SPDX-License-Identifier: MIT OR GPL-2.0-only"), (101, "under the mit licenses, xunder the mit license")], "doc_id long, text string")
    table = docs.select("doc_id", "text").union(extra).union(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id + 1000", "text"))
    got = sorted((tuple((x is None, x) for x in r[:5]) for r in licences.summary(licences.scan_licences(table)).collect()), key=str)
    want = []
    for d in table.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), d["text"] or ""))
        at = [i for p in licences.BASE_PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want.append(tuple((x is None, x) for x in (d["doc_id"], len(w), len(at), min(at, default=None), max(at, default=None))))
    assert got == sorted(want, key=str)
    row = licences.summary(licences.scan_licences(extra.where("doc_id = 100"))).first()
    assert row["base_labels"] == "apache-2,cc-by-nc,mit" and row["labels"] == "apache-2,cc-by-nc,mit,spdx:gpl-2.0-only,spdx:mit" and 0.99 < row["score"] <= 1


@pytest.mark.parametrize(
    "line, want",
    [
        ("MIT Permission is hereby granted", "MIT"),
        ("Apache-2.0 // comment", "Apache-2.0"),
        ("MIT and the notice below", "MIT"),
        ("(MIT OR Apache-2.0) AND BSD-3-Clause, see file", "(MIT OR Apache-2.0) AND BSD-3-Clause"),
        ("GPL-2.0 WITH Classpath-exception-2.0 OR", "GPL-2.0 WITH Classpath-exception-2.0"),
        ("mit or isc", "mit or isc"),
        ("(MIT OR", ""),
        ("OR MIT", ""),
        ("", ""),
        ("(" * 50_000 + "MIT", ""),
    ],
)
def test_longest_expression_behind_a_tag(line, want):
    assert licences.beginning(line) == want
    _, _, found = licences.scan(f"x SPDX-License-Identifier: {line}\nnext".encode(), licences.automaton([*licences.BASE_PHRASES, licences.TAG]))
    assert [(e["valid"], e["text"] if e["valid"] else "") for e in found] == [(bool(want), want)]
