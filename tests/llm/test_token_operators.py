import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from listflow.llm import alignment, queries, subwords, token_files
from listflow.llm.shared import Scratch

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")

WORD, BYTE, PIECE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
LETTERS = [*"aAbBÜé'sΣς1٣!?\t\n\r\x0b\x0c\x01\x1c\x85 ​᠎　 ́̊😀İſ<|>▁", "<|endoftext|>", "<0x0A>", "hello ", "ÀÖØÞßÿ×÷", "Été.", "The world", "Hello,", "it's", "O.K.", "a-b ", "x'", "the world ", " ", "  ", "'s", "’"]


def texts_of(seed: int, n: int) -> list:
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 3, 14, 14, 400]))) for _ in range(n)] + [None, "", " ", "\x01", "big " * 9000]


def plain_tokens(text: str, sides) -> tuple[list, list]:
    """Ids of the libraries for the whole text, none where bytes differ."""
    a = plain_tokens.own.encode(" " + text, add_special_tokens=False).ids
    b = plain_tokens.model.encode(text)
    same = all(b"".join(side.tokens[i] for i in ids) == (" " + text).encode() for side, ids in zip(sides, (a, b), strict=True))
    return (a, b) if text and same else ([], [])


def spans(ids, tokens):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(tokens[i]), i))
        at += len(tokens[i])
    return out


def plain_alignment(text, sides):
    a, b = plain_tokens(text or "", sides)
    x, y = spans(a, sides[0].tokens), spans(b, sides[1].tokens)
    links = [(i, j) for s, e, i in x for t, f, j in y if s < f and t < e] if len(x) < 500 else None
    if links is None:  # long texts: only tokens that begin near
        links, k = [], 0
        for s, e, i in x:
            while y[k][1] <= s:
                k += 1
            m = k
            while m < len(y) and y[m][0] < e:
                links.append((i, y[m][2]))
                m += 1
    cuts = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
    groups, low = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for s, e, i in z if low <= s and e <= cut) for z in (x, y)) if len(x) < 500 else "")
        low = cut
    return len(a), len(b), len(cuts), links, ";".join(groups) if len(x) < 500 else None


@pytest.fixture(scope="module")
def sides():
    plain_tokens.own = tokenizers.Tokenizer.from_file(public.path(BYTE))
    plain_tokens.own.encode_special_tokens = True
    plain_tokens.model = sentencepiece.SentencePieceProcessor(model_file=public.path(PIECE))
    return alignment.byte_level(public.path(BYTE)), alignment.pieces(public.path(PIECE))


def test_pieces_give_the_ids_of_whole_texts(sides):
    texts = texts_of(1, 3000)
    word = tokenizers.Tokenizer.from_file(public.path(WORD))
    ids, sizes = token_files.encoder(public.path(WORD))(pa.array(texts))
    ends = np.cumsum(sizes)
    for text, n, e in zip(texts, sizes, ends, strict=True):
        assert ids[e - n : e].tolist() == word.encode(text or "", add_special_tokens=False).ids
    known = tuple(subwords.Remembered(s.encode, s.tokens) for s in sides)
    t = alignment.tokens_of(pa.array(texts), sides, known)
    a, b = np.append(0, np.cumsum(t.n_a)), np.append(0, np.cumsum(t.n_b))
    for k, text in enumerate(texts):
        assert (t.a[a[k] : a[k + 1]].tolist(), t.b[b[k] : b[k + 1]].tolist()) == plain_tokens(text or "", sides)


@pytest.mark.parametrize("table", [alignment.TABLE, 3])
def test_alignment_against_overlapping_spans(spark, sides, table):
    texts = texts_of(2, 150) + ["again and again"] * 3
    rows = [(None if k == 5 else k % 170, t, "x", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, n int")
    want = [plain_alignment(t, sides) for t in texts]
    count = Counter(link for w in want for link in w[3])
    most: dict = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    kept = Scratch(spark)
    aligned, pairs = alignment.align(docs, public.path(BYTE), public.path(PIECE), kept, table=table)
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs.collect()} == {p: (n, n == most[p[1]]) for p, n in count.items()}
    got = Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"] if r["n_a"] < 500 else None, r["n_best"], r["count_sum"]) for r in aligned.collect())
    assert got == Counter((i, n_a, n_b, n_groups, len(links), groups, sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links)) for (i, *_), (n_a, n_b, n_groups, links, groups) in zip(rows, want, strict=True))
    empty, none = alignment.align(docs.limit(0), public.path(BYTE), public.path(PIECE), kept, table=table)
    assert empty.count() == 0 and none.count() == 0
    kept.drop()


def test_alignment_query(spark, tmp_path, sides):
    spark.createDataFrame([(1, "One two"), (2, None), (3, "x ▁ y")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op12_alignment(spark, str(tmp_path)).collect()}
    assert got[2]["groups_sha256"] == got[3]["groups_sha256"] == "" and got[3]["n_links"] == 0
    assert len(got[1]["groups_sha256"]) == 64 and got[1]["n_best"] == got[1]["n_links"] > 0


def test_words_come_back_packed():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, high = int(rng.choice([0, 1, 5, 59, 60, 61, 1023, 1024, 1025, 5000])), int(rng.choice([1, 2, 3, 10, 300, 50000, 2**32]))
        ids = rng.integers(0, high, n)
        if rng.random() < 0.5:
            ids = np.minimum(ids, (2 ** rng.integers(1, 33, n)).astype(np.int64) - 1)
        coded, escapes, n_words, n_escapes, n_ids = token_files.packed(ids)
        assert n_words.sum() == len(coded) and n_escapes.sum() == len(escapes)
        assert (token_files.unpacked(coded, escapes, n_words, n_ids) == ids).all()
        assert 8 * len(coded) + 4 * len(escapes) <= 12 * n
    # a block is decoded by itself
    ids = rng.integers(0, 40000, 3000)
    coded, escapes, n_words, n_escapes, n_ids = token_files.packed(ids)
    one = token_files.unpacked(coded[n_words[0] :][: n_words[1]], escapes[n_escapes[0] :][: n_escapes[1]], n_words[1:2], n_ids[1:2])
    assert (one == ids[1024:2048]).all()


@pytest.mark.parametrize("size", [None, 4000])
def test_token_files_round_trip(spark, monkeypatch, size):
    if size:  # several files and groups a task
        for name in ("FILE", "GROUP", "OUT", "BATCH"):
            monkeypatch.setattr(token_files, name, size)
        assert sys.modules["listflow.llm.token_files"].FILE == size
    word = tokenizers.Tokenizer.from_file(public.path(WORD))
    rows = [(None if k % 90 == 0 else k * 7 % 1000 - 300, t, "x", 1) for k, t in enumerate(texts_of(4, 600))] + [(5, "same", "", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(5)
    kept = Scratch(spark)
    path = f"{kept.path}/ids"
    token_files.write_token_ids(docs, path, public.path(WORD), end_id=2)
    got = token_files.read_token_ids(spark, path).orderBy("start").collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((i, (*word.encode(t or "", add_special_tokens=False).ids, 2)) for i, t, *_ in rows)
    assert [r["start"] for r in got] == np.cumsum([0] + [len(r["ids"]) for r in got])[:-1].tolist()
    ids = [-(10**9) if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    raw = {(r["doc_id"], r["start"]): r["ids"] for r in token_files.read_token_ids(spark, path, as_bytes=True).collect()}
    assert all(raw[r["doc_id"], r["start"]] == np.array(r["ids"], "<u4").tobytes() for r in got)
    with pytest.raises(Exception, match="(?i)exists"):
        token_files.write_token_ids(docs, path, public.path(WORD))
    # without an end, texts without words have no ids
    token_files.write_token_ids(docs.where("doc_id < 0 or text is null"), f"{kept.path}/bare", public.path(WORD))
    assert token_files.read_token_ids(spark, f"{kept.path}/bare").where("size(ids) = 0").count() > 0
    token_files.write_token_ids(docs.limit(0), f"{kept.path}/none", public.path(WORD))
    assert token_files.read_token_ids(spark, f"{kept.path}/none").count() == 0
    kept.drop()


def test_token_id_query(spark):
    folder = "/root/testdata/sf0.001"
    word = tokenizers.Tokenizer.from_file(public.path(WORD))
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op11_token_ids(spark, folder).collect()}
    start = 0
    for doc, e in zip(docs, word.encode_batch([d["text"] for d in docs], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        assert got.pop(doc["doc_id"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


cloudpickle.register_pickle_by_value(sys.modules[__name__])
