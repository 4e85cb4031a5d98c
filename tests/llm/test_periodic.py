import hashlib
import random
import re
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark import cloudpickle

from listflow.llm import periodic, queries


def plain_runs(w: list, least: int = 24) -> list[tuple[int, int, int]]:
    """Every period against every place."""
    found: dict = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(w: list, runs: list) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sample(rng: random.Random, kind: int, n: int) -> list[int]:
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:  # one period from some place on
        p, a = rng.randrange(1, max(2, n // 3)), rng.randrange(n)
        block = [rng.randrange(3) for _ in range(p)]
        return [rng.randrange(3) for _ in range(a)] + [block[i % p] for i in range(n - a)]
    if kind == 2:  # Fibonacci words have many runs
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        return y[:n]
    if kind == 3:  # long periods that are nearly periodic themselves
        p = rng.randrange(1, 40)
        return ([0] * p + [1]) * (n // (p + 1)) + [0] * (n % (p + 1))
    if kind == 4:
        out: list = []
        while len(out) < n:
            out += [rng.randrange(2) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 9)
        return out[:n]
    block = ([rng.randrange(2) for _ in range(3)] * 5 + [7]) * rng.randrange(2, 6) + [9]
    return (block * 20)[:n]


@pytest.mark.parametrize("least", [24, 3])
def test_runs_against_every_period(least):
    rng = random.Random(least)
    for _ in range(25):
        texts = [sample(rng, rng.randrange(6), rng.choice([1, 5, 23, 24, 30, 60, 100, 300])) for _ in range(25)] + [[]]
        rows, repeated = periodic.runs_of(np.array([x for t in texts for x in t], np.int64), np.array([len(t) for t in texts]), least)
        for k, t in enumerate(texts):
            want = plain_runs(t, least)
            assert [tuple(r[1:]) for r in rows.tolist() if r[0] == k] == want
            first = sum(len(x) for x in texts[:k])
            assert plain_collapse(list(map(str, t)), want) == " ".join(str(x) for x, gone in zip(t, repeated[first:], strict=False) if not gone)


def test_long_text_with_nested_runs(spark):
    inner = ["a"] * 40 + ["b"]
    rows = [(1, " ".join([f"w{i}" for i in range(5000)] + inner * 50 + ["end"])), (2, " \t"), (3, None), (None, "x " * 30), (None, "x " * 30)]
    docs = spark.createDataFrame([(i, t, "z", 3) for i, t in rows], "doc_id long, text string, runs string, best int")
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == 5 and periodic.periodic_runs(docs.limit(0)).count() == 0
    own = {r["doc_id"]: r for r in got}
    runs = [tuple(x) for x in own[1]["runs"]]
    assert (5000, 2050, 41) in runs and len(runs) == 51 and sum(x[2] == 1 for x in runs) == 50
    assert own[1]["collapsed"].split()[5000:] == ["a", "b", "end"] or own[1]["collapsed"] == plain_collapse(rows[0][1].split(), runs)
    assert [tuple(x) for x in own[None]["runs"]] == [(0, 30, 1)] and own[None]["collapsed"] == "x"
    assert all(own[k]["runs"] == [] and own[k]["collapsed"] == "" for k in (2, 3))


def test_query_against_the_contract(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in queries.op13_runs(spark, folder).collect()}
    assert set(got) == set(docs)
    seen = 0
    for doc, text in docs.items():
        w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 1500:
            continue  # every period against every place takes its time
        runs = plain_runs(w)
        seen += len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        r = got[doc]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest()
    assert seen > 10


cloudpickle.register_pickle_by_value(sys.modules[__name__])
