import itertools
import re
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from listflow.llm import decontamination, mixing, near_dup, queries, topk, warc
from listflow.llm.shared import Scratch

from .test_text_operators import words_of


def components(rows, width, percent):
    sets = {i: {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if (w := words_of(t)) else set() for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * (k := len(x & y)) >= percent * (len(x) + len(y) - k):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, docs, width, percent):
    rng = np.random.default_rng(4)
    base = [f"t{i}" for i in rng.integers(0, 400, 120)]
    rows = [(1000 + k, " ".join(w if rng.random() > 0.01 * (k % 6) else "x" for w in base)) for k in range(60)]
    chain = [f"c{i}" for i in range(160)]
    rows += [(2000 + k, " ".join(["z"] * 0 + chain[2 * k : 2 * k + 100])) for k in range(20)]
    table = docs.select("doc_id", "text", "rep", "key").unionByName(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'y' rep", "0 key"))
    got = near_dup.near_duplicates(table, width=width, percent=percent).collect()
    assert len(got) == table.count()
    want = components([(r["doc_id"], r["text"]) for r in table.where("doc_id is not null").collect()], width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_links_inside_a_family_from_one_template(spark):
    # texts of optional paragraphs: all pairs are similar, few of them are links
    rng = np.random.default_rng(8)
    parts = [" ".join(f"p{k}w{i}" for i in range(3)) for k in range(48)]
    rows = [(k, " ".join(x for x in parts if rng.random() < 0.82)) for k in range(3000)]
    shingles = {}
    sets = [sorted({shingles.setdefault(" ".join(w[i : i + 3]), len(shingles)) for i in range(len(w) - 2)}) for w in (t.split() for _, t in rows)]
    cells = np.zeros((len(rows), len(shingles)), np.float32)
    for k, own in enumerate(sets):
        cells[k, own] = 1
    both, size = cells @ cells.T, cells.sum(1)
    linked = 100 * both >= 80 * (size[:, None] + size - both)
    want = np.arange(len(rows))
    while (low := np.where(linked, want, len(rows)).min(1)).tolist() != want.tolist():
        want = low
    assert 100 < len(set(want.tolist())) < len(rows) - 100
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(table, width=3, percent=80).collect()}
    assert [got[k] for k in range(len(rows))] == want.tolist()


@pytest.mark.parametrize("block", [near_dup.BLOCK, 7])
def test_exact_finish_by_blocks(spark, monkeypatch, block):
    # a component that fills blocks, single texts around it, and two groups that overlap
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = np.random.default_rng(3)
    words = lambda k, n: " ".join(f"{k}x{i}" for i in range(n))
    rows = {k: words("a", 40) + " " + words(f"own{k % 9}", 4 + k % 5) for k in range(60)} | {100 + k: words("a", 40) + " " + words(f"far{k // 2}", 9 + k % 2) for k in range(20)}
    rows |= {k + 200: words("b", int(rng.integers(20, 40))) for k in range(40)}
    docs = spark.createDataFrame(list(rows.items()), "id long, text string")
    large = spark.createDataFrame([(1, k) for k in rows if k < 200] + [(2, k) for k in rows if k > 110], "key long, id long")
    labels = spark.createDataFrame([(k, 0) for k in range(0, 60, 9)] + [(k, 1) for k in range(1, 60, 9)], "id long, component long")
    sizes = docs.select("id", (F.size(F.split("text", " ")) - 2).cast("long").alias("n"))
    kept = Scratch(spark)
    try:
        links = [(r["m"], r["c"]) for r in near_dup._finished(kept, docs, large, sizes, labels, 3, 80).collect()]
    finally:
        kept.drop()
    root = {k: k for k in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for m, c in [*links, *((r["id"], r["component"]) for r in labels.collect())]:
        low, high = sorted((find(m), find(c)))
        root[high] = low
    want = components(rows.items(), 3, 80)
    assert {k: find(k) for k in rows} == {k: c for k, (_, c) in want.items()}


def test_densification_fills_every_bin():
    value = np.array([5, 1 << 63], np.uint64)
    out = near_dup.signature(value, np.array([0, 0]), 2, 128)
    assert set(out[0].tolist()) == set(value.tolist()) and not out[1].any()


def test_top_k_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 24).round(1)]) for i in range(230)]
    rows += [(300 + i, rows[7][1]) for i in range(12)] + [(50, rows[50][1])]
    rows += [(400, None), (401, []), (402, [None] * 24), (403, [float("nan")] * 24), (404, [float("inf")] * 24), (None, [0.1] * 24), (450, [0.5, 0.25]), (451, [0.5, -0.25])]
    rows += [(460, [1e12] * 24), (461, [2e12] * 23 + [-2e12])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = sorted(tuple(r) for r in topk.top_k(table, table.where("vec_id % 50 = 0 or vec_id > 440")).collect())
    whole = sorted({(i, tuple(floor(256 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and abs(x) < float("inf") for x in v)})
    want = []
    for i, q in whole:
        if i % 50 == 0 or i > 440:
            held = lambda s: max(-(2**63), min(2**63 - 1, s))
            score = sorted((-held(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in whole if j != i and len(v) == len(q))
            best = [(i, j, -s) for s, j in score[:5]]
            want += best
    # an id with two vectors gets the best of both
    twice = sorted({w for w in want if w[0] == 50}, key=lambda w: (-w[2], w[1]))[:5]
    want = sorted([w for w in want if w[0] != 50] + twice, key=lambda w: (w[0], -w[2], w[1]))
    assert [(q, j, s) for q, _, j, s in got] == want and {g[1] for g in got} == {1, 2, 3, 4, 5}
    assert topk.top_k(table.limit(0), table.limit(0)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for dims in (1, 3, 24, 64):
        q, x = rng.normal(size=(20, dims)), rng.normal(size=(30, dims))
        for parts in topk.LEVELS:
            assert (topk.segments(q, parts) @ topk.segments(x, parts).T >= q @ x.T - 1e-9).all()


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 0.5, "b": 0.3, "c": 0.2}, {k: 1.0 + k for k in range(17)}, {"x": 1e-9, None: 1.0}, {"third": 1 / 3, "odd": 0.1005, "rest": 2 / 3 - 0.1005}])
def test_schedule_keeps_to_the_wanted_weights(weights):
    total = sum(map(Fraction, weights.values()))
    wanted = {s: Fraction(w) / total for s, w in weights.items()}
    blocks = {s: 1 + int(3000 * w) for s, w in wanted.items()}
    plan, horizon = mixing.schedule(mixing.whole(weights), blocks)
    assert [p[2] for p in plan] == list(range(sum(blocks.values()))) and min(blocks.values()) <= horizon <= len(plan)
    done = dict.fromkeys(weights, 0)
    for s, k, slot, release, deadline in plan:
        assert k == done[s] and release <= slot < deadline
        done[s] += 1
        assert slot >= horizon or all(abs(done[x] - (slot + 1) * wanted[x]) < 1 for x in weights)
    assert done == blocks


def test_schedule_does_not_drift_over_a_million_slots():
    weights = {"third": 1 / 3, "odd": 0.1005, "rest": 2 / 3 - 0.1005}
    plan, horizon = mixing.schedule(mixing.whole(weights), {s: 1 + int(1_000_000 * w) for s, w in weights.items()})
    source = np.array([p[0] for p in plan])[:horizon]
    assert horizon > 999_000
    for s, w in weights.items():
        assert np.abs(np.cumsum(source == s) - np.arange(1, horizon + 1) * w).max() < 1


def test_mixture_is_whole_and_on_target(spark, docs):
    table = docs.select("doc_id", "source", F.lit(1).alias("slot")).unionByName(spark.range(900).selectExpr("id + 100 doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 4)) source", "1 slot"))
    weights = {"hot": 0.5, "s0": 0.1}
    rows = mixing.mix(table, weights, block=4).collect()
    assert sorted((str(r["doc_id"]), str(r["source"])) for r in rows) == sorted((str(r["doc_id"]), str(r["source"])) for r in table.collect())
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    slots = {r["slot"]: r["source"] for r in rows if r["on_target"]}
    assert sorted(slots) == list(range(len(slots))) and len(slots) > 2
    for upto in range(1, len(slots) + 1):
        assert abs(sum(slots[k] == "hot" for k in range(upto)) - 0.5 * upto) < 1 and abs(sum(slots[k] == "s0" for k in range(upto)) - 0.1 * upto) < 1
    coarse = mixing.mix(table, weights, block=4, most_blocks=10).collect()
    assert len(coarse) == len(rows) and len({r["slot"] for r in coarse}) <= 10 + 6
    assert mixing.mix(docs.limit(0)).count() == 0


def test_leaks_and_paraphrases(spark, docs):
    rng = np.random.default_rng(6)
    vocabulary = [f"v{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, text(40)) for k in range(12)] + [(50, None), (51, " "), (None, "no id"), (0, text(40)), (60, text(150))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    plain = {i: t for i, t in items if t and i is not None and i > 0}
    swap = lambda t: " ".join(w if k % 6 else "other" for k, w in enumerate(t.split()))
    rows = [(500 + k, text(200)) for k in range(40)]
    rows += [(100 + k, f"{text(int(rng.integers(0, 90)))} {plain[k].upper()}! {text(50)}") for k in range(1, 12)]
    rows += [(200 + k, f"{text(33)} {swap(plain[k])} {text(20)}") for k in range(1, 12)]
    rows += [(300, plain[1] + " " + text(7) + " " + plain[2]), (301, text(40) + " " + plain[60])]
    table = docs.select("doc_id", "text", "rep").unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit("r")))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(table, bench).collect()}
    want = {(100 + k, k) for k in range(1, 12)} | {(200 + k, k) for k in range(1, 12)} | {(300, 1), (300, 2), (301, 60)}
    assert got == want
    clean = decontamination.drop_leaks(table, bench)
    assert clean.columns == table.columns and clean.count() == table.count() - len({d for d, _ in want})
    assert decontamination.find_leaks(table, bench.limit(0)).count() == 0 and decontamination.find_leaks(table.limit(0), bench).count() == 0


def test_verbatim_runs_are_leaks(spark):
    rng = np.random.default_rng(16)
    text = lambda n: " ".join(f"v{i}" for i in rng.integers(0, 5000, n))
    items = {1: text(59), 2: text(100), 3: text(40), 4: text(5), 5: text(59), 6: text(200)}
    part = lambda k, low, high: " ".join(items[k].split()[low:high])
    runs = [(1, 0, 46), (1, 5, 40), (2, 27, 72), (2, 44, 57), (3, 0, 13), (3, 27, 40), (4, 0, 5), (6, 44, 57), (6, 93, 106), (6, 187, 200)]
    rows = {k: f"{text(int(n))} {part(*run)} {text(60)}" for k, (run, n) in enumerate(zip(runs, (0, 25, 31, 90, 95, 300, 64, 70, 28, 7), strict=True))}
    rows |= {20: f"{text(40)} {part(5, 8, 20)} {text(40)}", 21: text(300), 22: part(4, 0, 2), 23: f"{part(5, 0, 7)}"}
    # the next text goes on where one ends
    rows |= {24: part(5, 7, 14)}
    table = spark.createDataFrame(list(rows.items()), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(table, bench).collect()}
    assert got == {(k, run[0]) for k, run in enumerate(runs)}
    assert {r["doc_id"] for r in decontamination.drop_leaks(table, bench).collect()} == set(rows) - set(range(len(runs)))


def test_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 14)), rng.integers(0, 6, rng.integers(0, 20))
        grid = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            grid[i + 1, j + 1] = grid[i, j] + 1 if a[i] == b[j] else max(grid[i, j + 1], grid[i + 1, j])
        assert decontamination.common_subsequence(a, b).sum() == grid[-1, -1]


def test_warc_commits_add_up_or_replace(spark, tmp_path):
    kept = Scratch(spark)
    pages = spark.createDataFrame([(k, f"u{k}", f"<p>{k}") for k in range(1, 5)], "page_id long, url string, html string")
    path = f"{tmp_path}/w"
    for k in (1, 2):
        warc.write_warc(pages.where(f"page_id = {k}"), path, kept)
    assert sorted(r["page_id"] for r in warc.read_warc(spark, path).collect()) == [1, 2]
    warc.write_warc(pages.where("page_id = 3"), path, kept, mode="overwrite")
    assert [r["page_id"] for r in warc.read_warc(spark, path).collect()] == [3]
    warc.write_warc(pages.where("page_id = 4"), path, kept)
    assert sorted(r["page_id"] for r in warc.read_warc(spark, path).collect()) == [3, 4]
    kept.drop()


@pytest.mark.parametrize("packed", [True, False])
def test_warc_archives_of_others(spark, tmp_path, packed):
    html = "é" * 200_000
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n{html}".encode()

    def other(kind, block, *more):
        head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:12-ab>", "WARC-Date: 2020-01-01T00:00:00Z", *more, f"Content-Length: {len(block)}", "", ""]
        return "\r\n".join(head).encode() + block + b"\r\n\r\n"

    body = "application/http; msgtype=response"
    three = [
        other("warcinfo", b"software: x\r\n\r\n", "Content-Type: application/warc-fields"),
        other("response", http, f"Content-Type: {body}", "WARC-Target-URI: http://a/", "WARC-Payload-Digest: md5:00"),
        other("revisit", http[:40], f"Content-Type: {body}", "WARC-Refers-To: <urn:uuid:12-ab>"),
        other("response", b"HTTP/1.1 204 No Content\r\n\r\n", f"Content-Type: {body}", f"WARC-Payload-Digest: sha1:{warc.digest(b'')}"),
    ]
    import gzip

    (tmp_path / ("a.warc.gz" if packed else "a.warc")).write_bytes(b"".join(gzip.compress(x) if packed else x for x in three))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert [r["record_type"] for r in rows] == ["warcinfo", "response", "revisit", "response"]
    assert [r["payload_bytes"] for r in rows] == [15, len(html.encode()), None, 0]
    assert bytes(rows[1]["payload"]) == html.encode() and bytes(rows[3]["payload"]) == b"" and rows[2]["payload"] is None
    assert {r["page_id"] for r in rows} == {None} and rows[0]["record_id"] == rows[2]["refers_to_id"] == "<urn:uuid:12-ab>"
    heads = warc.read_warc(spark, str(tmp_path), payloads=False).collect()
    assert [r["payload_bytes"] for r in heads] == [15, len(html.encode()), None, 0]
    assert warc.read_warc(spark, str(tmp_path), payloads=False).where("target_uri = 'http://a/'").count() == 1
    bad = other("response", http, f"Content-Type: {body}", f"WARC-Payload-Digest: sha1:{warc.digest(b'x')}")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.warc").write_bytes(bad)
    with pytest.raises(Exception, match="headers say"):
        warc.read_warc(spark, f"{tmp_path}/b").collect()


def test_warc_round_trip(spark, tmp_path):
    import base64
    import hashlib

    pages = [(5, "http://a/\r\nX-Evil: 1", "same"), (3, None, "same"), (9, "http://c", None), (8, "http://d", ""), (7, "http://e", "ü" * 70000), (None, "http://f", "same"), (1, "http://g", "\r\n\r\nHTTP"), (3, "http://h", "same")]
    table = spark.createDataFrame([(i, u, h, "x") for i, u, h in pages], "page_id long, url string, html string, record_type string")
    kept = Scratch(spark)
    warc.write_warc(table, f"{tmp_path}/w", kept)
    rows = warc.read_warc(spark, f"{tmp_path}/w").collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = next(h or "" for i, _, h in pages if i == r["page_id"]).encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html), base64.b32encode(hashlib.sha1(html).digest()).decode())
        assert r["payload"] == (html if r["record_type"] == "response" else None)
        assert (r["record_type"], r["refers_to"]) == {5: ("revisit", 3), 9: ("revisit", 8), None: ("revisit", 3)}.get(r["page_id"], ("response", None))
    few = warc.read_warc(spark, f"{tmp_path}/w", payloads=False).where("record_type = 'revisit' and page_id in (5, 9, 1)")
    assert sorted(r["page_id"] for r in few.collect()) == [5, 9] and few.where("payload is not null").count() == 0
    reader = warc.WarcReader({"path": f"{tmp_path}/w"})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")])) == [] and reader.equal == {"record_type": ["revisit"]}
    warc.write_warc(table.limit(0), f"{tmp_path}/none", kept)
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def test_headers_come_first_and_unwanted_payloads_are_stepped_over(tmp_path):
    from pyarrow import fs

    class Row(dict):
        pass

    path, cuts = tmp_path / "a.warc.gz", [0]
    with open(path, "wb") as f:
        for k in range(30):
            f.write(warc.member(warc.record(Row(page_id=k, url=f"u{k}", html=str(np.random.default_rng(k).bytes(90000)), record_type="response", refers_to=None), "d")))
            cuts.append(f.tell())
    plain = warc.zlib.decompressobj(31)
    assert plain.decompress(path.read_bytes()[: cuts[1]]).startswith(b"WARC/1.1") and plain.eof
    with fs.LocalFileSystem().open_input_file(str(path)) as f:
        some = [h["warc-record-id"] for h, _ in warc.records(f, cuts[4], cuts[9], lambda h: True, False)]
        whole = [(h["warc-record-id"], len(b)) for h, b in warc.records(f, 0, cuts[-1], lambda h: h["warc-target-uri"] == "u7", True)]
    assert some == [f"<urn:page:{k}>" for k in range(4, 9)] and whole[0][0] == "<urn:page:7>" and whole[0][1] > 90000


def test_pipeline_against_plain_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages, now, at = Scratch(spark), docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = at[name] = stages.keep(stage(spark, now, folder), name)
        if name != names[-1]:
            assert now.columns == docs.columns
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in at.items()}
    kept = [i in ids["quality"] for i, q in labels.items() if q]
    gone = [i not in ids["quality"] for i, q in labels.items() if not q]
    assert sum(kept) >= 0.97 * len(kept) and sum(gone) >= 0.9 * len(gone)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = components([(i, rows[i]) for i in ids["quality"]], 5, 80)
    assert ids["near_dup"] == {i for i, (_, c) in want.items() if i == c}
    norm = lambda t: f" {' '.join(re.findall(r'[a-z0-9\x80-\U0010ffff]+', t.lower()))} "
    items = [norm(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert ids["decontamination"] == {i for i in ids["near_dup"] if not any(x in norm(rows[i]) for x in items)}
    assert ids["pii"] == ids["decontamination"] == ids["mixing"]
    from listflow.llm.pii import base_spans

    assert not any(base_spans(r["text"]) for r in at["pii"].collect())
    assert sorted(tuple(r) for r in queries.pipeline(spark, folder).collect()) == sorted(tuple(r) for r in at["mixing"].collect())


def test_registered_queries_against_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, folder)
        cur = duck.execute(sql)
        at = [[d[0] for d in cur.description].index(c) for c in df.columns]
        assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in cur.fetchall()), name
    # the others give a row for each row of their table
    for name in ("op2_quality", "op6_mixing", "op7_licences"):
        assert queries.QUERIES[name](spark, folder).count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert queries.op10_warc(spark, folder).count() == spark.read.parquet(f"{folder}/pages.parquet").count()


def test_texts_under_one_id_and_rows_without_id_are_documents(spark):
    words = lambda seed, n=60: " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, 10**6, n))
    a, b, c, d = (words(k) for k in range(4))
    rows = [(1, a), (1, a), (1, b), (1, b), (2, c), (3, c + " end"), (None, d), (None, d), (None, a), (4, None), (4, ""), (5, b + " end"), (None, None)]
    docs = spark.createDataFrame([(i, t, "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string, kept int")
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.distinct(spark, docs, "").collect()), key=str)
    want = {(2, c), (None, d), (None, None), (4, None), (4, "")}
    assert want <= set(got) and len(got) == len(want) + 2
    # a and its copy without an id stay once, under the id; b stays once, under one of its ids
    assert [t for i, t in got if t == a] == [a] and (1, a) in got and len([t for _, t in got if t in (b, b + " end")]) == 1
    plain = docs.where("doc_id in (2, 3)")
    assert [(r["doc_id"], r["text"]) for r in corpus_pipeline.distinct(spark, plain, "").collect()] == [(2, c)]
