import random
import re

import pytest

from listflow.operators import similar
from listflow.operators.similar import _links, near_copies


def plain(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").lower()) if x]
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    out = {}
    for i, x in sets.items():
        near = [j for j, y in sets.items() if j != i and x and y and 100 * len(x & y) >= percent * len(x | y)]
        out[i] = (len(x), min([j for j in near if j < i], default=None), len(near))
    return out


@pytest.mark.parametrize("width, percent", [(5, 80), (2, 50), (1, 100)])
def test_near_copies_against_all_pairs(spark, width, percent):
    rng = random.Random(width)
    base = [f"w{rng.randrange(60)}" for _ in range(40)]
    rows = [(k, " ".join(x if rng.random() > 0.004 * (k % 9) else "y" for x in base[: 20 + k % 21])) for k in range(120)]
    rows += [(500 + k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 9)))) for k in range(60)]
    rows += [(700, None), (701, ""), (702, " \t"), (703, "One"), (704, "one"), (705, "ONE one"), (706, "x " * 3000)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "key long, body string, n int, rep int").repartition(3)
    got = {r["id"]: (r["n_shingles"], r["copy_of"], r["links"]) for r in near_copies(df, "key", "body", width, percent).collect()}
    assert got == plain(rows, width, percent)
    assert near_copies(df.limit(0), "key", "body").count() == 0


def test_values_of_one_set_are_not_sorted_by_set(spark):
    sets = spark.createDataFrame([(k, 4, [k * 10, k * 10 + 1, k * 10 + 2, 1]) for k in range(1, 5)], "rep long, n long, s array<long>")
    plan = _links(sets, 80)._jdf.queryExecution().optimizedPlan().toString()
    # the counts lose them before they meet the sets
    assert re.search(r"Filter \(c#\d+L > 1\)", plan)
    assert _links(sets, 80).count() == 0 and _links(sets, 14).count() == 6


def test_only_sets_that_may_have_a_copy_are_met(spark, tmp_path, monkeypatch):
    """Most sets leave by one count of their values; the values of the others alone are joined and sorted."""
    rows = [(k, 5, [k * 10 + j for j in range(5)]) for k in range(1, 40)]
    rows += [(100, 5, [1, 2, 3, 4, 5]), (101, 6, [1, 2, 3, 4, 5, 6]), (102, 5, [7001, 7002, 7003, 7004, 7005]), (103, 5, [7001, 7002, 7003, 7004, 7005]), (104, 0, [])]
    # two rows of one id: neither speaks for the other
    rows += [(200, 5, [-1, -2, -3, -4, -5]), (200, 5, [8001, 8002, 8003, 8004, 8005]), (201, 5, [8001, 8002, 8003, 8004, 8005])]
    sets = spark.createDataFrame(rows, "id long, n long, s array<long>")
    assert sorted(r["id"] for r in similar._linkable(sets, 80, f"{tmp_path}/single").collect()) == [100, 101, 102, 103, 200, 201]
    seen = []
    monkeypatch.setattr(similar, "_links", lambda sets, percent, path: seen.append(sets.count()) or _links(sets, percent, path))
    texts = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(50)] + [(60, " ".join(f"a{j}" for j in range(40))), (61, " ".join(f"a{j}" for j in range(41)))]
    got = {r["id"]: r["copy_of"] for r in similar.near_copies(spark.createDataFrame(texts, "id long, t string"), "id", "t").collect()}
    assert seen == [2] and got == {**{k: None for k, _ in texts}, 61: 60}
