import re
from collections import defaultdict

import numpy as np
import pytest

from featherloom.llm.mixing import WEIGHTS, apportion, mix, mix_digest
from featherloom.llm.queries import op8_source_mixing


def slow_apportion(votes, house, caps):
    seats = [0] * len(votes)
    for _ in range(house):
        best, at = -1.0, None
        for i, v in enumerate(votes):
            if v > 0 and seats[i] < caps[i] and v / (2 * seats[i] + 1) > best:
                best, at = v / (2 * seats[i] + 1), i
        if at is None:
            break
        seats[at] += 1
    return seats


def test_apportion_gives_seats_to_the_highest_quotients():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        votes, caps = rng.integers(0, 50, n), rng.integers(0, 12, n)
        house = int(rng.integers(0, 40))
        assert apportion(votes, house, caps).tolist() == slow_apportion(
            votes.tolist(), house, caps.tolist())


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        rest = total - sum(done.values())
        w = sum(weight[s] for s in names if s not in done)
        share = {s: rest * weight[s] / w for s in names if s not in done} if w else {}
        above = [s for s in share if share[s] > 3 * sizes[s]]
        if not above:
            return {**share, **done}
        done |= {s: 3.0 * sizes[s] for s in above}


def judge(rows, out, tolerance):
    sizes, taken, got = defaultdict(int), defaultdict(int), {}
    for i, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    source = defaultdict(list)
    for i, _, s in rows:
        source[i].append(s)
    for r in out:
        s = source[r.doc_id][0]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(64, tolerance * want[s]), (s, taken[s], want[s])
    return got


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = op8_source_mixing(spark, folder).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert len(out) == len(rows)
    judge(rows, out, 0.03)
    again = mix_digest(docs.repartition(7)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


@pytest.mark.parametrize("seed", [0, 5])
def test_small_sources_nulls_and_repeats(spark, seed):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, "w " * 900, "z"),
            (5, "k\x0bl m n", None), (6, "q " * 5, "é"), (7, "v " * 300, "zz"), (8, None, "e")]
    df = spark.createDataFrame([(*r, 7, "t") for r in rows],
                               "doc_id long, text string, source string, size int, k1 string")
    out = mix(df, seed).collect()
    assert len(out) == len(rows) and {r.k1 for r in out} == {"t"}
    judge(rows, out, 0.05)
    for r in out:
        assert r.taken == r.copies * r.size + sum(s.end - s.start for s in r.spans)
        ends = [0] + [x for s in r.spans for x in (s.start, s.end)] + [r.size]
        assert ends == sorted(ends)
    assert mix(df.limit(0)).count() == 0
