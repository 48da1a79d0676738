import math
import random

import numpy as np
import pytest

from featherloom.llm.top_k import search_blocks, top_k

SCHEMA = "vec_id long, embedding array<float>, slot string"


def truth(rows, queries, k=10):
    def usable(r):
        return r[0] is not None and r[1] is not None and all(
            x is not None and math.isfinite(x) for x in r[1])
    q = lambda v: [math.floor(1024 * float(np.float32(x))) for x in v]
    have = [(r[0], q(r[1])) for r in rows if usable(r)]
    out, seen = [], {}
    for i, v, *_ in queries:
        if usable((i, v)):
            seen[i] = min(seen.get(i, q(v)), q(v))
    for i, v in seen.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j)  # noqa: B905
                        for j, w in have if j != i)[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 7, 9000])
def test_against_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5, rng.random() - .5]) for _ in range(3)], "s")
            for i in range(n)]
    rows += [(None, [1.0], ""), (5, None, ""), (6, [1.0, None], ""), (8, [float("nan")], ""),
             (9, [float("inf")], ""), (3, [2.0], ""), (100, [], "")] if n > 1 else []
    queries = [r for r in rows if r[0] is not None and r[0] % 500 == 0]
    df = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame(queries, SCHEMA)
    assert sorted(tuple(r) for r in top_k(df, asked).collect()) == truth(rows, queries)


def test_blocks_with_ties_and_large_values():
    rng = np.random.default_rng(3)
    for top in (2, 50, 1 << 25):
        ids, vectors = rng.permutation(300), rng.integers(-top, top, (300, 4))
        queries, query_ids = vectors[:5], ids[:5]
        row, found, scores = search_blocks(ids, vectors, query_ids, queries, 7, block=16)
        for i in range(5):
            s = vectors @ queries[i]
            want = sorted((-int(x), int(j)) for x, j in zip(s, ids, strict=True)
                          if j != query_ids[i])[:7]
            got = [(-int(x), int(j)) for x, j in zip(scores[row == i], found[row == i],
                                                     strict=True)]
            assert got == want
