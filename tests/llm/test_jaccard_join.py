import random

import numpy as np
import pytest

from featherloom.llm import jaccard_join as module
from featherloom.llm.components import components
from featherloom.llm.jaccard_join import (candidate_pairs, common_cells, linked_forest,
                                          near_duplicate_digest, signatures)

LAST = 1 << 63


def shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = text.encode().split()
    if not w:
        return set()
    return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}


def truth(rows):
    sets = [shingles(t) for _, t in rows]
    key = [LAST if i is None else i for i, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in holders[g]:
                common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= 90 * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), LAST), key[i])
    return [(rows[i][0], len(sets[i]), None if least[find(i)] == LAST else least[find(i)])
            for i in range(len(rows))]


def order(r):
    return tuple((x is None, x or 0) for x in r)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcDEé", k=rng.randint(1, 5))) for _ in range(300)]
    text = lambda k: rng.choices(vocab, k=k)
    rows = []
    for n in (1, 2, 3, 4, 12, 30, 61, 64, 70, 120, 400, 900):
        for _ in range(3):
            base = text(n)
            for _ in range(rng.randint(1, 12)):
                w = list(base)
                for _ in range(rng.randint(0, max(1, n // 45))):
                    at = rng.randrange(len(w) + 1)
                    w[at:at + rng.randint(0, 1)] = text(rng.randint(0, 1))
                rows.append(rng.choice([" ", "\n", "  "]).join(w))
    line = text(40)
    rows += [" ".join(line + text(rng.randint(1, 60))) for _ in range(90)]
    rows += [" ".join(line + [str(i)]) for i in range(90)]   # a large group of near copies
    ids = rng.sample(range(1000), len(rows))
    rows = list(zip(ids, rows, strict=True))
    rows += [(2000, None), (2001, " \t\x0b"), (2002, ""), (None, rows[0][1]), (None, "no one else's"),
             rows[1], rows[1], (2003, rows[2][1].upper()), (rows[5][0], "same id other text")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "frequent", "block"), [(1, 64, 1024), (2, 4, 8), (3, 2, 1024)])
def test_against_brute_force(spark, monkeypatch, seed, frequent, block):
    monkeypatch.setattr(module, "FREQUENT", frequent)
    monkeypatch.setattr(module, "BLOCK", block)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    got = sorted((tuple(r) for r in near_duplicate_digest(df.repartition(3)).collect()), key=order)
    assert got == sorted(truth(rows), key=order)


def test_whole_table_and_empty_table(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in near_duplicate_digest(df).collect()) == sorted(truth(rows))
    assert near_duplicate_digest(df.limit(0)).count() == 0


def test_linked_sets_share_a_signature():
    rng = random.Random(5)
    for _ in range(400):
        size = rng.randint(2, 150)
        x = {rng.getrandbits(64) for _ in range(size)}
        y = set(rng.sample(sorted(x), size - rng.randint(0, max(0, size // 11))))
        y |= {rng.getrandbits(64) for _ in range(rng.randint(0, 2))}
        if 100 * len(x & y) < 90 * len(x | y):
            continue
        count = {t: rng.choice([1, 3, 64]) if t in x and t in y else 1 for t in x | y}
        for t in x & y:
            count[t] = max(2, count[t])
        signs = []
        for s in (x, y):
            own = [t for t in s if t % 3 == 0]
            own = [t for t in own if t % 5]
            rest = sorted(t for t in s if t % 3 and t % 5)
            common = sorted(t for t in s if t % 5 == 0)
            shared = [(count[t], t) for t in own if count[t] > 1]
            signs.append(signatures(len(s), len(own), shared, rest, 90, common))
        assert signs[0] & signs[1], (len(x), len(y))


@pytest.mark.parametrize("percent", [51, 80, 99])
def test_sets_of_frequent_tokens_share_a_signature(percent):
    rng = random.Random(percent)
    for size in range(2, 130):
        x = sorted(rng.getrandbits(64) for _ in range(size))
        y = x[module.may_lack(size, percent):]   # what the first set lacks is first in its order
        if len(y) > 1:
            assert signatures(size, 0, [], [], percent, x) \
                & signatures(len(y), 0, [], [], percent, y), size


@pytest.mark.parametrize("own", [10, 20])
def test_boilerplate_makes_no_candidates(spark, own):
    rng = random.Random(8)
    line = [f"notice{i}" for i in range(30)]
    rows = [(i, i, " ".join(line + [str(rng.getrandbits(40)) for _ in range(own)]))
            for i in range(4000)]
    keyed = spark.createDataFrame(rows, "doc long, tag long, text string")
    _, pairs = candidate_pairs(keyed, 90, 3)
    sizes = components(pairs).groupBy("root").count().agg({"count": "max"}).first()[0]
    assert (sizes or 0) <= 10


def test_sketch_counts_all_partitions(spark):
    texts = ["a b c"] * 3 + [f"a b c {i}" for i in range(100)] + [None, "", "one two"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "tag long, text string")
    common = common_cells(df.repartition(5), 3)
    # "a b c" is in 103 rows, every other shingle in one
    assert common.shape == (2, 1 << 20) and common.sum(axis=1).tolist() == [1, 1]
    assert not common_cells(df.limit(0), 3).any()


def test_forest_joins_what_links_join():
    rng = np.random.default_rng(6)
    for _ in range(30):
        sets = [np.unique(rng.integers(0, 24, rng.integers(15, 60)).astype(np.uint64))
                for _ in range(20)]
        home = rng.random(20) < .7

        def closure(edges):
            group = list(range(20))
            for a, b in edges:
                group = [group[b] if g == group[a] else g for g in group]
            return [group.index(g) for g in group]
        every = [(a, b) for a in range(20) for b in range(a) if (home[a] or home[b]) and
                 100 * len(np.intersect1d(sets[a], sets[b]))
                 >= 90 * len(np.union1d(sets[a], sets[b]))]
        assert closure(linked_forest(sets, 90, home)) == closure(every)


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    out = components(spark.createDataFrame(edges, "a long, b long"))
    looped = {7} | {a for a, b in edges if a == b}
    got = {r.node: r.root for r in out.collect()}
    assert all(got.get(x, x if x in looped else None) == r for x, r in root.items())
