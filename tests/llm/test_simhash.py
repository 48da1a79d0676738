import random

import numpy as np
import pytest
import xxhash

from featherloom.llm import simhash as module
from featherloom.llm.simhash import (Forest, fingerprint_links, simhash_classes, simhash_digest,
                                     spanning)


def fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = text.encode().split(None) if text else []
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, seed=42)
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(grams))


def classes(bits, radius=2):
    root = {b: b for b in bits}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    bits = sorted(root)
    for i, a in enumerate(bits):
        for b in bits[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {b: find(b) for b in bits}


def truth(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = classes(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted([(i, f"{p:016x}", least.get(root[p])) for (i, _), p in
                   zip(rows, prints, strict=True)], key=str)


def test_against_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["É", "x y", "😀", "Ünder"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    rows = []
    for i in range(260):
        t = rng.choice(base).split(" ")
        if rng.random() < 0.6 and len(t) > 8:
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i if i % 17 else None, rng.choice([" ", "\t", "\n\x0b "]).join(t)))
    rows += [(1000, None), (900, ""), (901, " \n"), (902, "a b"), (903, "A B"), (None, "only null"),
             rows[3], rows[3], (rows[4][0], "another text of one id")]
    rows += [(2000, " ".join(rng.choice(words) for _ in range(400000)))]   # more hashes than a chunk
    df = spark.createDataFrame([(*r, 1, 2, "n") for r in rows],
                               "doc_id long, text string, bits long, component_id int, N string")
    got = sorted([tuple(r) for r in simhash_digest(df).select(
        "doc_id", "fingerprint", "component_id").collect()], key=str)
    assert got == truth(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_digest(df).count() == 0
    one = simhash_classes(spark.createDataFrame([(None, None)], df.schema)).collect()
    assert [tuple(r) for r in one] == [(None, 0, None)]


def crowded(rng, n, free):
    """Fingerprints that agree in all but ``free`` bits."""
    spots = rng.choice(64, free, replace=False)
    out = np.zeros(n, dtype=np.uint64)
    for s in spots:
        out |= (rng.integers(0, 2, n).astype(np.uint64) << np.uint64(s))
    return np.unique(out ^ np.uint64(0xF0F0123456789ABC))


@pytest.mark.parametrize("tree", [1 << 14, 3])
def test_links_join_what_brute_force_joins(spark, tree):
    rng = np.random.default_rng(tree)
    bits = np.unique(np.concatenate([crowded(rng, 300, 30), crowded(rng, 300, 12),
                                     rng.integers(0, 1 << 63, 100).astype(np.uint64)]))
    df = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "bits long")
    found = fingerprint_links(df, tree=tree).collect()
    root = {int(b): int(b) for b in bits.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in found:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 or find(a) is not None
        root[find(a)] = find(b)
    want = classes([int(b) for b in bits])
    one = {}
    for b in bits:
        key = find(int(b.view(np.int64)))
        assert one.setdefault(key, want[int(b)]) == want[int(b)]
    assert len(one) == len(set(want.values()))


def test_tree_keys_and_pruned_search():
    rng = np.random.default_rng(2)
    bits = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    shard = np.repeat(np.arange(4), len(bits) // 4 + 1)[:len(bits)]
    trees = Forest(bits, shard)
    slots = np.flatnonzero(trees.child >= 0)
    child, parent = trees.child[slots], slots // 65
    assert sorted(child.tolist() + np.unique(trees.root).tolist()) == list(range(len(bits)))
    assert (trees.distance(child, parent) == slots % 65).all()
    assert (shard[child] == shard[parent]).all()
    visited = 0
    distance = Forest.distance

    def counted(self, a, b):
        nonlocal visited
        visited += len(a)
        return distance(self, a, b)
    Forest.distance = counted
    try:
        found = {(int(a), int(b)) for x, y in trees.links(6) for a, b in zip(x, y, strict=True)}
    finally:
        Forest.distance = distance
    assert visited < 0.9 * sum(int((shard == s).sum()) ** 2 for s in range(4))
    want = {(i, j) for i in range(len(bits)) for j in range(i)
            if shard[i] == shard[j] and int(bits[i] ^ bits[j]).bit_count() <= 6}
    assert found == want


def test_spanning_joins_chains():
    order = np.random.default_rng(0).permutation(500)
    links = [(order[:-1][::2], order[1:][::2]), (order[:-1][1::2], order[1:][1::2])]
    assert (spanning(500, links) == 0).all()
    assert (spanning(5, []) == np.arange(5)).all()


def test_long_texts_are_counted_in_portions(monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    offsets = np.array([0, 0, 3, 700, 700, 999, 1000])
    whole = module.majority(values, offsets)
    monkeypatch.setattr(module, "HASHES", 64)
    assert (module.majority(values, offsets) == whole).all()
