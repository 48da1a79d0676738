import hashlib
import random
import zlib

import numpy as np
import pytest

from featherloom.llm import prefix_trie as module
from featherloom.llm.prefix_trie import RangeMinima, trie_digest

SCHEMA = "conv_id long, turn long, role string, text string, depth int, Node string"


def truth(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - int(np.fmod(c, 100))
        paths[c] = tuple(own.get(first, [])[:h] + ts[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        out, todo = [], [p]
        while todo:
            q = todo.pop()
            out.append(q)
            todo += children.get(q, [])
        return out
    out = []
    for p, cs in members.items():
        under = below(p)
        ends = ",".join(map(str, sorted(c for c in cs if len(paths[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs),
                    len(children.get(p, [])), sum(q not in children for q in under),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in trie_digest(df).select(columns).collect()), key=str)


def conversations(rng, n, texts, most):
    rows = []
    for c in rng.sample(range(-250, 3000), n):
        for turn in range(rng.randint(1, most)):
            rows.append((c, turn if turn else rng.choice([None, 0]), rng.choice(["u", None, ""]),
                         rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = conversations(rng, 220, ["a", "bb", "", None, "ünd 😀"], (3, 6, 9)[seed])
    rows += [(None, 1, "u", "no conversation")]
    # a crowd of equal conversations, and a long shared beginning
    rows += [(c, t, "u", "same") for c in range(5000, 5080) for t in range(4)]
    rows += [(c, t, "u", "long") for c in range(7000, 7012) for t in range(90 + c % 7)]
    assert found(spark, rows) == truth(rows)


def test_small_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "u", "t")]) == []
    turnless = [(c, 0, "u", "t") for c in range(101, 140)]
    assert found(spark, turnless) == truth(turnless)
    assert any(r[1] == 0 and r[7] != module._NONE for r in truth(turnless))
    for rows in ([(100, None, None, None)], [(100, 0, "u", "t"), (100, 1, "u", "t")]):
        assert found(spark, rows) == truth(rows)


def test_cuts_inside_a_shared_prefix(spark, monkeypatch):
    """Cuts that end inside common prefixes change the ranges, not the nodes."""
    rng = random.Random(9)
    rows = conversations(rng, 300, ["a", "b"], 7)
    want = truth(rows)
    for cut in (1, 3):
        monkeypatch.setattr(module, "CUT", cut)
        assert found(spark, rows) == want
    monkeypatch.setattr(module, "RANGE", 20)
    assert found(spark, rows) == want


def test_range_minima_search_both_ways():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(0, 4, n)
        table = RangeMinima(values)
        a, b = np.triu_indices(n)
        assert (table.least(a, b) == [values[i:j + 1].min() for i, j in zip(a, b, strict=True)]
                ).all()
        for bound in range(5):
            place = np.arange(n)
            right, left = place.copy(), place.copy()
            for i in range(n):
                while right[i] + 1 < n and values[right[i] + 1] >= bound:
                    right[i] += 1
                while left[i] > 0 and values[left[i]] >= bound:
                    left[i] -= 1
            assert (table.right(place, np.full(n, bound)) == right).all()
            assert (table.left(place, np.full(n, bound)) == left).all()
