"""Substring deduplication against brute force on small tables."""

import hashlib
import random

import numpy as np
import pytest

from featherloom.llm import suffix_array, suffix_tree
from featherloom.llm.suffix_array import dedup_digest, dedup_substrings
from featherloom.llm.suffix_tree import dedup_passages, passage_digest

LAST = 1 << 63


def bytes_truth(rows, width=100):
    first, texts = {}, [((LAST if i is None else i), (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - width + 1):
            w = t[s:s + width]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for (i, _), (key, t) in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for s in range(len(t) - width + 1):
            if first[t[s:s + width]] < (key, s):
                gone[s:s + width] = [True] * width
        spans = sum(g and (not j or not gone[j - 1]) for j, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words_truth(rows, width=13):
    first, texts = {}, [((LAST if i is None else i), (t or "").encode().split()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - width + 1):
            w = tuple(t[s:s + width])
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, _), (key, t) in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for s in range(len(t) - width + 1):
            if first[tuple(t[s:s + width])] < key:
                gone[s:s + width] = [True] * width
        kept = [b for b, g in zip(t, gone, strict=True) if not g]
        out.append((i, len(t), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeéñ\x00", k=rng.randint(1, 6))) for _ in range(40)]
    text = lambda k: "".join(w + rng.choice([" ", " ", "\n", "\t", "\x0b", "  "])
                             for w in rng.choices(vocab, k=k))
    shared = [text(rng.randint(5, 60)) for _ in range(6)]
    rows = [(i, text(rng.randint(0, 40)) + rng.choice([*shared, ""]) + text(rng.randint(0, 40))
             + rng.choice([*shared, ""])) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(6)]                      # exact copies
    rows += [(n + 10 + i, rows[i][1][:-20] + text(3)) for i in range(6)]  # near copies
    rows += [(200, "a" * 900), (201, "a" * 350), (202, "x y " * 200), (203, None), (204, ""),
             (205, "short"), (None, rows[3][1]), (None, "z" * 150), (7, "z" * 150 + shared[0]),
             rows[5], rows[5], (206, shared[1] * 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in dedup_digest(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(bytes_truth(rows), key=key)


@pytest.mark.parametrize("seed", [3, 4])
def test_words(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in passage_digest(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(words_truth(rows), key=key)


def test_whole_table(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in passage_digest(df).collect()) == sorted(words_truth(rows))
    assert sorted(tuple(r) for r in dedup_digest(df).collect()) == sorted(bytes_truth(rows))


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, starts int")
    assert dedup_substrings(empty).count() == dedup_passages(empty).count() == 0
    df = spark.createDataFrame(
        [(1, "ab" * 80, 5, "p", "q"), (2, "ab" * 80, 6, None, "r")],
        "doc_id long, text string, starts int, shard string, doc_order string")
    kept = dedup_substrings(df, keep=("starts", "shard", "doc_order")).orderBy("doc_id").collect()
    assert [(r.starts, r.shard, r.doc_order, r.n_removed) for r in kept] == [
        (5, "p", "q", 158), (6, None, "r", 160)]


def test_suffix_array_sorts_all_suffixes():
    rng = np.random.default_rng(1)
    for turn in range(80):
        text = np.append(rng.integers(1, (3, 4, 6, 200)[turn % 4], rng.integers(1, 70)), 0)
        text = text.astype(np.int16)
        expect = sorted(range(len(text)), key=lambda i, t=text: t[i:].tolist())
        assert suffix_array.suffix_array(text, 258).tolist() == expect


@pytest.mark.parametrize("find", [
    lambda *a: suffix_array.repeated_windows(*a), lambda *a: suffix_tree.repeated_windows(*a),
    lambda *a: suffix_tree.repeated_windows(*a, budget=5)])
def test_repeated_windows(find):
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = rng.integers(4, 20, rng.integers(1, 8))
        items = rng.integers(0, 2, lengths.sum()).astype(np.uint8)
        expect, found = {}, {}
        for base, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
            for i in range(base, base + n - 3):
                expect.setdefault(items[i:i + 4].tobytes(), set()).add(int(i))
        for at, label in zip(*find(items, lengths, 4), strict=True):
            found.setdefault(int(label), set()).add(int(at))
        assert sorted(map(sorted, found.values())) == sorted(
            sorted(v) for v in expect.values() if len(v) > 1)
