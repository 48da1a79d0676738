import random
import re
import zlib

import numpy as np
import pytest

from featherloom.llm import spelling as module
from featherloom.llm.spelling import Reduced, group_variants, spelling_digest, symbols_for


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def truth(counts, ratio=5):
    forms, out = {}, []
    for w, n in counts.items():
        around = [(-m, v) for v, m in counts.items() if near(w, v)]
        best = min(around, default=None)
        form = best[1] if best and -best[0] >= ratio * n else None
        forms[w] = form
        out.append([w, form, None, n, len(around), counts[form] if form else None])
    for row in out:
        row[2] = row[0]
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(tuple, out))


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n")
                  .collect())


def words_of(text, doc_id):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        yield run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run


def test_digest_against_brute_force(spark):
    rng = random.Random(1)
    stems = ["".join(rng.choice("abéÉß") for _ in range(rng.randint(5, 8))) for _ in range(60)]
    stems += ["Wörter", "÷×÷×÷×", "x" * 3000, "x" * 2999]
    rows = [(i if i % 9 else None, " ".join(rng.choice(stems) for _ in range(60)) + "Āab1cdefgh")
            for i in range(150)]
    rows += [(7, None), (8, ""), (9, "ab cd"), (3, "x" * 3000), rows[5], rows[5]]
    counts = {}
    for i, text in rows:
        for w in words_of(text, i):
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows],
                               "doc_id long, text string, word string, n long")
    found = rows_of(spelling_digest(df))
    assert found == truth(counts) and any(r[1] for r in found)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_digest(df).count() == 0
    assert spelling_digest(spark.createDataFrame([(1, None)], df.schema)).count() == 0


@pytest.mark.parametrize("symbols", [2, 5])
def test_variants_of_short_words_chains_and_ties(spark, symbols, monkeypatch):
    monkeypatch.setattr(module, "symbols_for", lambda words: symbols)
    rng = random.Random(symbols)
    counts = {"": 2, "a": 11, "b": 11, "ab": 1, "abc": 5, "abcd": 25, "abcde": 125, "𝒳bcde": 25}
    counts |= {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))): rng.choice(
        [1, 2, 5, 10, 25, 125, 1000]) for _ in range(400)}
    rows = [(w, n, "x") for w, n in counts.items()] + [(None, 5, "x")]
    rows = [(w, n - 1, "y") for w, n, _ in rows] + [(w, 1, "z") for w, _, _ in rows]
    df = spark.createDataFrame(rows, "word string, n long, near string")
    assert rows_of(group_variants(df)) == truth(counts)
    with pytest.raises(ValueError):
        group_variants(df, ratio=1)


def test_neighbourhood_is_full_and_without_repeats():
    words, symbols = ["abcab", "aaab", "c", ""], 4
    codes = np.array([ord(c) for w in words for c in w], dtype=np.uint32)
    one = Reduced(codes, np.array([len(w) for w in words]), symbols)
    got = {i: [] for i in range(len(words))}
    for keys, owner in one.neighbourhoods():
        for k, i in zip(keys.tolist(), owner.tolist(), strict=True):
            got[i].append(k)
    alphabet = {}
    for c in map(chr, range(97, 200)):
        s = int(Reduced(np.array([ord(c)], dtype=np.uint32), np.array([1]), symbols).symbol[0])
        alphabet.setdefault(s, c)
    assert len(alphabet) == symbols
    for i, w in enumerate(words):
        w = [int(s) for s in Reduced(np.array([ord(c) for c in w], dtype=np.uint32),
                                     np.array([len(w)]), symbols).symbol]
        forms = {tuple(w)} | {tuple(w[:k] + w[k + 1:]) for k in range(len(w))}
        for c in range(symbols):
            forms |= {tuple(w[:k] + [c] + w[k + 1:]) for k in range(len(w))}
            forms |= {tuple(w[:k] + [c] + w[k:]) for k in range(len(w) + 1)}
        want = []
        for f in forms:
            f = np.array([ord(alphabet[s]) for s in f], dtype=np.uint32)
            want.append(int(Reduced(f, np.array([len(f)]), symbols).keys()[0]))
        assert sorted(got[i]) == sorted(want)


def test_symbols_grow_with_the_vocabulary():
    assert symbols_for(0) == 4 and symbols_for(10 ** 9) == 32
