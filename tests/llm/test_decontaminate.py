import hashlib
import random
import re

import pytest

from featherloom.llm import decontaminate as module
from featherloom.llm.decontaminate import contamination_digest, decontaminate, mark


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def truth(docs, bench):
    grams = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            grams.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for g, of in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    items |= {str(x) for x in of if x is not None}
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), digest, bool(hit)))
    return out


def tables(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("aBcé9", k=rng.randint(1, 3)))
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "_", "-"])
                             for _ in range(n))
    bench = [(i, text(rng.choice([2, 3, 9, 10, 11, 25]))) for i in range(14)]
    bench += [(2, bench[5][1]), bench[3], (None, "only null id here"), (90, None), (91, " -- ")]
    docs = [(i, text(rng.randint(0, 30)) + rng.choice(bench[:14])[1].swapcase().replace("É", "é")
             + text(rng.randint(0, 9))) for i in range(40)]
    docs += [(50, None), (51, ""), (None, bench[1][1]), (52, "so ONLY null-id here it is"),
             (53, "x " * 3000 + bench[4][1]), docs[0], docs[0]]
    return docs, bench


@pytest.mark.parametrize(("part_bytes", "broadcast"), [(1 << 22, 1 << 26), (60, 1 << 26), (60, 10)])
def test_against_brute_force(spark, monkeypatch, part_bytes, broadcast):
    monkeypatch.setattr(module, "PART_BYTES", part_bytes)
    monkeypatch.setattr(module, "BROADCAST_BYTES", broadcast)   # beyond it, the items are joined
    docs, bench = tables(4)
    d = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, hits int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r)
    got = sorted((tuple(r) for r in contamination_digest(d, b).collect()), key=key)
    want = truth(docs, bench)
    assert got == sorted(want, key=key)
    assert mark(d, b).columns == ["doc_id", "text", "n_words", "hits", "items", "n_hit",
                                  "contaminated"]
    assert decontaminate(d, b).columns == d.columns
    assert decontaminate(d, b).count() == sum(not w[-1] for w in want)


def test_joined_benchmark_gives_the_same_rows(spark, monkeypatch, folder):
    d, b = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    found = sorted(contamination_digest(d, b).collect())
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    assert sorted(contamination_digest(d, b).collect()) == found
    assert any(r.contaminated for r in found)
    assert contamination_digest(d.limit(0), b).count() == 0
    no_words = spark.createDataFrame([(1, " -- ")], "item_id long, text string")
    assert not any(r.contaminated for r in contamination_digest(d, no_words).collect())


def test_empty_tables(spark):
    docs, bench = tables(5)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert contamination_digest(d.limit(0), b).count() == 0
    out = contamination_digest(d, b.limit(0)).collect()
    assert len(out) == len(docs) and not any(r.contaminated for r in out)
    assert sorted(r.n_words for r in out) == sorted(len(words(t)) for _, t in docs)
