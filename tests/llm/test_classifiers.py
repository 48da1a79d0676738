import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from featherloom.llm import quality, toxicity
from featherloom.llm.common import held_out
from featherloom.llm.quality import grade_quality, quality_report
from featherloom.llm.toxicity import score_toxicity, text_scores, toxicity_report


def sentences(rng, n, bad=()):
    out = []
    for _ in range(n):
        w = ["".join(rng.choices(["ra", "to", "mi", "ne", "su", "éa"], k=rng.randint(1, 4)))
             for _ in range(rng.randint(3, 120))]
        for b in bad:
            w.insert(rng.randrange(len(w) + 1), b())
        out.append(" ".join(w))
    return out


def test_misspelt_words_share_ngrams():
    rng = random.Random(1)
    insult = lambda: rng.choice(["blockhead", "nincompoop"]) + rng.choice(["", "s", "ish"])
    texts = sentences(rng, 200) + sentences(rng, 60, [insult])
    model = toxicity.train(texts, [0] * 200 + [1] * 60)
    clean, toxic = sentences(rng, 80), sentences(rng, 80, [lambda: "BLOCKHEADZ!!"])
    scores = text_scores(pa.array(clean + toxic), *model)
    assert np.mean(scores[80:, None] > scores[None, :80]) > 0.85
    assert np.mean(scores[:80] >= 0.3) < 0.1
    long = " ".join(sentences(rng, 200))
    alone = text_scores(pa.array([long, long + " nincompoop"]), *model)
    assert alone[1] > 0.3 and alone[1] >= alone[0] - 1e-9  # one word in thousands


def test_word_scores_are_means_over_ngrams():
    scores = np.random.default_rng(2).normal(size=toxicity.BUCKETS)
    texts = ["Two words", "", "ünï-code " * 40, "x", None]
    got = toxicity.text_scores(pa.array(texts), scores, 0.0)
    known = toxicity.Vocabulary([t or "" for t in texts])
    means = known.word_means(scores)[known.words]
    best, _ = toxicity.worst_passages(means, known.first)
    assert np.allclose(got, 1 / (1 + np.exp(-best)))


def test_edges_of_training():
    for labels in ([], [0, 0], [1, 1]):
        scores, bias = toxicity.train(["a b", "c"][:len(labels)], labels)
        out = text_scores(pa.array(["a b", "", None]), scores, bias)
        assert len(set(out.tolist())) == 1 and 0 < out[0] < 1
        weight, thresholds = quality.train(["a b", "c"][:len(labels)], labels)
        assert not weight.any() and (np.diff(thresholds) > 0).all()


def test_ordered_thresholds_separate_three_grades():
    rng = random.Random(3)
    bad = [t.replace(" ", "!! ").upper() + "***" for t in sentences(rng, 150)]
    middle = sentences(rng, 150, [lambda: "spam99"] * 3)
    good = sentences(rng, 150)
    weight, thresholds = quality.train(bad[:100] + middle[:100] + good[:100],
                                       [0] * 100 + [1] * 100 + [2] * 100)
    assert (np.diff(thresholds) > 0).all()
    total = quality.text_totals(pa.array(bad[100:] + middle[100:] + good[100:]), weight)
    grade = quality.grade_probabilities(total, thresholds).sum(1)
    parts = [grade[:50].mean(), grade[50:100].mean(), grade[100:].mean()]
    assert parts[0] < 0.4 and 0.7 < parts[1] < 1.4 and parts[2] > 1.6
    whole = [float((weight[i] * v).sum()) for i, v in quality.text_features(bad[:5])]
    assert np.allclose(whole, quality.text_totals(pa.array(bad[:5]), weight))


def test_shapes():
    hasher = quality.Hasher()
    shapes = {}
    for t in ["word", "WORD", "Word", "longerword", "a***", "b****", "c*", "12", "9"]:
        data = np.frombuffer(t.encode(), dtype=np.uint8)
        shapes[t] = int(quality.features(hasher, data, np.array([0, len(data)]))[2][0])
    assert shapes["word"] == shapes["longerword"] and shapes["a***"] == shapes["b****"]
    assert shapes["12"] == shapes["9"]
    assert len({shapes[t] for t in ("word", "WORD", "Word", "a***", "c*", "12")}) == 6


def test_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = toxicity_report(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    # labels of held-out rows change nothing
    other = labels.withColumn("toxic", (1 - labels.toxic) * held_out(labels.doc_id).cast("int")
                              + labels.toxic * (~held_out(labels.doc_id)).cast("int"))
    assert sorted(map(tuple, toxicity_report(docs, other).collect())) == sorted(map(tuple, out))
    graded = quality_report(docs, labels).collect()
    assert len(graded) == len(out) and all(0 <= r.tail_probability <= 1 for r in graded)
    assert all(0 <= r.expected_grade <= 2 for r in graded)


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "fine words", 1.0, "a"), (None, None, None, "b"), (2, "", 2.0, None),
         (1, "fine words", 1.0, "a"), (3, "x" * 50000, 3.0, "c"), (4, "y " * 30000, 3.0, "c")],
        "doc_id long, text string, score double, scored_text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1), (1, 0, 1), (9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    out = score_toxicity(docs, labels, keep=("doc_id", "scored_text")).collect()
    assert len(out) == 6 and {r.scored_text for r in out} == {"a", "b", "c", None}
    graded = grade_quality(docs, quality.ratings_of(labels), keep=("doc_id",)).collect()
    assert len(graded) == 6 and all(r.tail for r in graded)
    assert score_toxicity(docs.limit(0), labels).count() == 0
    assert score_toxicity(docs, labels.limit(0)).count() == 6
    assert grade_quality(docs.limit(0), quality.ratings_of(labels)).count() == 0


@pytest.mark.parametrize("size", ["sf0.1"])
def test_held_out_accuracy(spark, size):
    base = f"/root/testdata/{size}"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    rows = (toxicity_report(docs, labels).where("held_out").join(labels, "doc_id")
            .select("score", "toxic", "predicted").collect())
    pos, neg = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.88
    rows = (quality_report(docs, labels).where("held_out").join(labels, "doc_id")
            .select("quality", "selected").collect())
    assert np.mean([r.selected for r in rows if r.quality == 1]) > 0.97
    assert np.mean([r.selected for r in rows if r.quality == 0]) < 0.25
