"""Quality by ordinal cumulative-link regression.

Every word counts by hashed weights of its letters and of its shape, averaged over the text, beside
hashed weights of a few measures of the whole text. All grades share these weights; ordered
thresholds cut the sum into grades: P(grade > k) = logistic(sum - threshold k).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from featherloom.llm.common import fresh, held_out
from featherloom.llm.kernels import (LOWER, SPACE, Hasher, mix, owners, text_chunks,
                                     word_bounds)
from featherloom.llm.toxicity import labelled
from featherloom.naming import quoted

BUCKETS = 1 << 16
STEPS, BATCH, RATE, DECAY = 3000, 64, 0.3, 1e-5
#: Most labelled rows of each grade that the fit reads.
MOST_ROWS = 1500
#: Grade, and least probability of it or a better one, from which a text is kept.
KEEP_GRADE, KEEP_PROBABILITY = 1, 0.5
#: Weight of the measures of a whole text beside its words.
WHOLE = 0.2


def sign_classes() -> np.ndarray:
    """Small letters and bytes beyond ASCII as a, capitals as A, digits as 0, signs as they are."""
    out = np.arange(256, dtype=np.uint8)
    out[97:123] = out[128:] = 97
    out[65:91] = 65
    out[48:58] = 48
    return out


SIGN = sign_classes()


def bucketed(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind * 0x9E3779B9)) % np.uint64(BUCKETS)).astype(np.int64)


def features(hasher: Hasher, data: np.ndarray, offsets: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each text, word buckets, shape buckets, buckets of each whole text).

    A shape has one letter for a run of letters of a kind or of digits, and at most two of a run of
    one sign. Whole texts count by length and by share of different words, in coarse steps.
    """
    starts, ends, first = word_bounds(data, offsets, SPACE)
    low = hasher.prefix(hasher.codes[LOWER[data]])
    words = hasher.ranges(low, starts, ends)
    sign = SIGN[data]
    same = np.zeros(len(sign), dtype=bool)
    same[1:] = sign[1:] == sign[:-1]
    same[starts] = False
    twice = np.zeros(len(sign), dtype=bool)
    twice[1:] = same[:-1]
    kept = ~same | (~twice & ~np.isin(sign, (48, 65, 97)))
    place = np.concatenate([[0], np.cumsum(kept)])
    shapes = hasher.ranges(hasher.prefix(hasher.codes[sign[kept]]), place[starts], place[ends])
    owner = owners(first)
    _, at = np.unique(mix(words ^ mix(owner.astype(np.uint64))), return_index=True)
    count = np.diff(first)
    different = np.bincount(owner[at], minlength=len(count))
    size = np.ceil(np.log2(count + 1)).astype(np.uint64)
    whole = np.stack([bucketed(size, 3),
                      bucketed((20 * different // np.maximum(count, 1)).astype(np.uint64), 4)], 1)
    return first, bucketed(words, 1), bucketed(shapes, 2), whole


def text_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, values) of each text."""
    hasher, out = Hasher(), []
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.string())):
        first, words, shapes, whole = features(hasher, data, offsets)
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            index, inverse = np.unique(np.concatenate([words[a:b], shapes[a:b], whole[i]]),
                                       return_inverse=True)
            value = np.concatenate([np.full(2 * (b - a), 1 / max(1, b - a)), [WHOLE, WHOLE]])
            out.append((index, np.bincount(inverse, value)))
    return out


def text_totals(texts: pa.Array, weight: np.ndarray) -> np.ndarray:
    """Weighted sum of each text's features."""
    hasher, out = Hasher(), [np.zeros(0)]
    for _, _, data, offsets in text_chunks(texts):
        first, words, shapes, whole = features(hasher, data, offsets)
        sums = np.concatenate([[0.0], np.cumsum(weight[words] + weight[shapes])])
        mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)
        out.append(mean + WHOLE * weight[whole].sum(1))
    return np.concatenate(out)


def grade_probabilities(total: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for every threshold k, falling in k."""
    return 1 / (1 + np.exp(-np.clip(total[..., None] - thresholds, -40, 40)))


def ordered_thresholds(free: np.ndarray) -> np.ndarray:
    """First threshold and positive steps, so that any free numbers give ordered thresholds."""
    return np.cumsum(np.concatenate([free[:1], np.exp(np.clip(free[1:], -20, 20))]))


def train(texts: list[str], grades: list[int], weights: dict[int, float] | None = None,
          seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(weight of each bucket, ordered thresholds); grades are 0 to their maximum."""
    rng = np.random.default_rng(seed)
    y = np.array(grades, dtype=np.int64)
    steps = max(1, int(y.max(initial=0)))
    share = np.array([(weights or {}).get(int(g), 1.0) for g in y])
    share = share / share.mean() if len(y) else share
    weight, free = np.zeros(BUCKETS), np.zeros(steps)
    if not len(y) or y.min() == y.max():
        return weight, np.cumsum(np.ones(steps)) + (-50.0 if len(y) and y.max() else 0.0)
    rows = text_features(texts)
    seen_w, seen_f = np.full(BUCKETS, 1e-8), np.full(steps, 1e-8)
    above = np.arange(steps)
    order = np.zeros(0, dtype=np.int64)
    for _ in range(STEPS):
        if len(order) < BATCH:
            order = rng.permutation(len(y))
        batch, order = order[:BATCH], order[BATCH:]
        index = np.concatenate([rows[i][0] for i in batch])
        value = np.concatenate([rows[i][1] for i in batch])
        of = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
        total = np.bincount(of, value * weight[index], minlength=len(batch))
        thresholds = ordered_thresholds(free)
        tail = grade_probabilities(total, thresholds)
        g = y[batch]
        # likelihood of grade g is P(> g-1) - P(> g); slopes by its two ends
        upper = np.where(g > 0, tail[np.arange(len(g)), np.maximum(g - 1, 0)], 1.0)
        lower = np.where(g < steps, tail[np.arange(len(g)), np.minimum(g, steps - 1)], 0.0)
        chance = np.maximum(upper - lower, 1e-9)
        d_upper = upper * (1 - upper) / chance
        d_lower = lower * (1 - lower) / chance
        slope = -(d_upper - d_lower) * share[batch]
        by_threshold = np.zeros((len(g), steps))
        by_threshold[np.arange(len(g)), np.maximum(g - 1, 0)] += np.where(g > 0, d_upper, 0)
        by_threshold[np.arange(len(g)), np.minimum(g, steps - 1)] -= np.where(
            g < steps, d_lower, 0)
        pull = (by_threshold * share[batch][:, None]).sum(0) / len(g)
        step = np.diff(np.concatenate([[0.0], thresholds]))
        step[0] = 1.0
        grad_f = np.array([pull[above >= k].sum() * step[k] for k in range(steps)])
        grad = np.bincount(index, value * slope[of], minlength=BUCKETS) / len(g)
        used = np.flatnonzero(grad)
        grad[used] += DECAY * weight[used]
        seen_w[used] += grad[used] ** 2
        seen_f += grad_f ** 2
        weight[used] -= RATE * grad[used] / np.sqrt(seen_w[used])
        free -= RATE * 0.3 * grad_f / np.sqrt(seen_f)
    return weight, ordered_thresholds(free)


def _grade(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, thresholds = model.value
        for batch in batches:
            tail = grade_probabilities(text_totals(batch.column(0), weight), thresholds)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(tail.sum(1)),
                 pa.array(list(tail), pa.list_(pa.float64()))],
                names=[*batch.schema.names[1:], "expected_grade", "tail"])
    return run


def grade_quality(df: DataFrame, ratings: DataFrame, id_column: str = "doc_id",
                  text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, expected_grade, and tail: P(grade >= 1), P(grade >= 2), ...

    Fitted on ``ratings`` (id, grade 0, 1, 2, ...) of rows whose crc32(id) mod 4 is not 2, at most
    MOST_ROWS of each grade. Null and empty texts are graded by their length alone. With ratings of
    one grade only, or none, every text gets that grade or the middle. Repeated rows get equal
    grades; an empty table gives an empty table. Columns of ``keep`` named like the added ones are
    replaced.
    """
    keep = tuple(c for c in keep if c.lower() not in ("expected_grade", "tail"))
    texts = df.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    sample = labelled(texts, ratings.select(quoted(id_column).alias("doc_id"), "grade"), "doc_id",
                      F.col("grade"), MOST_ROWS)
    model = df.sparkSession.sparkContext.broadcast(train(*sample))
    types = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in keep]
                          + [T.StructField("expected_grade", T.DoubleType()),
                             T.StructField("tail", T.ArrayType(T.DoubleType()))])
    return df.select(quoted(text_column).alias(fresh(df, "graded_text")[0]), *[quoted(c) for c in keep]
                     ).mapInArrow(_grade(model), schema)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades from the table of labels: 0 bad, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(
        F.col("toxic") == 0, 2)
    return labels.select("doc_id", grade.alias("grade"))


def quality_report(df: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: held out or not, expected grade, tail probability, decision."""
    graded = grade_quality(df, ratings_of(labels))
    tail = F.get("tail", F.lit(KEEP_GRADE - 1))
    return graded.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade",
                         tail.alias("tail_probability"),
                         (tail >= KEEP_PROBABILITY).alias("selected"))
