"""Toxicity by subword-bag embeddings.

A word is the mean of the embeddings of its character n-grams, a passage the mean of its words, and
a linear softmax over the passage gives the probability. Embeddings and softmax are trained jointly
in numpy. Misspelt and unseen words share n-grams with known ones. A text is judged by its worst
passage, in training too, so long texts do not dilute what a few sentences say.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from featherloom.llm.common import fresh, held_out
from featherloom.llm.kernels import LOWER, NOT_WORD, Hasher, mix, text_chunks, word_bounds
from featherloom.naming import quoted

BUCKETS = 1 << 18
DIMENSIONS = 8
#: Shortest and longest n-gram, in UTF-8 bytes.
NGRAMS = (3, 6)
#: Words of a passage.
PASSAGE = 20
#: Training steps, texts of a step, steps between two choices of the worst passages.
STEPS, BATCH, REVIEW, RATE = 480, 64, 40, 0.5
#: Most labelled rows of each label that the fit reads, first in order of a hash of the id.
MOST_ROWS = 1500
#: Bytes of text that the fit takes apart at once.
FIT_CHUNK = 1 << 17
#: Score from which a text counts as toxic.
THRESHOLD = 0.3


class Chunk:
    """Words of a run of texts: lower-cased runs of letters and digits, a space on either side."""

    def __init__(self, hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> None:
        count = len(offsets) - 1
        spots = np.arange(len(data)) + np.repeat(np.arange(1, count + 1), np.diff(offsets))
        padded = np.full(len(data) + count + 1, 0x20, dtype=np.uint8)
        padded[spots] = np.where(NOT_WORD[LOWER[data]], 0x20, LOWER[data])
        starts, ends, self.first = word_bounds(padded, offsets + np.arange(count + 1), NOT_WORD)
        self.hasher, self.prefix = hasher, hasher.prefix(hasher.codes[padded])
        self.starts, self.ends = starts - 1, ends + 1   # with the spaces
        self.words = hasher.ranges(self.prefix, self.starts, self.ends)

    def whole(self) -> np.ndarray:
        return (mix(self.words) % np.uint64(BUCKETS)).astype(np.int64)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of every n-gram of the bytes, number of n-grams inside each word)."""
        hashes = self.hasher.grams(self.prefix, n) % np.uint64(BUCKETS)
        return hashes.astype(np.int64), np.maximum(self.ends - self.starts - n + 1, 0)

    def word_scores(self, scores: np.ndarray) -> np.ndarray:
        """Mean bucket score of each word's n-grams and of the word itself."""
        total, count = scores[self.whole()].astype(np.float64), np.ones(len(self.words))
        for n in range(NGRAMS[0], NGRAMS[1] + 1):
            buckets, inside = self.grams(n)
            sums = np.concatenate([[0.0], np.cumsum(scores[buckets], dtype=np.float64)])
            at = np.minimum(self.starts, len(sums) - 1)
            total += sums[np.minimum(at + inside, len(sums) - 1)] - sums[at]
            count += inside
        return total / count

    def word_buckets(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of the chosen words laid end to end, number of buckets of each word)."""
        kinds = [(self.whole()[which], np.arange(len(which)), np.ones(len(which), dtype=int))]
        for n in range(NGRAMS[0], NGRAMS[1] + 1):
            buckets, inside = self.grams(n)
            kinds.append((buckets, self.starts[which], inside[which]))
        sizes = sum(count for _, _, count in kinds)
        out, at = np.empty(sizes.sum(), dtype=np.int32), np.cumsum(sizes) - sizes
        for buckets, start, count in kinds:
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            out[np.repeat(at, count) + within] = buckets[np.repeat(start, count) + within]
            at = at + count
        return out, sizes


def worst_passages(scores: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(highest mean score of a passage of each text, its first word); 0 for texts without words."""
    count = len(first) - 1
    best, where = np.zeros(count), first[:-1].copy()
    if not len(scores):
        return best, where
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    lengths = np.diff(first)
    short = (lengths > 0) & (lengths <= PASSAGE)
    best[short] = (sums[first[1:]] - sums[first[:-1]])[short] / lengths[short]
    for i in np.flatnonzero(lengths > PASSAGE).tolist():
        part = sums[first[i]:first[i + 1] + 1]
        means = part[PASSAGE:] - part[:-PASSAGE]
        at = int(means.argmax())
        best[i], where[i] = means[at] / PASSAGE, first[i] + at
    return best, where


class Vocabulary:
    """The texts' words as indices, each with its buckets laid end to end."""

    def __init__(self, texts: list[str]) -> None:
        hasher, base, keys = Hasher(), 0, np.zeros(0, dtype=np.uint64)
        hashes, firsts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        parts, sizes = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        for _, _, data, offsets in text_chunks(pa.array(texts, pa.string()), FIT_CHUNK):
            chunk = Chunk(hasher, data, offsets)
            unique, at = np.unique(chunk.words, return_index=True)
            new = ~np.isin(unique, keys)
            buckets, counts = chunk.word_buckets(at[new])
            keys = np.concatenate([keys, unique[new]])
            parts.append(buckets)
            sizes.append(counts)
            hashes.append(chunk.words)
            firsts.append(chunk.first[:-1] + base)
            base += len(chunk.words)
        order = np.argsort(keys)
        place, ordered = order.astype(np.int32), keys[order]
        self.words = np.concatenate([place[np.searchsorted(ordered, h)] for h in hashes])
        self.first = np.append(np.concatenate(firsts), base)
        self.sizes = np.concatenate(sizes)
        self.start = np.cumsum(self.sizes) - self.sizes
        self.buckets = np.concatenate(parts)

    def word_means(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.buckets], self.start) / self.sizes if len(
            self.sizes) else np.zeros(0)


def train(texts: list[str], labels: list[int], weights: dict[int, float] | None = None,
          seed: int = 7) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias): the trained network is linear in the n-grams, so the softmax of
    averaged embeddings is the logistic function of averaged bucket scores."""
    rng = np.random.default_rng(seed)
    label = np.array(labels, dtype=np.int64)
    share = np.array([(weights or {}).get(int(y), 1.0) for y in label])
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    positive = float((share * label).sum() + 1) / float(share.sum() + 2)
    bias = np.array([0.0, np.log(positive / (1 - positive))], dtype=np.float32)
    if not len(label) or label.min() == label.max():
        return np.zeros(BUCKETS, dtype=np.float32), float(bias[1] - bias[0])
    known = Vocabulary(texts)
    seen_e = np.full((BUCKETS, 1), 1e-4, dtype=np.float32)
    seen_s = np.full_like(softmax, 1e-6)
    seen_b = np.full_like(bias, 1e-6)
    bags = [known.words[a:b] for a, b in zip(known.first[:-1], known.first[1:], strict=True)]
    order = np.zeros(0, dtype=np.int64)
    for turn in range(STEPS):
        if turn and turn % REVIEW == 0:
            word_score = known.word_means(embedding @ (softmax[:, 1] - softmax[:, 0]))
            _, where = worst_passages(word_score[known.words], known.first)
            bags = [known.words[a:min(a + PASSAGE, b)]
                    for a, b in zip(where, known.first[1:], strict=True)]
        if len(order) < BATCH:
            order = rng.permutation(len(label))
        batch, order = order[:BATCH], order[BATCH:]
        lengths = np.array([max(1, len(bags[i])) for i in batch])
        word = np.concatenate([bags[i] for i in batch])
        row = np.repeat(np.arange(len(batch)), [len(bags[i]) for i in batch])
        size = known.sizes[word]
        at = np.repeat(known.start[word] - (np.cumsum(size) - size), size) \
            + np.arange(size.sum())
        bucket = known.buckets[at]
        pull = np.repeat(1.0 / (size * lengths[row]), size).astype(np.float32)
        of = np.repeat(row, size)
        vectors = np.zeros((len(batch), DIMENSIONS), dtype=np.float32)
        edges = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
        if len(of):
            pulled = embedding[bucket]
            pulled *= pull[:, None]
            vectors[of[edges]] = np.add.reduceat(pulled, edges, 0)
            del pulled
        logits = vectors @ softmax + bias
        odds = np.exp(logits - logits.max(1, keepdims=True))
        odds /= odds.sum(1, keepdims=True)
        odds[np.arange(len(batch)), label[batch]] -= 1
        odds *= (share[batch] / share[batch].sum())[:, None].astype(np.float32) * len(batch)
        to_vectors = odds @ softmax.T
        grad_s, grad_b = vectors.T @ odds / len(batch), odds.mean(0)
        used, inverse = np.unique(bucket, return_inverse=True)
        grad = np.zeros((len(used), DIMENSIONS), dtype=np.float32)
        pushed = to_vectors[of]
        pushed *= pull[:, None]
        np.add.at(grad, inverse, pushed)
        del pushed
        seen_e[used] += (grad ** 2).mean(1, keepdims=True)
        embedding[used] -= RATE * grad / np.sqrt(seen_e[used])
        seen_s += grad_s ** 2
        seen_b += grad_b ** 2
        softmax -= RATE * 0.2 * grad_s / np.sqrt(seen_s)
        bias -= RATE * 0.2 * grad_b / np.sqrt(seen_b)
    return embedding @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0])


def text_scores(texts: pa.Array, scores: np.ndarray, bias: float) -> np.ndarray:
    """Probability of each text's worst passage."""
    hasher, out = Hasher(), [np.zeros(0)]
    for _, _, data, offsets in text_chunks(texts):
        chunk = Chunk(hasher, data, offsets)
        best, _ = worst_passages(chunk.word_scores(scores), chunk.first)
        out.append(1 / (1 + np.exp(-np.clip(best + bias, -60, 60))))
    return np.concatenate(out)


def _score(model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(text_scores(batch.column(0), *model.value))],
                names=[*batch.schema.names[1:], name])
    return run


def labelled_rows(df: DataFrame, labels: DataFrame, id_column: str, label: F.Column,
                  most: int = MOST_ROWS) -> DataFrame:
    """(label, id, text, known) of a bounded sample of the rows open to training.

    At most ``most`` rows of each label, first by a hash of the id; ``known`` counts the label's
    rows open to training. Rows with a null id, label or text are left out; an id labelled more
    than once takes its greatest label.
    """
    key = quoted(id_column)
    known = (labels.select(key.cast("long").alias("id"), label.cast("int").alias("label"))
             .dropna().where(~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("known")).collect()
    chosen = known.limit(0).withColumn("known", F.lit(0).cast("long"))
    for value, count in sorted(counts):
        chosen = chosen.unionByName(
            known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(most)
            .withColumn("known", F.lit(count).cast("long")))
    return (df.select(key.cast("long").alias("id"), quoted("text"))
            .join(F.broadcast(chosen), "id").where(F.col("text").isNotNull())
            .groupBy("label", "id").agg(F.min("text").alias("text"), F.first("known").alias("known")))


def weighted(rows: pa.Table) -> tuple[list[str], list[int], dict[int, float]]:
    """(texts, labels, weight of each label): weights restore the counts of all labelled rows."""
    rows = rows.sort_by([("label", "ascending"), ("id", "ascending")])
    found, known = rows.column("label").to_pylist(), rows.column("known").to_pylist()
    return (rows.column("text").to_pylist(), found,
            {v: n / found.count(v) for v, n in dict(zip(found, known, strict=True)).items()})


def labelled(df: DataFrame, labels: DataFrame, id_column: str, label: F.Column,
             most: int = MOST_ROWS) -> tuple[list[str], list[int], dict[int, float]]:
    """``weighted`` rows of ``labelled_rows``, on the driver."""
    return weighted(labelled_rows(df, labels, id_column, label, most).toArrow())


def _fit(rows: pa.Table) -> pa.Table:
    scores, bias = train(*weighted(rows))
    return pa.table({"scores": pa.array([scores.astype(np.float32).tobytes()], pa.binary()),
                     "bias": pa.array([bias])})


def score_toxicity(df: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                   text_column: str = "text", keep: tuple[str, ...] = ("doc_id",),
                   name: str = "score", most: int = MOST_ROWS) -> DataFrame:
    """The columns of ``keep`` and the toxicity score (0 to 1) of each whole text, as ``name``.

    The model is fitted in one task, on at most ``most`` rows of each value of ``labels``
    (id, toxic 0/1), all with crc32(id) mod 4 other than 2; only texts are inputs. Null, empty and wordless texts get the score of a passage without evidence.
    Without labels of both kinds every text gets the share of toxic labels. Repeated rows get equal
    scores; an empty table gives an empty table. A column of ``keep`` called
    ``name`` is replaced.
    """
    keep = tuple(c for c in keep if c.lower() != name.lower())
    texts = df.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    sample = labelled_rows(texts, labels.select(quoted(id_column).alias("doc_id"), "toxic"),
                           "doc_id", F.col("toxic"), most)
    fitted = (sample.groupBy(F.lit(0).alias("all"))
              .applyInArrow(_fit, "scores binary, bias double").first())
    model = df.sparkSession.sparkContext.broadcast(
        (np.frombuffer(fitted["scores"], dtype=np.float32), fitted["bias"]) if fitted
        else train([], []))
    types = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in keep]
                          + [T.StructField(name, T.DoubleType())])
    return df.select(quoted(text_column).alias(fresh(df, "scored_text")[0]), *[quoted(c) for c in keep]
                     ).mapInArrow(_score(model, name), schema)


def toxicity_report(df: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether it was held out, its score and the decision."""
    scored = score_toxicity(df, labels)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
