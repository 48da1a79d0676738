"""Groups the spelling variants of a corpus: words one edit apart, rare ones under frequent ones.

Letters are hashed to a few symbols. Each word generates the full one-edit neighbourhood (equal,
deleted, replaced, inserted symbols) of its reduced form, as 64-bit keys; the keys join the reduced
vocabulary, and the pairs that meet are verified on the words themselves. One edit of a word is at
most one edit of its reduced form, so no pair is lost; equal keys of different forms only add
candidates. Neighbourhoods are mutual, so only keys from a form's own key upwards are sent. There are so many symbols that reduced words of six letters are about as many as words:
a neighbourhood grows with the sixth root of the vocabulary, the candidates of a word with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from featherloom.llm.common import materialise
from featherloom.llm.kernels import BASE, mix
from featherloom.naming import quoted

#: Letters of a word: ASCII letters and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Length for which there are about as many reduced words as words.
TYPICAL = 6
#: Letters that a task takes apart at once; a longer word is taken alone.
LETTERS_AT_ONCE = 1 << 17
_INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def symbols_for(words: int) -> int:
    """Number of symbols for a vocabulary of so many words."""
    return max(4, ceil(words ** (1 / TYPICAL)))


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points laid end to end, length of each word)."""
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    return codes, pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)


def _slices(words: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(words):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + LETTERS_AT_ONCE, side="right")))
        yield first, last
        first = last


class Reduced:
    """Hashes of the reduced forms of words, and of what one edit makes of them."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, symbols: int) -> None:
        self.symbols = symbols
        self.values = mix(np.arange(1, symbols + 1, dtype=np.uint64) * np.uint64(BASE))
        self.symbol = (mix(codes.astype(np.uint64) + np.uint64(1)) % np.uint64(symbols)
                       ).astype(np.int64)
        self.lengths, first = lengths, np.cumsum(lengths) - lengths
        self.owner = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(codes)) - first[self.owner]
        power = np.full(int(lengths.max(initial=0)) + 2, BASE, dtype=np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        self.at, self.end = power[place], power[lengths]
        self.own = self.values[self.symbol] * self.at
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.own, dtype=np.uint64)])
        self.whole = sums[first + lengths] - sums[first]
        self.before = sums[:-1] - sums[first[self.owner]]
        self.from_here = self.whole[self.owner] - self.before
        # of a run of equal symbols only the first is deleted
        self.opens = place == 0
        self.opens[1:] |= self.symbol[1:] != self.symbol[:-1]

    def keys(self) -> np.ndarray:
        return mix(self.whole)

    def neighbourhoods(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(keys, word of each key): every form at most one edit away, each once for its word."""
        words = np.arange(len(self.lengths))
        rest = self.from_here - self.own
        yield mix(np.concatenate([self.whole, (self.before + rest * _INVERSE)[self.opens]])), \
            np.concatenate([words, self.owner[self.opens]])
        moved = self.from_here * np.uint64(BASE)
        for c in range(self.symbols):
            value, other = self.values[c], self.symbol != c
            here = value * self.at
            replaced = self.whole[self.owner] + here - self.own
            inserted = self.before + here + moved
            appended = self.whole + value * self.end
            yield mix(np.concatenate([replaced[other], inserted[other], appended])), \
                np.concatenate([self.owner[other], self.owner[other], words])


def _reduce(symbols: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(batch.column(0)):
                part = batch.slice(a, b - a)
                keys = Reduced(*_letters(part.column(0)), symbols).keys().view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys)],
                                                 names=["near", "near_n", "key"])
    return run


def _generate(symbols: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(batch.column(0)):
                source = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False)
                forms = Reduced(*_letters(batch.column(0).slice(a, b - a)), symbols)
                own = forms.keys()
                for keys, word in forms.neighbourhoods():
                    # of two forms one edit apart, the one with the smaller key finds the other
                    first = keys >= own[word]
                    keys, word = keys[first], word[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(source[word])],
                        names=["key", "source"])
    return run


def word_counts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                shortest: int = 1, least: int = 1, slip: int = 0) -> DataFrame:
    """(word, n) of the maximal runs of letters of whole texts, A-Z lower-cased.

    Words of fewer than ``shortest`` code points, or with fewer than ``least`` occurrences, are left
    out. ``slip`` > 0 misspells runs on purpose: where it divides h, the unsigned crc32 of
    ``<id>:<run>``, the run loses its code point h % length. Null and empty texts have no words; a
    null id counts as empty there. Repeated rows count each time.
    """
    run = F.explode(F.regexp_extract_all(
        quoted(text_column), F.lit(f"[{LETTERS}]{{{max(1, shortest)},}}"), F.lit(0)))
    runs = df.select(quoted(id_column).cast("string").alias("id"), run.alias("run"))
    word = F.translate("run", UPPER, LOWER)
    if slip:
        digest = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), word).cast("binary"))
        runs = runs.select(word.alias("run"), digest.alias("h"))
        at = (F.col("h") % F.char_length("run")).cast("int")
        word = F.when(F.col("h") % slip != 0, F.col("run")).otherwise(
            F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2)))
    return (runs.select(word.alias("word")).where(F.char_length("word") >= shortest)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs that differ by exactly one edit.

    An edit inserts, deletes or replaces one code point. ``words`` holds one row (word, n) a word.
    """
    keyed = words.select("word", "n").mapInArrow(_reduce(symbols),
                                                 "near string, near_n long, key long")
    source = F.xxhash64("word")
    asked = words.select("word", source.alias("source")).mapInArrow(_generate(symbols),
                                                                    "key long, source long")
    met = asked.join(keyed.hint("shuffle_hash"), "key").select("source", "near", "near_n")
    # sources only narrow the pairs down: words that share one are all compared
    found = (met.join(words.select(source.alias("source"), "word", "n"), "source")
             .where(F.levenshtein("word", "near", 1) == 1))
    both = F.array(F.struct("word", "n", "near", "near_n"),
                   F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"),
                            F.col("word").alias("near"), F.col("n").alias("near_n")))
    return found.select(F.explode(both).alias("pair")).select("pair.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): pointers of (word, form) followed to the end, doubling their reach."""
    links = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("on")))
    while not links.where("on").isEmpty():
        step = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialise(links.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("on")))
    return links.select("word", "root")


def group_variants(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """Each word with its form and root.

    ``counts`` holds ``word`` and ``n``; null words are left out, the counts of repeated words add
    up. Words are near if they differ by one edit. The form of a word is its near word of largest n
    (ties: smallest in code-point order) if that n is at least ``ratio`` (2 or more) times its own;
    else null. The root is the end of the chain of forms, or the word itself. Returns word, form,
    root, n, n_near, form_n. An empty table gives an empty table.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = materialise(counts.where(F.col("word").isNotNull()).groupBy("word")
                        .agg(F.sum("n").cast("long").alias("n")))
    near = near_words(words, symbols_for(words.count()))
    best = near.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("top"))
    taken = -F.col("top.order") >= ratio * F.col("n")
    found = materialise(best.select("word", "n_near", F.when(taken, F.col("top.near"))
                                    .alias("form"), F.when(taken, -F.col("top.order"))
                                    .alias("form_n")))
    roots = _roots(found.where(F.col("form").isNotNull()))
    return (words.join(found, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def spelling_digest(df: DataFrame) -> DataFrame:
    """Variants among the words of six letters and more that occur five times and more."""
    return group_variants(word_counts(df, shortest=6, least=5, slip=199))
