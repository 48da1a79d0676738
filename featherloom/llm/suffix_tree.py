"""Substring deduplication over words with prefix-partitioned suffix trees.

Suffixes of a shard's segments split into groups by prefix: one word first, and one word more for
every group above the memory budget. Each group is built into a subtree on its own; internal nodes
at least ``width`` words deep are repeats, and the topmost of them hold the windows to compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from featherloom.llm.common import fresh
from featherloom.llm.repeats import Unit, repeated_ranges
from featherloom.naming import quoted

#: Words of a gram that anchors a window.
GRAM = 2
#: Suffixes of a group that one subtree holds at a time.
BUDGET = 1 << 16


def prefix_groups(words: np.ndarray, suffixes: np.ndarray, width: int, budget: int = BUDGET
                  ) -> Iterator[tuple[int, np.ndarray]]:
    """(prefix length, suffixes) of groups with one prefix and at most ``budget`` members.

    Suffixes that agree on ``width`` words are one repeat and stay together at any size. Small
    groups are not split further.
    """
    waiting = [(0, suffixes)]
    while waiting:
        depth, group = waiting.pop()
        if len(group) <= budget or depth >= width:
            yield depth, group
            continue
        order = np.argsort(words[group + depth], kind="stable")
        group = group[order]
        word = words[group + depth]
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        small: list[np.ndarray] = []
        held = 0
        for part in np.split(group, edges):
            if len(part) > budget:
                waiting.append((depth + 1, part))
                continue
            if len(part) > 1:  # a prefix of one suffix cannot repeat
                small.append(part)
                held += len(part)
            if held > budget // 2:
                yield depth, np.concatenate(small)
                small, held = [], 0
        if small:
            yield depth, np.concatenate(small)


def subtree(words: np.ndarray, suffixes: np.ndarray, depth: int, width: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in tree order, and the depth of the node where each meets the leaf before it.

    The order grows level by level: only leaves that still agree with a neighbour are compared on
    the next word. The suffixes agree on their first ``depth`` words; nodes below ``width`` words
    are not told apart.
    """
    n = len(suffixes)
    leaves = suffixes.copy()
    meets = np.full(n, width, dtype=np.int64)
    meets[:1] = 0
    alive = np.arange(n)
    for level in range(depth, width):
        run = np.cumsum(meets[alive] < width)
        word = words[leaves[alive] + level]
        order = np.lexsort((word, run))
        leaves[alive] = leaves[alive][order]
        word = word[order]
        splits = np.append(False, (run[1:] == run[:-1]) & (word[1:] != word[:-1]))
        meets[alive[splits]] = level
        deep = meets[alive] >= width
        alive = alive[deep | np.append(deep[1:], False)]
        if not len(alive):
            break
    return leaves, meets


def repeated_windows(items: np.ndarray, lengths: np.ndarray, width: int, budget: int = BUDGET
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``width`` words that occur more than once, with node labels."""
    _, words = np.unique(items, return_inverse=True)
    ends = np.repeat(np.cumsum(lengths), lengths)
    suffixes = np.flatnonzero(ends - np.arange(len(items)) >= width)
    starts, labels, nodes = [], [], 0
    for depth, group in prefix_groups(words, suffixes, width, budget):
        leaves, meets = subtree(words, group, depth, width)
        deep = meets >= width
        member = deep | np.append(deep[1:], False)
        label = np.cumsum(~deep)
        starts.append(leaves[member])
        labels.append(nodes + label[member])
        nodes += len(leaves) + 1
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(labels)


def _without_words(untouched: bool, names: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _kept_words(batch, untouched, names)
    return run


def _kept_words(batch: pa.RecordBatch, untouched: bool, names: tuple[str, str, str]
                ) -> pa.RecordBatch:
    texts = batch.column(0).cast(pa.large_binary()).to_pylist()
    starts, ends = batch.column(1).to_pylist(), batch.column(2).to_pylist()
    n_words, removed, kept = [], [], []
    for text, a, b in zip(texts, starts, ends, strict=True):
        words = (text or b"").split()  # at space, tab, line feeds and carriage return
        n_words.append(len(words))
        removed.append(sum(b) - sum(a) if a else 0)
        if a:
            pieces, at = [], 0
            for x, y in zip(a, b, strict=True):
                pieces += words[at:x]
                at = y
            words = pieces + words[at:]
        kept.append(text if untouched and not a else b" ".join(words))
    return pa.RecordBatch.from_arrays(
        [*batch.columns[3:], pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string())],
        names=[*batch.schema.names[3:], *names])


def dedup_passages(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   width: int = 13, keep: tuple[str, ...] = (), untouched: bool = False,
                   names: tuple[str, str, str] = ("n_words", "n_removed", "kept")) -> DataFrame:
    """Removes every word covered by ``width`` words that also start in a document of smaller id.

    Windows are judged on the input and never cross texts. Returns the id, the columns of
    ``keep``, n_words, n_removed and kept (the words left, joined by one space; with ``untouched``
    a text that loses nothing is kept as it is), the last three called ``names``.

    Null text has no words; texts shorter than ``width`` words stay whole. A null id comes after
    every other id. Rows that share an id never remove anything from each other; repeated rows get
    equal results. An empty table gives an empty table.
    """
    unit = Unit(words=True, width=width, gram=GRAM, inside=False)
    ranged = repeated_ranges(df.select(*[quoted(c) for c in (id_column, *keep, text_column)]),
                             id_column, text_column, unit, repeated_windows)
    starts, ends = ranged.columns[-2:]
    text = fresh(ranged, "whole_text")[0]
    types = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in (id_column, *keep)]
                          + [T.StructField(names[0], T.LongType()),
                             T.StructField(names[1], T.LongType()),
                             T.StructField(names[2], T.StringType())])
    return (ranged.select(quoted(text_column).alias(text), quoted(starts), quoted(ends),
                          quoted(id_column), *[quoted(c) for c in keep])
            .mapInArrow(_without_words(untouched, names), schema))


def passage_digest(df: DataFrame) -> DataFrame:
    """One row per document: number of words, of removed words, digest of what is left."""
    out = dedup_passages(df)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
