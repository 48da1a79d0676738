"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

Everything is a DataFrame expression. A rule is listed under its canonical key ``host`` + ``path``.
A URL's possible keys are its host and parent hosts, each with every prefix of its path as long as
some listed path. Only URLs with a key that the filter may hold reach the join. Rules that fit many
URLs and URLs of many rows are counted first and broadcast, fewer than a thousand of each, so no task
gets them whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from featherloom.llm.common import materialise
from featherloom.naming import quoted
from featherloom.operators.joins import lookup_join

#: Words of 64 bits in a block of the filter; a key sets one bit in each.
LANES = 8
#: Bits of the filter for each listed key.
BITS_PER_KEY = 16
#: Most blocks of a filter (64 bytes each): the broadcast filter never passes 16 MB. A longer list
#: only lets more false positives through to the join.
MAX_BLOCKS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else ''."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: Column, lane: int) -> Column:
    """The key's bit in a lane: six bits of a second hash, one in each of 8 words."""
    six = F.shiftrightunsigned(F.xxhash64(key, F.lit("lane")), 6 * lane).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), six.cast("int"))


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as one row ``words``: LANES words of each block, one block after the other.

    Bits are combined before the shuffle; the row has at most MAX_BLOCKS blocks.
    """
    lanes = [F.bit_or(_bit(quoted(key), i)).alias(f"w{i}") for i in range(LANES)]
    filled = listed.groupBy(_block(quoted(key), blocks).alias("block")).agg(*lanes)
    empty = listed.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    every = empty.join(filled, "block", "left").select(
        "block", *[F.coalesce(f"w{i}", F.lit(0).cast("long")).alias(f"w{i}")
                   for i in range(LANES)])
    ordered = F.array_sort(F.collect_list(F.struct("block", *[f"w{i}" for i in range(LANES)])))
    return every.agg(F.flatten(F.transform(
        ordered, lambda b: F.array(*[b[f"w{i}"] for i in range(LANES)]))).alias("words"))


def may_hold(words: Column, key: Column, blocks: int) -> Column:
    """Whether the filter may hold the key."""
    at = _block(key, blocks) * LANES
    hit = F.lit(True)
    for i in range(LANES):
        hit = hit & (F.get(words, at + i).bitwiseAND(_bit(key, i)) != 0)
    return hit


def candidate_keys(host: Column, path: Column, lengths: Column) -> Column:
    """Host and parent hosts, each with the path prefixes of the given lengths."""
    labels = F.split(host, r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.char_length(path)),
                           lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(
        prefixes, lambda p: F.struct(h.alias("host"), p.alias("path")))))


def filter_urls(df: DataFrame, rules: DataFrame, url_column: str = "url",
                default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to each row.

    ``rules`` has host, path and verdict ('allow' or 'block'). A rule fits its host and all
    subdomains if the URL's path starts with the rule's. The longest rule wins, then the longer
    host; of rules listed twice, 'block' wins. Without a fitting rule, ``rule`` is null and the
    verdict is ``default``: the URL is not listed.

    A null URL, or one without ``://``, has an empty host and path and fits no rule unless one
    with an empty host is listed. Repeated URLs get equal verdicts. Columns of the input that have
    one of the four names, in any case, are replaced. An empty table gives an empty table; without rules every
    URL gets the default. A rule with a null host, path or verdict is ignored.
    """
    listed = (rules.dropna(subset=["host", "path", "verdict"])
              .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
              .withColumn("key", F.concat("host", "path")))
    size = listed.agg(F.count(F.lit(1)).alias("n"),
                      F.array_sort(F.collect_set(F.char_length("path"))).alias("lengths")).first()
    added = ("host", "path", "rule", "verdict")
    names = {c: f"c{i}" for i, c in enumerate(df.columns) if c.lower() not in added}
    parts = df.select(*[quoted(c).alias(n) for c, n in names.items()],
                      host_of(quoted(url_column)).alias("h"), path_of(quoted(url_column)).alias("p"))
    if not size["n"]:
        judged = parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    else:
        blocks = min(MAX_BLOCKS, max(1, -(-size["n"] * BITS_PER_KEY // (64 * LANES))))
        words = blocked_bloom(listed, "key", blocks).scalar()
        lengths = F.array(*[F.lit(n) for n in size["lengths"]])
        possible = materialise(
            parts.groupBy("h", "p").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("key", F.explode(candidate_keys(F.col("h"), F.col("p"), lengths)))
            .select("h", "p", "rows", F.col("key.host").alias("host"),
                    F.col("key.path").alias("path"))
            .where(may_hold(words, F.concat("host", "path"), blocks)))
        # the exact join has one row per key on both sides; false positives get no rule
        keys = materialise(possible.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
                           .join(listed.hint("shuffle_hash"), ["host", "path"], "left"))
        hits = materialise(
            lookup_join(possible, keys, ["host", "path"], "n").where(F.col("key").isNotNull())
            .groupBy("h", "p").agg(F.first("rows").alias("rows"), F.max(F.struct(
                F.char_length("key"), F.char_length("host"), "key", "verdict")).alias("best"))
            .select("h", "p", "rows", F.col("best.key").alias("rule"),
                    F.col("best.verdict").alias("verdict")))
        judged = lookup_join(parts, hits, ["h", "p"], "rows").withColumn(
            "verdict", F.coalesce("verdict", F.lit(default)))
    return judged.select(*[F.col(n).alias(c) for c, n in names.items()], F.col("h").alias("host"),
                         F.col("p").alias("path"), "rule", "verdict")
