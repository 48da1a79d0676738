"""Five stages that turn the table of documents into a training mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.llm.common import fresh, materialise, table
from featherloom.llm.decontaminate import decontaminate
from featherloom.llm.jaccard_join import near_duplicates
from featherloom.llm.mixing import ADDED, mix, word_count
from featherloom.llm.repeats import LAST_ID
from featherloom.llm.suffix_tree import dedup_passages
from featherloom.llm.toxicity import THRESHOLD, score_toxicity
from featherloom.naming import quoted

#: Words of a shingle and least similarity, in percent, of near duplicates.
SHINGLE, SIMILARITY = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold.

    Null and empty texts get the score of no evidence, and repeated rows equal scores. Columns of
    any name stay as they are; an empty table gives an empty table.
    """
    score, = fresh(docs, "score")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns),
                            name=score)
    return scored.where(F.col(score) < THRESHOLD).select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id.

    Documents without words stay, as they resemble nothing. Of repeated rows one stays. Rows with a
    null id, or with one id and unlike texts, are documents of their own; of a class with equal
    least ids the text with the least hash stays.
    """
    doc, tag = fresh(docs, "doc_order", "text_tag")
    classes = materialise(near_duplicates(docs, percent=SIMILARITY, shingle=SHINGLE)
                          .where("n_shingles > 0"))
    first = (classes.groupBy("class_root")
             .agg(F.min(F.struct("doc_order", "text_tag")).alias("one"))
             .select(F.col("one.doc_order").alias(doc), F.col("one.text_tag").alias(tag)))
    keyed = docs.withColumns({
        doc: F.coalesce(quoted("doc_id"), F.lit(LAST_ID)),
        tag: F.xxhash64("text")})
    empty = word_count(F.col("text")) == 0
    kept = keyed.where(~empty).join(first.hint("shuffle_hash"), [doc, tag])
    repeated = classes.groupBy("doc_order", "text_tag").count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([doc, tag])
    return kept.unionByName(keyed.where(empty)).select(*map(quoted, docs.columns))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of earlier documents; documents that lose all words go.

    A null text becomes empty; a null id comes after all others, and rows of one id take nothing
    from each other. Columns of any name stay; an empty table gives an empty table.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    words, gone, kept = names = tuple(fresh(docs, "n_words", "n_removed", "kept"))
    cut = dedup_passages(docs, keep=others, untouched=True, names=names)
    new = {"text": F.col(kept), "n_chars": F.char_length(kept).cast("long")}
    return (cut.where((F.col(gone) == 0) | (F.col(gone) < F.col(words)))
            .select(*[new[c].alias(c) if c in new else quoted(c) for c in docs.columns]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none. Columns of any name stay; an empty table, or an empty
    benchmark, removes nothing.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often (copies) and which ranges once more (spans).

    Empty texts are never taken; a null source is a source of its own. Columns of any name stay, an
    added one of equal name gets an underscore; an empty table gives an empty table.
    """
    names = fresh(docs, *ADDED)
    return mix(docs, names=names).where(F.col(names[ADDED.index("taken")]) > 0)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("substring_dedup", cut_passages), ("decontamination", drop_contaminated),
          ("mixing", mix_sources)]

#: SQL cannot express the trained stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages; each stage's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
