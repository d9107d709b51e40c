"""A training-data pipeline over ``documents``: filter, deduplicate, decontaminate, mix, write tokens.

Every stage takes rows as they are: ids may be null or repeat, a text may be null (it counts as empty), empty or very long and is used
whole, and columns of any name come through unchanged.  All but the last return the columns they were given, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import decontaminate, huffman, mixing, naive_bayes_svm, scratch, simhash
from tillwise.llm.queries import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Each row is judged by its own text, so rows of one text stay or go together whatever their ids; null and empty texts have no
    features and get the score of the bias.
    """
    return naive_bayes_svm.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component.

    The row of the smallest id stays, null ids come last, and among rows of one id one stays.  Null, empty and blank texts have
    fingerprint zero and are near each other: one of them stays.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark.

    Rows are judged one by one: a hit takes its own row, and rows of the same text, but no other row of its id.  Texts without a
    word stay; benchmark items without a word, null ones included, match nothing.
    """
    return decontaminate.drop_rows(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mix of 150 % of all words, shared 3 : 1 : 2 among sources; a document may come twice.

    A null source is a source of its own, the last in order.  A text without a word has size 0 and may be taken like any other; rows
    that repeat an id are drawn each for itself.  Reruns draw the same copies, among rows equal in id and size any may be the one.
    """
    return mixing.take(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as Huffman blocks; what reading them back gives, one row per document.

    A null or empty text is its end id alone.  Rows follow each other by id, null ids first, and rows of one id in any order.
    """
    return huffman.round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: The classifier and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.materialize(stage(spark, docs, sf_dir), name)
        scratch.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
