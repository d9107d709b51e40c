"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import content_sort, decision_list, decontaminate, huffman, mixing, naive_bayes_svm, oracle, pii, recompression, shared_search, simhash, spelling, suffix_tree, token_counts, workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers.reach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("print")).alias("fingerprint"), "component_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document, written as Huffman blocks and read back."""
    return huffman.round_trip(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of each document lie in a benchmark window, and which items those come from."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document, from the labels that are not held out."""
    return naive_bayes_svm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-frequency score and suffix-tree score of each document."""
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document: by fixed patterns, and all spans."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs)).drop("redacted")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words, shared 3 : 1 : 2 among sources, takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document, from one encoding of the whole text."""
    return token_counts.count_sections(table(spark, sf_dir, "documents"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document left after repeats of 13 words from documents of smaller id are removed."""
    return recompression.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document, the fixed rule and the learned rules' verdict."""
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays of each group of equal texts."""
    return content_sort.duplicates(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return shared_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, the form each is a variant of, and where forms end."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_token_files, op3_decontamination, op4_quality_classifier, op5_suffix_tree_scores, op6_personal_data, op7_source_mix, op8_section_tokens, op9_repeated_passages, op10_quality_rules, op11_exact_duplicates, op12_ranked_search, op13_spelling_variants)
}

ORACLES: dict[str, str] = {"op3_decontamination": oracle.DECONTAMINATION, "op7_source_mix": oracle.SOURCE_MIX, "op9_repeated_passages": oracle.REPEATS, "op11_exact_duplicates": oracle.EXACT_DUPLICATES, "op12_ranked_search": oracle.RANKED_SEARCH}
