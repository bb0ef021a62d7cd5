"""The registered queries of the operators: each over its whole table, with the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableflow.llm import (
    decontaminate,
    embedding_dedup,
    jaccard_join,
    packing,
    pii,
    quality_model,
    quality_rules,
    secret_scan,
    sharding,
    spelling,
    suffix_dedup,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_flow_resharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.digest(spark, f"{sf}/documents.parquet")


def op2_fourier_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_model.digest(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_randomness_tests(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf, "documents"))


def op4_suffix_merge_sort(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf, "documents"))


def op5_fertility_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf, "documents"))


def op6_combination_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.digest(table(spark, sf, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(table(spark, sf, "documents"))


def op8_lexicon_automata(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.digest(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_disclosure_terms(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(table(spark, sf, "documents"))


def op10_benchmark_join(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"])
    return decontaminate.digest(found)


def op11_rank_one_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.digest(table(spark, sf, "embeddings"))


def op12_collision_counting(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.digest(table(spark, sf, "embeddings"))


def op13_trie_node_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.digest(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_flow_resharding, op2_fourier_quality, op3_randomness_tests, op4_suffix_merge_sort, op5_fertility_rules,
        op6_combination_prefixes, op7_best_fit_packing, op8_lexicon_automata, op9_disclosure_terms, op10_benchmark_join,
        op11_rank_one_whitening, op12_collision_counting, op13_trie_node_pairs,
    )
}
