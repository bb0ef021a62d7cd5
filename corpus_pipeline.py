"""A corpus pipeline: each stage works on all documents its predecessor kept and writes its own table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.llm import decontaminate, jaccard_join, packing, pii, quality_rules
from tableflow.session import pinned


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or a fertility band go."""
    return quality_rules.good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each component of near copies stays."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: found spans and the terms that reveal them are masked in the texts; every document stays."""
    return pii.sanitised(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: one row per piece with its place in a training sequence."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("PII", sanitise),
    ("best-fit packing", pack),
]

#: Tokenisers and links between documents are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = pinned(docs, name.replace(" ", "_").replace("-", "_"))
    return docs
