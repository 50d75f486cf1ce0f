"""The corpus pipeline: documents through five stages, each written and reread."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirebind.llm import decontaminate, near, packing, pii, quality
from quirebind.session import shared_folder

#: Percent of shingles from which documents of the corpus are near-duplicates.
SIMILAR = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least id."""
    return near.one_of_each(docs, percent=SIMILAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    return packing.pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("packing", pack),
]

#: Expectation-maximisation and tokenisation are not SQL; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: the pieces of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
