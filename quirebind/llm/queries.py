"""Registered queries of the subpackage: each runs one operator over whole tables."""

import os
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quirebind.llm import (
    chat, decontaminate, language, licenses, lm, near, ngram_join, packing, pii, prefix_trie,
    quality, token_files, whiten,
)
from quirebind.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_ROOT = str(Path(__file__).resolve().parents[2])


def query(f: Query) -> Query:
    """Register; tasks of a session that was started elsewhere find the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        known = os.environ.get("PYTHONPATH", "")
        if _ROOT not in known.split(os.pathsep):
            paths = os.pathsep.join(x for x in (_ROOT, known) if x)
            spark.sparkContext.environment["PYTHONPATH"] = paths
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    return quality.quality_report(documents(spark, sf_dir))


@query
def op2_packing(spark, sf_dir):
    return packing.pieces(documents(spark, sf_dir))


@query
def op3_token_files(spark, sf_dir):
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4()}"
    token_files.write_token_files(documents(spark, sf_dir), path)
    return token_files.read_token_files(spark, path)


@query
def op4_pii(spark, sf_dir):
    return pii.pii_report(documents(spark, sf_dir))


@query
def op5_chat(spark, sf_dir):
    return chat.rotated(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE["op5_chat"] = chat.ORACLE


@query
def op6_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.leak_report(documents(spark, sf_dir), benchmark)


@query
def op7_licenses(spark, sf_dir):
    return licenses.license_report(documents(spark, sf_dir))


@query
def op8_language(spark, sf_dir):
    return language.identified(documents(spark, sf_dir))


@query
def op10_near_duplicates(spark, sf_dir):
    return near.near_report(documents(spark, sf_dir))


@query
def op9_language_model(spark, sf_dir):
    return lm.scored(documents(spark, sf_dir))


@query
def op11_whitening(spark, sf_dir):
    return whiten.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_ngram_join(spark, sf_dir):
    return ngram_join.joined(documents(spark, sf_dir))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE["op13_prefix_trie"] = prefix_trie.ORACLE
