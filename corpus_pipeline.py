"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

1. quality: documents that fail the base rules or the classifier go;
2. near_duplicates: one document of each class of near copies stays;
3. decontaminate: documents that contain a benchmark item go;
4. secrets: secrets in the texts are replaced by a mark;
5. tokens: the remaining texts are encoded; the result has their digests.

The verdicts of the first stage come from a fitted model, which SQL can't express, so ORACLE_SQL is None; the stages are
tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, near_dup, quality, secret_scan
from tidemark.llm.common import stored, table

ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_class),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
