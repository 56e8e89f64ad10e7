"""The training-corpus pipeline: quality filter, exact and near duplicates, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir); it judges all of docs and its decisions take effect. All but the last return the
columns of documents; the last returns doc_id, n_tokens, ids_sha256, decoded_sha256 and ids. Null and empty texts, null ids,
repeated rows and empty tables are defined by the operators' own texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factweave.llm import bpe, decontam, exact, quality, simhash
from factweave.llm.common import materialise, table
from factweave.llm.queries import quality_labels


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality_labels(spark, sf_dir))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_one(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more."""
    return simhash.keep_one(docs, shingle=5)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", good_quality), ("exact copies", no_copies), ("near copies", no_near_copies), ("decontamination", no_benchmark), ("tokens", tokens)]

#: The classifier, the components and the merges are beyond SQL; tests/llm/test_pipeline.py has a plainer version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
