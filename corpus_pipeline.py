"""Documents to training sequences: quality, near copies, private data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crawlsight.llm import dedup, mixing, packing, private, quality
from crawlsight.llm import queries as _registered  # noqa: F401 - makes task code travel with the plan
from crawlsight.session import fresh_dir

#: The key of the test data; a real one comes from a secret store.
KEY = b"training-data-pseudonyms"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies: five words, similarity 0.8 or more."""
    return dedup.drop_near_copies(docs, k=5, percent=80)


def unnamed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values become pseudonyms of the same format and length."""
    return private.pseudonyms(docs, KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture, within files and from file to file."""
    return mixing.mixed_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences, by the targets of the mixture."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), weights=mixing.targets(docs))


STAGES = [("quality", good), ("near_copies", distinct), ("private", unnamed), ("mixture", mixed), ("packing", packed)]

# SQL has no tokenizer, Feistel network or trained scorer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what lies between stages is in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
