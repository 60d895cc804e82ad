"""Queries over whole texts and vectors: nearest neighbours, quality, repeats, near copies, pseudonyms, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, dedup, neighbours, packing, periodic, private, quality, substrings


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


#: The key of the test data; a real one comes from a secret store.
KEY = b"training-data-pseudonyms"


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(documents(spark, folder))


def op5_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return private.pseudonyms(documents(spark, folder), KEY, keep=("doc_id", "text"), counts=True)


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.without_repeats(documents(spark, folder), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_copies(documents(spark, folder), k=3, percent=85)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def repeating(docs: DataFrame) -> DataFrame:
    """doc_id, text: every tenth document, by its id's checksum, repeats from some word on with some period."""
    split = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = F.col("h") % 10 == 0
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(chosen, split)).withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    told = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p AS int)])), ' ')")
    return rows.select("doc_id", F.when(chosen & (F.col("n") > 0), told).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.collapse_runs(repeating(documents(spark, folder)), least=6, exponent=4)
    # The first of the runs of greatest exponent; they are in order of start and period.
    best = F.expr("""aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),
                     (b, r) -> if(b IS NULL OR r.length * b.period > b.length * r.period, r, b))""")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "n_words", best.alias("best"), lines.alias("lines"), "collapsed")
    return told.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    byte_level, pieces = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(documents(spark, folder), byte_level, pieces)


QUERIES = {"op1_quality": op1_quality, "op2_neighbours": op2_neighbours, "op3_substrings": op3_substrings, "op4_near_copies": op4_near_copies, "op5_pseudonyms": op5_pseudonyms, "op6_packing": op6_packing, "op12_runs": op12_runs, "op13_alignment": op13_alignment}
ORACLES: dict[str, str] = {}
