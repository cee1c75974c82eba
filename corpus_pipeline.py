"""The corpus pipeline: stages over documents, each written and read again before the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import byte_bpe, language_id
from barflow.llm.common import BLOCK_BYTES
from barflow.llm.decontaminate import drop_contaminated
from barflow.llm.exact_dedup import drop_copies
from barflow.llm.jaccard_join import drop_near_copies
from barflow.llm.queries import RANKS
from barflow.session import BATCH_SETTING, byte_size, work_dir


#: Bytes of a batch that goes to Python at once, there and back: a block's text. Spark's own bound is 64 MB.
BATCH_BYTES = BLOCK_BYTES


def in_small_batches(spark: SparkSession) -> None:
    """Let the session send Python no batch far beyond BATCH_BYTES; no row is cut or left out.

    Executors hold a batch and its answer outside the heap, a worker several copies of it, and neither gives
    the memory back between stages. A smaller bound of the session is kept.
    """
    if byte_size(spark, BATCH_SETTING) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with no n-gram in common with any language, go. All documents teach."""
    in_small_batches(spark)
    return language_id.keep_identified(docs, language_id.learn_profiles(docs))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles, the one with the least id stays."""
    in_small_batches(spark)
    return drop_near_copies(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that holds a test item's question and answer go."""
    in_small_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) and ``text`` as decoded from them."""
    in_small_batches(spark)
    decoded = byte_bpe.encode_and_decode(docs, public_tokenizers.path(RANKS))
    return decoded.select("doc_id", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("decontaminate", remove_benchmark),
    ("encode", encode),
]

#: Rank-order profiles, retrieval and byte pairs have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
