"""A training corpus from raw documents: rejected, near and later copies out, packed.

Each stage takes all that its predecessor kept; stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.importance import keep_target_like
from lakeline.llm.order_minhash import keep_one
from lakeline.llm.packing import pack
from lakeline.llm.queries import vocabulary
from lakeline.llm.suffix_dedup import remove_later_copies
from lakeline.llm.tables import store

WINDOW = 2048
COPY_BYTES = 50
SIMILARITY = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled ones keeps.

    Null and empty texts weigh 0 and are judged like any other."""
    return keep_target_like(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest doc_id."""
    return keep_one(docs, SIMILARITY)


def copied_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that an earlier document holds; n_chars is counted
    anew. A document that loses everything stays as an empty one; a null text
    becomes an empty one."""
    cleaned = remove_later_copies(docs, COPY_BYTES, carry=True)
    fresh = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.char_length("kept_text")}
    return cleaned.select(*[
        fresh.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 ids; see :func:`pack`."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), WINDOW)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", copied_passages),
    ("packing", packing),
]

# Byte-pair encoding has no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written and read again, on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
