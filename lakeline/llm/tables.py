"""Stored intermediates and the few settings the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.operators.sinks import delete
from lakeline.session import checkpoint_root, scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and return the table read back.

    This cuts the lineage: a lost executor re-reads files instead of re-running
    what came before, and non-deterministic ids (task numbers) are fixed by the
    one committed attempt of each task.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)  # most of what is stored are texts and hashes
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path  # for discard()
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        delete(spark, t.stored_at, checkpoint_root(spark))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_for(spark: SparkSession, amount: int, per_group: int) -> int:
    """Number of groups to hash into so that each holds about ``per_group``."""
    return max(4 * shuffle_partitions(spark), -(-int(amount) // per_group))


def texts(docs: DataFrame, *more) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null as empty), whatever else ``docs`` has."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of at most ``limit`` together (one row at least)."""
    begin, held, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield begin, i
            begin, held = i, 0
        held += n
    if i >= 0:
        yield begin, i + 1
