"""Exact row positions inside a group, without one task per group.

``row_number() over (partition by g order by k)`` sends every row of a group
to one task, so a group that holds a third of the data is processed by one
core. Here rows are range-partitioned on ``(g, k...)`` instead: a hot group is
cut into many ranges, each task numbers its sorted rows, and per-(task, group)
counts turn the local numbers into exact positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.session import scratch_path

_LOCAL_BITS = 33  # low bits of monotonically_increasing_id() = row index in its task
_FEW = 1 << 18  # (task, group) pairs that are broadcast


@dataclass(frozen=True)
class Ranged:
    """Rows stored in range order and where each (task, group) begins, as two folders."""

    rows: str
    offsets: str
    group: str
    few: bool  # the offsets are small, whatever the number of rows

    def numbered(self, spark: SparkSession, out: str, group_columns: dict[str, Column] | None = None) -> DataFrame:
        """The rows with ``out`` = 0-based position inside their group.

        ``group_columns`` are computed from the group's column, once for each (task, group)
        and not for each row. The offsets are joined to the rows where they are read, so
        the rows are not shuffled again.
        """
        offsets = spark.read.parquet(self.offsets).withColumns(group_columns or {})
        ranged = spark.read.parquet(self.rows)
        return (
            ranged.join(F.broadcast(offsets) if self.few else offsets, ["_pos_task", self.group])
            .withColumn(out, (F.col("_pos_local") + F.col("_pos_shift")).cast("long"))
            .select(*[c for c in ranged.columns if not c.startswith("_pos_")], *(group_columns or {}), out)
        )


def store_ranged(
    df: DataFrame,
    group: str,
    order: list[str | Column],
    num_partitions: int | None = None,
    columns: list[str | Column] | None = None,
    name: str = "positions",
) -> Ranged:
    """Write ``df`` in ranges of ``(group, *order)`` below the checkpoint folder.

    ``columns`` (default: all) are what is stored of a row, ``group`` among them; they are
    computed after the rows were shuffled and sorted. The ranged rows are written once
    and read for both the counts and the result: range bounds come from a sample, so two
    evaluations of the range exchange need not agree.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *[F.col(c) if isinstance(c, str) else c for c in order]]

    path = scratch_path(spark, name)
    (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        # Evaluated after the sort, so it counts rows in sorted order per task.
        .withColumn("_pos_id", F.monotonically_increasing_id())
        .select(*(columns or df.columns), F.shiftright("_pos_id", _LOCAL_BITS).alias("_pos_task"),
                F.col("_pos_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_pos_local"))
        .write.option("compression", "zstd").parquet(path)
    )
    ranged = spark.read.parquet(path)

    # One row per (task, group): at most n rows per group, so the window
    # below never holds more than n rows, whatever the group's size.
    before = Window.partitionBy(group).orderBy("_pos_task").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_pos_task", group)
        .agg(F.count(F.lit(1)).alias("_pos_n"), F.min("_pos_local").alias("_pos_first"))
        .withColumn("_pos_base", F.coalesce(F.sum("_pos_n").over(before), F.lit(0)))
        .select("_pos_task", group, (F.col("_pos_base") - F.col("_pos_first")).alias("_pos_shift"))
    )
    begins, told = scratch_path(spark, "range-offsets"), Observation()
    offsets.observe(told, F.count(F.lit(1)).alias("n")).write.parquet(begins)
    return Ranged(path, begins, group, told.get["n"] <= _FEW)


def position_within(
    df: DataFrame,
    group: str,
    order: list[str | Column],
    out: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside ``group`` by ``order``.

    ``(group, *order)`` should be unique per row (add a tie-breaker such as the
    input file and row index); equal keys still get distinct positions, in
    an arbitrary order among themselves. The rows are written once below the
    checkpoint folder (see :func:`store_ranged`).
    """
    return store_ranged(df, group, order, num_partitions).numbered(df.sparkSession, out)
