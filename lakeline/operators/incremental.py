"""File-level change detection: which landing / upstream files to (re)load.

A file is identified by its path and versioned by its modification time
(landing) or by the batch that loaded it (every later layer), so a
re-delivered file is picked up again by bronze and then by each layer below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.sources.landing import source_period

FILE = "_source_file"


def pending_landing_files(listing: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Listed files that are new or whose mtime differs from the loaded one.

    ``listing``: ``(_source_file, _source_modified_at)``; ``loaded``: any table
    with those columns (the bronze rows or a per-file load log), or ``None``
    on a first load. A changed mtime in either direction counts.
    """
    files = listing.select(FILE, "_source_modified_at")
    if loaded is None:
        return files.select(FILE).distinct()
    seen = loaded.select(FILE, "_source_modified_at").distinct()
    return files.join(seen, [FILE, "_source_modified_at"], "left_anti").select(FILE).distinct()


def pending_source_files(upstream: DataFrame, own: DataFrame | None) -> DataFrame | None:
    """Upstream files whose latest batch has not reached this model yet.

    ``None`` means "all files" (first load or full refresh), which is not the
    same as an empty result ("nothing to do").
    """
    if own is None:
        return None
    up = upstream.select(FILE, "_batch_id").distinct()
    mine = own.select(FILE, "_batch_id").distinct()
    return up.join(mine, [FILE, "_batch_id"], "left_anti").select(FILE).distinct()


def source_file_filter(df: DataFrame, pending: DataFrame | list[str] | None) -> DataFrame:
    """Rows of pending files: ``None`` = all, an empty set = none, else the named ones.

    A ``left_semi`` join on the file name, for a list of names as for a table of
    them. The months that the names span (a bounded set, however many files) prune
    a table partitioned by ``_source_period``.
    """
    if pending is None:
        return df
    if isinstance(pending, list):
        if not pending:
            return df.where(F.lit(False))
        pending = df.sparkSession.createDataFrame([(f,) for f in pending], f"{FILE} string")
    pending = pending.select(FILE).distinct()
    if "_source_period" in df.columns:
        months = [r[0] for r in pending.select(source_period(FILE)).distinct().collect()]
        known = F.col("_source_period").isin([m for m in months if m is not None])
        df = df.where(known | F.col("_source_period").isNull() if None in months else known)
    return df.join(pending, FILE, "left_semi")


def file_names(pending: DataFrame) -> list[str]:
    """A pending-file set (one row per file) as a sorted list, for a reader that takes paths."""
    return sorted(r[0] for r in pending.select(FILE).distinct().collect())
