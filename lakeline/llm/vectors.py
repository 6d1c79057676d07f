"""Embedding columns as checked double arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, vec (little-endian doubles) of the vectors that can take part.

    Null vectors, those with a null or non-finite component, zero ones, empty ones
    and rows without a vec_id do not. Nor do vectors whose length differs from the
    one most vectors have (the larger one on a tie): there is no product with them.
    """
    vec = F.col("embedding").cast("array<double>")
    sound = F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")) \
        .filter("vec_id IS NOT NULL").filter(sound).filter(F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    n = sizes["n"] if sizes else 0

    def packed(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8")
            raw = flat.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([raw[i * 8 * n:(i + 1) * 8 * n] for i in range(batch.num_rows)], pa.binary())],
                names=["vec_id", "vec"])

    return rows.filter(F.size("vec") == n).mapInArrow(packed, "vec_id long, vec binary")


def matrix(column) -> np.ndarray:
    """Rows of a binary column of doubles."""
    values = column.to_pylist()
    if not values:
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)
