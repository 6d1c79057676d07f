"""Contiguous shards of nearly equal bytes from global prefix sums.

Documents are ordered once by a range shuffle of narrow rows (id, size, checksum;
no text). Every task of that order cuts its rows into blocks of ``BLOCK_ROWS``;
bytes and rows before a document are then the sum of three prefixes: of the tasks
before its own, of its task's blocks before its own, and of its block's rows before
it. No level gathers more than a block, a task's block totals, or one row per task.
The whole byte axis is cut at equal targets, and a document goes to the shard in
which its middle byte lies, so a cut is never further from its target than half a
document. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.tables import discard, shuffle_partitions, store

BLOCK_ROWS = 1 << 14
OVERHEAD = 8  # bytes that a document takes besides its text
_LOCAL_BITS = 33  # monotonically_increasing_id() counts a task's rows in its low bits


def _prefixed(rows: DataFrame, keys: list[str], order: str, sums: dict[str, str]) -> DataFrame:
    """``rows`` with, for each ``{out: column}``, the column's sum over the rows before."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(out) for out, c in sums.items()])


def assign(docs: DataFrame, count: int = 24, carry: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to count - 1) and slot (0, 1, ... in its shard).

    ``docs``: doc_id, text; other columns are not read, whatever their names. Size is
    the text's UTF-8 bytes plus ``OVERHEAD``. The order is by doc_id, then size,
    checksum and hash of the text, so shards do not depend on how the input was cut
    into files; rows equal in all of these are told apart by their place in the input,
    so a key that holds a third of all rows still spreads over many tasks and its rows
    may lie in several shards. A null doc_id comes first and stays null. A null text
    counts as empty (size ``OVERHEAD``, checksum 0). Every row gets a place, as often
    as it occurs. Fewer documents than shards, or documents larger than a shard's
    target, leave some shards empty. No rows give no rows.

    ``carry`` adds the whole input row as the struct ``row``; the rows then go through
    the range shuffle with their texts, as :func:`write_shards` needs them.
    """
    if count < 1:
        raise ValueError("count must be at least 1")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + F.lit(OVERHEAD)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("input"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    measured = rows if carry else store(rows, "shard-sizes")
    keys = ["doc_id", "size", "text_crc32", "hash", "input"]
    payload = ["doc_id", "size", "text_crc32", *(["row"] if carry else [])]
    local = F.col("at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    ordered = store(
        measured.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
        .select(*payload, F.monotonically_increasing_id().alias("at"))
        .select(*payload, "at", F.shiftright("at", _LOCAL_BITS).alias("task"),
                F.floor(local / F.lit(BLOCK_ROWS)).alias("block")), "shard-order")
    if not carry:
        discard(measured)

    blocks = ordered.groupBy("task", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    tasks = blocks.groupBy("task").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    before = {"bytes_before": "bytes", "rows_before": "rows"}
    offsets = _prefixed(blocks, ["task"], "block", before) \
        .join(_prefixed(tasks, [], "task", {"task_bytes": "bytes", "task_rows": "rows"}).drop("bytes", "rows"), "task") \
        .select("task", "block", (F.col("bytes_before") + F.col("task_bytes")).alias("block_bytes"),
                (F.col("rows_before") + F.col("task_rows")).alias("block_rows"))
    one = ordered.withColumn("one", F.lit(1))
    placed = _prefixed(one, ["task", "block"], "at", {"own_bytes": "size", "own_rows": "one"}) \
        .join(offsets, ["task", "block"]) \
        .withColumn("begin", F.col("own_bytes") + F.col("block_bytes")) \
        .withColumn("position", F.col("own_rows") + F.col("block_rows"))
    total = tasks.agg(F.sum("bytes")).first()[0] or 1  # one number
    middle = (2 * F.col("begin") + F.col("size")).cast("decimal(38,0)")  # twice its byte
    shard = F.floor(middle * F.lit(count) / F.lit(2 * total).cast("decimal(38,0)")).cast("int")
    cut = store(placed.select(*payload, shard.alias("shard"), "position"), "shard-cuts")
    first = cut.groupBy("shard").agg(F.min("position").alias("first"))  # at most ``count`` rows
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot"),
        *(["row"] if carry else []))


def write_shards(docs: DataFrame, path: str, count: int = 24) -> None:
    """The rows of ``docs`` as Parquet folders ``shard=0`` ... below ``path``.

    Each row keeps its columns in the struct ``row`` beside doc_id, size and slot. The
    tasks of the order hold contiguous rows, so each opens the files of a few shards."""
    assign(docs, count, carry=True).write.partitionBy("shard").parquet(path)
