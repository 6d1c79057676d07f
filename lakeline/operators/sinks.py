"""Table writes: full overwrite, append, replace-by-key; schema-change guard.

A table is a folder of versions, each a Parquet folder partitioned with
Spark's writer. An overwrite writes a new version; it becomes the table the
moment Spark's own ``_SUCCESS`` marker is in it, so a write killed at any point
leaves a readable table. Older versions stay as long as a :class:`Retention`
says, so a query that was opened on one, and a catalog entry that still points
to it, go on answering while the table is replaced. A table has one writer at
a time.
``replace_by_key`` works inside the current version: it keeps one partition
folder per ``(partition..., key)`` so that re-loading a key rewrites only that
key's folders (dynamic partition overwrite), and it also removes folders of
keys that were re-loaded but produced no rows. Which folders a key has is known
from an inventory kept as a small table in the version (``_partitions``), so
nothing lists the whole table.

File-system work (exists / delete / rename / list) goes through Hadoop's
``FileSystem`` API of the session, so it works on any storage Spark can
write to. Nothing is ever deleted outside the table root given to a sink.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaChanged(RuntimeError):
    pass


@dataclass(frozen=True)
class Retention:
    """Which replaced versions of a table stay.

    The newest ``versions`` complete ones before the current, and every one that
    was written less than ``seconds`` ago."""

    versions: int = 3
    seconds: float = 0.0


DEFAULT_RETENTION = Retention()


# --- file system helpers (Hadoop FileSystem through the session) ------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


VERSION = "version-"


def versions(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """(number, folder, complete) of a table's versions, oldest first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION) and name[len(VERSION):].isdigit():
            folder = f"{path.rstrip('/')}/{name}"
            out.append((int(name[len(VERSION):]), folder, bool(fs.exists(marker(f"{folder}/_SUCCESS")))))
    return sorted(out)


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the table's latest complete version (``None``: no table)."""
    complete = [folder for _, folder, done in versions(spark, path) if done]
    return complete[-1] if complete else None


def _next_version(spark: SparkSession, path: str) -> str:
    last = max((n for n, _, _ in versions(spark, path)), default=0)
    return f"{path.rstrip('/')}/{VERSION}{last + 1:09d}"


def table_exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def _qualify(path: str) -> str:
    """Scheme-qualified form of a path (``/a/b`` -> ``file:/a/b`` locally)."""
    from pyspark.sql import SparkSession as _S

    spark = _S.getActiveSession()
    if spark is None:
        return path.rstrip("/")
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def _check_below(path: str, root: str) -> None:
    p, r = _qualify(path), _qualify(root)
    if not p.startswith(r + "/") or ".." in p[len(r):].split("/"):
        raise ValueError(f"refusing to touch {path!r}: not strictly below {root!r}")


def delete(spark: SparkSession, path: str, root: str) -> bool:
    """Recursively delete ``path``; only strictly below ``root``."""
    _check_below(path, root)
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


# --- table schema file ----------------------------------------------------------
# Every table folder keeps its schema in ``_schema.json`` (ignored by Parquet
# readers, like ``_SUCCESS``). Reads use it, so an emptied table stays
# readable and partition columns keep their declared types.

SCHEMA_FILE = "_schema.json"


def _write_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, p = _fs(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(schema.json().encode("utf-8")))
    finally:
        out.close()


def read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema recorded for a table (``None`` if there is none)."""
    folder = current(spark, path)
    return _read_schema(spark, folder) if folder else None


def _read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, p = _fs(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(__import__("json").loads(text))


# --- reads --------------------------------------------------------------------

def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table's current version with its recorded schema (or ``schema``)."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = schema or _read_schema(spark, folder)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(folder)


# --- schema guard -------------------------------------------------------------

def schema_changes(existing: T.StructType, incoming: T.StructType) -> list[str]:
    """What differs between two schemas, one message per column name, by name.

    Names are compared without regard to case."""
    sides = [{f.name.casefold(): f.dataType.simpleString() for f in s.fields} for s in (existing, incoming)]
    names = sorted(set().union(*sides))
    pairs = [(n, sides[0].get(n, "no column"), sides[1].get(n, "no column")) for n in names]
    return [f"{n}: table has {have}, rows have {got}" for n, have, got in pairs if have != got]


def schema_rows(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    """``(owner, column_name, type)`` of several schemas; names in lower case."""
    rows = [(owner, f.name.casefold(), f.dataType.simpleString()) for owner, s in schemas.items() for f in s.fields]
    return spark.createDataFrame(rows, "owner string, column_name string, type string")


def schema_differences(table: T.StructType, incoming: DataFrame) -> DataFrame:
    """What differs between a table's schema and each owner's in ``incoming``
    (:func:`schema_rows`): ``owner, column_name, table_type, rows_type, change``,
    the change being added, removed or changed; no row for equal columns."""
    declared = F.array(*[F.struct(F.lit(f.name.casefold()).alias("column_name"), F.lit(f.dataType.simpleString()).alias("table_type"))
                         for f in table.fields])
    have = incoming.select("owner").distinct().select("owner", F.inline(declared))
    got = incoming.withColumnRenamed("type", "rows_type")
    change = F.when(F.col("table_type").isNull(), "added").when(F.col("rows_type").isNull(), "removed").otherwise("changed")
    return have.join(got, ["owner", "column_name"], "full").where(~F.col("table_type").eqNullSafe(F.col("rows_type"))) \
        .select("owner", "column_name", "table_type", "rows_type", change.alias("change"))


def _guard(path: str, existing: T.StructType, incoming: T.StructType) -> None:
    found = schema_changes(existing, incoming)
    if found:
        raise SchemaChanged(
            f"the columns of {path} differ from the rows to write ({'; '.join(found)}). If the change is wanted, "
            f"rebuild the table and what depends on it: python -m lakeline ... --full-refresh")


# --- writes -------------------------------------------------------------------

def _writer(df: DataFrame, partition_by: list[str] | None, max_records: int | None):
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    return w


def _into_version(df: DataFrame, folder: str, partition_by: list[str] | None, max_records: int | None) -> None:
    """Write a fresh version; its schema is there before Spark marks it complete."""
    _write_schema(df.sparkSession, folder, df.schema)
    _writer(df, partition_by, max_records).mode("append").parquet(folder)


def expire(spark: SparkSession, path: str, root: str, retention: Retention = DEFAULT_RETENTION) -> int:
    """Delete the versions that ``retention`` no longer keeps; how many went.

    Versions older than the current one that never got complete go at once."""
    found = versions(spark, path)
    complete = [folder for _, folder, done in found if done]
    if not complete:
        return 0
    fs, _ = _fs(spark, path)
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    recent = (time.time() - retention.seconds) * 1000
    spare = complete[:-1][-retention.versions:] if retention.versions else []
    gone = 0
    for _, folder, done in found:
        if folder >= complete[-1] or folder in spare:
            continue
        if done and fs.getFileStatus(marker(f"{folder}/_SUCCESS")).getModificationTime() > recent:
            continue
        gone += delete(spark, folder, root)
    return gone


def overwrite_table(df: DataFrame, path: str, root: str, partition_by: list[str] | None = None,
                    max_records: int | None = 5_000_000, metrics: dict | None = None,
                    retention: Retention = DEFAULT_RETENTION) -> int:
    """Rebuild a table; older versions stay as ``retention`` says.

    Returns the number of rows written.
    """
    spark = df.sparkSession
    _check_below(path, root)
    folder = _next_version(spark, path)
    obs = Observation("overwrite")
    extra = [c.alias(n) for n, c in (metrics or {}).items()]
    try:
        _into_version(df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), folder, partition_by, max_records)
    except Exception:
        delete(spark, folder, root)  # the current version is untouched; drop the partial copy
        raise
    if metrics is not None:
        metrics.clear()
        metrics.update({k: v for k, v in obs.get.items() if k != "rows"})
    if partition_by:
        _take_inventory(spark, folder, root, partition_by)
    expire(spark, path, root, retention)
    return int(obs.get["rows"])


def append_table(df: DataFrame, path: str, root: str, partition_by: list[str] | None = None,
                 max_records: int | None = 5_000_000) -> int:
    """Append rows (by name: columns are put in the table's order first)."""
    spark = df.sparkSession
    _check_below(path, root)
    folder = current(spark, path)
    if folder is None:
        return overwrite_table(df, path, root, partition_by, max_records)
    existing = read_table(spark, path).schema
    _guard(path, existing, df.schema)
    _forget_inventory(spark, folder, root)
    obs = Observation("append")
    rows = df.select(*existing.fieldNames()).observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(rows, partition_by, max_records).mode("append").parquet(folder)
    return int(obs.get["rows"])


def data_file_count(spark: SparkSession, path: str) -> int:
    """Number of data files of an unpartitioned table."""
    folder = current(spark, path)
    if folder is None:
        return 0
    fs, p = _fs(spark, folder)
    return sum(1 for st in fs.listStatus(p) if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def compact(spark: SparkSession, path: str, root: str, max_files: int = 64, target_files: int = 1) -> bool:
    """Rewrite a small, append-only table into ``target_files`` files once it
    has more than ``max_files`` (load logs gain one file per run)."""
    if data_file_count(spark, path) <= max_files:
        return False
    overwrite_table(read_table(spark, path).coalesce(target_files), path, root)
    return True


# --- partition inventory ---------------------------------------------------------
# ``_partitions`` in a version's folder: a small table with one row per partition
# folder (its values as strings, and its rows). ``_touched`` holds the partitions that
# the last replacement wrote; it is there before the data are, so what a killed
# replacement wrote is still known to the next one.

INVENTORY, TOUCHED = "_partitions", "_touched"
ROWS = "_rows"


def _pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Partitions that ``df`` falls into, with their rows; only ``cols`` are read."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).groupBy(*cols).agg(F.count(F.lit(1)).alias(ROWS))


def _take_inventory(spark: SparkSession, folder: str, root: str, cols: list[str]) -> None:
    """Count a version's partitions from its folders and footers (no column is read)."""
    table = spark.read.schema(_read_schema(spark, folder)).parquet(folder)
    overwrite_table(_pairs(table, cols), f"{folder}/{INVENTORY}", root, retention=Retention(1))


def _forget_inventory(spark: SparkSession, folder: str, root: str) -> None:
    for name in (INVENTORY, TOUCHED):
        if exists(spark, f"{folder}/{name}"):
            delete(spark, f"{folder}/{name}", root)


def inventory(spark: SparkSession, path: str, root: str, cols: list[str]) -> DataFrame:
    """Partition values (strings) and rows of a partitioned table's current version."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    if not table_exists(spark, f"{folder}/{INVENTORY}"):
        _take_inventory(spark, folder, root, cols)
    return read_table(spark, f"{folder}/{INVENTORY}")


def _same(cols: list[str]):
    """Null-safe equality of the columns ``cols`` of the sides x and y."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    return out


def _partition_folder(spark: SparkSession, folder: str, cols: list[str], row) -> str:
    """``folder/k1=v1/...`` as Spark's writer names it."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([folder, *[name(c, row[c]) for c in cols]])


def replace_by_key(df: DataFrame, path: str, root: str, key: str, partition_by: list[str] | None = None,
                   replace_keys: DataFrame | list[str] | None = None, strict_reference: bool = False,
                   max_records: int | None = 5_000_000, metrics: dict | None = None) -> dict:
    """Delete the rows of every replaced key, then insert ``df``.

    The table is partitioned by ``(*partition_by, key)``. A dynamic partition
    overwrite rewrites exactly the folders the new rows fall into; then any
    other folder of a replaced key is removed, so stale rows cannot survive,
    also for a key whose new version has no rows at all. ``replace_keys``
    names the keys being re-loaded (a table with the column ``key``, or a list);
    without it, only keys present in ``df`` are replaced. ``strict_reference=True``
    replaces only keys present in ``df`` even when ``replace_keys`` is given.

    The stale folders are the inventory's partitions of replaced keys that the new
    rows do not fall into: a semi and an anti join of small tables, whose few rows
    are walked one after another. ``df`` is read twice, once for its partition
    columns alone.

    Partitions are replaced one folder at a time, not in one commit; a crash
    in between leaves extra rows that the next run (which still sees the key
    as pending) replaces again.

    Returns ``rows`` and ``partitions_written``, ``stale_removed``, and ``touched``:
    the partitions written or removed, as a table.
    """
    spark = df.sparkSession
    _check_below(path, root)
    cols = [*(partition_by or []), key]
    folder = current(spark, path)
    obs = Observation("replace_by_key")
    extra = [c.alias(n) for n, c in (metrics or {}).items()]

    def observed(rows: DataFrame) -> DataFrame:
        return rows.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)

    def done(written: int, removed: int, touched: DataFrame) -> dict:
        found = obs.get
        if metrics is not None:
            metrics.clear()
            metrics.update({k: v for k, v in found.items() if k != "rows"})
        return {"rows": int(found["rows"]), "partitions_written": written, "stale_removed": removed, "touched": touched}

    if folder is None:
        folder = _next_version(spark, path)
        try:
            _into_version(observed(df), folder, cols, max_records)
        except Exception:
            delete(spark, folder, root)
            raise
        _take_inventory(spark, folder, root, cols)
        touched = read_table(spark, f"{folder}/{INVENTORY}").select(*cols)
        return done(touched.count(), 0, touched)

    existing = read_table(spark, path).schema
    _guard(path, existing, df.schema)
    df = df.select(*existing.fieldNames())
    held = inventory(spark, path, root, cols)
    if table_exists(spark, f"{folder}/{TOUCHED}"):  # a killed replacement may have got this far
        held = held.unionByName(read_table(spark, f"{folder}/{TOUCHED}"))
    held = held.groupBy(*cols).agg(F.max(ROWS).alias(ROWS))
    keep = Retention(1)
    n_written = overwrite_table(_pairs(df, cols), f"{folder}/{TOUCHED}", root, retention=keep)
    written = read_table(spark, f"{folder}/{TOUCHED}")
    _writer(observed(df), cols, max_records).mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").parquet(folder)

    keys = written.select(key)
    if replace_keys is not None and not strict_reference:
        if isinstance(replace_keys, list):
            replace_keys = spark.createDataFrame([(k,) for k in replace_keys], f"{key} string")
        keys = keys.unionByName(replace_keys.select(F.col(key).cast("string").alias(key)))
    keys = keys.distinct()
    replaced = held.alias("x").join(keys.alias("y"), _same([key]), "left_semi")
    stale = replaced.alias("x").join(written.alias("y"), _same(cols), "left_anti").select(*cols)
    removed = [tuple(r) for r in stale.toLocalIterator()]
    for values in removed:
        delete(spark, _partition_folder(spark, folder, cols, dict(zip(cols, values))), root)
    untouched = held.alias("x").join(keys.alias("y"), _same([key]), "left_anti")
    overwrite_table(untouched.unionByName(written), f"{folder}/{INVENTORY}", root, retention=keep)
    touched = written.select(*cols)
    if removed:
        touched = touched.unionByName(spark.createDataFrame(removed, ", ".join(f"`{c}` string" for c in cols)))
    return done(n_written, len(removed), touched)
