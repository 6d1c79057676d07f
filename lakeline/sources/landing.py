"""Landing files: listing, schema-drift conforming and row lineage.

A landing zone holds one Parquet file per month whose column names change
case, whose integer widths drift and whose optional columns come and go.
Bronze reads it into a fixed contract:

* names match case-insensitively, missing columns become NULL, extra columns
  are dropped and every column is cast to the contract type;
* ``_source_file`` / ``_source_row_number`` come from the reader's
  ``_metadata`` (file path, 0-based row index inside the file), so they are
  exact however the file is split into tasks;
* ``_source_modified_at`` is the file's modification time as read, so the
  stamp always belongs to the bytes that were loaded.

Files are grouped by footer schema and each group is read with one scan, so
the plan has one scan per distinct schema, not one per file.
"""

from __future__ import annotations

import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.config import BRONZE_CONTRACT, SOURCE_PERIOD_PATTERN


def source_period(path: str | Column) -> Column:
    """First day of the month named by ``..._YYYY_MM.parquet`` / ``YYYY-MM``.

    NULL when the name carries no year and month, and also when the month is
    outside 1..12 (the SQL version aborts the whole run on ``_2023_13``).
    """
    p = F.col(path) if isinstance(path, str) else path
    year = F.regexp_extract(p, SOURCE_PERIOD_PATTERN, 1).try_cast("int")
    month = F.regexp_extract(p, SOURCE_PERIOD_PATTERN, 2).try_cast("int")
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


LISTING_SCHEMA = T.StructType([
    T.StructField("_source_file", T.StringType()),
    T.StructField("_source_modified_at", T.TimestampType()),
])


def list_landing(spark: SparkSession, glob: str) -> DataFrame:
    """``(_source_file, _source_modified_at)`` of every file matching ``glob``.

    A scan of Spark's ``binaryFile`` source with the bodies pruned: the file index
    lists the matches (with a Spark job where they are many), tasks turn them into
    rows, and nothing is gathered on the driver. Paths are fully qualified and spelled
    as the file system spells them, like the ``_source_file`` of :func:`read_landing`.
    Files inside folders that match are not landing files, nor are hidden ones (names
    that begin with ``_`` or ``.``) and files of no bytes, which no Spark reader would
    read. No match gives no rows.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    depth = _segments(fs.makeQualified(path).toString())
    return found.where(F.size(F.split("path", "/")) == depth).select(
        F.col("path").alias("_source_file"), F.col("modificationTime").alias("_source_modified_at"))


def _segments(glob: str) -> int:
    """Parts of a path that ``glob`` matches; slashes in ``{a,b}`` are not supported."""
    return len(glob.split("/"))


def matching(listing: DataFrame, glob: str) -> DataFrame:
    """The listed files whose name (the path's last part) matches ``glob``.

    ``*`` and ``?`` stand for any characters, ``[12]``, ``[a-c]`` and ``[^x]`` for one of a
    class, ``{a,b}`` for one of several texts, a backslash takes the next character as
    it is. The filter narrows a listing that is at hand; the columns stay as they are.
    """
    out, i, depth = "", 0, 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "\\" and i + 1 < len(glob):
            out += re.escape(glob[i + 1])
            i += 1
        elif close > 0:
            body = glob[i + 1:close]
            negated = body[0] in "!^"
            out += "[" + ("^" if negated else "") + re.sub(r"([\\\[\]&~|])", r"\\\1", body[negated:]) + "]"
            i = close
        elif c in "{}" and (c == "{" or depth):
            depth += 1 if c == "{" else -1
            out += "(?:" if c == "{" else ")"
        elif c == "," and depth:
            out += "|"
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c))
        i += 1
    return listing.where(F.regexp_extract("_source_file", "([^/]+)$", 1).rlike(f"^(?:{out})$"))


def decoded_path(uri: Column) -> Column:
    """The path in a ``_metadata.file_path`` URI: its percent escapes undone.

    ``url_decode`` is made for form values, where a plus sign is a space; in a
    path it is a plus sign."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _reader_path(path: str) -> str:
    """``path`` with the characters that a reader would expand escaped."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def enrich_with_listing(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Attach each file's listed mtime to its rows (inner join on the path).

    The listing has one row per landing file; whether that is small enough to
    broadcast is left to the planner.
    """
    return rows.join(listing, "_source_file", "inner")


def footer_signatures(spark: SparkSession, files: list[str], threads: int = 16) -> dict[str, str]:
    """A schema signature per file, from the Parquet footers only.

    Footers are opened through the session's Hadoop file systems, with its
    credentials and for every scheme and number of files alike, a few at a time
    from a thread pool. No row data is read.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def one(path: str) -> tuple[str, str]:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            return path, reader.getFooter().getFileMetaData().getSchema().toString().lower()
        finally:
            reader.close()

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        return dict(pool.map(one, files))


def schema_groups(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """``files`` by footer schema."""
    groups: dict[str, list[str]] = defaultdict(list)
    for path, signature in footer_signatures(spark, files).items():
        groups[signature].append(path)
    return list(groups.values())


def file_schemas(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(owner, column_name, type)`` of every file, the file being the owner.

    One file of each footer schema is opened by a reader; the others share its types."""
    rows = []
    for group in schema_groups(spark, files):
        schema = spark.read.parquet(_reader_path(group[0])).schema
        rows.append((group, [(f.name.casefold(), f.dataType.simpleString()) for f in schema.fields]))
    table = spark.createDataFrame(rows, "files array<string>, columns array<struct<column_name: string, type: string>>")
    return table.select(F.explode("files").alias("owner"), "columns").select("owner", F.inline("columns"))


def _as_type(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast to a contract type: drifted doubles round half to even on their way to
    integers, zoned timestamps become UTC wall-clock time in any session zone."""
    if isinstance(want, T.IntegralType) and isinstance(have, (T.DoubleType, T.FloatType)):
        return F.rint(col).cast(want)
    if isinstance(want, T.TimestampNTZType) and isinstance(have, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch)
    return col.cast(want)


def conform(df: DataFrame, contract: list[tuple[str, T.DataType]] = BRONZE_CONTRACT) -> DataFrame:
    """Project ``df`` onto the contract: case-insensitive names, casts, NULL fill.

    Lineage columns produced by :func:`read_landing` are kept as they are.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for name, dtype in contract:
        src = by_lower.get(name.lower())
        cols.append((_as_type(F.col(f"`{src}`"), df.schema[src].dataType, dtype) if src
                     else F.lit(None).cast(dtype)).alias(name))
    lineage = [c for c in df.columns if c.startswith("_source_")]
    return df.select(*cols, *lineage)


def read_landing(spark: SparkSession, files: list[str],
                 contract: list[tuple[str, T.DataType]] = BRONZE_CONTRACT) -> DataFrame:
    """Read landing files into the contract with row lineage.

    Files sharing a footer schema are read by one scan; the groups are then
    unioned by name. Returns the contract columns plus ``_source_file``,
    ``_source_row_number``, ``_source_modified_at`` and ``_source_period``.
    """
    if not files:
        raise ValueError("read_landing needs at least one file")
    parts = []
    for paths in schema_groups(spark, files):
        raw = spark.read.parquet(*[_reader_path(p) for p in sorted(paths)])
        raw = raw.select(
            "*",
            decoded_path(F.col("_metadata.file_path")).alias("_source_file"),
            F.col("_metadata.row_index").alias("_source_row_number"),
            F.col("_metadata.file_modification_time").alias("_source_modified_at"),
        )
        parts.append(conform(raw, contract))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("_source_period", source_period("_source_file"))


def bronze_rows(landing: DataFrame, batch_id: str) -> DataFrame:
    """Bronze table rows: contract + lineage + batch id + ingest time."""
    return landing.select(
        *[n for n, _ in BRONZE_CONTRACT],
        "_source_file",
        "_source_row_number",
        "_source_modified_at",
        "_source_period",
        F.lit(batch_id).alias("_batch_id"),
        F.current_timestamp().alias("_ingested_at"),
    )


def typed_empty(spark: SparkSession, contract: list[tuple[str, T.DataType]] = BRONZE_CONTRACT) -> DataFrame:
    """The typed, empty frame of the contract (``... limit 0``)."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in contract])
    return spark.createDataFrame([], schema)


def conform_union(spark: SparkSession, frames: list[DataFrame],
                  contract: list[tuple[str, T.DataType]] = BRONZE_CONTRACT) -> DataFrame:
    """``typed_empty UNION ALL BY NAME frame1 UNION ALL BY NAME ...``.

    Each frame is conformed first (lower-cased names, contract casts, missing
    columns NULL), then the frames are appended by name.
    """
    out = typed_empty(spark, contract)
    for f in frames:
        out = out.unionByName(conform(f, contract), allowMissingColumns=True)
    return out
