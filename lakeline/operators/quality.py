"""Silver data quality: typing, keep-first de-duplication, first broken rule.

``classify`` tags every bronze row with the first rule it breaks
(``_reject_reason`` NULL = valid); :func:`silver_valid` and
:func:`silver_rejected` are the two halves of that one result, so every input
row lands in exactly one of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeline.config import (
    DEDUP_KEYS,
    DEFAULT_THRESHOLDS,
    MAX_LOCATION_ID,
    MIN_LOCATION_ID,
    UNKNOWN_RATE_CODE,
    Thresholds,
)
from lakeline.functions.compat import round2_decimal, seconds_between, to_int, to_money, month_start

TRIP_ID_ROW_LIMIT = 100_000_000  # trip_id = yyyymm * 10^8 + row


def trip_id(period: str = "_source_period", row: str = "_source_row_number") -> Column:
    """Stable surrogate key: ``yyyymm * 10^8 + row number inside the file``."""
    p = F.col(period)
    yyyymm = (F.year(p) * 100 + F.month(p)).cast("long")
    return yyyymm * F.lit(TRIP_ID_ROW_LIMIT) + F.col(row)


def typed_trips(bronze: DataFrame) -> DataFrame:
    """Rename raw columns to snake_case and give them their silver types."""
    money = [
        ("extra", "extra_amount"),
        ("mta_tax", "mta_tax_amount"),
        ("tip_amount", "tip_amount"),
        ("tolls_amount", "tolls_amount"),
        ("improvement_surcharge", "improvement_surcharge_amount"),
        ("congestion_surcharge", "congestion_surcharge_amount"),
        ("airport_fee", "airport_fee_amount"),
    ]
    flag = F.col("store_and_fwd_flag")
    return bronze.select(
        trip_id().alias("trip_id"),
        F.col("vendorid").cast("int").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_at"),
        F.col("tpep_dropoff_datetime").alias("dropoff_at"),
        seconds_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("trip_duration_seconds"),
        # a cab seats six at most; other counts are meter slips
        F.when(F.col("passenger_count").between(1, 6), to_int("passenger_count")).alias("passenger_count"),
        F.col("trip_distance").alias("trip_distance_miles"),
        F.coalesce(to_int("ratecodeid"), F.lit(UNKNOWN_RATE_CODE)).alias("rate_code_id"),
        F.when(flag == "Y", F.lit(True)).when(flag == "N", F.lit(False)).alias("is_store_and_forward"),
        F.col("pulocationid").cast("int").alias("pickup_location_id"),
        F.col("dolocationid").cast("int").alias("dropoff_location_id"),
        F.col("payment_type").cast("int").alias("payment_type_id"),
        to_money("fare_amount").alias("fare_amount"),
        *[to_money(F.coalesce(F.col(src), F.lit(0.0))).alias(dst) for src, dst in money],
        to_money("total_amount").alias("total_amount"),
        "_source_file",
        "_source_row_number",
        "_source_period",
        "_batch_id",
    )


FILTER_BYTES = 32 << 20  # of the Bloom filter that every executor gets
_WORD_BYTES = 32  # of a word in a broadcast table
_ROWS_PER_RANGE = 1 << 16  # of the rows that may repeat, put in order again
_BITS = 4  # bits of a hash in its word
_BITS_PER_HASH = 16  # of the filter


def repeat_groups(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Groups of ``keys`` that occur more than once, with their first ``order``.

    The aggregate combines on the map side, so a group of copies that holds a
    third of all rows leaves each map task as one row.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min(order).alias("_first_order"), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .drop("_copies")
    )


def _key_hash(df: DataFrame, keys: list[str]) -> Column:
    return F.xxhash64(*[_hash_input(df, k) for k in keys])


def repeat_hashes(df: DataFrame, keys: list[str]) -> DataFrame:
    """64-bit hashes of ``keys`` that occur more than once (``_rh``).

    Only the hash is shuffled, after a map-side combine.
    """
    return (
        df.select(_key_hash(df, keys).alias("_rh"))
        .groupBy("_rh").agg(F.count(F.lit(1)).alias("_c"))
        .where(F.col("_c") > 1).select("_rh")
    )


def _words(hashes: DataFrame, n_hashes: int, filter_bytes: int) -> tuple[DataFrame, Callable[[Column], tuple[Column, Column]]]:
    """A Bloom filter over the hashes ``_rh``, as a table of 64-bit words, and how to look a hash up.

    A hash sets ``_BITS`` bits of one word, so a lookup is one join on the word's number.
    The table is built by a map-side-combined ``bit_or`` and has at most as many words
    as ``filter_bytes`` hold: with more hashes than that suits, more rows that do not
    repeat look as if they did, and the filter never outgrows its bound.
    """
    most = max(1, filter_bytes // _WORD_BYTES)
    words = max(1, min(most, n_hashes * _BITS_PER_HASH // 64 + 1))

    def place(h: Column) -> tuple[Column, Column]:
        mask = F.lit(0).cast("long")
        for i in range(_BITS):  # six bits of the hash for each of its bits in the word
            bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        return F.pmod(F.shiftright(h, 6 * _BITS), F.lit(words)).alias("_word"), mask.alias("_mask")

    word, mask = place(F.col("_rh"))
    table = hashes.select(word, mask).groupBy("_word").agg(F.bit_or("_mask").alias("_set"))
    return table, place


def _broadcast_limit_bytes(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 disables: 0)."""
    raw = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    num = raw.rstrip("bkmg")
    unit = raw[len(num):] or "b"
    return max(int(float(num) * units.get(unit, 1)), 0)


def _hash_input(df: DataFrame, name: str) -> Column:
    """A key column as hashed: -0.0 and NaN normalised as grouping does."""
    c = F.col(name)
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return F.when(F.isnan(c), F.lit(float("nan"))).when(c == 0, F.lit(0.0)).otherwise(c)
    return c


def _row_width(schema) -> int:
    """Rough in-memory width of a row, for the broadcast size check."""
    return 16 + sum(64 if f.dataType.typeName() in ("string", "binary") else 8 for f in schema.fields)


def flag_repeats(df: DataFrame, keys: list[str], order: str, out: str,
                 broadcast_bytes: int | None = None, scratch: str | None = None,
                 filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``out`` = row is not the first of its ``keys`` group (by ``order``).

    Same result as ``row_number() over (partition by keys order by order) > 1``
    without a window: a window sends each group to one task, and a group of
    copies may hold a third of the data. Instead the groups that have copies
    are found in two map-side-combined aggregates (first on a 64-bit hash of
    the keys, then exactly on the rows whose hash repeats) and stored in the
    shared checkpoint folder; their size is then known. When that set fits the broadcast limit
    it is broadcast and the rows are never shuffled, so the output keeps the
    input's file-aligned partitioning; otherwise a Bloom filter over the repeated
    hashes, of at most ``filter_bytes``, is broadcast in its place: rows that it
    rules out stay where they are, and only the others, the copies and a few percent
    besides, are shuffled and joined on their keys. Keys match NULL to NULL, as
    ``partition by`` does.
    """
    spark = df.sparkSession
    from lakeline.session import scratch_path

    def stored(frame: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Write ``frame`` to the shared scratch folder; return it and its row count."""
        path = scratch_path(spark, name) if scratch is None else f"{scratch}/{name}-{id(frame):x}"
        written = Observation(name)  # counted while writing: no second job
        frame.observe(written, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path), int(written.get["n"])

    limit = _broadcast_limit_bytes(df) if broadcast_bytes is None else broadcast_bytes
    # Phase 1: 64-bit hashes of the keys that occur more than once. Only the
    # hash crosses the shuffle (8 bytes a row, combined map-side); a row whose
    # hash is unique has unique keys, so it cannot repeat.
    key_hash = _key_hash(df, keys)
    hashes, n_hashes = stored(repeat_hashes(df, keys), "repeat-hashes")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_g_{k}"))

    def grouped(candidates: DataFrame) -> DataFrame:
        return repeat_groups(candidates, keys, order).select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_first_order")

    # There are hardly more groups than hashes, so the hashes tell whether they fit.
    width = _row_width(df.select(*keys, order).schema)
    if n_hashes * width <= limit:
        # Phase 2 on the candidates only (copies, plus rare hash collisions):
        # exact groups, so collisions never flag a row.
        groups, n = stored(grouped(df.join(F.broadcast(hashes), key_hash == F.col("_rh"), "left_semi")), "repeat-groups")
        if n * width <= limit:
            return _flagged(df.join(F.broadcast(groups), cond, "left"), keys, order, out)

    # Phase 3, too many groups to broadcast: only candidate rows are shuffled. A filter of
    # bounded size over the repeated hashes tells, row by row and in place, which rows may
    # repeat; the others are first of their keys and stay in the tasks that read them.
    table, place = _words(hashes, n_hashes, filter_bytes)
    words, _ = stored(table, "repeat-words")
    word, mask = place(key_hash)
    tested = df.withColumns({"_word": word, "_mask": mask}).join(F.broadcast(words.withColumnRenamed("_word", "_w")),
                                                                 F.col("_word") == F.col("_w"), "left")
    may_repeat = F.coalesce(F.col("_set").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    single = tested.where(~may_repeat).select(*df.columns, F.lit(False).alias(out))
    rows, n_rows = stored(tested.where(may_repeat).select(*df.columns), "repeat-candidates")
    # the groups come from the stored candidates: the input is not read for them;
    # a hot group of copies is split by AQE over several tasks
    repeats = _flagged(rows.join(grouped(rows), cond, "left"), keys, order, out)
    # The join scattered each unit (the first key, e.g. a file) over all tasks; ranges of
    # (first key, order) put contiguous slices of one or two units per task again, so
    # partitioned writes stay few large files, and a hot unit still spans many tasks.
    n_parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // _ROWS_PER_RANGE + 1)
    return single.unionByName(repeats.repartitionByRange(n_parts, keys[0], order))


def _flagged(joined: DataFrame, keys: list[str], order: str, out: str) -> DataFrame:
    """``out`` of rows joined with their group, if it has copies."""
    return joined.withColumn(out, F.coalesce(F.col(order) > F.col("_first_order"), F.lit(False))) \
        .drop(*[f"_g_{k}" for k in keys], "_first_order")


@dataclass(frozen=True)
class Rule:
    """A named rejection rule: a row breaks it when ``broken`` is true."""

    reason: str
    broken: Column


def trip_rules(th: Thresholds = DEFAULT_THRESHOLDS, duplicate_flag: str = "_is_duplicate") -> list[Rule]:
    """The nine silver rules, in the order they are tried."""
    secs = F.col("trip_duration_seconds")
    dist = F.col("trip_distance_miles")
    fare, total = F.col("fare_amount"), F.col("total_amount")
    pickup, dropoff, period = F.col("pickup_at"), F.col("dropoff_at"), F.col("_source_period")
    # A zero duration only reaches this rule when the minimum is 0; the SQL
    # engine's x / 0.0 is +inf there, i.e. too fast, so NULL counts as too fast.
    speed = F.try_divide(dist, secs / F.lit(3600.0))
    out_of_range = lambda c: ~F.col(c).between(MIN_LOCATION_ID, MAX_LOCATION_ID)
    return [
        Rule("duplicate", F.col(duplicate_flag)),
        Rule("unknown_source_period", period.isNull()),
        Rule("missing_timestamp", pickup.isNull() | dropoff.isNull()),
        Rule("pickup_outside_file_month", month_start(pickup) != period),
        Rule("invalid_duration",
             (secs < F.lit(th.min_trip_duration_minutes * 60))
             | (secs > F.lit(th.max_trip_duration_hours * 3600))),
        Rule("invalid_distance",
             dist.isNull() | (dist <= 0) | (dist > F.lit(float(th.max_trip_distance_miles)))),
        Rule("implausible_speed", speed.isNull() | (speed > F.lit(float(th.max_avg_speed_mph)))),
        Rule("invalid_amount",
             fare.isNull() | (fare <= 0) | total.isNull() | (total <= 0)
             | (fare > F.lit(th.max_fare_amount))),
        Rule("unknown_location", out_of_range("pickup_location_id") | out_of_range("dropoff_location_id")),
    ]


def first_broken(rules: list[Rule]) -> Column:
    """``case when r1 then 'r1' when r2 then ... end`` (no ELSE: NULL = valid)."""
    expr = None
    for r in rules:
        expr = F.when(r.broken, F.lit(r.reason)) if expr is None else expr.when(r.broken, F.lit(r.reason))
    return expr


def classify(bronze: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS, scratch: str | None = None) -> DataFrame:
    """Typed rows + ``_reject_reason`` (first rule broken, NULL when valid).

    ``scratch``: a shared folder for the intermediate repeat groups (default:
    below ``spark.checkpoint.dir``).
    """
    typed = typed_trips(bronze)
    flagged = flag_repeats(typed, DEDUP_KEYS, "_source_row_number", "_is_duplicate", scratch=scratch)
    return flagged.withColumn("_reject_reason", first_broken(trip_rules(th))).drop("_is_duplicate")


SILVER_COLUMNS = [
    "trip_id", "vendor_id", "pickup_at", "dropoff_at", "pickup_date", "trip_duration_minutes",
    "passenger_count", "trip_distance_miles", "rate_code_id", "is_store_and_forward",
    "pickup_location_id", "dropoff_location_id", "payment_type_id", "fare_amount", "extra_amount",
    "mta_tax_amount", "tip_amount", "tolls_amount", "improvement_surcharge_amount",
    "congestion_surcharge_amount", "airport_fee_amount", "total_amount",
    "_source_file", "_source_period", "_batch_id",
]


REJECTED_COLUMNS = [
    "_reject_reason", "trip_id", "vendor_id", "pickup_at", "dropoff_at", "trip_duration_seconds",
    "passenger_count", "trip_distance_miles", "rate_code_id", "is_store_and_forward",
    "pickup_location_id", "dropoff_location_id", "payment_type_id", "fare_amount", "extra_amount",
    "mta_tax_amount", "tip_amount", "tolls_amount", "improvement_surcharge_amount",
    "congestion_surcharge_amount", "airport_fee_amount", "total_amount",
    "_source_file", "_source_row_number", "_source_period", "_batch_id",
]


def _derived() -> dict[str, Column]:
    return {
        "pickup_date": F.to_date("pickup_at"),
        "trip_duration_minutes": round2_decimal(F.col("trip_duration_seconds") / F.lit(60.0)),
    }


def both_halves(classified: DataFrame) -> DataFrame:
    """The classified rows for one table with both halves: ``half`` is ``valid`` or
    ``rejected``, and valid rows have the columns that silver adds."""
    valid = F.col("_reject_reason").isNull()
    return classified.withColumns({c: F.when(valid, e) for c, e in _derived().items()} | {
        "half": F.when(valid, F.lit("valid")).otherwise(F.lit("rejected"))})


def silver_valid(classified: DataFrame) -> DataFrame:
    """Rows that pass every rule, in the silver layout."""
    derived = _derived()
    return classified.where(F.col("_reject_reason").isNull()).select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in SILVER_COLUMNS]
    )


def silver_rejected(classified: DataFrame) -> DataFrame:
    """Rows that broke a rule: the reason first, then every classified column."""
    rest = [c for c in classified.columns if c != "_reject_reason"]
    return classified.where(F.col("_reject_reason").isNotNull()).select("_reject_reason", *rest)


def reject_reason_counts(classified: DataFrame) -> DataFrame:
    """Rows per outcome (``valid`` for rows that broke no rule)."""
    return (
        classified.groupBy(F.coalesce(F.col("_reject_reason"), F.lit("valid")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
