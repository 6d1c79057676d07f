"""Registered queries beyond the flagship (imported by the registry).

Each query runs one operator of the pipeline over the whole provided tables:
the trips fixture built from ``lineitem``, zones from ``nation``/``region``,
file names from ``orders``. Scenario states that an incremental operator
needs (files loaded by an earlier run, a re-delivered file) are derived from
the same rows by fixed rules on the file's month, and spelled out identically
in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.config import DEDUP_KEYS
from lakeline.operators import checks, dims, incremental, sinks
from lakeline.operators.quality import flag_repeats
from lakeline.plans.models import TripModels, stored_models, zones_from_customers
from lakeline.plans.oracle import with_ctes
from lakeline.functions.compat import month_start
from lakeline.plans.pipeline import FACT, MODEL_EDGES, SUMMARY, Pipeline, model_tests, picked_up_between
from lakeline.plans.registry import register
from lakeline.session import checkpoint_root, scratch_path
from lakeline.sources import landing, lookups
from lakeline.sources.fixture import _input_version, drifted_deliveries, read_table, write_landing

FILE = "_source_file"


def _month(col: str = "_source_period"):
    return F.month(F.col(col))


# --- silver ------------------------------------------------------------------

@register("silver_typed", with_ctes("SELECT * FROM typed", "typed"))
def q_silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TripModels(spark, sf_dir).typed


@register("dedup_keep_first", with_ctes("SELECT * EXCLUDE (is_repeat) FROM flagged WHERE NOT is_repeat", "flagged"))
def q_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = TripModels(spark, sf_dir).typed
    flagged = flag_repeats(typed, DEDUP_KEYS, "_source_row_number", "_repeat")
    return flagged.where(~F.col("_repeat")).drop("_repeat")


@register("silver_valid", with_ctes("SELECT * FROM silver", "silver"))
def q_silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TripModels(spark, sf_dir).silver


@register("silver_rejected", with_ctes("SELECT * FROM rejected", "rejected"))
def q_silver_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TripModels(spark, sf_dir).rejected


def _layer_counts(parts: list[tuple[DataFrame, int]], names: list[str], keys: list[str]) -> DataFrame:
    """Rows per key in several layers with one shuffle (union, then sum)."""
    tagged = None
    for df, idx in parts:
        cols = [F.col(k) for k in keys] + [F.lit(1 if i == idx else 0).alias(n) for i, n in enumerate(names)]
        t = df.select(*cols)
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.groupBy(*keys).agg(*[F.sum(n).cast("long").alias(n) for n in names])


@register("split_conservation", with_ctes("""
SELECT _source_file, bronze_rows, valid_rows, rejected_rows,
       bronze_rows = valid_rows + rejected_rows AS balanced
FROM (
    SELECT b._source_file, b.n AS bronze_rows, coalesce(v.n, 0) AS valid_rows, coalesce(r.n, 0) AS rejected_rows
    FROM (SELECT _source_file, count(*) AS n FROM bronze GROUP BY 1) b
    LEFT JOIN (SELECT _source_file, count(*) AS n FROM silver GROUP BY 1) v USING (_source_file)
    LEFT JOIN (SELECT _source_file, count(*) AS n FROM rejected GROUP BY 1) r USING (_source_file)
)""", "bronze", "silver", "rejected"))
def q_split_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_models(spark, sf_dir)
    names = ["bronze_rows", "valid_rows", "rejected_rows"]
    counts = _layer_counts([(m.bronze, 0), (m.silver, 1), (m.rejected, 2)], names, [FILE])
    return counts.withColumn("balanced", F.col("bronze_rows") == F.col("valid_rows") + F.col("rejected_rows"))


@register("trip_id", with_ctes("""
SELECT _source_file, _source_period, count(*) AS trips, min(trip_id) AS first_trip_id,
       max(trip_id) AS last_trip_id, count(DISTINCT trip_id) AS distinct_trip_ids
FROM typed GROUP BY 1, 2""", "typed"))
def q_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = TripModels(spark, sf_dir).typed
    return typed.groupBy(FILE, "_source_period").agg(
        F.count(F.lit(1)).alias("trips"), F.min("trip_id").alias("first_trip_id"),
        F.max("trip_id").alias("last_trip_id"), F.count_distinct("trip_id").alias("distinct_trip_ids"))


# --- gold --------------------------------------------------------------------

@register("fact_trips", with_ctes("SELECT * FROM fact", "fact"))
def q_fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_models(spark, sf_dir)
    return TripModels(spark, sf_dir, silver=stored.silver).fact


@register("fact_daily_zone_summary", with_ctes("SELECT * FROM daily_zone_summary", "daily_zone_summary"))
def q_fact_daily_zone_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_models(spark, sf_dir).daily_zone_summary


@register("dim_date", with_ctes("SELECT * FROM dim_date", "dim_date"))
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_models(spark, sf_dir).dim_date


@register("dim_location", with_ctes("SELECT * FROM customer_dim_location", "customer_dim_location"))
def q_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location dimension over a zone lookup that grows with the data
    (one zone per customer); the star query uses the 265-zone lookup."""
    return dims.dim_location(zones_from_customers(spark, sf_dir))


@register("dim_vendor", with_ctes("SELECT * FROM dim_vendor", "dim_vendor"))
def q_dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_models(spark, sf_dir).dim_vendor


@register("dim_rate_code", with_ctes("SELECT * FROM dim_rate_code", "dim_rate_code"))
def q_dim_rate_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_models(spark, sf_dir).dim_rate_code


@register("dim_payment_type", with_ctes("SELECT * FROM dim_payment_type", "dim_payment_type"))
def q_dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_models(spark, sf_dir).dim_payment_type


# --- file names, lineage -------------------------------------------------------

_NAME_SQL = """
    CASE o_orderkey % 5
        WHEN 0 THEN 'landing/yellow_tripdata_' || strftime(o_orderdate::DATE, '%Y_%m') || '.parquet'
        WHEN 1 THEN 'landing/yellow_tripdata_' || strftime(o_orderdate::DATE, '%Y-%m') || '.parquet'
        WHEN 2 THEN 'landing/yellow_tripdata_' || strftime(o_orderdate::DATE, '%Y') || '_13.parquet'
        WHEN 3 THEN 'landing/yellow_tripdata_' || strftime(o_orderdate::DATE, '%Y%m') || '.parquet'
        ELSE 'landing/yellow_tripdata_' || strftime(o_orderdate::DATE, '%Y_%m') || '.parquet.bak'
    END"""
_PERIOD_SQL = """
    CASE WHEN try_cast(regexp_extract(name, '{p}', 2) AS INTEGER) BETWEEN 1 AND 12
         THEN make_date(try_cast(regexp_extract(name, '{p}', 1) AS INTEGER),
                        try_cast(regexp_extract(name, '{p}', 2) AS INTEGER), 1) END"""


@register("source_period", f"""
SELECT name, {_PERIOD_SQL.format(p=landing.SOURCE_PERIOD_PATTERN)} AS _source_period, count(*) AS files_named
FROM (SELECT {_NAME_SQL} AS name FROM orders) GROUP BY name""")
def q_source_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    prefix = F.lit("landing/yellow_tripdata_")
    k = F.col("o_orderkey") % 5
    name = (
        F.when(k == 0, F.concat(prefix, F.date_format(d, "yyyy_MM"), F.lit(".parquet")))
        .when(k == 1, F.concat(prefix, F.date_format(d, "yyyy-MM"), F.lit(".parquet")))
        .when(k == 2, F.concat(prefix, F.date_format(d, "yyyy"), F.lit("_13.parquet")))
        .when(k == 3, F.concat(prefix, F.date_format(d, "yyyyMM"), F.lit(".parquet")))
        .otherwise(F.concat(prefix, F.date_format(d, "yyyy_MM"), F.lit(".parquet.bak")))
    )
    return (o.select(name.alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("files_named"))
            .withColumn("_source_period", landing.source_period("name")))


@register("lineage_columns", with_ctes("""
SELECT _source_file, _batch_id, sum(b)::BIGINT AS bronze_rows, sum(s)::BIGINT AS silver_rows,
       sum(f)::BIGINT AS fact_rows
FROM (SELECT _source_file, _batch_id, 1 AS b, 0 AS s, 0 AS f FROM bronze
      UNION ALL SELECT _source_file, _batch_id, 0, 1, 0 FROM silver
      UNION ALL SELECT _source_file, _batch_id, 0, 0, 1 FROM fact)
GROUP BY 1, 2""", "bronze", "silver", "fact"))
def q_lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_models(spark, sf_dir)
    return _layer_counts([(m.bronze, 0), (m.silver, 1), (m.fact, 2)],
                         ["bronze_rows", "silver_rows", "fact_rows"], [FILE, "_batch_id"])


# --- schema conforming -----------------------------------------------------------

@register("conform_union", with_ctes(
    "SELECT * EXCLUDE (_source_modified_at, _source_period, _batch_id) FROM bronze", "bronze"))
def q_conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = drifted_deliveries(TripModels(spark, sf_dir).bronze)
    return landing.conform_union(spark, frames)


# --- incremental selection ---------------------------------------------------------

def _listing(bronze: DataFrame) -> DataFrame:
    """Landing listing today: files of months 4, 8, 12 were re-delivered a day later."""
    mtime = F.col("_source_modified_at")
    bumped = F.when(_month() % 4 == 0, mtime + F.expr("INTERVAL 1 DAY")).otherwise(mtime)
    return bronze.select(FILE, bumped.alias("_source_modified_at"), "_source_period").distinct()


def _loaded_landing(bronze: DataFrame) -> DataFrame:
    """Files a previous run loaded: everything but months 11 and 12."""
    return bronze.where(~(_month() >= 11) | F.col("_source_period").isNull())


_LISTING_SQL = """
    SELECT DISTINCT _source_file,
        CASE WHEN month(_source_period) % 4 = 0 THEN _source_modified_at + INTERVAL 1 DAY
             ELSE _source_modified_at END AS _source_modified_at
    FROM bronze"""
_LOADED_SQL = """
    SELECT DISTINCT _source_file, _source_modified_at FROM bronze
    WHERE NOT (month(_source_period) >= 11) OR _source_period IS NULL"""


@register("pending_landing_files", with_ctes("""
SELECT DISTINCT l._source_file FROM listing l
ANTI JOIN loaded d ON l._source_file = d._source_file AND l._source_modified_at = d._source_modified_at
ORDER BY 1""", "bronze", extra=[("listing", _LISTING_SQL), ("loaded", _LOADED_SQL)]))
def q_pending_landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = TripModels(spark, sf_dir).bronze
    return incremental.pending_landing_files(_listing(bronze), _loaded_landing(bronze)).orderBy(FILE)


def _own_state(silver: DataFrame) -> DataFrame:
    """Silver after an earlier run: months 7-9 came from an older batch,
    months 10-12 were not loaded yet."""
    m = _month()
    return silver.where(m <= 9).select(
        FILE, F.when(m >= 7, F.lit("batch-old")).otherwise(F.col("_batch_id")).alias("_batch_id"))


_OWN_SQL = """
    SELECT _source_file, CASE WHEN month(_source_period) >= 7 THEN 'batch-old' ELSE _batch_id END AS _batch_id
    FROM silver WHERE month(_source_period) <= 9"""
_PENDING_SQL = """
    SELECT DISTINCT u._source_file
    FROM (SELECT DISTINCT _source_file, _batch_id FROM bronze) u
    ANTI JOIN (SELECT DISTINCT _source_file, _batch_id FROM own) o
        ON u._source_file = o._source_file AND u._batch_id = o._batch_id"""


@register("pending_source_files", with_ctes("SELECT * FROM pending ORDER BY 1", "bronze", "silver",
                                            extra=[("own", _OWN_SQL), ("pending", _PENDING_SQL)]))
def q_pending_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_models(spark, sf_dir)
    return incremental.pending_source_files(m.bronze, _own_state(m.silver)).orderBy(FILE)


@register("incremental_slice", with_ctes(
    "SELECT * FROM bronze WHERE _source_file IN (SELECT _source_file FROM pending)", "bronze", "silver",
    extra=[("own", _OWN_SQL), ("pending", _PENDING_SQL)]))
def q_incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_models(spark, sf_dir)
    pending = incremental.pending_source_files(m.bronze, _own_state(m.silver))
    return incremental.source_file_filter(m.bronze, pending)


@register("enrich_with_listing", with_ctes("""
SELECT b._source_file, b._source_row_number, b.vendorid, b.tpep_pickup_datetime, l._source_modified_at
FROM bronze b JOIN listing l ON b._source_file = l._source_file""",
                                           "bronze", extra=[("listing", _LISTING_SQL)]))
def q_enrich_with_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = TripModels(spark, sf_dir).bronze
    rows = bronze.select(FILE, "_source_row_number", "vendorid", "tpep_pickup_datetime")
    return landing.enrich_with_listing(rows, _listing(bronze).drop("_source_period"))


# --- data tests -------------------------------------------------------------------

def _test_tables(m: TripModels) -> dict[str, DataFrame]:
    return {
        "zones": m.zones,
        "vendors": m.known_codes("vendor"),
        "rate_codes": m.known_codes("rate_code"),
        "payment_types": m.known_codes("payment_type"),
        "bronze_yellow_tripdata": m.bronze,
        "silver_yellow_trips": m.silver,
        "silver_yellow_trips_rejected": m.rejected,
        "fact_trips": m.fact,
        "fact_daily_zone_summary": m.daily_zone_summary,
        "dim_date": m.dim_date,
        "dim_time_of_day": m.dim_time_of_day,
        "dim_location": m.dim_location,
        "dim_vendor": m.dim_vendor,
        "dim_rate_code": m.dim_rate_code,
        "dim_payment_type": m.dim_payment_type,
    }


_TEST_CTE = {
    "zones": "zones", "vendors": "known_vendor", "rate_codes": "known_rate_code",
    "payment_types": "known_payment_type", "bronze_yellow_tripdata": "bronze",
    "silver_yellow_trips": "silver", "silver_yellow_trips_rejected": "rejected", "fact_trips": "fact",
    "fact_daily_zone_summary": "daily_zone_summary", "dim_date": "dim_date",
    "dim_time_of_day": "dim_time_of_day", "dim_location": "dim_location", "dim_vendor": "dim_vendor",
    "dim_rate_code": "dim_rate_code", "dim_payment_type": "dim_payment_type",
}


def _all_tests(kind: str) -> list[checks.DataTest]:
    return [t for layer in model_tests().values() for t in layer if t.kind == kind]


def _test_sql(kind: str) -> str:
    selects, ctes = [], set()
    for t in _all_tests(kind):
        src = _TEST_CTE[t.model]
        ctes.add(src)
        if kind == "not_null":
            col, failures = t.column, f"(SELECT count(*) FROM {src} WHERE {t.column} IS NULL)"
        elif kind == "unique":
            col = t.column
            failures = (f"(SELECT count(*) FROM (SELECT {t.column} FROM {src} WHERE {t.column} IS NOT NULL "
                        f"GROUP BY 1 HAVING count(*) > 1))")
        elif kind == "relationships":
            parent = _TEST_CTE[t.to_model]
            ctes.add(parent)
            col = f"{t.column}->{t.to_model}.{t.to_field}"
            failures = (f"(SELECT count(*) FROM {src} c WHERE c.{t.column} IS NOT NULL AND NOT EXISTS "
                        f"(SELECT 1 FROM {parent} p WHERE p.{t.to_field} = c.{t.column}))")
        else:
            vals = ", ".join(f"'{v}'" for v in t.values)
            col = t.column
            failures = (f"(SELECT count(DISTINCT {t.column}) FROM {src} WHERE {t.column} IS NOT NULL "
                        f"AND {t.column} NOT IN ({vals}))")
        selects.append(f"SELECT '{kind}' AS test, '{t.model}' AS model, '{col}' AS column_name, "
                       f"{failures}::BIGINT AS failures")
    return with_ctes("\nUNION ALL\n".join(selects), *sorted(ctes))


def _test_query(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checks.run_tests(_test_tables(stored_models(spark, sf_dir)), _all_tests(kind))
    return run


for _kind in ["not_null", "unique", "relationships", "accepted_values"]:
    register(f"test_{_kind}", _test_sql(_kind))(_test_query(_kind))


# --- sinks (write under the shared checkpoint folder, read back) ----------------------

_BRONZE_COLS = "* EXCLUDE (_source_modified_at)"


@register("replace_by_key", with_ctes(f"""
SELECT {_BRONZE_COLS} FROM bronze WHERE NOT coalesce(month(_source_period) % 4 = 0, false)
UNION ALL BY NAME
SELECT * EXCLUDE (_source_modified_at, fare_amount, _batch_id), fare_amount * 2 AS fare_amount,
       'batch-redelivered' AS _batch_id
FROM bronze
WHERE month(_source_period) IN (4, 8) AND _source_row_number % 10 <> 0""", "bronze"))
def q_replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every file, then re-deliver months 4/8 (corrected, fewer rows)
    and month 12 (now empty); read the table back."""
    bronze = TripModels(spark, sf_dir).bronze.drop("_source_modified_at")
    root = checkpoint_root(spark)
    path = scratch_path(spark, "replace_by_key")
    sinks.overwrite_table(bronze, path, root, ["_source_period", FILE])
    redelivered = [r[0] for r in bronze.where(_month() % 4 == 0).select(FILE).distinct().collect()]
    v2 = (bronze.where(_month().isin(4, 8) & (F.col("_source_row_number") % 10 != 0))
          .withColumn("fare_amount", F.col("fare_amount") * 2)
          .withColumn("_batch_id", F.lit("batch-redelivered")))
    sinks.replace_by_key(v2, path, root, FILE, ["_source_period"], replace_keys=redelivered)
    return sinks.read_table(spark, path)


@register("append_load", with_ctes(f"SELECT {_BRONZE_COLS} FROM bronze", "bronze"))
def q_append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First the odd months, then an append of the rest; read back."""
    bronze = TripModels(spark, sf_dir).bronze.drop("_source_modified_at")
    root, path = checkpoint_root(spark), scratch_path(spark, "append_load")
    odd = F.coalesce(_month() % 2 == 1, F.lit(False))
    sinks.overwrite_table(bronze.where(odd), path, root, ["_source_period"])
    sinks.append_table(bronze.where(~odd), path, root, ["_source_period"])
    return sinks.read_table(spark, path)


@register("overwrite_table", with_ctes("SELECT * FROM daily_zone_summary", "daily_zone_summary"))
def q_overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the summary from the first half of the year, then rebuild it in full."""
    m = stored_models(spark, sf_dir)
    root, path = checkpoint_root(spark), scratch_path(spark, "overwrite_table")
    first_half = m.daily_zone_summary.where(F.col("date_key") % 10000 <= 630)
    sinks.overwrite_table(first_half, path, root)
    sinks.overwrite_table(m.daily_zone_summary, path, root)
    return sinks.read_table(spark, path)



# --- real files: landing listing, ingest, lookup CSV ----------------------------------

_CONTRACT = ", ".join(n for n, _ in landing.BRONZE_CONTRACT)
_LANDING: dict[tuple, str] = {}


def _landing_glob(spark: SparkSession, sf_dir: str) -> str:
    """Landing files written from the trips (once per session)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _input_version(spark, sf_dir))
    if key not in _LANDING:
        _LANDING[key] = write_landing(spark, TripModels(spark, sf_dir).bronze, scratch_path(spark, "landing"))
    return _LANDING[key]


@register("landing_listing", with_ctes(
    "SELECT DISTINCT regexp_extract(_source_file, '[^/]+$') AS landing_name, _source_period FROM bronze", "bronze"))
def q_landing_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and month of every landing file, from the listing (bodies are never read)."""
    listing = landing.list_landing(spark, _landing_glob(spark, sf_dir))
    name = F.regexp_extract(FILE, "([^/]+)$", 1)
    return listing.select(name.alias("landing_name"), landing.source_period(FILE).alias("_source_period")).distinct()


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    glob = _landing_glob(spark, sf_dir)
    files = [r[0] for r in landing.list_landing(spark, glob).select(FILE).collect()]
    return landing.read_landing(spark, files)


@register("ingest_conform", with_ctes(f"SELECT {_CONTRACT}, _source_period FROM bronze", "bronze"))
def q_ingest_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifted landing files read into the contract (values, types, period)."""
    return _ingested(spark, sf_dir).select(*[n for n, _ in landing.BRONZE_CONTRACT], "_source_period")


@register("ingest_lineage", with_ctes(
    "SELECT _source_period, count(*) AS rows_read, true AS row_index_ok FROM bronze GROUP BY 1", "bronze"))
def q_ingest_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per period, and whether every file's row numbers are exactly 0..n-1."""
    per_file = _ingested(spark, sf_dir).groupBy(FILE, "_source_period").agg(
        F.count(F.lit(1)).alias("n"), F.min("_source_row_number").alias("lo"),
        F.max("_source_row_number").alias("hi"), F.count_distinct("_source_row_number").alias("k"))
    ok = (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1) & (F.col("k") == F.col("n"))
    return per_file.groupBy("_source_period").agg(
        F.sum("n").alias("rows_read"), F.bool_and(ok).alias("row_index_ok"))


_ZONES_CSV_SQL = """
    SELECT location_id, borough, zone_name || ', ' || borough AS zone_name, service_zone FROM customer_zones"""


@register("lookup_csv", with_ctes("SELECT * FROM zones_csv", "customer_zones",
                                  extra=[("zones_csv", _ZONES_CSV_SQL)]))
def q_lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone lookup written as a quoted CSV (names contain commas) and read back typed."""
    zones = zones_from_customers(spark, sf_dir).withColumn(
        "zone_name", F.concat(F.col("zone_name"), F.lit(", "), F.col("borough")))
    path = scratch_path(spark, "zones-csv")
    zones.write.option("header", True).option("quoteAll", True).csv(path)
    return lookups.read_zones(spark, path)


# --- schema guard, globs, counters, months, the gate, table properties -----------------

@register("schema_changes", with_ctes("""
SELECT DISTINCT regexp_extract(_source_file, '[^/]+$') AS landing_name, d.column_name, d.table_type, d.rows_type, d.change
FROM bronze JOIN (VALUES
    (0, 'vendorid', 'bigint', 'int', 'changed'), (0, 'pulocationid', 'bigint', 'int', 'changed'),
    (1, 'passenger_count', 'double', 'bigint', 'changed'), (1, 'airport_fee', 'double', NULL, 'removed'),
    (2, 'unexpected_column', NULL, 'string', 'added')
) d(kind, column_name, table_type, rows_type, change) ON d.kind = coalesce(month(_source_period) % 2, 2)""", "bronze"))
def q_schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every drifted landing file differs from the bronze contract."""
    files = incremental.file_names(landing.list_landing(spark, _landing_glob(spark, sf_dir)))
    changes = sinks.schema_differences(landing.typed_empty(spark).schema, landing.file_schemas(spark, files))
    name = F.regexp_extract("owner", "([^/]+)$", 1)
    return changes.select(name.alias("landing_name"), "column_name", "table_type", "rows_type", "change").distinct()


@register("landing_glob", with_ctes("""
SELECT DISTINCT regexp_extract(_source_file, '[^/]+$') AS landing_name, _source_period,
       regexp_extract(_source_file, '[^/]+$') SIMILAR TO 'trips_199[5-8]_[01][12][.]parquet|misc[.]parquet' AS in_run
FROM bronze""", "bronze"))
def q_landing_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which landing files a run narrowed by a glob with classes takes; a glob that
    matches nothing adds no rows and keeps the listing's types."""
    glob = _landing_glob(spark, sf_dir)
    listing = landing.list_landing(spark, glob)
    nothing = landing.list_landing(spark, glob.replace("*.parquet", "none_[0-9].parquet"))
    taken = landing.matching(listing, "{trips_199[5-8]_[01][12],misc}.parquet").unionByName(nothing)
    name = F.regexp_extract(FILE, "([^/]+)$", 1)
    both = listing.join(taken.select(FILE, F.lit(True).alias("taken")), FILE, "left")
    return both.select(name.alias("landing_name"), landing.source_period(FILE).alias("_source_period"),
                       F.coalesce("taken", F.lit(False)).alias("in_run")).distinct()


@register("run_counters", with_ctes("""
SELECT 'overwrite' AS step, count(*) AS rows_reported, max(_source_row_number) AS max_row, count(*) AS rows_stored
FROM bronze WHERE month(_source_period) % 2 = 1
UNION ALL
SELECT 'append', count(*) FILTER (WHERE coalesce(month(_source_period) % 2, 0) = 0), NULL, count(*) FROM bronze
UNION ALL
SELECT 'replace', count(*) FILTER (WHERE month(_source_period) IN (4, 8) AND _source_row_number % 10 <> 0),
       max(_source_row_number) FILTER (WHERE month(_source_period) IN (4, 8) AND _source_row_number % 10 <> 0),
       count(*) FILTER (WHERE NOT coalesce(month(_source_period) % 4 = 0, false)
                        OR (month(_source_period) IN (4, 8) AND _source_row_number % 10 <> 0))
FROM bronze""", "bronze"))
def q_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three writes report (counted while writing) beside what the table then holds."""
    bronze = TripModels(spark, sf_dir).bronze.drop("_source_modified_at")
    root, path, parts = checkpoint_root(spark), scratch_path(spark, "run_counters"), ["_source_period", FILE]
    odd = F.coalesce(_month() % 2 == 1, F.lit(False))
    steps, top = [], F.max("_source_row_number")

    def held() -> int:
        return sinks.inventory(spark, path, root, parts).agg(F.sum(sinks.ROWS)).first()[0]

    seen = {"max_row": top}
    steps.append(("overwrite", sinks.overwrite_table(bronze.where(odd), path, root, parts, metrics=seen), seen["max_row"], held()))
    steps.append(("append", sinks.append_table(bronze.where(~odd), path, root, parts), None, held()))
    seen = {"max_row": top}
    again = bronze.where(_month().isin(4, 8) & (F.col("_source_row_number") % 10 != 0))
    out = sinks.replace_by_key(again, path, root, FILE, parts[:1], replace_keys=bronze.where(_month() % 4 == 0).select(FILE).distinct(),
                               metrics=seen)
    steps.append(("replace", out["rows"], seen["max_row"], held()))
    return spark.createDataFrame(steps, "step string, rows_reported long, max_row long, rows_stored long")


_PIVOT = "1998-03-17 12:00:00"


@register("month_partitioning", with_ctes(f"""
SELECT CASE WHEN pickup_at < TIMESTAMP '{_PIVOT}' THEN 'before' ELSE 'since' END AS side,
       CAST(date_trunc('month', pickup_at) AS DATE) AS pickup_month, count(*) AS trips,
       CAST(sum(fare_amount) AS DECIMAL(18, 2)) AS fares
FROM fact GROUP BY ALL""", "fact"))
def q_month_partitioning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips before and since a moment in the middle of a month, each from the months
    that the bound on pickup_at leaves of a table laid out by month."""
    fact = stored_models(spark, sf_dir).fact.withColumn("pickup_month", month_start("pickup_at"))
    path = scratch_path(spark, "month_partitioning")
    sinks.overwrite_table(fact, path, checkpoint_root(spark), ["pickup_month"])
    table = sinks.read_table(spark, path)
    before = picked_up_between(table, "pickup_month", until=_PIVOT).withColumn("side", F.lit("before"))
    since = picked_up_between(table, "pickup_month", since=_PIVOT).withColumn("side", F.lit("since"))
    return before.unionByName(since).groupBy("side", "pickup_month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").cast("decimal(18,2)").alias("fares"))


_BAD_SILVER = """
    SELECT trip_id, pickup_at, dropoff_at, CASE WHEN trip_id % 100 <> 7 THEN pickup_location_id END AS pickup_location_id,
           dropoff_location_id, fare_amount, total_amount
    FROM silver, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR trip_id % 50 = 3"""
_EDGES_SQL = ", ".join(f"('{a}', '{b}')" for a, b in MODEL_EDGES)


@register("gate_blocked", with_ctes("""
SELECT model, failing_model, min(steps) AS steps, any_value(failing_tests) AS failing_tests, any_value(failures)::BIGINT AS failures
FROM reach JOIN failed USING (failing_model) GROUP BY ALL""", "silver", extra=[
    ("bad_silver", _BAD_SILVER),
    ("bad_tests", "\nUNION ALL\n".join([
        *[f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS failures FROM bad_silver" for c in
          ("trip_id", "pickup_at", "dropoff_at", "pickup_location_id", "dropoff_location_id", "fare_amount", "total_amount")],
        "SELECT count(*) FROM (SELECT trip_id FROM bad_silver GROUP BY 1 HAVING count(*) > 1)"])),
    ("failed", "SELECT 'silver_yellow_trips' AS failing_model, count(*) AS failing_tests, sum(failures) AS failures "
               "FROM bad_tests WHERE failures > 0 HAVING count(*) > 0"),
    ("edges(parent, child)", f"VALUES {_EDGES_SQL}"),
    ("reach(failing_model, model, steps)", "SELECT failing_model, failing_model, 0 FROM failed UNION ALL "
     "SELECT r.failing_model, e.child, r.steps + 1 FROM reach r JOIN edges e ON e.parent = r.model"),
]).replace("WITH ", "WITH RECURSIVE ", 1))
def q_gate_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which models the data tests stop when silver is corrupted (locations lost, trips doubled)."""
    m = stored_models(spark, sf_dir)
    copies = F.when(F.col("trip_id") % 50 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    bad = m.silver.withColumn("copy", F.explode(copies)).drop("copy").withColumn(
        "pickup_location_id", F.when(F.col("trip_id") % 100 != 7, F.col("pickup_location_id")))
    results = checks.run_tests(_test_tables(m) | {"silver_yellow_trips": bad},
                               [t for layer in ("bronze", "silver") for t in model_tests()[layer]])
    return checks.blocked_models(results, spark.createDataFrame(MODEL_EDGES, "parent string, child string"))


@register("table_properties", with_ctes("""
SELECT 'fact_trips' AS table_name, 'gold' AS layer, 'pickup_month,_source_file' AS partitioned_by, count(*) AS row_count FROM fact
UNION ALL SELECT 'fact_daily_zone_summary', 'gold', '', count(*) FROM daily_zone_summary""", "fact", "daily_zone_summary"))
def q_table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of two published tables, as the catalog shows them."""
    m = stored_models(spark, sf_dir)
    pipe = Pipeline(spark, "unused", scratch_path(spark, "table_properties"), zones=m.zones)
    sinks.overwrite_table(m.fact.withColumn("pickup_month", month_start("pickup_at")), pipe.path(FACT), pipe.root, ["pickup_month", FILE])
    sinks.overwrite_table(m.daily_zone_summary, pipe.path(SUMMARY), pipe.root)
    prefix = "shown_" + pipe.root[-12:]
    out = None
    for name in pipe.publish(prefix):
        shown = spark.sql(f"SHOW TBLPROPERTIES {name}").groupBy().pivot(
            "key", ["lakeline.layer", "lakeline.partitioned_by", "lakeline.rows"]).agg(F.first("value"))
        row = shown.select(F.lit(name.split(".")[1]).alias("table_name"), F.col("`lakeline.layer`").alias("layer"),
                           F.col("`lakeline.partitioned_by`").alias("partitioned_by"),
                           F.col("`lakeline.rows`").cast("long").alias("row_count"))
        out = row if out is None else out.unionByName(row)
    spark.sql(f"DROP DATABASE {prefix}_gold CASCADE")  # entries only: the tables are external
    return out
