"""The incremental landing -> bronze -> silver -> gold run.

One ``Pipeline.run()``:

1. lists the landing glob once (path + mtime, no file bodies) and finds new
   or re-delivered files against bronze's load log;
2. reads only those files into the bronze contract and replaces their rows
   (replace-by-key on ``_source_file``);
3. classifies the bronze rows of files whose latest batch silver has not
   seen, once, and writes both halves (valid / rejected) and a small per-file
   profile from that one result;
4. does the same for ``fact_trips``; recomputes the summary only for the
   pickup months those files touched, and the calendar and code dimensions
   from the profile;
5. runs the data tests after each layer on what changed (whole tables on a
   first load or full refresh); a failing test stops the layers that depend
   on it, in this run and in every later one until it passes.

Each layer keeps a small load log (one row per file and batch), written only
after its tables and its tests: what failed stays pending, so the next run
does it and tests it again. Change detection reads a few rows per file, never
the data. A first load or full refresh starts the logs anew.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.config import (
    DEFAULT_THRESHOLDS,
    PAYMENT_TYPES,
    RATE_CODES,
    REJECT_REASONS,
    VENDORS,
    Thresholds,
)
from lakeline.functions.compat import month_start
from lakeline.operators import checks, dims, facts, quality, sinks
from lakeline.operators.checks import DataTest, accepted_values, not_null, relationship, unique
from lakeline.operators.incremental import file_names, pending_landing_files, pending_source_files, source_file_filter
from lakeline.sources import landing, lookups

FILE = "_source_file"

BRONZE = "bronze/bronze_yellow_tripdata"
SILVER = "silver/silver_yellow_trips"
REJECTED = "silver/silver_yellow_trips_rejected"
FACT = "gold/fact_trips"
SUMMARY = "gold/fact_daily_zone_summary"
GOLD_DIMS = ["dim_date", "dim_time_of_day", "dim_location", "dim_vendor", "dim_rate_code", "dim_payment_type"]
LOOKUP_DIMS = {"dim_time_of_day", "dim_location"}
PROFILE_DIMS = {"dim_date", "dim_vendor", "dim_rate_code", "dim_payment_type"}
PROFILE = "silver_file_profile"
TABLE_PARTITIONS = {
    BRONZE: ["_source_period", FILE],
    SILVER: ["_source_period", FILE],
    REJECTED: ["_source_period", FILE],
    FACT: ["pickup_month", FILE],
    SUMMARY: [],
    **{f"gold/{d}": [] for d in ["dim_date", "dim_time_of_day", "dim_location", "dim_vendor", "dim_rate_code",
                                 "dim_payment_type"]},
}


# partition columns that only lay a table out and are no part of its contract
LAYOUT_ONLY = {FACT: ["pickup_month"]}
# the partition column that holds the month of pickup_at (a valid trip starts in its file's month)
MONTH_OF_PICKUP = {SILVER: "_source_period", FACT: "pickup_month"}

# which model reads which, as (model, model that reads it)
MODEL_EDGES = [
    ("bronze_yellow_tripdata", "silver_yellow_trips"),
    ("bronze_yellow_tripdata", "silver_yellow_trips_rejected"),
    ("silver_yellow_trips", "fact_trips"),
    ("silver_yellow_trips", "dim_date"),
    ("silver_yellow_trips", "dim_vendor"),
    ("silver_yellow_trips", "dim_rate_code"),
    ("silver_yellow_trips", "dim_payment_type"),
    ("fact_trips", "fact_daily_zone_summary"),
    ("zones", "dim_location"),
    ("vendors", "dim_vendor"),
    ("rate_codes", "dim_rate_code"),
    ("payment_types", "dim_payment_type"),
]


class NoLandingFiles(RuntimeError):
    pass


class TripIdOverflow(RuntimeError):
    pass


class PeriodClash(RuntimeError):
    """Two landing files of one month: their rows would get the same trip ids."""


class RowsLost(RuntimeError):
    """Silver's two halves do not hold exactly the bronze rows of the loaded files."""


@dataclass
class RunSummary:
    batch_id: str
    stages: dict[str, dict] = field(default_factory=dict)
    tests: list[tuple] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"batch_id": self.batch_id, "stages": self.stages, "tests": len(self.tests)})


def model_tests() -> dict[str, list[DataTest]]:
    """The pipeline's data tests, grouped by the layer they guard."""
    return {
        "sources": [
            *not_null("zones", "location_id"), unique("zones", "location_id"),
            *not_null("vendors", "vendor_id"), unique("vendors", "vendor_id"),
            *not_null("rate_codes", "rate_code_id"), unique("rate_codes", "rate_code_id"),
            *not_null("payment_types", "payment_type_id"), unique("payment_types", "payment_type_id"),
        ],
        "bronze": not_null("bronze_yellow_tripdata", "_source_file", "_source_row_number", "_batch_id"),
        "silver": [
            *not_null("silver_yellow_trips", "trip_id", "pickup_at", "dropoff_at", "pickup_location_id",
                      "dropoff_location_id", "fare_amount", "total_amount"),
            unique("silver_yellow_trips", "trip_id"),
            *not_null("silver_yellow_trips_rejected", "_reject_reason"),
            accepted_values("silver_yellow_trips_rejected", "_reject_reason", REJECT_REASONS),
        ],
        "gold": [
            *not_null("dim_date", "date_key"), unique("dim_date", "date_key"),
            *not_null("dim_time_of_day", "hour_of_day"), unique("dim_time_of_day", "hour_of_day"),
            *not_null("dim_location", "location_id"), unique("dim_location", "location_id"),
            *not_null("dim_vendor", "vendor_id"), unique("dim_vendor", "vendor_id"),
            *not_null("dim_rate_code", "rate_code_id"), unique("dim_rate_code", "rate_code_id"),
            *not_null("dim_payment_type", "payment_type_id"), unique("dim_payment_type", "payment_type_id"),
            *not_null("fact_trips", "trip_id", "pickup_date_key"), unique("fact_trips", "trip_id"),
            relationship("fact_trips", "pickup_date_key", "dim_date", "date_key"),
            relationship("fact_trips", "dropoff_date_key", "dim_date", "date_key"),
            relationship("fact_trips", "pickup_hour_of_day", "dim_time_of_day", "hour_of_day"),
            relationship("fact_trips", "pickup_location_id", "dim_location", "location_id"),
            relationship("fact_trips", "dropoff_location_id", "dim_location", "location_id"),
            relationship("fact_trips", "vendor_id", "dim_vendor", "vendor_id"),
            relationship("fact_trips", "rate_code_id", "dim_rate_code", "rate_code_id"),
            relationship("fact_trips", "payment_type_id", "dim_payment_type", "payment_type_id"),
            *not_null("fact_daily_zone_summary", "date_key", "location_id"),
            relationship("fact_daily_zone_summary", "date_key", "dim_date", "date_key"),
            relationship("fact_daily_zone_summary", "location_id", "dim_location", "location_id"),
        ],
    }


class Pipeline:
    """Incremental trip pipeline over a landing glob and a lakehouse root."""

    def __init__(self, spark: SparkSession, landing_glob: str, root: str, zones: DataFrame | str,
                 thresholds: Thresholds = DEFAULT_THRESHOLDS, run_tests: bool = True,
                 strict_reference: bool = False, gold_threads: int = 4, publish_prefix: str | None = None,
                 log_max_files: int = 64, vendors: DataFrame | str | None = None,
                 rate_codes: DataFrame | str | None = None, payment_types: DataFrame | str | None = None,
                 retention: sinks.Retention = sinks.DEFAULT_RETENTION):
        self.spark = spark
        self.glob = landing_glob
        self.root = root.rstrip("/")
        self.zones = lookups.read_zones(spark, zones) if isinstance(zones, str) else zones
        self.thresholds = thresholds
        self.run_tests = run_tests
        self.strict_reference = strict_reference
        self.gold_threads = gold_threads
        self.publish_prefix = publish_prefix
        self.log_max_files = log_max_files
        self.retention = retention
        self._known_prefixes: list[str] = []
        self.codes = {
            "vendor": self._codes(vendors, VENDORS, "vendor"),
            "rate_code": self._codes(rate_codes, RATE_CODES, "rate_code"),
            "payment_type": self._codes(payment_types, PAYMENT_TYPES, "payment_type"),
        }

    def _codes(self, given: DataFrame | str | None, default: list[tuple[int, str]], kind: str) -> DataFrame:
        """A code list: a table, the path of its CSV file, or the built-in one."""
        columns = f"{kind}_id", f"{kind}_name"
        if given is None:
            return dims.code_list(self.spark, default, *columns)
        return lookups.read_codes(self.spark, given, *columns) if isinstance(given, str) else given.select(*columns)

    # -- locations and reads -------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log_path(self, name: str) -> str:
        return f"{self.root}/_loads/{name.split('/')[-1]}"

    def exists(self, name: str) -> bool:
        return sinks.table_exists(self.spark, self.path(name))

    def table(self, name: str, since=None, until=None) -> DataFrame:
        """A table, or of a table laid out by pickup month the rows picked up from
        ``since`` on and before ``until`` (timestamps without zone, or text that casts
        to one): the bounds also hold for the month, so other months are never read."""
        df = sinks.read_table(self.spark, self.path(name))
        if since is None and until is None:
            return df
        if name not in MONTH_OF_PICKUP:
            raise ValueError(f"{name} is not laid out by pickup month")
        return picked_up_between(df, MONTH_OF_PICKUP[name], since, until)

    def load_log(self, name: str) -> DataFrame | None:
        p = self.log_path(name)
        return sinks.read_table(self.spark, p) if sinks.table_exists(self.spark, p) else None

    @staticmethod
    def latest(log: DataFrame) -> DataFrame:
        """Latest (file, batch) per file of a load log (a few rows per file)."""
        w = Window.partitionBy(FILE).orderBy(F.col("_loaded_at").desc())
        return log.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

    def _log(self, name: str, rows: DataFrame, fresh: bool) -> None:
        """Record loaded files; ``fresh`` starts the log anew (first load, full refresh)."""
        path = self.log_path(name)
        rows = rows.withColumn("_loaded_at", F.current_timestamp())
        if fresh:
            sinks.overwrite_table(rows, path, self.root)
            return
        sinks.append_table(rows, path, self.root)
        sinks.compact(self.spark, path, self.root, max_files=self.log_max_files)

    # -- pending files --------------------------------------------------------
    def _scratch(self, summary: RunSummary) -> str:
        return f"{self.root}/_scratch/{summary.batch_id}"

    def _kept(self, summary: RunSummary, pending: DataFrame, layer: str) -> tuple[DataFrame, int]:
        """A set of pending files as a table that the run's readers join, and its size."""
        path = f"{self._scratch(summary)}/pending-{layer}"
        n = Observation(f"pending-{layer}")
        pending.select(FILE).observe(n, F.count(F.lit(1)).alias("n")).write.parquet(path)
        return self.spark.read.schema(f"{FILE} string").parquet(path), int(n.get["n"])

    # -- stages ---------------------------------------------------------------
    def _timed(self, summary: RunSummary, stage: str, fn):
        t0 = time.time()
        out = fn() or {}
        out["seconds"] = round(time.time() - t0, 3)
        summary.stages[stage] = {k: v for k, v in out.items() if not k.startswith("_")}
        return out

    def _test(self, summary: RunSummary, layer: str, tables: dict[str, DataFrame],
              only: list[DataTest] | None = None) -> None:
        if not self.run_tests:
            return
        tests = model_tests()[layer] if only is None else only
        if tests:
            summary.tests += checks.gate(checks.run_tests(tables, tests))

    def bronze(self, summary: RunSummary, full_refresh: bool, listing: DataFrame | None = None) -> dict:
        if listing is None:
            listing = landing.list_landing(self.spark, self.glob)
        listing = listing.select(FILE, "_source_modified_at")
        log = self.load_log(BRONZE)
        first = full_refresh or not self.exists(BRONZE) or log is None
        loaded = None if first else self.latest(log)
        pending, n_files = self._kept(summary, pending_landing_files(listing, loaded), "bronze")
        if not n_files:
            if first:
                raise NoLandingFiles(f"No landing files match {self.glob}")
            return {"files": 0, "rows": 0, "_pending": None}
        self._one_file_per_period(pending, loaded)
        # the one place that needs names in hand: the reader takes paths
        rows = landing.bronze_rows(landing.read_landing(self.spark, file_names(pending)), summary.batch_id)
        metrics = {"max_row": F.max("_source_row_number")}
        if first:
            if log is not None:  # until bronze is whole again nothing counts as loaded
                sinks.overwrite_table(log.limit(0), self.log_path(BRONZE), self.root)
            n = sinks.overwrite_table(rows, self.path(BRONZE), self.root, ["_source_period", FILE], metrics=metrics,
                                      retention=self.retention)
            stats = {"rows": n}
            self._move(BRONZE)
        else:
            stats = sinks.replace_by_key(rows, self.path(BRONZE), self.root, FILE, ["_source_period"],
                                         replace_keys=pending, strict_reference=self.strict_reference,
                                         metrics=metrics)
            stats.pop("touched")
            self._move(BRONZE)
        max_row = metrics.get("max_row")
        if max_row is not None and max_row >= quality.TRIP_ID_ROW_LIMIT:
            raise TripIdOverflow(f"a landing file has {max_row + 1} rows; trip_id allows "
                                 f"{quality.TRIP_ID_ROW_LIMIT} per file")

        def commit() -> None:
            """Files and their modification times as listed, with the rows bronze now holds of each."""
            parts = sinks.inventory(self.spark, self.path(BRONZE), self.root, TABLE_PARTITIONS[BRONZE])
            held = parts.groupBy(FILE).agg(F.sum(sinks.ROWS).alias("_rows"))
            files = source_file_filter(listing, pending).join(held, FILE, "left")
            self._log(BRONZE, files.select(
                FILE, "_source_modified_at", F.lit(summary.batch_id).alias("_batch_id"),
                F.coalesce("_rows", F.lit(0)).alias("_rows")), fresh=first)

        return {"files": n_files, **stats, "_pending": None if first else pending, "_commit": commit}

    def _one_file_per_period(self, pending: DataFrame, loaded: DataFrame | None) -> None:
        files = pending.select(FILE)
        if loaded is not None:
            files = files.unionByName(loaded.select(FILE)).distinct()
        period = landing.source_period(FILE)
        clashes = (files.where(period.isNotNull()).groupBy(period.alias("period"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min(FILE).alias("a"), F.max(FILE).alias("b"))
                   .where("n > 1").orderBy("period").take(1))
        if clashes:
            c = clashes[0]
            raise PeriodClash(f"{c['n']} landing files for {c['period']:%Y-%m}, among them {c['a']} and {c['b']}")

    def _pending(self, summary: RunSummary, upstream: str, own: str,
                 full_refresh: bool) -> tuple[DataFrame | None, int | None]:
        """Upstream files that ``own`` has not seen and how many they are; ``None``: all."""
        if full_refresh or not self.exists(own) or self.load_log(own) is None:
            return None, None
        up = self.latest(self.load_log(upstream))
        return self._kept(summary, pending_source_files(up, self.load_log(own)), own.split("/")[-1])

    def _upstream_batches(self, upstream: str, pending: DataFrame | None) -> DataFrame:
        return source_file_filter(self.latest(self.load_log(upstream)), pending).select(FILE, "_batch_id")

    def _write_by_file(self, df: DataFrame, name: str, partition: str, pending: DataFrame | None) -> dict:
        """Overwrite (all files) or replace the pending files' partitions."""
        path = self.path(name)
        if pending is None:
            out = {"rows": sinks.overwrite_table(df, path, self.root, [partition, FILE], retention=self.retention),
                   "touched": None}
        else:
            out = sinks.replace_by_key(df, path, self.root, FILE, [partition], replace_keys=pending,
                                       strict_reference=self.strict_reference)
        self._move(name)
        return {"rows": out["rows"], "touched": out["touched"]}

    def silver(self, summary: RunSummary, full_refresh: bool) -> dict:
        pending, n_files = self._pending(summary, BRONZE, SILVER, full_refresh)
        if n_files == 0:
            return {"files": 0, "_periods": []}
        bronze = source_file_filter(self.table(BRONZE), pending)
        scratch = f"{self._scratch(summary)}/classify"
        try:
            # Classified once into a scratch table that both halves and the profile read.
            quality.classify(bronze, self.thresholds, scratch=scratch).write.parquet(f"{scratch}/classified")
            classified = self.spark.read.parquet(f"{scratch}/classified")
            now = F.current_timestamp()
            valid = quality.silver_valid(classified).withColumn("_processed_at", now)
            rejected = quality.silver_rejected(classified).withColumn("_processed_at", now)
            v = self._write_by_file(valid, SILVER, "_source_period", pending)
            r = self._write_by_file(rejected, REJECTED, "_source_period", pending)
            # Per-file profile of the valid rows: code combinations and time bounds
            # (a few rows per file). Gold's calendar and code dimensions are rebuilt from it.
            profile = quality.silver_valid(classified).groupBy(
                FILE, "_source_period", "vendor_id", "rate_code_id", "payment_type_id").agg(
                F.min("pickup_at").alias("pickup_at"), F.max("dropoff_at").alias("dropoff_at"))
            profile_path = self.log_path(PROFILE)
            if pending is not None and sinks.table_exists(self.spark, profile_path):
                kept = sinks.read_table(self.spark, profile_path).join(pending, FILE, "left_anti")
                profile = kept.unionByName(profile)
            sinks.overwrite_table(profile, profile_path, self.root)
        finally:
            if sinks.exists(self.spark, scratch):
                sinks.delete(self.spark, scratch, self.root)
        log = source_file_filter(self.latest(self.load_log(BRONZE)), pending)
        expected = log.agg(F.sum("_rows")).first()[0] or 0
        if v["rows"] + r["rows"] != expected:
            raise RowsLost(f"bronze holds {expected} rows of the loaded files, silver wrote "
                           f"{v['rows']} valid and {r['rows']} rejected")

        def commit() -> None:
            self._log(SILVER, self._upstream_batches(BRONZE, pending), fresh=pending is None)

        periods = None
        if pending is not None:  # months: few, however many files were touched
            touched = v["touched"].unionByName(r["touched"]).select("_source_period").distinct().collect()
            periods = sorted({t[0] for t in touched}, key=str)
        return {"files": n_files, "valid": v["rows"], "rejected": r["rows"], "_periods": periods, "_commit": commit}

    def fact(self, summary: RunSummary, full_refresh: bool) -> dict:
        pending, n_files = self._pending(summary, SILVER, FACT, full_refresh)
        if n_files == 0:
            return {"files": 0, "_months": []}
        silver = source_file_filter(self.table(SILVER), pending)
        rows = (facts.fact_trips(silver).withColumn("_processed_at", F.current_timestamp())
                .withColumn("pickup_month", month_start("pickup_at")))
        out = self._write_by_file(rows, FACT, "pickup_month", pending)
        # Which pickup months each re-loaded file touched (written or removed):
        # gold recomputes those months, also after a failed run.
        batches = self._upstream_batches(SILVER, pending)
        if pending is None:  # no list of months: gold has to be rebuilt as a whole
            logged = batches.withColumn("_months", F.lit(None).cast("array<string>"))
        else:
            months = out["touched"].groupBy(FILE).agg(F.sort_array(F.collect_set("pickup_month")).alias("_months"))
            logged = batches.join(months, FILE, "left").withColumn(
                "_months", F.coalesce("_months", F.array().cast("array<string>")))
        # Fact's own tests run with gold's, and gold's log waits for both.
        self._log(FACT, logged, fresh=pending is None)
        return {"files": n_files, "rows": out["rows"]}

    def lookup_dims(self) -> dict[str, DataFrame]:
        return {"dim_time_of_day": dims.dim_time_of_day(self.spark), "dim_location": dims.dim_location(self.zones)}

    def profile_dims(self) -> dict[str, DataFrame]:
        """Calendar and code dimensions from the per-file profile of silver."""
        profile = self.table(f"_loads/{PROFILE}") if sinks.table_exists(self.spark, self.log_path(PROFILE)) \
            else self.table(SILVER)
        return {
            "dim_date": dims.dim_date(profile),
            **{f"dim_{kind}": dims.complete_code_dim(
                known, profile, f"{kind}_id", f"{kind}_name", f"Unknown {kind.replace('_', ' ')} ")
                for kind, known in self.codes.items()},
        }

    def gold_tables(self) -> dict[str, DataFrame]:
        """All gold tables as plans (full rebuild)."""
        return {"fact_daily_zone_summary": facts.fact_daily_zone_summary(self.table(FACT)),
                **self.profile_dims(), **self.lookup_dims()}

    def _overwrite_all(self, tables: dict[str, DataFrame]) -> dict:
        def build(item):
            name, df = item
            rows = sinks.overwrite_table(df, self.path(f"gold/{name}"), self.root, retention=self.retention)
            self._move(f"gold/{name}")
            return name, rows

        with ThreadPoolExecutor(max_workers=self.gold_threads) as pool:
            return dict(pool.map(build, tables.items()))

    def gold_pending_months(self, summary: RunSummary, full_refresh: bool) -> tuple[list | None, DataFrame | None]:
        """Pickup months whose fact rows changed since gold was last built.

        Gold keeps its own load log; the fact files gold has not seen yet
        (by batch) bring the months they touched, as recorded in the fact
        log. ``None`` = rebuild everything.
        """
        own = self.load_log(SUMMARY)
        if full_refresh or own is None or not self.exists(SUMMARY):
            return None, None
        fact_log = self.latest(self.load_log(FACT))
        pending, n = self._kept(summary, pending_source_files(fact_log, own), "gold")
        if not n:
            return [], pending
        todo = source_file_filter(fact_log, pending)
        if todo.where(F.col("_months").isNull()).take(1):  # fact was rebuilt as a whole
            return None, None
        rows = todo.select(F.explode("_months")).distinct().collect()
        return sorted(r[0] for r in rows), pending

    def gold(self, summary: RunSummary, months: list | None, silver_changed: bool) -> dict:
        """Rebuild gold for what changed.

        ``months`` = pickup months whose fact rows changed (``None`` = all).
        A summary row of day d only depends on fact rows of month(d) (a valid
        trip starts in its file's month), so only those months are recomputed,
        from the fact partitions of those months, and the other months' rows
        are kept from the current summary (one row per day and zone, so it
        stays small however large the facts grow); the result replaces the
        table. Calendar and code dimensions come from the per-file silver
        profile; lookup dimensions are rebuilt when their rows differ.
        """
        out: dict = {}
        full = months is None or not self.exists(SUMMARY)
        tables: dict[str, DataFrame] = {}
        if full:
            tables.update(self.gold_tables())
        else:
            if silver_changed:
                tables.update(self.profile_dims())
            if months:
                fact = self.table(FACT).where(F.col("pickup_month").isin([str(m) for m in months]))
                days = [int(d.strftime("%Y%m%d")) for m in months for d in _days_of_month(m)]
                kept = self.table(SUMMARY).where(~F.col("date_key").isin(days))
                tables["fact_daily_zone_summary"] = kept.unionByName(facts.fact_daily_zone_summary(fact))
        changed_lookups = []
        for name, df in self.lookup_dims().items():
            path = self.path(f"gold/{name}")
            if full or not sinks.table_exists(self.spark, path):
                tables[name] = df
                changed_lookups.append(name)
                continue
            old = sinks.read_table(self.spark, path)
            if not df.exceptAll(old).unionByName(old.exceptAll(df)).isEmpty():
                tables[name] = df
                changed_lookups.append(name)
        out.update(self._overwrite_all(tables))
        out["_changed_lookups"] = changed_lookups
        return out

    # -- catalog ------------------------------------------------------------------
    def publish(self, prefix: str = "lake") -> list[str]:
        """Register every table as ``<prefix>_<layer>.<name>``; returns the names.

        Unpartitioned tables are external Parquet tables. A partitioned one is a view
        over an external table of its current version (``<name>__v<number>``), so that
        moving to another version is one replacement of the view and no reader ever
        sees half of the partitions; layout columns that are no part of the contract
        stay behind it. Every entry carries a comment and properties (see
        :meth:`table_properties`). For tables laid out by pickup month the function
        ``<name>_between(since, until)`` of the same database returns the rows picked up
        from ``since`` on and before ``until`` and reads only their months (Spark takes
        such a function without a database, so ``USE`` it first).

        Only catalog metadata is written; dropping an entry leaves the files alone.
        The prefix is remembered below the root: whenever a run replaces a table, its
        entries are moved to the new version at once, with or without ``publish_prefix``.
        """
        self._remember(prefix)
        return [name for table in TABLE_PARTITIONS if (name := self._register(prefix, table))]

    def table_properties(self, name: str) -> dict[str, str]:
        """What the catalog says about a published table."""
        rows = sinks.read_table(self.spark, self.path(name)).count()  # footers only
        return {
            "lakeline.layer": name.split("/")[0],
            "lakeline.version": sinks.current(self.spark, self.path(name)).rsplit("-", 1)[1],
            "lakeline.partitioned_by": ",".join(TABLE_PARTITIONS[name]),
            "lakeline.rows": str(rows),
        }

    def _register(self, prefix: str, name: str) -> str | None:
        schema = sinks.read_schema(self.spark, self.path(name))
        if schema is None:
            return None
        parts = TABLE_PARTITIONS[name]
        layer, table = name.split("/")
        full = f"{prefix}_{layer}.{table}"
        folder = sinks.current(self.spark, self.path(name))
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}_{layer}")
        properties = self.table_properties(name)
        told = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        comment = f"{table} of the {layer} layer, version {int(properties['lakeline.version'])}"
        columns = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields}
        ordered = ", ".join(columns[c] for c in [*[c for c in columns if c not in parts], *parts])
        if not parts:
            if self._kind(full) == "EXTERNAL" and self.spark.table(full).schema.simpleString() == schema.simpleString():
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{folder}'")
                self.spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({told})")
                self.spark.sql(f"COMMENT ON TABLE {full} IS '{comment}'")
                self.spark.catalog.refreshTable(full)
                return full
            self._forget(full)
            self.spark.sql(f"CREATE TABLE {full} ({ordered}) USING parquet LOCATION '{folder}' COMMENT '{comment}' TBLPROPERTIES ({told})")
            return full
        stored = f"{full}__v{int(properties['lakeline.version'])}"
        if self._kind(full) not in (None, "VIEW"):
            self._forget(full)
        if self._kind(stored) is None:
            self.spark.sql(f"CREATE TABLE {stored} ({ordered}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{folder}'")
        # folder listing only: registers partitions that came and forgets those that went
        self.spark.sql(f"MSCK REPAIR TABLE {stored} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(stored)
        names = ", ".join(f"`{c}`" for c in columns if c not in LAYOUT_ONLY.get(name, ()))
        self.spark.sql(f"CREATE OR REPLACE VIEW {full} COMMENT '{comment}' TBLPROPERTIES ({told}) AS SELECT {names} FROM {stored}")
        if name in MONTH_OF_PICKUP:
            month = MONTH_OF_PICKUP[name]
            returned = ", ".join(columns[c] for c in columns if c not in LAYOUT_ONLY.get(name, ()))
            self.spark.sql(
                f"CREATE OR REPLACE FUNCTION {full}_between(since TIMESTAMP_NTZ, until TIMESTAMP_NTZ) RETURNS TABLE ({returned}) "
                f"RETURN SELECT {names} FROM {stored} WHERE pickup_at >= since AND pickup_at < until "
                f"AND {month} >= trunc(since, 'MM') AND {month} <= trunc(until, 'MM')")
        self._drop_versions(full, keep=stored)
        return full

    def _drop_versions(self, full: str, keep: str) -> None:
        """Forget the entries of versions whose folders are gone."""
        database, table = full.split(".")
        held = {f"{table}__v{n}" for n, _, done in sinks.versions(self.spark, self.path(f"{database.rsplit('_', 1)[1]}/{table}")) if done}
        for t in self.spark.catalog.listTables(database, f"{table}__v*"):
            if t.name not in held and f"{database}.{t.name}" != keep:
                self.spark.sql(f"DROP TABLE {database}.{t.name}")

    def _prefixes(self) -> list[str]:
        path = f"{self.root}/_loads/published"
        return [r[0] for r in sinks.read_table(self.spark, path).collect()] if sinks.table_exists(self.spark, path) else []

    def _remember(self, prefix: str) -> None:
        known = self._prefixes()
        if prefix not in known:
            rows = self.spark.createDataFrame([(p,) for p in sorted({*known, prefix})], "prefix string")
            sinks.overwrite_table(rows.coalesce(1), f"{self.root}/_loads/published", self.root)

    def _move(self, name: str) -> None:
        """Move a table's catalog entries to what is current now, where it is published."""
        for prefix in self._known_prefixes:
            self._register(prefix, name)

    def _kind(self, name: str) -> str | None:
        return self.spark.catalog.getTable(name).tableType if self.spark.catalog.tableExists(name) else None

    def _forget(self, name: str) -> None:
        """Drop the catalog entry of a view or an external table; refuse a managed one."""
        kind = self._kind(name)
        if kind is None:
            return
        if kind not in ("EXTERNAL", "VIEW"):
            raise ValueError(f"{name} exists and is a {kind} table: dropping it would delete its data")
        self.spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")

    def _published(self, summary: RunSummary) -> RunSummary:
        if self.publish_prefix:
            self.publish(self.publish_prefix)
        return summary

    # -- the run --------------------------------------------------------------
    def run(self, full_refresh: bool = False, listing: DataFrame | None = None) -> RunSummary:
        """One run. ``listing`` (``_source_file, _source_modified_at``) replaces
        the landing listing, e.g. the new files of a streaming micro-batch.

        Tests run on what the run changed: bronze/silver on the periods of
        re-loaded files (trip ids can only clash inside one period), fact and
        summary on the changed pickup months, dimensions in full, and the
        relationships to a lookup dimension in full when that lookup changed.
        First loads and full refreshes test whole tables.
        """
        summary = RunSummary(batch_id=uuid.uuid4().hex)
        self._known_prefixes = self._prefixes()
        # The lookup tests only gate the gold dimensions: they run alongside
        # bronze / silver / fact and are awaited before gold.
        lookups_pool = ThreadPoolExecutor(max_workers=1)
        lookup_tests = lookups_pool.submit(self._test, summary, "sources", {
            "zones": self.zones,
            "vendors": self.codes["vendor"],
            "rate_codes": self.codes["rate_code"],
            "payment_types": self.codes["payment_type"],
        })
        lookups_pool.shutdown(wait=False)
        try:
            return self._run_layers(summary, full_refresh, listing, lookup_tests)
        finally:
            wait([lookup_tests])  # never leave test jobs running after the run
            if sinks.exists(self.spark, self._scratch(summary)):
                sinks.delete(self.spark, self._scratch(summary), self.root)

    def _run_layers(self, summary: RunSummary, full_refresh: bool, listing: DataFrame | None,
                    lookup_tests) -> RunSummary:
        b = self._timed(summary, "bronze", lambda: self.bronze(summary, full_refresh, listing))
        if b["files"]:
            bronze = self.table(BRONZE)
            if b["_pending"] is not None:
                bronze = source_file_filter(bronze, b["_pending"])
            self._test(summary, "bronze", {"bronze_yellow_tripdata": bronze})
            b["_commit"]()

        s = self._timed(summary, "silver", lambda: self.silver(summary, full_refresh))
        if s["files"] != 0:
            silver, rejected = self.table(SILVER), self.table(REJECTED)
            if s["_periods"] is not None:
                in_periods = F.col("_source_period").isin(list(s["_periods"]))
                silver, rejected = silver.where(in_periods), rejected.where(in_periods)
            self._test(summary, "silver", {"silver_yellow_trips": silver, "silver_yellow_trips_rejected": rejected})
            s["_commit"]()

        self._timed(summary, "fact", lambda: self.fact(summary, full_refresh))
        lookup_tests.result()  # raises if a lookup test failed: no gold is built
        months, gold_files = self.gold_pending_months(summary, full_refresh)
        owed = months is None or not gold_files.isEmpty()  # fact batches that gold has not seen
        silver_changed = s["files"] != 0 or owed
        g = self._timed(summary, "gold", lambda: self.gold(summary, months, silver_changed))
        gold = {n: self.table(f"gold/{n}") for n in GOLD_DIMS}
        full = {"fact_trips": self.table(FACT), "fact_daily_zone_summary": self.table(SUMMARY), **gold}
        tests = model_tests()["gold"]
        if months is None:  # first load or full refresh: whole tables
            self._test(summary, "gold", full, only=tests)
            return self._gold_done(summary, gold_files, owed)
        facts_models = ("fact_trips", "fact_daily_zone_summary")
        changed = set(g["_changed_lookups"])
        # relationships to a lookup that changed: every fact row is re-checked
        whole = [t for t in tests if t.kind == "relationships" and t.to_model in changed]
        scoped = [t for t in tests if t not in whole and (
            (t.model in facts_models and months)
            or (t.model in LOOKUP_DIMS and t.model in changed)
            or (t.model in PROFILE_DIMS and silver_changed))]
        self._test(summary, "gold", full, only=whole)
        days = [int(d.strftime("%Y%m%d")) for m in months for d in _days_of_month(m)]
        self._test(summary, "gold", {
            **full,
            "fact_trips": full["fact_trips"].where(F.col("pickup_month").isin([str(m) for m in months])),
            "fact_daily_zone_summary": full["fact_daily_zone_summary"].where(F.col("date_key").isin(days)),
        }, only=scoped)
        return self._gold_done(summary, gold_files, owed)

    def _gold_done(self, summary: RunSummary, files: DataFrame | None, owed: bool) -> RunSummary:
        """Gold has seen and tested these fact batches (``None``: all of them)."""
        if owed:
            self._log(SUMMARY, self._upstream_batches(FACT, files), fresh=files is None)
        return self._published(summary)


def picked_up_between(df: DataFrame, month: str, since=None, until=None, column: str = "pickup_at") -> DataFrame:
    """Rows with ``since <= column < until``; the bounds also hold for ``month``, a
    partition column with the first day of the column's month, which prunes the scan."""
    stamp = lambda v: F.lit(v).cast("timestamp_ntz")
    if since is not None:
        df = df.where((F.col(column) >= stamp(since)) & (F.col(month) >= F.trunc(stamp(since), "MM")))
    if until is not None:
        df = df.where((F.col(column) < stamp(until)) & (F.col(month) <= F.trunc(stamp(until), "MM")))
    return df


def _days_of_month(month) -> list:
    import calendar
    import datetime as dt

    first = month if isinstance(month, dt.date) else dt.date.fromisoformat(str(month))
    n = calendar.monthrange(first.year, first.month)[1]
    return [first.replace(day=i) for i in range(1, n + 1)]
