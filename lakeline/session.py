"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on or benefit from. Applied only where the
# session has no value yet, so a cluster's own configuration wins.
_LOCAL_ROOT_KEY = "lakeline.local.checkpointRoot"

# HotSpot never compiles a method of more bytes than this, and the generated loop over rows
# as wide as trips is longer; beyond the limit Spark runs the stage by smaller methods.
_CODEGEN_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    _CODEGEN_LIMIT[0]: _CODEGEN_LIMIT[1],
}


def build_session(master: str = "local[*]", app: str = "lakeline",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans show whole filters
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def submitted_session(app: str = "lakeline") -> SparkSession:
    """The session of ``spark-submit`` (or the active one), its settings untouched.

    Only recommended SQL settings that nobody has set are added."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName(app).getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in RECOMMENDED_CONF.items():
        if k not in given and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def compile_wide_rows(spark: SparkSession) -> None:
    """Let the session's generated code stay within what the JVM compiles, unless its
    configuration says otherwise. This changes no result, only how long rows take."""
    key, value = _CODEGEN_LIMIT
    if spark.sparkContext.getConf().get(key, None) is None:
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage; without it every
    executor would write to its own disk, so that is an error. Only a local
    master (tests, benchmarks) gets a fresh folder of this machine.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get(_LOCAL_ROOT_KEY, None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is not set; on {master} it must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="lakeline-ckpt-", dir="/tmp")
        spark.conf.set(_LOCAL_ROOT_KEY, root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_CREATED: dict[str, list[str]] = {}  # application id -> scratch folders handed out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _CREATED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this application created; forget cached layers.

    Only folders handed out by :func:`scratch_path` in this application are
    removed, and only below the checkpoint root. Returns how many existed.
    """
    from lakeline.operators import sinks
    from lakeline.plans import catalog, models
    from lakeline.sources import fixture

    app = spark.sparkContext.applicationId
    root = checkpoint_root(spark)
    removed = 0
    for path in _CREATED.pop(app, []):
        if sinks.exists(spark, path):
            sinks.delete(spark, path, root)
            removed += 1
    for cache in (fixture._MATERIALIZED, models._STORED, catalog._LANDING):
        for key in [k for k in cache if k[0] == app]:
            del cache[key]
    return removed
