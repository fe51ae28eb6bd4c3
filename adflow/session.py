"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Fits a laptop run; on a cluster the submit configuration wins, because only
# keys it leaves unset are filled in.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when it costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of code; split those.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state on local disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Do not record the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "adflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``conf`` set, and ``DEFAULTS`` where neither it nor the submit
    configuration sets a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(list(conf.items())))
    given = {key for key, _ in SparkConf().getAll()} | set(conf)
    active = SparkSession.getActiveSession()
    for key, value in DEFAULTS.items():
        if key not in given and (active is None or active.conf.get(key, None) is None):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared base."""
    return f"{shared_base(spark)}/adflow/{label}-{uuid.uuid4().hex[:12]}"


def temp_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose tables live below the shared base."""
    name = f"adflow_{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_dir(spark, name)}'")
    return name
