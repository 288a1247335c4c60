"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint dir, memory) belong to the
deployment; the defaults here only apply when a value is unset, as in tests
and local benchmarks.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE for runtime coalescing and skew-join
# splitting, UTC so timestamps compare with the DuckDB oracle, Arrow for the
# few pandas UDFs.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # broadcast joins are chosen explicitly behind a size check; Catalyst's
    # own threshold stays at its conservative default
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vitrine") -> SparkSession:
    """Return the active session or build a local one for tests/benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    master = master or os.environ.get("VITRINE_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in _BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    builder = builder.config("spark.driver.memory", os.environ.get("VITRINE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``.  Where it is unset, a
    local master gets a scratch folder (tests, bench); a cluster raises."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # one process: its own scratch folder is shared by driver and executor
    local = tempfile.mkdtemp(prefix="vitrine-ckpt-", dir=os.environ.get("VITRINE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vitrine`` importable in Python workers (pandas UDFs,
    ``applyInPandas``) wherever the driver runs from: zip the package once per
    application and hand it to ``addPyFile`` (Spark distributes it)."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import vitrine
    root = os.path.dirname(os.path.abspath(vitrine.__file__))
    fd, path = tempfile.mkstemp(suffix=".zip", prefix="vitrine-pkg-")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
