"""Spark session helpers.

Library code never creates a session on its own; these helpers exist for
tests, the benchmark and command-line use.  On a cluster the session is
built by the job and only ``require_checkpoint_dir`` is used.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.  The UTC session zone is a
# correctness setting: hour buckets and directory names are defined in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Loaded directories carry string partition values (dt=20240101/hr=00);
    # inference would turn them into ints and drop the leading zero.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "tidewater",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for k, v in {**REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators rely on."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """What runs meanwhile hands rows to Python workers in batches of about ``size`` at most: a batch
    stands several times in an executor's memory, for each of its tasks."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def require_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or an earlier
    ``setCheckpointDir``).  Only when neither is set — local tests — a
    fallback is installed; on a cluster a machine-local temp folder would not
    survive executor loss, so callers there must configure the setting.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if fallback is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required")
        fallback = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir()


_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package (no-op when it is installed there).

    Worker processes get ``sc.environment`` at UDF creation, so adding the
    package root to its PYTHONPATH is enough in local mode; on a cluster the
    package is installed on the executors or shipped with ``--py-files``.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _PACKAGE_ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_PACKAGE_ROOT, *parts])
