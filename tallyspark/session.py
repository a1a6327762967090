"""Session construction and the few settings every model relies on."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# The "today" used by tests, the oracle and the bench (FIXTURES.md).
AS_OF_TEST = dt.date(2001, 6, 15)

# Settings the models depend on for *correct* results.
_REQUIRED = {
    # every date/timestamp rule is written for UTC midnights
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for *fast* results at scale; applied only when unset so a
# cluster's own tuning wins.
_TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even where what follows must then be shuffled once more: without
    # skew, joins and the aggregates behind them share one shuffle (operators.revenue)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # an invoice becomes up to twelve rows behind its join: split from one task's usual size on
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
}


def ensure_session_conf(spark: SparkSession) -> SparkSession:
    """Apply the required settings; fill in tuning defaults that are unset.

    Also make sure ``spark.checkpoint.dir`` names a folder: on a cluster it is
    set by the cluster (a shared file system); only when it is unset, as in
    local tests, a scratch folder is chosen here.
    """
    for k, v in _REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in _TUNING.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised models and checkpoints.

    Read from the session (``spark.checkpoint.dir``); set to a fresh local
    scratch folder only when the session has none (local runs and tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every "
                               "executor can reach (HDFS, object store) before building models")
        path = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyspark") -> SparkSession:
    """Build (or reuse) a session configured for the models.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` only when none is
    configured; under spark-submit pass nothing and the submitted master is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not SparkConf().contains("spark.master"):
        # plain `python` run: no master from spark-submit or spark-defaults
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g")))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session_conf(spark)
