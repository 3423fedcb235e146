"""SparkSession helpers shared by tests, bench and examples."""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "lapline") -> SparkSession:
    """Session tuned for the lapline operators.

    AQE is on so that join strategies (broadcast vs sort-merge), partition
    coalescing and skew splitting are decided from runtime statistics.
    """
    # driver memory only takes effect when the JVM is launched
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files go with the tables that they hold
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory that ``spark.checkpoint.dir`` names.

    On a cluster it must be set, to a folder that all machines share; only a
    local session (one machine, as in tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="lapline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once for each application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/lapline-code", "zip", root, "lapline"))
        _shipped.add(app)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
