"""Session helpers: settings for stand-alone use and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app_name: str = "siteatlas") -> SparkSession:
    """A session for tests and benchmarks on one machine. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not configured:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="siteatlas-")
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    return configured or current


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/siteatlas/{name}-{uuid.uuid4().hex}"


ARROW_BYTES = 2 << 20


def bound_arrow_batches(spark: SparkSession) -> None:
    """Let the session send at most ``ARROW_BYTES`` of texts to Python at a time, unless it is set to less already.

    Both sides hold a batch more than once, and executors keep several Python workers.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(name, f"{ARROW_BYTES}b")


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def persist_reliably(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage; survives the loss of executors.

    What the plan shuffled is not read again after that, so its files go at once instead of with the driver's next
    garbage collection. Spark reads this setting when a DataFrame is built, hence the ``select``; the session gets its own value back.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
