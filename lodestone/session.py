"""Session helpers: local sessions for tests and benches, shared scratch space, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "lodestone", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches. On a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder: on a cluster the folder has to be
    reachable from every executor, so a missing setting is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="lodestone-")
    context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/lodestone-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, key: str | None = None) -> DataFrame:
    """The rows dealt anew over the session's partitions, by ``key`` or by their own order.

    Costly work keeps the partitions it is given. Those of a file are as few as its row groups, and
    one task would do the work of a whole group.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                2 * spark.sparkContext.defaultParallelism)
    return df.repartition(parts) if key is None else df.repartition(parts, key)
