"""Session helpers.

`get_session` is for tests and local runs. On a cluster the caller owns the session; the
library only reads settings from it (checkpoint folder, shuffle partitions).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hourglass")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names a shared folder in `spark.checkpoint.dir`; we use it as given. Only
    when it is unset (tests, local runs) do we make one of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    # unset (tests, a laptop): a stable local folder, so later applications reuse what
    # earlier ones wrote; on a cluster the setting names a shared folder. The setting
    # itself cannot change at runtime, so only the context's folder is set here.
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        configured = os.path.join(tempfile.gettempdir(), "hourglass-checkpoints")
    if configured.startswith("/"):
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession) -> str:
    """The shared folder itself, as named by `spark.checkpoint.dir`.

    `SparkContext.getCheckpointDir()` is a fresh per-application subfolder of it; tables
    that should outlive one application (materialized stand-in sources) go under the
    named folder instead."""
    app_dir = ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    # set through SparkContext.setCheckpointDir only: its per-application subfolder's parent
    return app_dir.rstrip("/").rsplit("/", 1)[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared checkpoint folder.

    Used where a plan is read many times downstream (the ledger); survives executor loss
    because the data is in the shared folder, not on a local disk.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
