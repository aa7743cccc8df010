"""Session helpers.

Library code never fixes partition counts or memory; those are deploy-time
settings.  ``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "chainsight",
                  shuffle_partitions: int = 8, driver_memory: str = "16g") -> SparkSession:
    """A local session with AQE on; a checkpoint folder only when none is set."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chainsight-ckpt-"))
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``,
    else whatever the SparkContext was already pointed at (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Point the SparkContext at the session's checkpoint folder, if one is named.

    Returns the folder, or None when neither the session nor the context has
    one (then callers run without lineage cuts rather than invent a local path).
    """
    path = checkpoint_dir(spark)
    if path is not None:
        spark.sparkContext.setCheckpointDir(path)
    return path
