"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "terrane") -> SparkSession:
    """A session tuned for the analytics plans.

    AQE re-plans joins from runtime sizes, coalesces small shuffle partitions and
    splits skewed ones; the UI stays off (no listening port).
    """
    master = master or os.environ.get("TERRANE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TERRANE_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as given. Only a local
    session without one (tests, a laptop) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="terrane-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
