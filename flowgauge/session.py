"""Session defaults and the shared folder for tables that outlive one job."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("flowgauge")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a scratch folder only in local mode."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="flowgauge-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder that belongs to this application only."""
    return "/".join([shared_folder(spark), "flowgauge", spark.sparkContext.applicationId, *parts])
