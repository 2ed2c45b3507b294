"""Session helpers shared by tests, bench and jobs."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | None = None, app: str = "quarryline", **conf: str) -> SparkSession:
    """A local session with the settings the operators expect; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus or os.cpu_count() or 4}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRYLINE_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a local one only where none is set."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN_FOLDER:
            own = tempfile.mkdtemp(prefix="quarryline-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _OWN_FOLDER.append("file://" + own)
        folder = _OWN_FOLDER[0]
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager)
