"""Session helpers: recommended settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the one spark-submit gives you."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("recordflow")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    share_package(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever Spark was started, as far as they see this folder."""
    root = str(Path(__file__).resolve().parent.parent)
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


UTC_NAMES = {"UTC", "Etc/UTC", "Etc/UCT", "UCT", "Etc/GMT", "GMT", "GMT0", "Zulu", "Universal", "Z", "+00:00"}


def require_utc(spark: SparkSession) -> None:
    """Stop a job whose times would be read in another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC for this job; it is {zone}")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one is set only where the cluster names none."""
    context = spark.sparkContext
    configured = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="recordflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint, so a lost executor never loses the loop state."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
