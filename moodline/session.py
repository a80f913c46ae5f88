"""Session helpers: a local session for tests and bench, and shared scratch space."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "moodline", **conf: str) -> SparkSession:
    """Session for tests and for ``bench.py``; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without the setting; it then gets a temporary
    folder of its own, kept for the life of the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="moodline-"))
    return spark.sparkContext.getCheckpointDir()


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
