"""Session settings for local runs, and the shared working folder every job uses for files of its own."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app_name: str = "chunklake", **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster the session is given; nothing here is needed there."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, benches on one machine) a temporary folder is chosen and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="chunklake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root.rstrip("/"), f"{purpose}-{uuid.uuid4().hex}")
