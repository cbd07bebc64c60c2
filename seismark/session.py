"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "seismark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on.

    The time zone is pinned because ``from_unixtime`` and ``date_format`` read it. Shuffle
    partitions are left to the cluster: adaptive execution coalesces them from the real sizes.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a write by outcome or day keeps that many files open instead of sorting its rows first
        .config("spark.sql.maxConcurrentOutputFileWriters", "40")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder named by ``spark.checkpoint.dir``.

    Every executor must be able to read what another one wrote, so a machine-local folder is
    used only for a local master with the setting absent.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="seismark-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder, in whatever store it lies."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
