"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "moodframe") -> SparkSession:
    """Session used by tests and the bench. Arguments win; every other setting
    is filled in only where the submitter (``spark-submit``, defaults file) has
    left it unset."""
    conf = SparkConf()
    wanted = {
        "spark.master": os.environ.get("MOODFRAME_MASTER", "local[8]"),
        "spark.sql.shuffle.partitions": os.environ.get("MOODFRAME_SHUFFLE_PARTITIONS", "8"),
        "spark.driver.memory": os.environ.get("MOODFRAME_DRIVER_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # files of several row groups are read by every core; a row group is never split
        "spark.sql.files.minPartitionNum": os.environ.get("MOODFRAME_MIN_SPLITS", "8"),
    }
    wanted = {k: v for k, v in wanted.items() if not conf.contains(k)}
    if master:
        wanted["spark.master"] = master
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = SparkSession.builder.appName(app_name).config(map=wanted).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local session may do without it: it then gets
    a fresh folder of its own. On a cluster an unset folder is an error, because
    executors would each write to their own disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="moodframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused, never cleared)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/moodframe/{name}-{uuid.uuid4().hex[:12]}"

