"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Stored instants are read and cut into days in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Days and minutes are cut in UTC; another zone would move them without a word."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"the session time zone is {zone}; set it to UTC (session.pin_utc)")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach, deleted when the session ends.

    Lies under ``spark.checkpoint.dir`` as set by the cluster.  Only a session on one machine
    may do without that setting, and uses its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("changeflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
