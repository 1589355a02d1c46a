"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import posixpath
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "relayline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with UTC time, AQE on and the web UI off.

    On a cluster ``master`` is left to spark-submit; the local default is
    only for tests and the bench.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.maxMetadataStringLength": "1000",  # printed plans show pushed filters whole, not their first 97 characters
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Set the session's time zone to UTC: payload timestamps are labelled 'Z'."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def bound_arrow_batches(spark: SparkSession, most: int = 2 << 20) -> None:
    """Let Arrow batches on their way to Python workers end after ``most``
    bytes. Spark's own bounds, 10,000 rows and 64 MB, let an executor's buffers
    follow the length of the texts, in the JVM and in each worker. A smaller
    bound that is set already stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    set_now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m"))
    if not 0 < set_now <= most:
        spark.conf.set(name, str(most))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read
    here (unset on a cluster is an error). Only in local mode with the
    setting unset (tests) a scratch folder is created.
    Spark checkpoints RDDs in a per-application subfolder; this returns the
    folder above it, so tables written here can be found by later sessions.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder: executors on other "
                                   "machines cannot read a driver-local scratch folder")
            configured = tempfile.mkdtemp(prefix="relayline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(configured)
    return posixpath.dirname(sc.getCheckpointDir().rstrip("/"))
