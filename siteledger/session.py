"""Session settings the operators are designed around."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter to the plans.  The number of shuffle partitions is only
# a starting point: AQE coalesces small ones and splits skewed ones.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture on every column expression slows plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "siteledger", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Start (or join) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(PLAN_SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local session, whose tasks and driver are one machine, may leave it unset
    (tests, a laptop); it gets a temporary folder, remembered in its configuration.
    Anywhere else a missing setting is an error: a local folder would not be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.siteledger.scratch", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="siteledger-")
        spark.conf.set("spark.siteledger.scratch", configured)
    return configured.rstrip("/")


def release_intermediates(spark: SparkSession) -> None:
    """Delete everything this application wrote to the shared folder.

    For the end of a job: frames built on written intermediates can't be read afterwards.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{context.applicationId}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding the cluster's choice."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
