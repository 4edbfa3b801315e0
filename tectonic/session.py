"""SparkSession construction and session-scoped settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on: ANSI casts (so every cast from raw text
# must be a try_* form), a pinned UTC zone (the event key hashes timestamp strings) and AQE.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # strict java.time parsing for the event time; standard decimal result scales for shares
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tectonic",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides; ``shuffle_partitions``
    should then be sized so one partition of the largest shuffle fits an executor core
    (AQE coalesces the small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Session-level SQL settings also apply when the session already existed.
    for key, value in conf.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    A cluster names it with ``spark.checkpoint.dir`` (shared storage: HDFS or an object
    store), which Spark applies when the context starts; a folder set later with
    ``setCheckpointDir`` is honoured too. Only a local master may go without: there a private
    temporary folder is registered; on a cluster such a folder would be lost or unseen by
    the executors, so its absence is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tectonic-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for staged/intermediate tables next to the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)
