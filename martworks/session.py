"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every plan of this package relies on. They can be set on a session that someone else built.
# Joins are left to Catalyst: a side is broadcast only when its measured size is under the threshold, otherwise
# the join is shuffled and AQE splits hot partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Sizing for a large cluster: many small initial shuffle partitions, merged by AQE to about 256 MB each.
CLUSTER_SIZING = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}

# Codecs of what is written: digests hold four bits in each character, and JSON and CSV repeat names and days.
TABLE_CODEC, TEXT_CODEC = "zstd", "gzip"
# Records of one landed file. A compressed file is read by one task.
FILE_RECORDS = 250_000


def build(app_name: str = "martworks", master: str | None = None, cores: int = 8) -> SparkSession:
    """Session for a cluster (``master=None``) or for a ``local[n]`` master."""
    builder = SparkSession.builder.appName(app_name)
    # Call-site capture costs several round trips for each column expression of a plan.
    settings = {**SETTINGS, "spark.python.sql.dataFrameDebugging.enabled": "false"}
    if master is None:
        settings.update(CLUSTER_SIZING)
    else:
        builder = builder.master(master)
        settings.update({
            "spark.sql.shuffle.partitions": str(cores),
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        })
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session, leaving its sizing alone."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster shares (``spark.checkpoint.dir``).

    A machine-local folder is used only by a local master that names no folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/martworks/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Hold one runtime setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
