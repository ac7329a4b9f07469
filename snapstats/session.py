"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Applied to every session the library is handed; all are runtime settings.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows of ids and counts unfold to some 15 times their shuffled size in sorts and hash maps, several of which a task holds at
    # once; and a table of few buckets is written by as many tasks as it has parts of this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that carry their whole text, or the same ids and times again and again, take a fraction of what the default leaves.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # So many keys of a small batch reach the Parquet files one by one, where Bloom filters answer.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on an existing session and return it.

    Shuffle partition counts and memory are left to whoever sized the cluster.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "snapstats", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Session for a job of our own; on a cluster `master` comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read, named by the cluster in `spark.checkpoint.dir`.

    A local session without that setting (a test run) gets a folder of its own, which is set for the
    rest of the session. On a cluster a missing setting is an error: a folder of one machine would lose files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder
