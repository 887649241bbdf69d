"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that the plans rely on.  Partition counts are left to AQE: it starts from a
# high initial number and merges small shuffle blocks up to the advisory size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM interprets, and never compiles, methods above 8000 bytes.  Projections that would
    # generate one are then run from several smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "mediatide", master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS; `extra` uses '__' for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can read, as named by spark.checkpoint.dir.

    Only a local master may go without it; on a cluster a temporary folder of one
    machine would be invisible to the others, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="mediatide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one run, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/mediatide/{name}-{uuid.uuid4().hex}"
