"""Session settings and the shared working folder.

Nothing here picks a cluster size.  The settings only make sure adaptive execution may re-plan
joins, split skewed partitions and coalesce small ones, and that clocks are read in UTC.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A third of the rows on one key is the planning assumption, so split earlier than the default
    # factor of 5 would.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Split a hot key even where the grouping after the join then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Full outer joins of pre-aggregated legs are small; everything else is decided by size.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "boxledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only where the setting is absent (a local test session) is a temporary folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = os.path.join(tempfile.gettempdir(), "boxledger-shared")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is written yet."""
    return f"{shared_dir(spark)}/boxledger/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint in the shared folder: survives the loss of any executor."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
