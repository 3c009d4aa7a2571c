"""Session helpers: a sane local session for tests/bench and a shared work dir.

On a cluster the session comes from the platform; nothing here overrides a
setting that is already present.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    # small local inputs: let AQE keep several post-shuffle tasks busy
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.driver.memory": "16g",
}


def local_session(master: str | None = None, app: str = "cohort_effects", **conf) -> SparkSession:
    """Build (or reuse) a local session for tests and the benchmark."""
    builder = SparkSession.builder.master(master or "local[8]").appName(app)
    for key, value in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; we set our own only
    when it is unset and the master is local, as in tests.  Elsewhere a folder
    of one machine would lose rows, so an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current and not fallback and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not current:
        current = fallback or os.path.join("/tmp", f"cohort_effects_ckpt_{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never a node-local tmp)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "cohort_effects_work", uuid.uuid4().hex[:12], *parts])


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes made meanwhile drop their shuffle files as soon as they are done.
    Otherwise these lie on the executors' disks until the driver's garbage
    collection finds their plan unused, those of all steps of a query at worst."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


# Settings for large inputs (hundreds of TB on many executors).  Applied only
# where the cluster has not set them already.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    # start with many shuffle partitions; AQE coalesces small ones at run time
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_scale_conf(spark: SparkSession, conf: dict | None = None) -> dict:
    """Set the large-input settings that are not already set; returns what
    was applied."""
    applied = {}
    for key, value in (conf or SCALE_CONF).items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
            applied[key] = value
    return applied
