"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_RUNTIME_SETTINGS = {
    # all month and day logic is done in one zone
    "spark.sql.session.timeZone": "UTC",
    # loosely typed documents may repeat a key in another spelling; the last one counts
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep small shuffles spread over the cores; large ones are far above this size anyway
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64kb",
    # documents take many times their compressed size in memory: a task's share must still sort without a spill
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "512k",  # small files are packed as many to a task as before
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}
# Shuffles start with no fewer partitions and are merged by size; a caller's larger number stands.
_INITIAL_PARTITIONS = 400
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings. Sizing (cores, memory, shuffle partitions) is left to the caller."""
    for key, value in _RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(_INITIAL, None) is None:
        spark.conf.set(_INITIAL, max(_INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is used only when Spark itself runs on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="pactlens-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
