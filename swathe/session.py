"""Settings the operators are written for, and a shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed values. Adaptive execution picks partition counts and joins from
# measured sizes and splits skewed partitions. A join may be split even where
# that costs one more shuffle above it. Small shuffles keep more tasks than by
# default, because polygon and distance tests are costly per row.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


class NoSharedFolder(ValueError):
    """A cluster without ``spark.checkpoint.dir``."""


# Shuffle data per task to aim for.
BYTES_PER_TASK = 128 << 20


def configure(spark: SparkSession, data_bytes: int | None = None) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session.

    Adaptive execution can merge shuffle partitions but not add any. Pass the
    size of the data about to be shuffled to start with enough of them.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if data_bytes is not None:
        now = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", max(now, -(-data_bytes // BYTES_PER_TASK)))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a local master. On a cluster
    it would be another folder on every machine, so that is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not (context.master or "").startswith("local") or context.master.startswith("local-cluster"):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="swathe-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
