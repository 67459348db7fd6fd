"""Session settings the library relies on, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED_CONF = {
    # time stays zone-less (TIMESTAMP_NTZ); UTC keeps the few zoned intermediates harmless
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tables laid out by (tile, salt) may join on (tile, salt, src_idx) where they lie
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # replace only the day partitions a job wrote
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spherecube-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path for an intermediate table under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for a broadcast join when it has at most ``max_rows`` rows.

    The table is fixed and counted first. Left to itself Catalyst cannot know that an axis derived
    from a huge cube is short, and would shuffle the cube to join it. A table beyond the limit is
    returned as it is and joined by shuffle.
    """
    fixed = cut_lineage(df)
    return F.broadcast(fixed) if fixed.count() <= max_rows else fixed
