"""Session settings and the few driver-side helpers the operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a dimension (features, transcripts, chain blocks) may be broadcast. At about
# 200 bytes a row this is 100 MB, well under Spark's own 8 GB limit for a broadcast relation.
BROADCAST_MAX_ROWS = 500_000

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partitions measured to be small are hash-joined instead of sorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.caseSensitive": "false",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are tuned for; cluster sizing stays with the caller."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster, whose executors could not read one, is an
    error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="siteloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of an iterated DataFrame with a reliable (replayable) checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table or text file another step of the same job reads back."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows that a plan needs more than once to the shared folder, and read them back: a replayable cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` is proven to hold at most ``max_rows`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only for a side whose size was checked; larger sides keep a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
