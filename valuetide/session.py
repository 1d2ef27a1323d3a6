"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Only settings whose Spark default is wrong for wide, skewed inputs.  Shuffle
# partition counts stay with the cluster: AQE coalesces a generous setting, so
# the job never hard-codes one.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "valuetide", master: str | None = None, **conf) -> SparkSession:
    """Session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only where the setting is absent *and* the
    session is local; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    folder = tempfile.mkdtemp(prefix="valuetide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop ``path`` when the driver's JVM ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


# Tables up to this size by the optimizer's estimate go to every executor.
BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size by the optimizer's estimate, for a plain scan that of its files; huge if unknown."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small by its plan's estimate; an unknown size is a large one."""
    return estimated_bytes(df) <= limit


# Stored bytes of a table that one task of a dealt exchange takes.
PIECE_BYTES = 8 << 20
UNKNOWN_BYTES = 1 << 60


def pieces_of(table: DataFrame) -> list[int]:
    """``[n]``: into how many pieces a table is dealt; empty, as the session does, for an unknown size.

    The number grows with the table, so no piece does.  Narrow rows compress so
    well that a partition of adaptive execution's own size holds millions of
    them, more than one task wants to join and to group at once.
    """
    size = estimated_bytes(table)
    return [max(1, -(-size // PIECE_BYTES))] if size < UNKNOWN_BYTES else []
