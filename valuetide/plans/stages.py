"""Finished stages of a run, keyed by the content of its inputs.

A stage's table is written first and its mark last.  The mark holds the run's
key, a digest of what the run reads and is asked for; a later run with the same
key reads finished stages instead of computing them, whatever folder or layout
its inputs have, and any other key computes them again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import row_hashes
from ..sources import sinks


def content(df: DataFrame) -> list:
    """Schema, rows and an order-independent digest of ``df``, in one scan."""
    first, second = row_hashes(df.columns)
    hashed = df.select(first.alias("a"), second.alias("b"))
    row = hashed.agg(
        F.count("*").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("a", "b")]
    ).first()
    return [df.schema.json(), row["n"], str(row["a"]), str(row["b"])]


def run_key(inputs: dict[str, DataFrame], **asked) -> str:
    """Digest of the inputs' content and of what is asked for."""
    parts = [[name, content(df)] for name, df in sorted(inputs.items())]
    return hashlib.sha256(json.dumps([parts, asked], sort_keys=True, default=str).encode()).hexdigest()


class Stages:
    """Tables of one run below ``folder``; finished ones are read."""

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.folder, self.key = spark, folder, key

    def _mark(self, name: str) -> str:
        return f"{self.folder}/_stages/{name}"

    def finished(self, *names: str) -> bool:
        return all(self._key_of(n) == self.key for n in names)

    def _key_of(self, name: str) -> str | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._mark(name)}/_SUCCESS")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.parquet(self._mark(name)).first()["key"]

    def table(self, name: str, make: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        """The stored table; ``make`` is called only where it is not finished."""
        path = f"{self.folder}/{name}"
        if not self.finished(name):
            sinks.write_parquet(make(), path, partition_by)
            sinks.write_parquet(self.spark.createDataFrame([(self.key,)], "key string"), self._mark(name))
        return self.spark.read.parquet(path)
