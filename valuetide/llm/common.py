"""Shared pieces of the corpus operators: words, stored frames, row keys."""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import repeat
from operator import is_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_at_exit, scratch_path

# Fixed value: a word is a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder, read it back, delete it at the end.

    Later jobs start from stored rows, so a lost executor costs a re-read, and
    nothing is computed twice.  The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def row_key(text: str = "text") -> Column:
    """What tells rows of one ``doc_id`` apart; NULL and '' differ."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))


class Recent:
    """Values of recent keys, in two generations of at most ``size`` keys.

    When the young one is full it becomes the old one; what is still in use
    moves back, so a stream of rare keys does not drive out the frequent ones.
    """

    def __init__(self, make: Callable[[list], list], size: int):
        self.make, self.size = make, size
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, keys: list) -> list:
        found = list(map(self.young.get, keys))
        # By identity: a value may be an array, which compares by element.
        if any(map(is_, found, repeat(None))):
            self._fetch({k for k, v in zip(keys, found) if v is None})
            found = list(map(self.young.__getitem__, keys))
            if len(self.young) > self.size:
                self.old, self.young = self.young, {}
        return found

    def _fetch(self, missing: set) -> None:
        kept = {k: self.old[k] for k in missing if k in self.old}
        self.young.update(kept)
        rest = [k for k in missing if k not in kept]
        self.young.update(zip(rest, self.make(rest)))


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def pick_rows(docs: DataFrame, picks: DataFrame) -> DataFrame:
    """``docs`` with every row as often as ``picks`` says.

    ``picks`` has a row for each pair of ``doc_id`` and ``key`` (see
    ``row_key``) that stays: ``rows`` says how many rows of ``docs`` have this
    pair, ``copies`` how many shall come of them.  Rows equal in id and text
    are interchangeable.  Only this join moves texts; it is dealt by id, so no
    source or group is hot.
    """
    wanted = picks.filter("copies > 0").select(
        F.col("doc_id").alias("__id"),
        F.col("key").alias("__want"),
        F.col("copies").alias("__copies"),
        F.col("rows").alias("__rows"),
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = Window.partitionBy("__id", "__want").orderBy("__id", "__want")
    return (
        docs.withColumn("__key", row_key())
        .join(
            wanted,
            F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__key").eqNullSafe(F.col("__want")),
        )
        .withColumn("__rank", F.row_number().over(same))
        .withColumn(
            "__copies",
            F.expr("CAST(__copies DIV __rows AS INT) + IF(__rank <= __copies % __rows, 1, 0)"),
        )
        .withColumn("__each", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
        .select(*columns)
    )
