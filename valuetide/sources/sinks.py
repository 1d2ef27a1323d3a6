"""Writers: Parquet and CSV results, catalog tables, JDBC, metrics, models."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..session import delete_at_exit, scratch_path
from . import schemas
from .published import create_tables, refresh_tables  # noqa: F401
from .readers import DATE_FORMAT, TIMESTAMP_FORMAT

# Rows per insert batch of the relational sink.
BATCH_ROWS = {
    "users": 5000,
    "events": 5000,
    "transactions": 5000,
    "user_snapshots": 3000,
    "customer_predictions": 3000,
}


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    What follows starts from stored rows: tasks carry no long lineage, and a
    lost executor costs a re-read.  The files go when the driver's JVM ends.
    """
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path, partition_by)
    delete_at_exit(df.sparkSession, path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export; NULL stays an empty cell so censored values remain blank."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("dateFormat", DATE_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric rows as JSON, NULLs included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_jdbc(frames: dict[str, DataFrame], url: str, **options: str) -> None:
    """Full refresh of an external database: truncate and append in batches.

    All five tables are emptied, children before parents, whether or not a
    frame is given; those given are then filled, parents first.  Some databases
    refuse to truncate a table that foreign keys point to even when it is
    empty: switch the checks off for the connection there, e.g. with
    ``?sessionVariables=foreign_key_checks=0`` in a MySQL ``url``.
    """
    for table, frame in jdbc_steps(frames):
        if frame is None:
            spark = next(iter(frames.values())).sparkSession
            writer = jdbc_writer(schemas.empty(spark, table), table, url, **options)
            writer.mode("overwrite").option("truncate", True).save()
        else:
            jdbc_writer(frame, table, url, **options).mode("append").save()


def jdbc_steps(frames: dict[str, DataFrame]) -> list[tuple[str, DataFrame | None]]:
    """What a full refresh does in turn: empty a table (None) or append a frame."""
    empty = [(t, None) for t in reversed(schemas.TABLES)]
    return empty + [(t, frames[t]) for t in schemas.TABLES if t in frames]


def jdbc_writer(df: DataFrame, table: str, url: str, **options: str):
    return (
        schemas.conform(df, table)
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", BATCH_ROWS[table])
        .options(**options)
    )


def save_models(models: dict[str, PipelineModel], folder: str) -> None:
    """Save each below ``folder``, side by side: most of the time goes to the driver's part of it."""

    def save(name: str) -> None:
        models[name].write().overwrite().save(f"{folder}/{name}")

    side_by_side(save, models)


def side_by_side(work: Callable[[str], object], names: Iterable[str]) -> list:
    """``work`` of each name, as concurrent Spark jobs."""
    names = list(names)
    spark = SparkSession.active()
    with ThreadPoolExecutor(min(8, len(names) or 1)) as pool:
        return [r.result() for r in [pool.submit(inheritable_thread_target(spark)(work), n) for n in names]]
