"""Full refresh of the catalog tables as one publication.

A refresh writes all five tables into the folder of its own run, below the
database's location, and touches nothing that is read.  Then one change of the
database's properties names the run: that is the switch.  The tables' locations
follow; a refresh that broke off among them is finished by whoever comes next
(``recover``).  A failure before the switch leaves every table as it was, and
``tables`` gives one run's five tables even while locations are moving.

The run before stays for queries that are under way; older ones are deleted, as
are folders of runs that never came to their switch.  One writer at a time is
assumed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas

RUN, EARLIER, PLACED = "valuetide.run", "valuetide.earlier", "valuetide.placed"


def create_tables(spark: SparkSession, database: str) -> None:
    """The five tables of the data model, if they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, columns in schemas.TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet")


def _properties(spark: SparkSession, database: str) -> dict[str, str]:
    told = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").where("info_name = 'Properties'").first()
    return dict(re.findall(r"\((valuetide\.\w+),\s*(\w*)\)", told["info_value"] if told else ""))


def _set(spark: SparkSession, database: str, **values: str) -> None:
    pairs = ", ".join(f"'valuetide.{k}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ({pairs})")


def _folder(spark: SparkSession, database: str, run: str = "") -> str:
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{home}/_runs/{run}".rstrip("/")


def _aligned(frame: DataFrame | None, table: str, spark: SparkSession) -> DataFrame:
    """All columns of the table in order, NULL where the frame has none."""
    if frame is None:
        return schemas.empty(spark, table)
    frame = schemas.conform(frame, table)
    columns = [
        F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.struct(table).fields
    ]
    return frame.select(*columns)


def stage(spark: SparkSession, database: str, frames: dict[str, DataFrame]) -> str:
    """Write all tables of a new run, parents before children; the run's name."""
    run = uuid.uuid4().hex[:16]
    for table in schemas.TABLES:
        aligned = _aligned(frames.get(table), table, spark)
        aligned.write.mode("overwrite").parquet(f"{_folder(spark, database, run)}/{table}")
    return run


def switch(spark: SparkSession, database: str, run: str) -> None:
    """Publish a staged run: one change of the catalog, which ``recover`` follows up."""
    _set(spark, database, run=run, earlier=_properties(spark, database).get(RUN, ""))


def recover(spark: SparkSession, database: str) -> bool:
    """Have the tables' locations follow the published run; whether they had not."""
    held = _properties(spark, database)
    run = held.get(RUN)
    if not run or held.get(PLACED) == run:
        return False
    for table in schemas.TABLES:
        spark.sql(f"ALTER TABLE {database}.{table} SET LOCATION '{_folder(spark, database, run)}/{table}'")
        spark.catalog.refreshTable(f"{database}.{table}")
    _set(spark, database, placed=run)
    return True


def sweep(spark: SparkSession, database: str) -> list[str]:
    """Delete the folders of all runs but the published one and the one before it."""
    held = _properties(spark, database)
    root = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark, database))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in files.listStatus(root)] if files.exists(root) else []
    gone = [p for p in found if p.getName() not in (held.get(RUN), held.get(EARLIER))]
    for path in gone:
        files.delete(path, True)
    return sorted(p.getName() for p in gone)


def refresh_tables(spark: SparkSession, database: str, frames: dict[str, DataFrame]) -> str:
    """Full refresh of the catalog tables as one publication; the run's name.

    Tables without a given frame are emptied, as after a truncate.  Frames may
    be read from the very tables that are refreshed.
    """
    create_tables(spark, database)
    recover(spark, database)
    run = stage(spark, database, frames)
    switch(spark, database, run)
    recover(spark, database)
    sweep(spark, database)
    return run


def tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The five tables of the published run, all of one run at any moment."""
    run = _properties(spark, database).get(RUN)
    if not run:
        raise ValueError(f"nothing has been published in {database}")
    folder = _folder(spark, database, run)
    return {t: spark.read.schema(schemas.struct(t)).parquet(f"{folder}/{t}") for t in schemas.TABLES}
