"""Readers for the input tables, exported results and metric documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from . import schemas

# Text formats of the CSV exchange files.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
INPUTS = ("users", "events", "transactions")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed CSV read by column name; a malformed cell fails instead of turning NULL.

    Columns may stand in any order; those that ``schema`` does not name are
    dropped, and those that the file lacks stay absent.
    """
    known = {f.name: f for f in StructType.fromDDL(schema).fields}
    header = spark.read.option("header", True).csv(path).columns
    layout = StructType([known.get(c, StructField(c, StringType())) for c in header])
    rows = (
        spark.read.schema(layout)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", f"{DATE_FORMAT}[ HH:mm:ss]")
        .option("timestampNTZFormat", f"yyyy-MM-dd[ HH:mm:ss][.SSSSSS]")
        .csv(path)
    )
    return rows.select(*[c for c in known if c in header])


def read_tables(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The three input tables from ``<folder>/<table>.<csv>`` or Parquet folders."""
    if fmt == "csv":
        return {t: read_csv(spark, f"{folder}/{t}.csv", schemas.TABLES[t]) for t in INPUTS}
    return {
        t: schemas.conform(spark.read.format(fmt).load(f"{folder}/{t}"), t) for t in INPUTS
    }


def read_result(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A written result: Parquet, or CSV when the caller names the schema."""
    return read_csv(spark, path, schema) if schema else spark.read.parquet(path)


def read_metrics(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Metric documents: a JSON object in each line, or with ``document`` one in each file."""
    return spark.read.option("multiLine", document).json(path)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Result of one SQL statement evaluated by an external database.

    With ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` among the options it is read in ranges by many tasks.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS q")
    return reader.options(**options).load()
