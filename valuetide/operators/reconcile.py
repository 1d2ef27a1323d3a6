"""Reconciliation of loaded tables against the frames they came from."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import net_revenue
from ..session import fits_broadcast

# Fixed value: largest accepted revenue difference.
REVENUE_TOLERANCE = 0.01
# Ranges of a table's key that get a digest each.
KEY_RANGES = 16


def orphan_rows(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Number of fact rows whose user is unknown or missing.

    Small users tables are broadcast; otherwise facts are counted per user first.
    """
    known = users.select("user_id")
    if fits_broadcast(known):
        return facts.select("user_id").join(F.broadcast(known), "user_id", "left_anti").agg(F.count("*").alias("n"))
    per_user = facts.groupBy("user_id").agg(F.count("*").alias("n"))
    lost = per_user.join(known, "user_id", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def total_net_revenue(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        F.coalesce(F.sum(net_revenue()), F.lit(0)).cast("double").alias("n")
    )


def reconcile(
    expected: dict[str, DataFrame], actual: dict[str, DataFrame], monthly: DataFrame
) -> DataFrame:
    """One row per check: (check_name, expected, actual, ok).

    Row counts per table, orphans of the loaded facts, and loaded net revenue
    against the monthly KPI revenue.
    """
    pieces = []

    def check(name: str, want: DataFrame | None, got: DataFrame, tolerance: float = 0.0):
        row = got.select(F.col(got.columns[0]).cast("double").alias("actual"))
        wanted = F.lit(0.0) if want is None else want.scalar().cast("double")
        row = row.withColumn("expected", wanted)
        close = F.abs(F.col("actual") - F.col("expected"))
        ok = close < tolerance if tolerance else close == 0
        pieces.append(
            row.select(F.lit(name).alias("check_name"), "expected", "actual", ok.alias("ok"))
        )

    for table, frame in expected.items():
        check(f"rows_{table}", frame.agg(F.count("*")), actual[table].agg(F.count("*")))
    check("orphan_events", None, orphan_rows(actual["events"], actual["users"]))
    check("orphan_transactions", None, orphan_rows(actual["transactions"], actual["users"]))
    kpi_revenue = monthly.agg(
        F.coalesce(F.sum(F.col("revenue").cast("decimal(20,2)")), F.lit(0))
    )
    check("net_revenue", kpi_revenue, total_net_revenue(actual["transactions"]), REVENUE_TOLERANCE)
    return reduce(DataFrame.unionByName, pieces)


def require_reconciled(result: DataFrame) -> DataFrame:
    """Pass the result through, raising if any check failed."""
    failed = result.where(~F.col("ok")).collect()
    if failed:
        detail = ", ".join(f"{r['check_name']}: {r['actual']} != {r['expected']}" for r in failed)
        raise ValueError(f"Reconciliation failed: {detail}")
    return result


# Digests ---------------------------------------------------------------------


@dataclass(frozen=True)
class KeyRanges:
    """Equal ranges of a numeric key between its least and its greatest value."""

    key: str
    low: int
    width: int
    count: int

    @classmethod
    def of(cls, df: DataFrame, key: str, count: int = KEY_RANGES) -> KeyRanges:
        row = df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
        low, high = (row["low"], row["high"]) if row["low"] is not None else (0, 0)
        return cls(key, low, -(-(high - low + 1) // count), count)

    def number(self) -> Column:
        """The range of a row; keys outside belong to the nearest range, NULL to -1."""
        place = F.floor((F.col(self.key).cast("bigint") - F.lit(self.low)) / F.lit(self.width))
        inside = F.least(F.greatest(place, F.lit(0)), F.lit(self.count - 1))
        return F.when(F.col(self.key).isNull(), -1).otherwise(inside).cast("int")


def row_hashes(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row; NULLs and their places count, the row's place does not."""
    marked = [x for c in sorted(columns) for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*marked), F.xxhash64(F.lit("again"), *marked)]


def digests(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """(range, rows, digest): an order-independent digest of the rows of each key range.

    The rows' hashes are added up, so neither order nor partitions matter, yet
    a value that moved from one row to another changes it.  Partial sums are
    formed where the rows lie; a range sends one row a task.
    """
    first, second = row_hashes(df.columns)
    hashed = df.select(ranges.number().alias("range"), first.alias("a"), second.alias("b"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return hashed.groupBy("range").agg(
        F.count("*").alias("rows"), F.concat_ws(":", total("a"), total("b")).alias("digest")
    )


def compare_digests(
    expected: DataFrame, actual: DataFrame, key: str, count: int = KEY_RANGES
) -> DataFrame:
    """(range, key_from, key_to, expected_rows, actual_rows, ok) of every range with rows.

    Ranges are those of the expected frame.  Columns are taken by name and in
    the expected frame's types; a missing one is an error.
    """
    ranges = KeyRanges.of(expected, key, count)
    aligned = actual.select(*[F.col(f.name).cast(f.dataType) for f in expected.schema.fields])
    want = digests(expected, ranges).withColumnsRenamed({"rows": "expected_rows", "digest": "want"})
    got = digests(aligned, ranges).withColumnsRenamed({"rows": "actual_rows", "digest": "got"})
    # As long integers: a small range number times a width may leave the range of an int.
    start = F.col("range").cast("bigint") * F.lit(ranges.width) + F.lit(ranges.low)
    known = F.col("range") >= 0
    return want.join(got, "range", "full").select(
        "range",
        F.when(known, start).cast("bigint").alias("key_from"),
        F.when(known, start + F.lit(ranges.width - 1)).cast("bigint").alias("key_to"),
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
        F.coalesce(F.col("want") == F.col("got"), F.lit(False)).alias("ok"),
    )


def reconcile_rows(
    expected: dict[str, DataFrame], actual: dict[str, DataFrame], keys: dict[str, str]
) -> DataFrame:
    """:func:`compare_digests` of every table with a key, under its name."""
    pieces = [
        compare_digests(expected[t], actual[t], key).select(F.lit(t).alias("table_name"), "*")
        for t, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, pieces)
