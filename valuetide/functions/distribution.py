"""Order statistics without sorting a whole table in one task.

Running totals, ranks and exact quantiles need a global order.  A plain
``Window.orderBy`` would move every row to one partition, so rows are first
aggregated by distinct value, the distinct values are split at approximate
quantiles, each part is accumulated on its own, and the totals of the earlier
parts are added back.  The number of parts grows as the square root of the
rows, and so does their size: neither the step over parts nor a part outgrows a
task.  The split points are plain literals in the plan: a lost executor
recomputes exactly the same parts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# With n rows there are sqrt(n / ROWS_PER_STEP) parts.
ROWS_PER_STEP = 1_000


@dataclass(frozen=True)
class Profile:
    """Row count, totals of the measures, and split points per column."""

    rows: int
    totals: dict[str, float]
    cuts: dict[str, list[float]]


def profile(
    df: DataFrame,
    columns: list[str],
    totals: dict[str, Column] | None = None,
    rows_per_part: int | None = None,
) -> Profile:
    """Count and sums in one aggregate pass, approximate quantiles in another.

    One number for each part and column reaches the driver.  Only finite
    quantiles split: infinite values belong to the outer parts.
    """
    totals = totals or {}
    row = df.agg(
        F.count("*").alias("n"), *[F.sum(e).alias(f"t_{k}") for k, e in totals.items()]
    ).first()
    found = Profile(row["n"], {k: row[f"t_{k}"] or 0 for k in totals}, {c: [] for c in columns})
    per = row["n"] / rows_per_part if rows_per_part else math.sqrt(row["n"] / ROWS_PER_STEP)
    parts = math.ceil(per)
    if parts > 1:
        steps = [i / parts for i in range(1, parts)]
        accuracy = max(10_000, 4 * parts)
        row = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), steps, accuracy).alias(c) for c in columns]
        ).first()
        for c in columns:
            found.cuts[c] = sorted({q for q in row[c] or () if math.isfinite(q)})
    return found


def assign_part(df: DataFrame, column: str, cuts: list[float], part: str) -> DataFrame:
    """Number of the value range a row falls into."""
    if not cuts:
        return df.withColumn(part, F.lit(0.0))
    as_double = df.withColumn("_as_double", F.col(column).cast("double"))
    splits = [-math.inf, *cuts, math.inf]
    return (
        Bucketizer(splits=splits, inputCol="_as_double", outputCol=part, handleInvalid="keep")
        .transform(as_double)
        .drop("_as_double")
    )


def cumulative_by_value(
    df: DataFrame,
    value: str,
    measures: dict[str, Column],
    cuts: list[float],
    descending: bool = True,
) -> DataFrame:
    """Per distinct value: the measures' sums and their running totals ``cum_*``."""
    grouped = df.groupBy(value).agg(*[F.sum(e).alias(k) for k, e in measures.items()])
    grouped = assign_part(grouped, value, cuts, "_part")
    direction = F.desc if descending else F.asc
    running = (
        Window.partitionBy("_part")
        .orderBy(direction(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = grouped
    for k in measures:
        out = out.withColumn(f"cum_{k}", F.sum(k).over(running))
    if cuts:
        earlier = Window.orderBy(direction("_part")).rowsBetween(Window.unboundedPreceding, -1)
        offsets = grouped.groupBy("_part").agg(*[F.sum(k).alias(k) for k in measures])
        offsets = offsets.select(
            "_part",
            *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"off_{k}") for k in measures],
        )
        out = out.join(offsets, "_part")
        for k in measures:
            out = out.withColumn(f"cum_{k}", F.col(f"cum_{k}") + F.col(f"off_{k}"))
    return out.select(value, *measures, *[f"cum_{k}" for k in measures])


def rank_rows(
    df: DataFrame, value: str, tie: str, measure: str, prof: Profile, descending: bool = True
) -> DataFrame:
    """Add the global ``rank`` (1-based) and the running ``cum_<measure>``.

    Rows are ordered by ``value`` and, among equal values, by ``tie``.  A value
    shared by a large part of the rows is split by ranges of ``tie``, so no
    window holds an unbounded group of ties.
    """
    spread = assign_part(df, tie, prof.cuts[tie], "_tie_part")
    inside = (
        Window.partitionBy(value, "_tie_part")
        .orderBy(tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = spread.withColumn("_rn", F.row_number().over(inside)).withColumn(
        "_cm", F.sum(measure).over(inside)
    )
    before = (
        Window.partitionBy(value).orderBy("_tie_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = spread.groupBy(value, "_tie_part").agg(
        F.count("*").alias("_n"), F.sum(measure).alias("_m")
    )
    by_value = cumulative_by_value(
        cells, value, {"_n": F.col("_n"), "_m": F.col("_m")}, prof.cuts[value], descending
    ).select(
        value,
        (F.col("cum__n") - F.col("_n")).alias("_n_before"),
        (F.col("cum__m") - F.col("_m")).alias("_m_before"),
    )
    offsets = cells.select(
        value,
        "_tie_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_tie"),
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_m_tie"),
    ).join(by_value, value)
    return (
        rows.join(offsets, [value, "_tie_part"])
        .withColumn("rank", F.col("_rn") + F.col("_n_tie") + F.col("_n_before"))
        .withColumn(f"cum_{measure}", F.col("_cm") + F.col("_m_tie") + F.col("_m_before"))
        .select(*df.columns, "rank", f"cum_{measure}")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    rows_per_part: int | None = None,
) -> DataFrame:
    """One row of exact, linearly interpolated quantiles; NULL on no rows."""
    present = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    prof = profile(present, ["v"], rows_per_part=rows_per_part)
    running = cumulative_by_value(present, "v", {"n": F.lit(1)}, prof.cuts["v"], descending=False)
    columns = []
    for name, p in probabilities.items():
        position = max(prof.rows - 1, 0) * p
        low, high = math.floor(position), math.ceil(position)
        below = F.min(F.when(F.col("cum_n") > low, F.col("v")))
        above = F.min(F.when(F.col("cum_n") > high, F.col("v")))
        between = below + (above - below) * F.lit(position - low)
        columns.append(F.when(below == above, below).otherwise(between).alias(name))
    return running.agg(*columns)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]; the top edge joins the last bin.

    All ``bins`` rows are present.  A constant column gets half a unit on both
    sides.  The range is one aggregated row, the counts at most ``bins`` rows.
    """
    present = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    bounds = present.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if bounds["lo"] is None:
        lo, hi = 0.0, 1.0
    elif bounds["lo"] == bounds["hi"]:
        lo, hi = bounds["lo"] - 0.5, bounds["hi"] + 0.5
    else:
        lo, hi = bounds["lo"], bounds["hi"]
    slot = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
    counts = present.groupBy(slot.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    width = (hi - lo) / bins
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left_edge"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right_edge"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"),
        )
    )
