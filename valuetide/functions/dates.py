"""Day, week and month bucketing on dates, free of session time zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEPS = {
    # unit: (interval literal, day before the next bucket)
    "day": ("interval 1 day", lambda nxt: F.date_sub(nxt, 1)),
    "week": ("interval 7 day", lambda nxt: F.date_sub(nxt, 7)),
    "month": ("interval 1 month", lambda nxt: F.add_months(nxt, -1)),
}


def month_start(day: Column) -> Column:
    return F.trunc(F.to_date(day), "month")


def week_ending_monday(day: Column) -> Column:
    """Closing Monday of the Tuesday..Monday week that holds ``day``."""
    return F.next_day(F.date_sub(day, 1), "MON")


def month_index(day: Column) -> Column:
    """Ordinal month number; differences count calendar months."""
    return F.year(day) * 12 + F.month(day)


def elapsed_days(moment: Column, as_of: Column) -> Column:
    """Whole 24-hour days from a timestamp to midnight of ``as_of`` (floor)."""
    past_midnight = moment > F.to_date(moment).cast("timestamp_ntz")
    return F.datediff(as_of, F.to_date(moment)) - past_midnight.cast("int")


def fill_gaps(counts: DataFrame, bucket: str, unit: str, *measures: str) -> DataFrame:
    """Add the missing buckets between the first and the last with zeros.

    ``counts`` holds one row per calendar bucket, so the single-partition
    window sorts at most one row per day of history whatever the data size;
    each row then unfolds into itself plus the gap behind it.
    """
    interval, before = _STEPS[unit]
    following = F.lead(bucket).over(Window.orderBy(bucket))
    last = F.coalesce(before(following), F.col(bucket))
    unfolded = counts.where(F.col(bucket).isNotNull()).withColumn(
        "_slot", F.sequence(F.col(bucket), last, F.expr(interval))
    )
    unfolded = unfolded.withColumn("_slot", F.explode("_slot"))
    own = F.col("_slot") == F.col(bucket)
    kept = [
        F.when(own, F.col(m)).otherwise(F.lit(0)).cast(counts.schema[m].dataType).alias(m)
        for m in measures
    ]
    return unfolded.select(F.col("_slot").alias(bucket), *kept)
