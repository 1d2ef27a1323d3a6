"""Exact-day retention, right-censored signup cohorts and retention by dimension.

Events are reduced to one row per user and day before they meet the users, so
a hot user contributes at most one row per calendar day to the join.  They meet
once: ``user_months`` keeps a row per user and active month, with a bit for
each retention day that was hit, and every table is counted from these rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index, month_start
from ..functions.numbers import ratio
from ..sources.sinks import materialize
from .kpi import user_days

# The retention days of the summary and of the dimension cuts.
RETENTION_DAYS = (1, 7, 30)


def _observation_end(days: DataFrame):
    return days.agg(F.max("date")).scalar()


MONTHS = {"user_id", "signup_date", "cohort", "period", "hits", "once"}


def _days_of_users(users: DataFrame, events: DataFrame, *dimensions: str) -> DataFrame:
    """User-days next to their user rows: signup, months since then, retention days hit."""
    signup = F.to_date("signup_date")
    who = users.select("user_id", signup.alias("signup_date"), *dimensions).where("signup_date IS NOT NULL")
    day = F.datediff("date", "signup_date")
    bits = [F.when(day == d, 1 << k).otherwise(0) for k, d in enumerate(RETENTION_DAYS)]
    return (
        user_days(events)
        .where(F.col("date").isNotNull())
        .join(who, "user_id")
        .select(
            "user_id",
            "signup_date",
            *dimensions,
            (month_index(F.col("date")) - month_index(F.col("signup_date"))).alias("period"),
            sum(bits[1:], bits[0]).alias("hit"),
        )
    )


def user_months(users: DataFrame, events: DataFrame, *dimensions: str) -> DataFrame:
    """One row per user row and active month: cohort, months since signup, hits.

    Bit k of ``hits`` tells activity exactly ``RETENTION_DAYS[k]`` days after
    signup; of rows that repeat a user, cohort and month one has ``once`` set.
    Passes its own output through.
    """
    if MONTHS <= set(events.columns):
        return events
    months = (
        _days_of_users(users, events, *dimensions)
        .groupBy("user_id", "signup_date", *dimensions, "period")
        .agg(F.bit_or("hit").alias("hits"))
        .withColumn("cohort", month_start(F.col("signup_date")))
    )
    same = Window.partitionBy("user_id", "cohort", "period").orderBy("signup_date", *dimensions)
    return months.withColumn("once", F.row_number().over(same) == 1)


def _hit_users(users: DataFrame, events: DataFrame, months: DataFrame | None, *dimensions: str) -> DataFrame:
    """Distinct users with a hit per value of the dimensions, one count a retention day.

    Only rows with a hit are grouped, to one a user first, so nothing is
    expanded for the distinct counts.
    """
    if months is None and MONTHS <= set(events.columns):
        months = events
    if months is None:
        rows = _days_of_users(users, events, *dimensions).withColumnRenamed("hit", "hits")
    else:
        rows = months
    each = rows.where("hits <> 0").groupBy("user_id", *dimensions).agg(F.bit_or("hits").alias("hits"))
    known = F.col("user_id").isNotNull()
    return each.groupBy(*dimensions).agg(
        *[
            F.count_if(known & (F.col("hits").bitwiseAND(1 << k) != 0)).alias(f"r{d}")
            for k, d in enumerate(RETENTION_DAYS)
        ]
    )


def day_n_retention(
    users: DataFrame, events: DataFrame, months: DataFrame | None = None
) -> DataFrame:
    """One row: share of matured users active exactly 1, 7 and 30 days after signup.

    A user is matured for day d once the data covers signup + d; with nobody
    matured the share is NULL.
    """
    days = user_days(events)
    end = _observation_end(days)
    signups = users.select(F.to_date("signup_date").alias("signup_date"))
    matured = signups.withColumn("end", end).agg(
        *[
            F.count_if(F.date_add("signup_date", d) <= F.col("end")).alias(f"m{d}")
            for d in RETENTION_DAYS
        ]
    )
    # An activity on day d proves signup + d <= last event date: all hits are matured.
    retained = _hit_users(users, days, months)
    one_row = matured.withColumn("k", F.lit(1)).join(retained.withColumn("k", F.lit(1)), "k")
    return one_row.select(
        *[
            ratio(F.col(f"r{d}"), F.col(f"m{d}")).alias(f"d{d}_retention")
            for d in RETENTION_DAYS
        ]
    )


def cohort_size(users: DataFrame) -> DataFrame:
    """Distinct users per signup month."""
    return (
        users.where(F.col("signup_date").isNotNull())
        .groupBy(month_start(F.col("signup_date")).alias("cohort"))
        .agg(F.countDistinct("user_id").alias("cohort_size"))
    )


def _cohort_activity(months: DataFrame) -> DataFrame:
    """Distinct active users per (cohort, months since signup), observed cells only."""
    return months.where("once").groupBy("cohort", "period").agg(F.count("user_id").alias("active_users"))


def _dense(cohorts: DataFrame) -> DataFrame:
    """One row per cohort and period 0..max; ``seen`` maps observed periods to users.

    The unpartitioned window sees one row per signup month.
    """
    longest = F.max("last_period").over(Window.partitionBy())
    return (
        cohorts.withColumn("longest", longest)
        .where(F.col("longest") >= 0)
        .withColumn("period", F.explode(F.sequence(F.lit(0), F.col("longest"))))
        .withColumn("active_users", F.try_element_at("seen", F.col("period")))
    )


def _per_cohort(observed: DataFrame) -> DataFrame:
    """Fold the observed cells of a cohort, at most one per month, into a map."""
    cells = F.collect_list(F.struct("period", "active_users"))
    return observed.groupBy("cohort").agg(
        F.map_from_entries(cells).alias("seen"), F.max("period").alias("last_period")
    )


def cohort_counts(users: DataFrame, events: DataFrame) -> DataFrame:
    """Active users per cohort with any activity, for every period 0..max."""
    cohorts = _per_cohort(_cohort_activity(user_months(users, events)))
    return _dense(cohorts).select(
        "cohort", "period", F.coalesce("active_users", F.lit(0)).alias("active_users")
    )


def cohort_retention(
    users: DataFrame, events: DataFrame, months: DataFrame | None = None
) -> DataFrame:
    """Share of each cohort active per period since signup.

    Periods the data cannot cover yet are NULL, covered periods without
    activity are 0, and a cohort that was never active is NULL throughout.
    """
    days = user_days(events)
    active = _cohort_activity(months if months is not None else user_months(users, days))
    cohorts = cohort_size(users).join(_per_cohort(active), "cohort", "left")
    dense = _dense(cohorts).withColumn("end", _observation_end(days))
    covered = F.col("period") <= month_index(F.col("end")) - month_index(F.col("cohort"))
    silent_is_zero = F.when(
        F.col("seen").isNotNull(), F.coalesce("active_users", F.lit(0))
    )
    return dense.select(
        F.date_format("cohort", "yyyy-MM").alias("cohort"),
        "period",
        "cohort_size",
        F.when(covered, ratio(silent_is_zero, F.col("cohort_size"))).alias("retention"),
    )


def matrix_header(retention: DataFrame) -> list[int]:
    """The periods of a wide export: 0 to the longest one, a single number read from the data."""
    return list(range((retention.agg(F.max("period")).first()[0] or 0) + 1))


def cohort_vectors(retention: DataFrame) -> DataFrame:
    """(cohort, rates): all periods of a cohort in order, NULL where censored.

    A cohort has at most one cell a month of history.
    """
    cells = F.array_sort(F.collect_list(F.struct("period", "retention")))
    return retention.groupBy("cohort").agg(F.transform(cells, lambda c: c["retention"]).alias("rates"))


def cohort_matrix(retention: DataFrame, periods: int | None = None) -> DataFrame:
    """Wide export of :func:`cohort_retention`: one column per period.

    The header is declared first, from ``periods`` or from the data; each row
    is then spread over it, so there is no limit to its width.
    """
    header = list(range(periods)) if periods is not None else matrix_header(retention)
    return cohort_vectors(retention).select(
        "cohort", *[F.get("rates", F.lit(k)).alias(str(k)) for k in header]
    )


def retention_by(
    users: DataFrame, events: DataFrame, dimension: str, months: DataFrame | None = None
) -> DataFrame:
    """Day-1/7/30 retention per value of a user column.

    The divisor is every user of the value, matured or not.  A value with no
    hit on any of the days is NULL, otherwise a day without hits is 0.
    """
    sizes = (
        users.where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(F.countDistinct("user_id").alias("size"))
    )
    hits = _hit_users(users, events, months, dimension).where(F.col(dimension).isNotNull())
    return sizes.join(hits, dimension, "left").select(
        dimension,
        *[ratio(F.col(f"r{d}"), F.col("size")).alias(f"day_{d}") for d in RETENTION_DAYS],
    )


@dataclass(frozen=True)
class Retention:
    summary: DataFrame
    cohorts: DataFrame
    by_channel: DataFrame
    by_device: DataFrame


def calculate_retention(users: DataFrame, events: DataFrame) -> Retention:
    """The four tables; user-days meet the users once, in a stored table of user-months."""
    days = user_days(events)
    months = materialize(user_months(users, days, "channel", "device"), "user-months")
    return Retention(
        summary=day_n_retention(users, days, months),
        cohorts=cohort_retention(users, days, months),
        by_channel=retention_by(users, days, "channel", months),
        by_device=retention_by(users, days, "device", months),
    )
