"""Engagement and revenue KPIs.

All distinct-user counts start from ``user_days``: one row per user and active
day, combined on the map side, so neither a hot user nor a hot day reaches a
single task as raw rows.  ``daily_activity`` reduces them, with one exchange by
user, to one row a day that serves days, weeks and months alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import fill_gaps, month_start, week_ending_monday
from ..functions.numbers import net_revenue, ratio
from ..sources.sinks import materialize


def user_days(events: DataFrame) -> DataFrame:
    """Distinct (user_id, date) pairs; passes its own output through."""
    if set(events.columns) == {"user_id", "date"}:
        return events
    return events.select("user_id", F.to_date("event_time").alias("date")).distinct()


ACTIVITY = ("active", "first_of_week", "first_of_month")


def daily_activity(events: DataFrame) -> DataFrame:
    """(date, active, first_of_week, first_of_month): all distinct-user counts in one pass.

    A user's days are put in order once; the first of a week and of a month
    count for it.  So sums over the days of a week or month are its distinct
    users, and every grain comes from one small row a day.  A hot user has at
    most one row a day, a day is combined on the map side.  Passes its own
    output through.
    """
    if set(events.columns) == {"date", *ACTIVITY}:
        return events
    days = user_days(events).where(F.col("date").isNotNull())
    before = F.lag("date").over(Window.partitionBy("user_id").orderBy("date"))

    def first(bucket) -> Column:
        return F.col("before").isNull() | (bucket(F.col("before")) != bucket(F.col("date")))

    known = F.col("user_id").isNotNull()
    return (
        days.withColumn("before", before)
        .groupBy("date")
        .agg(
            F.count("user_id").alias("active"),
            F.count_if(known & first(week_ending_monday)).alias("first_of_week"),
            F.count_if(known & first(month_start)).alias("first_of_month"),
        )
    )


def dau(events: DataFrame) -> DataFrame:
    """Distinct users per day, zero on silent days inside the range."""
    counts = daily_activity(events).select("date", F.col("active").alias("dau"))
    return fill_gaps(counts, "date", "day", "dau")


def _active_users(events: DataFrame, bucket, name: str, measure: str) -> DataFrame:
    days = daily_activity(events)
    return days.groupBy(bucket(F.col("date")).alias(name)).agg(F.sum(f"first_of_{name}").alias(measure))


def wau(events: DataFrame) -> DataFrame:
    """Distinct users per Tuesday..Monday week, labelled by the closing Monday."""
    return fill_gaps(_active_users(events, week_ending_monday, "week", "wau"), "week", "week", "wau")


def mau(events: DataFrame) -> DataFrame:
    """Distinct users per calendar month."""
    return fill_gaps(_active_users(events, month_start, "month", "mau"), "month", "month", "mau")


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Net revenue, distinct payers and distinct orders per month.

    Rows shrink in two plain steps, to one for each order and user of a month
    and on to the month's sums, so nothing is expanded for a distinct count.
    """
    rows = transactions.select(
        month_start(F.col("order_time")).alias("month"),
        "user_id",
        "order_id",
        net_revenue().alias("net"),
    ).where(F.col("month").isNotNull())
    orders = _count_once(rows.groupBy("month", "order_id").agg(F.sum("net").alias("net")), "order_id")
    by_order = orders.groupBy("month").agg(
        F.sum("net").alias("net"), F.sum("counts").alias("orders")
    )
    payers = _count_once(rows.select("month", "user_id").distinct(), "user_id")
    by_user = payers.groupBy("month").agg(F.sum("counts").alias("paying_users"))
    return by_order.join(by_user, "month").select(
        "month", F.coalesce("net", F.lit(0)).alias("revenue"), "paying_users", "orders"
    )


def _count_once(df: DataFrame, key: str) -> DataFrame:
    """Mark rows that count for a distinct count of ``key``: all but NULL keys."""
    return df.withColumn("counts", F.col(key).isNotNull().cast("bigint"))


def monthly_kpis(events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Monthly activity joined with revenue; months are those of the events.

    Missing revenue counts as zero; a ratio with a zero divisor is NULL.
    """
    joined = (
        mau(events)
        .join(monthly_revenue(transactions), "month", "left")
        .select(
            "month",
            "mau",
            F.coalesce("revenue", F.lit(0)).cast("double").alias("revenue"),
            F.coalesce("paying_users", F.lit(0)).alias("paying_users"),
            F.coalesce("orders", F.lit(0)).alias("orders"),
        )
    )
    return joined.select(
        "*",
        ratio(F.col("revenue"), F.col("mau")).alias("arpu"),
        ratio(F.col("revenue"), F.col("paying_users")).alias("arppu"),
        ratio(F.col("revenue"), F.col("orders")).alias("aov"),
        ratio(F.col("paying_users"), F.col("mau")).alias("paying_rate"),
    )


def daily_kpis(events: DataFrame) -> DataFrame:
    """DAU and its share of the month's users (stickiness)."""
    days = daily_activity(events)
    daily = dau(days).withColumn("month", month_start(F.col("date")))
    return daily.join(mau(days), "month", "left").select(
        "date",
        "dau",
        (F.col("dau") / F.greatest(F.lit(1), F.coalesce("mau", F.lit(0)))).alias("dau_mau"),
    )


def channel_revenue(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Revenue, payers and orders per acquisition channel.

    Users without a channel and orders of unknown users drop out.  Orders are
    reduced to one row for each user before they meet the users table, so a
    user with very many orders costs the join one row.  ``order_id`` is a key
    of transactions: an order belongs to one user.
    """
    orders = transactions.select("user_id", "order_id", net_revenue().alias("net"))
    each = _count_once(orders.groupBy("user_id", "order_id").agg(F.sum("net").alias("net")), "order_id")
    by_user = each.groupBy("user_id").agg(F.sum("net").alias("net"), F.sum("counts").alias("orders"))
    # A repeated user row repeats that user's revenue, but not the distinct counts.
    places = users.groupBy("user_id", "channel").agg(F.count("*").alias("times"))
    return (
        by_user.join(places, "user_id")
        .where(F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(
            F.sum(F.col("net") * F.col("times")).cast("double").alias("revenue"),
            F.count("*").alias("paying_users"),
            F.sum("orders").alias("orders"),
        )
    )


def headline(monthly: DataFrame) -> DataFrame:
    """Total revenue, average MAU and the latest month's figures, in one row."""
    latest = {c: F.max_by(c, "month") for c in ("mau", "arpu", "paying_rate")}
    total = F.sum(F.col("revenue").cast("decimal(20,2)")).cast("double")
    return monthly.agg(
        total.alias("total_revenue"),
        F.avg("mau").alias("average_mau"),
        *[c.alias(f"latest_{k}") for k, c in latest.items()],
    )


@dataclass(frozen=True)
class Kpis:
    daily: DataFrame
    weekly: DataFrame
    monthly: DataFrame
    channel: DataFrame


def calculate_kpis(users: DataFrame, events: DataFrame, transactions: DataFrame) -> Kpis:
    """The four KPI tables; daily, weekly and monthly start from one stored row a day."""
    days = materialize(daily_activity(events), "daily-activity")
    return Kpis(
        daily=daily_kpis(days),
        weekly=wau(days),
        monthly=monthly_kpis(days, transactions),
        channel=channel_revenue(users, transactions),
    )
