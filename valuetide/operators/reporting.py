"""Datasets for BI pages, charts and exploratory tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fill_gaps, month_start
from ..functions.distribution import exact_quantiles, histogram
from ..functions.numbers import net_revenue, ratio
from ..sources.sinks import materialize
from . import kpi, retention
from .segments import latest_per_user
from .splits import TEST, TRAIN, VALIDATION

# Chart sizes, quantile labels and funnel order.
LTV_HISTOGRAM_BINS = 60
TARGET_HISTOGRAM_BINS = 40
PROBABILITY_HISTOGRAM_BINS = 40
DESCRIBE_QUANTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
FUNNEL = ["browse", "search", "add_to_cart", "purchase", "login"]


def _one_row(*frames: DataFrame) -> DataFrame:
    """Glue one-row aggregates side by side."""
    keyed = [f.withColumn("_one", F.lit(1)) for f in frames]
    return reduce(lambda a, b: a.join(b, "_one"), keyed).drop("_one")


# BI ----------------------------------------------------------------------------


def customer_features(snapshots: DataFrame) -> DataFrame:
    """Latest test-split snapshot of each user, all columns."""
    return latest_per_user(snapshots.where(F.col("split") == TEST)).select(*snapshots.columns)


def measures(
    users: DataFrame,
    daily: DataFrame,
    monthly: DataFrame,
    features: DataFrame,
    segments: DataFrame,
) -> DataFrame:
    """Report measures in one row.  MAU and DAU totals add up the KPI rows."""
    months = monthly.agg(
        F.sum(F.col("revenue").cast("decimal(20,2)")).cast("double").alias("revenue"),
        F.sum("mau").alias("mau"),
        F.sum("paying_users").alias("paying_users"),
    )
    row = _one_row(
        users.agg(F.countDistinct("user_id").alias("total_users")),
        months,
        daily.agg(F.sum("dau").alias("dau")),
        features.agg(ratio(F.sum("churn_30d"), F.count("churn_30d")).alias("churn_rate")),
        segments.agg(
            F.avg("predicted_ltv").alias("avg_predicted_ltv"),
            F.countDistinct(F.when(F.col("risk_segment") == "High Risk", F.col("user_id"))).alias(
                "high_risk_users"
            ),
        ),
    )
    return row.select(
        "*",
        ratio(F.col("revenue"), F.col("mau")).alias("arpu"),
        ratio(F.col("revenue"), F.col("paying_users")).alias("arppu"),
        ratio(F.col("dau"), F.col("mau")).alias("dau_mau"),
    )


def executive_cards(
    users: DataFrame,
    events: DataFrame,
    transactions: DataFrame,
    features: DataFrame,
    segments: DataFrame,
    channel: str | None = None,
) -> DataFrame:
    """Executive and retention cards, optionally for the users of one channel.

    The channel filter is applied before anything is aggregated.
    """
    if channel is not None:
        users = users.where(F.col("channel") == channel)
        members = users.select("user_id")
        transactions, features, segments = (
            t.join(members, "user_id", "left_semi") for t in (transactions, features, segments)
        )
    # Events meet the members as user-days, not as raw rows; all counts take these from the store.
    days = kpi.user_days(events)
    if channel is not None:
        days = days.join(members, "user_id", "left_semi")
    days = materialize(days, "user-days")
    daily = materialize(kpi.daily_activity(days), "daily-activity")
    row = measures(users, kpi.dau(daily), kpi.monthly_kpis(daily, transactions), features, segments)
    cards = row.select(
        "total_users", "mau", "dau_mau", "revenue", "arpu", "churn_rate", "avg_predicted_ltv"
    )
    return _one_row(cards, retention.day_n_retention(users, days))


def calendar(events: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per day from the first to the last event or order."""
    days = events.select(F.to_date("event_time").alias("date")).unionByName(
        transactions.select(F.to_date("order_time").alias("date"))
    )
    span = days.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    one_day = F.expr("interval 1 day")
    return (
        span.where(F.col("lo").isNotNull())
        .select(F.explode(F.sequence("lo", "hi", one_day)).alias("date"))
        .select(
            "date",
            F.year("date").alias("year"),
            F.quarter("date").alias("quarter"),
            F.month("date").alias("month"),
            month_start(F.col("date")).alias("month_start"),
            kpi.week_ending_monday(F.col("date")).alias("week_ending"),
        )
    )


def ltv_by_channel(users: DataFrame, segments: DataFrame) -> DataFrame:
    return (
        segments.join(users.select("user_id", "channel"), "user_id")
        .groupBy("channel")
        .agg(F.avg("predicted_ltv").alias("avg_predicted_ltv"), F.count("*").alias("users"))
    )


def value_segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("value_segment").agg(F.count("*").alias("users"))


def high_risk_customers(users: DataFrame, features: DataFrame, segments: DataFrame) -> DataFrame:
    """Drillable list over the star: segments, user attributes and latest features."""
    return (
        segments.where(F.col("risk_segment") == "High Risk")
        .join(users.select("user_id", "channel", "device"), "user_id")
        .join(features.select("user_id", "days_since_last_active", "historical_ltv"), "user_id")
        .select(
            "user_id",
            "channel",
            "device",
            "churn_probability",
            "predicted_ltv",
            "customer_segment",
            "recommended_action",
            "days_since_last_active",
            "historical_ltv",
        )
        .orderBy(F.desc("churn_probability"), "user_id")
    )


# Chart datasets --------------------------------------------------------------


def kpi_trend(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Daily DAU and stickiness next to the month's MAU and revenue."""
    months = monthly.select("month", "mau", F.col("revenue").alias("month_revenue"))
    return (
        daily.withColumn("month", month_start(F.col("date")))
        .join(months, "month", "left")
        .select("date", "dau", "dau_mau", "mau", "month_revenue")
    )


def ltv_histogram(predictions: DataFrame) -> DataFrame:
    return histogram(predictions, "future_90d_revenue", LTV_HISTOGRAM_BINS)


def target_histogram(snapshots: DataFrame) -> DataFrame:
    development = snapshots.where(F.col("ltv_split").isin(TRAIN, VALIDATION))
    return histogram(development, "future_90d_revenue", TARGET_HISTOGRAM_BINS)


def probability_histogram(segments: DataFrame) -> DataFrame:
    return histogram(segments, "churn_probability", PROBABILITY_HISTOGRAM_BINS)


def actual_vs_predicted(predictions: DataFrame) -> DataFrame:
    return predictions.select("user_id", "future_90d_revenue", "predicted_ltv")


def value_risk_points(segments: DataFrame) -> DataFrame:
    return segments.select("user_id", "predicted_ltv", "churn_probability", "customer_segment")


def top_features(importance: DataFrame, k: int = 12) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def last_months(monthly: DataFrame, k: int = 5) -> DataFrame:
    return monthly.orderBy(F.desc("month")).limit(k)


def heatmap(cohorts: DataFrame, periods: int = 12) -> DataFrame:
    """The first ``periods`` columns of the cohort table, in long form."""
    return cohorts.where(F.col("period") < periods)


# Exploration -----------------------------------------------------------------


def totals(users: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    return _one_row(
        users.agg(F.count("*").alias("users")),
        events.agg(F.count("*").alias("events")),
        transactions.agg(
            F.count("*").alias("orders"), F.sum(net_revenue()).cast("double").alias("net_revenue")
        ),
    )


def revenue_describe(transactions: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact upper quantiles of net revenue."""
    net = transactions.select(net_revenue().alias("net"))
    moments = net.agg(
        F.count("net").alias("count"),
        ratio(F.sum("net"), F.count("net")).alias("mean"),
        F.stddev_samp(F.col("net").cast("double")).alias("std"),
        F.min("net").cast("double").alias("min"),
        F.max("net").cast("double").alias("max"),
    )
    return _one_row(moments, exact_quantiles(net, "net", DESCRIBE_QUANTILES))


def mix(users: DataFrame, dimension: str) -> DataFrame:
    """Users per value of a column, missing values excluded."""
    return (
        users.where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(F.count("*").alias("users"))
    )


def monthly_trend(events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Event volume and net revenue per month, aligned on the union of months.

    Gaps inside either series are 0; months outside a series are NULL.
    """
    volume = (
        events.where(F.col("event_time").isNotNull())
        .groupBy(month_start(F.col("event_time")).alias("month"))
        .agg(F.count("*").alias("events"))
    )
    sales = (
        transactions.where(F.col("order_time").isNotNull())
        .groupBy(month_start(F.col("order_time")).alias("month"))
        .agg(F.coalesce(F.sum(net_revenue()), F.lit(0)).cast("double").alias("net_revenue"))
    )
    return fill_gaps(volume, "month", "month", "events").join(
        fill_gaps(sales, "month", "month", "net_revenue"), "month", "full"
    )


def event_funnel(events: DataFrame) -> DataFrame:
    """Event volume per funnel stage in fixed order; absent stages are left out."""
    stage = F.array_position(F.array(*[F.lit(s) for s in FUNNEL]), F.col("event_type"))
    return (
        events.where(F.col("event_type").isin(FUNNEL))
        .groupBy("event_type")
        .agg(F.count("*").alias("events"))
        .select(stage.cast("int").alias("stage"), "event_type", "events")
        .orderBy("stage")
    )


def run_manifest(users: DataFrame, events: DataFrame, transactions: DataFrame, seed: int) -> DataFrame:
    """Row counts, overall date range and seed of a run."""
    midnight = F.to_date("signup_date").cast("timestamp_ntz")
    row = _one_row(
        users.agg(F.count("*").alias("users"), F.min(midnight).alias("first_signup")),
        events.agg(
            F.count("*").alias("events"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
        ),
        transactions.agg(F.count("*").alias("orders"), F.max("order_time").alias("last_order")),
    )
    return row.select(
        "users",
        "events",
        "orders",
        F.least("first_signup", "first_event").alias("date_start"),
        F.greatest("last_event", "last_order").alias("date_end"),
        F.lit(seed).alias("seed"),
    )
