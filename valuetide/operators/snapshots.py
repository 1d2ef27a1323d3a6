"""Point-in-time user snapshots: 18 trailing features and two forward labels.

Plan shape: events and orders are rolled up to one row per user and day
(map-side combined, so a hot user costs at most one row per calendar day),
the eligible (user, snapshot) rows join in as extra day rows, and one window
partitioned by user evaluates every trailing, forward and lifetime frame.
Nothing is multiplied by the number of snapshots and there is no range join.

Orders are counted as rows per day, which equals distinct orders because
``order_id`` is the key of transactions (``quality.constraint_violations``
checks it).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import elapsed_days
from ..functions.numbers import net_revenue

# Column names, horizons and the default snapshot calendar.
ID_COLUMNS = ["user_id", "snapshot_date"]
TARGETS = ["churn_30d", "future_90d_revenue"]
SPLIT_COLUMNS = [
    "split",
    "ltv_split",
    "churn_split",
    "ltv_label_mature_date",
    "churn_label_mature_date",
]
FEATURES = [
    "tenure_days",
    "active_days_7d",
    "active_days_30d",
    "active_days_90d",
    "login_count_30d",
    "browse_count_30d",
    "search_count_30d",
    "cart_count_30d",
    "purchase_count_30d",
    "purchase_count_90d",
    "revenue_30d",
    "revenue_90d",
    "days_since_last_active",
    "days_since_last_purchase",
    "avg_session_duration",
    "avg_order_value",
    "purchase_frequency",
    "historical_ltv",
]
CHURN_HORIZON_DAYS = 30
LTV_HORIZON_DAYS = 90
COUNTED_EVENTS = {
    "login_count": "login",
    "browse_count": "browse",
    "search_count": "search",
    "cart_count": "add_to_cart",
}
DEFAULT_SNAPSHOTS = [dt.date(2024, m, 1) for m in range(7, 13)] + [
    dt.date(2025, m, 1) for m in range(1, 4)
]


def feature_columns(frame: DataFrame) -> list[str]:
    """Columns a model may see: everything but ids, targets and split columns."""
    hidden = {*ID_COLUMNS, *TARGETS, *SPLIT_COLUMNS}
    return [c for c in frame.columns if c not in hidden]


def as_dates(snapshot_dates) -> list[dt.date]:
    days = [d.date() if isinstance(d, dt.datetime) else d for d in snapshot_dates]
    return sorted(set(days))


def snapshot_spine(users: DataFrame, snapshot_dates=None) -> DataFrame:
    """Users who signed up strictly before each snapshot date."""
    dates = as_dates(snapshot_dates or DEFAULT_SNAPSHOTS)
    calendar = F.array(*[F.lit(d) for d in dates])
    signup = F.to_date("signup_date")
    return (
        users.select("user_id", signup.alias("signup_date"))
        .where(F.col("signup_date") < F.lit(dates[-1]))
        .withColumn("snapshot_date", F.explode(calendar))
        .where(F.col("signup_date") < F.col("snapshot_date"))
    )


def _cents(amount: Column) -> Column:
    """Money as whole cents: exact sums on a primitive column."""
    return (amount * 100).cast("bigint")


def daily_rollup(
    events: DataFrame, transactions: DataFrame, before: dt.date | None = None, pieces: int | None = None
) -> DataFrame:
    """One row per user and day with the partial sums every feature needs.

    ``before`` bounds both scans: nothing on or after it can enter a window.
    Facts without a time have no day and are left out.  With ``pieces`` the
    facts are dealt by user into so many, and days are made and kept there;
    else they are combined before they are dealt.
    """

    def in_time(column: str) -> Column:
        return F.col(column).isNotNull() if before is None else F.col(column) < F.lit(before).cast("timestamp_ntz")

    kinds = {name: F.col("event_type") == kind for name, kind in COUNTED_EVENTS.items()}
    nothing = F.lit(None)
    acts = events.where(in_time("event_time")).select(
        "user_id",
        F.to_date("event_time").alias("date"),
        F.lit(1).alias("is_event"),
        *[hit.cast("int").alias(name) for name, hit in kinds.items()],
        _cents(F.col("session_duration").cast("decimal(12,2)")).alias("session"),
        F.col("event_time").alias("seen_at"),
        nothing.cast("int").alias("is_order"),
        nothing.cast("bigint").alias("net"),
        nothing.cast("timestamp_ntz").alias("bought_at"),
    )
    buys = transactions.where(in_time("order_time")).select(
        "user_id",
        F.to_date("order_time").alias("date"),
        nothing.cast("int").alias("is_event"),
        *[nothing.cast("int").alias(name) for name in kinds],
        nothing.cast("bigint").alias("session"),
        nothing.cast("timestamp_ntz").alias("seen_at"),
        F.col("order_id").isNotNull().cast("int").alias("is_order"),
        _cents(net_revenue()).alias("net"),
        F.col("order_time").alias("bought_at"),
    )
    facts = acts.unionByName(buys)
    return (
        (facts.repartition(pieces, "user_id") if pieces else facts)
        .groupBy("user_id", "date")
        .agg(
            F.max("is_event").alias("active"),
            *[F.sum(name).alias(name) for name in kinds],
            F.sum("session").alias("session_sum"),
            F.count("session").alias("session_n"),
            F.max("seen_at").alias("seen_at"),
            F.sum("is_order").alias("orders"),
            F.sum("net").alias("net"),
            F.count("net").alias("net_n"),
            F.max("bought_at").alias("bought_at"),
        )
    )


# How day rows of one user and day become one: every column is a sum or a maximum.
LARGEST = ("active", "seen_at", "bought_at")
SUMMED = (*COUNTED_EVENTS, "session_sum", "session_n", "orders", "net", "net_n")


def merged_days() -> list[Column]:
    """Aggregates that merge the day rows of a group."""
    return [F.max(c).alias(c) for c in LARGEST] + [F.sum(c).alias(c) for c in SUMMED]


def horizon_of(dates: list[dt.date]) -> dt.date:
    """The first day that no label of the dates looks at."""
    return dates[-1] + dt.timedelta(days=max(LTV_HORIZON_DAYS, CHURN_HORIZON_DAYS))


def build_snapshots(
    users: DataFrame, events: DataFrame, transactions: DataFrame, snapshot_dates=None, pieces: int | None = None
) -> DataFrame:
    """Features over ``[snapshot - d, snapshot)`` and labels over ``[snapshot, snapshot + h)``.

    Missing values become 0, so a user who never bought has recency 0.  With
    ``pieces`` users and their facts are dealt into so many, once.
    """
    dates = as_dates(snapshot_dates or DEFAULT_SNAPSHOTS)
    if pieces:
        users = users.select("user_id", "signup_date").repartition(pieces, "user_id")
    return snapshots_of_days(users, daily_rollup(events, transactions, horizon_of(dates), pieces), dates)


def snapshots_of_days(users: DataFrame, rollup: DataFrame, snapshot_dates) -> DataFrame:
    """Snapshots from the rows of ``daily_rollup``, of which a user and day has one at most."""
    dates = as_dates(snapshot_dates)
    spine = snapshot_spine(users, dates).withColumn("date", F.col("snapshot_date"))
    timeline = rollup.unionByName(spine, allowMissingColumns=True).withColumn(
        "day", F.unix_date("date")
    )

    by_user = Window.partitionBy("user_id").orderBy("day")
    past = by_user.rangeBetween(Window.unboundedPreceding, -1)

    def trailing(days: int):
        return by_user.rangeBetween(-days, -1)

    def ahead(days: int):
        return by_user.rangeBetween(0, days - 1)

    def money(cents: Column) -> Column:
        return cents.cast("double") / 100

    windows = {}
    for d in (7, 30, 90):
        windows[f"active_days_{d}d"] = F.sum("active").over(trailing(d))
    for name in COUNTED_EVENTS:
        windows[f"{name}_30d"] = F.sum(name).over(trailing(30))
    for d in (30, 90):
        windows[f"purchase_count_{d}d"] = F.sum("orders").over(trailing(d))
        windows[f"cents_{d}d"] = F.sum("net").over(trailing(d))
    for name in ("session_sum", "session_n", "orders", "net", "net_n"):
        windows[f"past_{name}"] = F.sum(name).over(past)
    for name in ("seen_at", "bought_at"):
        windows[f"past_{name}"] = F.max(name).over(past)
    windows["comes_back"] = F.max("active").over(ahead(CHURN_HORIZON_DAYS))
    windows["cents_ahead"] = F.sum("net").over(ahead(LTV_HORIZON_DAYS))

    framed = timeline.select(
        "user_id", "snapshot_date", "signup_date", *[w.alias(k) for k, w in windows.items()]
    ).where(F.col("snapshot_date").isNotNull())

    snap = F.col("snapshot_date")
    tenure = F.datediff(snap, "signup_date")
    zero = F.lit(0)

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), zero).cast("int").alias(name)

    def mean(total: str, n: str) -> Column:
        return F.coalesce(F.try_divide(money(F.col(total)), F.col(n)), F.lit(0.0))

    def revenue(name: str) -> Column:
        return money(F.coalesce(F.col(name), zero))

    return framed.select(
        "user_id",
        "snapshot_date",
        tenure.alias("tenure_days"),
        *[count(f"active_days_{d}d") for d in (7, 30, 90)],
        *[count(f"{name}_30d") for name in COUNTED_EVENTS],
        *[count(f"purchase_count_{d}d") for d in (30, 90)],
        *[revenue(f"cents_{d}d").alias(f"revenue_{d}d") for d in (30, 90)],
        F.coalesce(elapsed_days(F.col("past_seen_at"), snap), zero).alias("days_since_last_active"),
        F.coalesce(elapsed_days(F.col("past_bought_at"), snap), zero).alias(
            "days_since_last_purchase"
        ),
        mean("past_session_sum", "past_session_n").alias("avg_session_duration"),
        mean("past_net", "past_net_n").alias("avg_order_value"),
        (F.coalesce("past_orders", zero) / F.greatest(tenure / 30, F.lit(1.0))).alias(
            "purchase_frequency"
        ),
        revenue("past_net").alias("historical_ltv"),
        F.col("comes_back").isNull().cast("int").alias("churn_30d"),
        revenue("cents_ahead").alias("future_90d_revenue"),
    )
