"""The analysts' SQL statements, run by ``spark.sql`` over given tables.

They differ from the KPI operators on purpose: no zero-filled buckets, NULL
revenue stays NULL, and orders count rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def daily_active_users(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(
        """
        SELECT to_date(event_time) AS activity_date, count(DISTINCT user_id) AS dau
        FROM {events}
        GROUP BY to_date(event_time)
        ORDER BY activity_date
        """,
        events=events,
    )


def stickiness(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(
        """
        WITH active AS (
          SELECT DISTINCT to_date(event_time) AS dt, user_id FROM {events}
        ), daily AS (
          SELECT dt, count(user_id) AS dau FROM active GROUP BY dt
        ), monthly AS (
          SELECT trunc(dt, 'month') AS month_start, count(DISTINCT user_id) AS mau
          FROM active GROUP BY trunc(dt, 'month')
        )
        SELECT dt, dau, mau, try_divide(CAST(dau AS DOUBLE), mau) AS dau_mau
        FROM daily JOIN monthly ON trunc(dt, 'month') = month_start
        """,
        events=events,
    )


def monthly_finance(events: DataFrame, transactions: DataFrame) -> DataFrame:
    return events.sparkSession.sql(
        """
        WITH activity AS (
          SELECT trunc(to_date(event_time), 'month') AS month_start,
                 count(DISTINCT user_id) AS active_users
          FROM {events} GROUP BY 1
        ), sales AS (
          SELECT trunc(to_date(order_time), 'month') AS month_start,
                 CAST(sum(amount - refund_amount) AS DOUBLE) AS revenue,
                 count(DISTINCT user_id) AS payers,
                 count(*) AS orders
          FROM {transactions} GROUP BY 1
        )
        SELECT month_start, revenue,
               try_divide(revenue, active_users) AS arpu,
               try_divide(revenue, payers) AS arppu,
               try_divide(revenue, orders) AS aov,
               try_divide(CAST(payers AS DOUBLE), active_users) AS paying_rate
        FROM activity LEFT JOIN sales USING (month_start)
        """,
        events=events,
        transactions=transactions,
    )


def channel_sales(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Needs no distinct orders, so sales shrink to one row per user first."""
    return users.sparkSession.sql(
        """
        WITH per_user AS (
          SELECT user_id, sum(amount - refund_amount) AS net
          FROM {transactions} GROUP BY user_id
        )
        SELECT channel, CAST(sum(net) AS DOUBLE) AS revenue,
               count(DISTINCT user_id) AS paying_users
        FROM per_user JOIN {users} USING (user_id)
        GROUP BY channel
        ORDER BY revenue DESC
        """,
        users=users,
        transactions=transactions,
    )


def orders_and_last_activity(
    users: DataFrame, events: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Both sides are aggregated per user before any join."""
    return users.sparkSession.sql(
        """
        WITH bought AS (
          SELECT user_id, count(*) AS order_count FROM {transactions} GROUP BY user_id
        ), seen AS (
          SELECT user_id, max(event_time) AS last_active FROM {events} GROUP BY user_id
        )
        SELECT u.user_id, coalesce(order_count, 0) AS order_count, last_active
        FROM {users} u LEFT JOIN bought USING (user_id) LEFT JOIN seen USING (user_id)
        """,
        users=users,
        events=events,
        transactions=transactions,
    )
