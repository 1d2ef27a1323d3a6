"""SQL twins of the named queries, in the DuckDB dialect.

Each statement is built from common table expressions over the driver's views
and shares no code with the DataFrame operators.
"""

from __future__ import annotations

import re

# Common table expressions ----------------------------------------------------------

_USERS = """
w_users AS (
  SELECT s.user_id, s.signup_date, c.c_mktsegment AS channel, r.r_name AS region,
         CASE s.user_id % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Web' END AS device
  FROM (SELECT user_id, CAST(min(event_time) AS DATE) AS signup_date
        FROM w_events GROUP BY user_id) s
  LEFT JOIN customer c ON c.c_custkey = s.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

ACTIVITY = (
    """
w_events AS (
  SELECT event_id, user_id, ts AS event_time,
         CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'browse'
              WHEN 'click' THEN 'search' WHEN 'error' THEN 'add_to_cart'
              WHEN 'purchase' THEN 'purchase' END AS event_type,
         CAST(value AS DECIMAL(10,2)) AS session_duration
  FROM events
), w_transactions AS (
  SELECT event_id AS order_id, user_id, ts AS order_time,
         CAST(value AS DECIMAL(12,2)) AS amount,
         CASE WHEN event_id % 10 = 0 THEN CAST(value AS DECIMAL(12,2))
              ELSE CAST(0 AS DECIMAL(12,2)) END AS refund_amount
  FROM events WHERE event_type = 'purchase'
),"""
    + _USERS
)

COMMERCE = (
    """
w_events AS (
  SELECT o_orderkey * 1000 AS event_id, o_custkey AS user_id, o_orderdate AS event_time,
         'purchase' AS event_type, CAST(o_orderkey % 60 AS DECIMAL(10,2)) AS session_duration
  FROM orders
  UNION ALL
  SELECT l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
           l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice), o_custkey, l_shipdate,
         CASE l_linenumber % 5 WHEN 0 THEN 'login' WHEN 1 THEN 'browse' WHEN 2 THEN 'search'
              WHEN 3 THEN 'favorite' ELSE 'add_to_cart' END,
         CAST(l_quantity AS DECIMAL(10,2))
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), w_returned AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS returned
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
), w_transactions AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_time,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CAST(least(CAST(o_totalprice AS DECIMAL(12,2)), coalesce(returned, 0))
              AS DECIMAL(12,2)) AS refund_amount
  FROM orders LEFT JOIN w_returned ON l_orderkey = o_orderkey
),"""
    + _USERS
)

WORLDS = {"commerce": COMMERCE, "activity": ACTIVITY}
SILENT = {
    "commerce": "DATE '1996-05-01' AND DATE '1996-07-31'",
    "activity": "DATE '2024-01-09' AND DATE '2024-01-17'",
}
# The clean tables, named b_*, with what a raw source may deliver.
for _name in list(WORLDS):
    WORLDS[f"{_name}_raw"] = (
        re.sub(r"\bw_", "b_", WORLDS[_name])
        + f""", x_users AS (
  SELECT c_custkey AS user_id,
         CAST(coalesce(b.signup_date, DATE '1995-01-01' + CAST(c_custkey % 700 AS INTEGER))
              + CASE WHEN c_custkey % 97 = 5 THEN 400 ELSE 0 END AS DATE) AS signup_date,
         c_mktsegment AS channel, r_name AS region,
         CASE c_custkey % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Web' END AS device
  FROM customer LEFT JOIN b_users b ON b.user_id = c_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
  WHERE c_custkey % 89 <> 3
), w_users AS (
  SELECT * FROM x_users UNION ALL SELECT * FROM x_users WHERE user_id % 501 = 7
), w_events AS (
  SELECT * REPLACE (CAST(CASE WHEN event_id % 211 = 4 THEN -1 ELSE session_duration END AS DECIMAL(10,2))
                    AS session_duration)
  FROM b_events WHERE CAST(event_time AS DATE) NOT BETWEEN {SILENT[_name]}
), w_transactions AS (
  SELECT order_id, user_id, order_time,
         CAST(CASE WHEN order_id % 53 = 2 THEN 0 ELSE amount END AS DECIMAL(12,2)) AS amount,
         CAST(CASE WHEN order_id % 59 = 1 THEN amount + 1 ELSE refund_amount END AS DECIMAL(12,2))
           AS refund_amount
  FROM b_transactions
)"""
    )
SNAPSHOT_DATES = {
    "commerce": "generate_series(DATE '2000-07-01', DATE '2001-03-01', INTERVAL 1 MONTH)",
    "activity": "generate_series(DATE '2024-01-05', DATE '2024-01-26', INTERVAL 7 DAY)",
}

DAILY = """
d_raw AS (
  SELECT CAST(event_time AS DATE) AS date, count(DISTINCT user_id) AS dau
  FROM w_events GROUP BY 1
), daily AS (
  SELECT CAST(g.d AS DATE) AS date, coalesce(dau, 0) AS dau
  FROM (SELECT unnest(generate_series((SELECT min(date) FROM d_raw),
               (SELECT max(date) FROM d_raw), INTERVAL 1 DAY)) AS d) g
  LEFT JOIN d_raw ON d_raw.date = CAST(g.d AS DATE)
)"""

MAU = """
m_raw AS (
  SELECT CAST(date_trunc('month', event_time) AS DATE) AS month, count(DISTINCT user_id) AS mau
  FROM w_events GROUP BY 1
), mau AS (
  SELECT CAST(g.d AS DATE) AS month, coalesce(mau, 0) AS mau
  FROM (SELECT unnest(generate_series((SELECT min(month) FROM m_raw),
               (SELECT max(month) FROM m_raw), INTERVAL 1 MONTH)) AS d) g
  LEFT JOIN m_raw ON m_raw.month = CAST(g.d AS DATE)
)"""

MONTHLY = (
    MAU
    + """, sales AS (
  SELECT CAST(date_trunc('month', order_time) AS DATE) AS month,
         CAST(sum(amount - refund_amount) AS DOUBLE) AS revenue,
         count(DISTINCT user_id) AS paying_users, count(DISTINCT order_id) AS orders
  FROM w_transactions GROUP BY 1
), monthly AS (
  SELECT month, mau, coalesce(revenue, 0) AS revenue, coalesce(paying_users, 0) AS paying_users,
         coalesce(orders, 0) AS orders,
         coalesce(revenue, 0) / nullif(mau, 0) AS arpu,
         coalesce(revenue, 0) / nullif(paying_users, 0) AS arppu,
         coalesce(revenue, 0) / nullif(orders, 0) AS aov,
         CAST(coalesce(paying_users, 0) AS DOUBLE) / nullif(mau, 0) AS paying_rate
  FROM mau LEFT JOIN sales USING (month)
)"""
)

DAILY_KPIS = """
daily_kpis AS (
  SELECT date, dau, CAST(dau AS DOUBLE) / greatest(1, coalesce(mau, 0)) AS dau_mau
  FROM daily LEFT JOIN mau ON month = CAST(date_trunc('month', date) AS DATE)
)"""

COHORTS = """
c_size AS (
  SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort,
         count(DISTINCT user_id) AS cohort_size
  FROM w_users GROUP BY 1
), c_seen AS (
  SELECT CAST(date_trunc('month', u.signup_date) AS DATE) AS cohort,
         CAST((year(e.event_time) - year(u.signup_date)) * 12
              + month(e.event_time) - month(u.signup_date) AS INTEGER) AS period,
         count(DISTINCT user_id) AS n
  FROM w_events e JOIN w_users u USING (user_id) GROUP BY 1, 2
), c_periods AS (
  SELECT CAST(unnest(generate_series(0, (SELECT max(period) FROM c_seen))) AS INTEGER) AS period
), c_counts AS (
  SELECT a.cohort, p.period, coalesce(n, 0) AS active_users
  FROM (SELECT DISTINCT cohort FROM c_seen) a CROSS JOIN c_periods p
  LEFT JOIN c_seen s ON s.cohort = a.cohort AND s.period = p.period
), c_end AS (SELECT max(event_time) AS t FROM w_events), c_rates AS (
  SELECT strftime(z.cohort, '%Y-%m') AS cohort, p.period, z.cohort_size,
         CASE WHEN p.period <= (year(t) - year(z.cohort)) * 12 + month(t) - month(z.cohort)
              THEN CAST(active_users AS DOUBLE) / cohort_size END AS retention
  FROM c_size z CROSS JOIN c_periods p CROSS JOIN c_end
  LEFT JOIN c_counts c ON c.cohort = z.cohort AND c.period = p.period
)"""

SNAPSHOTS = """
spine AS (
  SELECT user_id, signup_date, snap
  FROM w_users CROSS JOIN (SELECT CAST(unnest({dates}) AS DATE) AS snap)
  WHERE signup_date < snap
), ev AS (
  SELECT s.user_id, s.snap,
    count(DISTINCT CAST(event_time AS DATE)) FILTER (event_time < snap
      AND event_time >= snap - INTERVAL 7 DAY) AS active_days_7d,
    count(DISTINCT CAST(event_time AS DATE)) FILTER (event_time < snap
      AND event_time >= snap - INTERVAL 30 DAY) AS active_days_30d,
    count(DISTINCT CAST(event_time AS DATE)) FILTER (event_time < snap
      AND event_time >= snap - INTERVAL 90 DAY) AS active_days_90d,
    count(*) FILTER (event_type = 'login' AND event_time < snap
      AND event_time >= snap - INTERVAL 30 DAY) AS login_count_30d,
    count(*) FILTER (event_type = 'browse' AND event_time < snap
      AND event_time >= snap - INTERVAL 30 DAY) AS browse_count_30d,
    count(*) FILTER (event_type = 'search' AND event_time < snap
      AND event_time >= snap - INTERVAL 30 DAY) AS search_count_30d,
    count(*) FILTER (event_type = 'add_to_cart' AND event_time < snap
      AND event_time >= snap - INTERVAL 30 DAY) AS cart_count_30d,
    date_sub('day', max(event_time) FILTER (event_time < snap), CAST(snap AS TIMESTAMP))
      AS days_since_last_active,
    CAST(sum(session_duration) FILTER (event_time < snap) AS DOUBLE)
      / nullif(count(session_duration) FILTER (event_time < snap), 0) AS avg_session_duration,
    count(*) FILTER (event_time >= snap AND event_time < snap + INTERVAL 30 DAY) AS returns
  FROM spine s LEFT JOIN w_events e ON e.user_id = s.user_id GROUP BY s.user_id, s.snap
), tx AS (
  SELECT s.user_id, s.snap,
    count(DISTINCT order_id) FILTER (order_time < snap
      AND order_time >= snap - INTERVAL 30 DAY) AS purchase_count_30d,
    count(DISTINCT order_id) FILTER (order_time < snap
      AND order_time >= snap - INTERVAL 90 DAY) AS purchase_count_90d,
    sum(amount - refund_amount) FILTER (order_time < snap
      AND order_time >= snap - INTERVAL 30 DAY) AS revenue_30d,
    sum(amount - refund_amount) FILTER (order_time < snap
      AND order_time >= snap - INTERVAL 90 DAY) AS revenue_90d,
    date_sub('day', max(order_time) FILTER (order_time < snap), CAST(snap AS TIMESTAMP))
      AS days_since_last_purchase,
    CAST(sum(amount - refund_amount) FILTER (order_time < snap) AS DOUBLE)
      / nullif(count(amount - refund_amount) FILTER (order_time < snap), 0) AS avg_order_value,
    count(DISTINCT order_id) FILTER (order_time < snap) AS past_orders,
    sum(amount - refund_amount) FILTER (order_time < snap) AS historical_ltv,
    sum(amount - refund_amount) FILTER (order_time >= snap
      AND order_time < snap + INTERVAL 90 DAY) AS future_90d_revenue
  FROM spine s LEFT JOIN w_transactions t ON t.user_id = s.user_id GROUP BY s.user_id, s.snap
), snapshots AS (
  SELECT s.user_id, s.snap AS snapshot_date,
    CAST(date_diff('day', signup_date, s.snap) AS INTEGER) AS tenure_days,
    CAST(active_days_7d AS INTEGER) AS active_days_7d,
    CAST(active_days_30d AS INTEGER) AS active_days_30d,
    CAST(active_days_90d AS INTEGER) AS active_days_90d,
    CAST(login_count_30d AS INTEGER) AS login_count_30d,
    CAST(browse_count_30d AS INTEGER) AS browse_count_30d,
    CAST(search_count_30d AS INTEGER) AS search_count_30d,
    CAST(cart_count_30d AS INTEGER) AS cart_count_30d,
    CAST(purchase_count_30d AS INTEGER) AS purchase_count_30d,
    CAST(purchase_count_90d AS INTEGER) AS purchase_count_90d,
    CAST(coalesce(revenue_30d, 0) AS DOUBLE) AS revenue_30d,
    CAST(coalesce(revenue_90d, 0) AS DOUBLE) AS revenue_90d,
    CAST(coalesce(days_since_last_active, 0) AS INTEGER) AS days_since_last_active,
    CAST(coalesce(days_since_last_purchase, 0) AS INTEGER) AS days_since_last_purchase,
    coalesce(avg_session_duration, 0) AS avg_session_duration,
    coalesce(avg_order_value, 0) AS avg_order_value,
    CAST(past_orders AS DOUBLE)
      / greatest(CAST(date_diff('day', signup_date, s.snap) AS DOUBLE) / 30, CAST(1 AS DOUBLE))
      AS purchase_frequency,
    CAST(coalesce(historical_ltv, 0) AS DOUBLE) AS historical_ltv,
    CAST(CASE WHEN returns = 0 THEN 1 ELSE 0 END AS INTEGER) AS churn_30d,
    CAST(coalesce(future_90d_revenue, 0) AS DOUBLE) AS future_90d_revenue
  FROM spine s JOIN ev ON ev.user_id = s.user_id AND ev.snap = s.snap
  JOIN tx ON tx.user_id = s.user_id AND tx.snap = s.snap
)"""

SPLITS = """
sp_test AS (SELECT max(snapshot_date) AS test FROM snapshots),
sp_dates AS (
  SELECT test,
    max(snapshot_date) FILTER (snapshot_date + INTERVAL 90 DAY <= test) AS lv,
    max(snapshot_date) FILTER (snapshot_date + INTERVAL 30 DAY <= test) AS cv
  FROM snapshots CROSS JOIN sp_test GROUP BY test
), split_rows AS (
  SELECT s.*,
    CAST(snapshot_date + INTERVAL 90 DAY AS DATE) AS ltv_label_mature_date,
    CAST(snapshot_date + INTERVAL 30 DAY AS DATE) AS churn_label_mature_date,
    CASE WHEN snapshot_date = test THEN 'test' WHEN snapshot_date = lv THEN 'validation'
         WHEN snapshot_date + INTERVAL 90 DAY <= lv THEN 'train' ELSE 'embargo' END AS ltv_split,
    CASE WHEN snapshot_date = test THEN 'test' WHEN snapshot_date = cv THEN 'validation'
         WHEN snapshot_date + INTERVAL 30 DAY <= cv THEN 'train' ELSE 'embargo' END AS churn_split,
    CASE WHEN snapshot_date = test THEN 'test' WHEN snapshot_date = lv THEN 'validation'
         WHEN snapshot_date + INTERVAL 90 DAY <= lv THEN 'train' ELSE 'embargo' END AS split
  FROM snapshots s CROSS JOIN sp_dates
)"""

SCORED = """
scored AS (
  SELECT *,
    CAST(100 + least(days_since_last_active, 89) * 9 + user_id % 10 AS DOUBLE) / 1000
      AS churn_probability,
    revenue_90d * CAST(0.5 AS DOUBLE) + historical_ltv / greatest(tenure_days, 1) * 45
      AS predicted_ltv
  FROM split_rows
), churn_test AS (
  SELECT *, churn_30d AS y, churn_probability AS p FROM scored WHERE churn_split = 'test'
), churn_val AS (
  SELECT *, churn_30d AS y, churn_probability AS p FROM scored WHERE churn_split = 'validation'
), ltv_test AS (SELECT * FROM scored WHERE ltv_split = 'test')"""

STEPS = """
tot AS (SELECT count(*) AS n, sum(y) AS pos FROM churn_test),
steps AS (
  SELECT p, n, pos, CAST(sum(n) OVER w AS BIGINT) AS cn, CAST(sum(pos) OVER w AS BIGINT) AS cp
  FROM (SELECT p, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos FROM churn_test GROUP BY p)
  WINDOW w AS (ORDER BY p DESC)
)"""

RANKED = """
tot AS (SELECT count(*) AS n, CAST(sum(y) AS DOUBLE) AS pos FROM churn_test),
ranked AS (
  SELECT user_id, y, row_number() OVER w AS rank, sum(y) OVER w AS hits
  FROM churn_test WINDOW w AS (ORDER BY p DESC, user_id ROWS UNBOUNDED PRECEDING)
)"""

SEGMENTS = """
segments AS (
  SELECT user_id, predicted_ltv, churn_probability,
    CASE WHEN predicted_ltv >= 100000 THEN 'High Value' ELSE 'Low Value' END AS value_segment,
    CASE WHEN churn_probability >= CAST(0.6 AS DOUBLE) THEN 'High Risk' ELSE 'Low Risk' END
      AS risk_segment,
    CASE WHEN predicted_ltv >= 100000
         THEN CASE WHEN churn_probability >= CAST(0.6 AS DOUBLE) THEN 'Priority Retention'
                   ELSE 'VIP Maintenance' END
         ELSE CASE WHEN churn_probability >= CAST(0.6 AS DOUBLE) THEN 'Automated Reactivation'
                   ELSE 'Growth/Nurture' END END AS customer_segment,
    CASE WHEN predicted_ltv >= 100000
         THEN CASE WHEN churn_probability >= CAST(0.6 AS DOUBLE)
                   THEN 'Personal outreach and retention offer'
                   ELSE 'VIP benefits and cross-sell' END
         ELSE CASE WHEN churn_probability >= CAST(0.6 AS DOUBLE)
                   THEN 'Automated win-back campaign'
                   ELSE 'Education and next-best-action nurture' END END AS recommended_action
  FROM ltv_test
)"""


RANGES = "range, key_from, key_to, n AS expected_rows, n AS actual_rows"


def _ranged(view: str, key: str) -> str:
    """Rows of 16 equal ranges of a key, and whether a range has the first or last key."""
    return f"""(
  SELECT CAST(floor((k - lo) / w) AS INTEGER) AS range, lo + w * CAST(floor((k - lo) / w) AS BIGINT) AS key_from,
         lo + w * CAST(floor((k - lo) / w) AS BIGINT) + w - 1 AS key_to, count(*) AS n,
         bool_or(k = lo OR k = hi) AS holds_end
  FROM (SELECT CAST({key} AS BIGINT) AS k FROM {view})
  CROSS JOIN (SELECT CAST(min({key}) AS BIGINT) AS lo, CAST(max({key}) AS BIGINT) AS hi,
                     CAST(ceil((max({key}) - min({key}) + 1) / 16.0) AS BIGINT) AS w FROM {view})
  GROUP BY 1, 2, 3)"""


def _with(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


# Statements on both worlds ---------------------------------------------------------


def _dn(days: tuple[int, ...] = (1, 7, 30)) -> str:
    def share(d: int) -> str:
        return f"""
        (SELECT CAST(count(DISTINCT user_id) AS DOUBLE)
         FROM w_events JOIN w_users USING (user_id)
         WHERE CAST(event_time AS DATE) = signup_date + {d} AND signup_date + {d} <= t)
        / nullif((SELECT count(*) FROM w_users WHERE signup_date + {d} <= t), 0)
          AS d{d}_retention"""

    return f"SELECT {', '.join(share(d) for d in days)} FROM (SELECT CAST(max(event_time) AS DATE) AS t FROM w_events)"


def _retention_by(column: str) -> str:
    def cell(d: int) -> str:
        return f"""CASE WHEN h.{column} IS NOT NULL
          THEN CAST(h.n{d} AS DOUBLE) / z.size END AS day_{d}"""

    hit = "count(DISTINCT user_id) FILTER (CAST(event_time AS DATE) = signup_date + {d}) AS n{d}"
    return f"""
    SELECT z.{column}, {cell(1)}, {cell(7)}, {cell(30)}
    FROM (SELECT {column}, count(DISTINCT user_id) AS size FROM w_users
          WHERE {column} IS NOT NULL GROUP BY 1) z
    LEFT JOIN (SELECT {column}, {hit.format(d=1)}, {hit.format(d=7)}, {hit.format(d=30)}
               FROM w_events JOIN w_users USING (user_id)
               WHERE CAST(event_time AS DATE) - signup_date IN (1, 7, 30) GROUP BY 1) h
      ON h.{column} = z.{column}"""


_ORPHANS = """(SELECT count(DISTINCT coalesce(user_id, -1)) FROM {t}
  WHERE NOT EXISTS (SELECT 1 FROM w_users u WHERE u.user_id = {t}.user_id))"""
_EARLY = """(SELECT count(*) FROM {t} JOIN w_users USING (user_id) WHERE {c} < signup_date)"""
_RULES = {
    "users_key": "(SELECT count(*) - count(DISTINCT user_id) FROM w_users)",
    "orphan_events": _ORPHANS.format(t="w_events"),
    "event_before_signup": _EARLY.format(t="w_events", c="event_time"),
    "session_duration": """(SELECT count(*) FROM w_events
      WHERE session_duration IS NULL OR session_duration < 0)""",
    "orphan_transactions": _ORPHANS.format(t="w_transactions"),
    "order_before_signup": _EARLY.format(t="w_transactions", c="order_time"),
    "amount": "(SELECT count(*) FROM w_transactions WHERE amount IS NULL OR amount <= 0)",
    "refund": """(SELECT count(*) FROM w_transactions WHERE refund_amount IS NULL
      OR refund_amount < 0 OR refund_amount > amount)""",
}

_KEYS = {"users": "user_id", "events": "event_id", "transactions": "order_id"}
_REQUIRED = {
    "users": ["signup_date", "channel"],
    "events": ["user_id", "event_time", "event_type", "session_duration"],
    "transactions": ["user_id", "order_time", "amount", "refund_amount"],
}


def _constraints() -> str:
    rows = []
    for table, key in _KEYS.items():
        rows.append(
            f"SELECT '{table}' AS table_name, 'primary_key' AS constraint_type, '{key}' AS columns, "
            f"count(*) - count(DISTINCT {key}) AS violations FROM w_{table}"
        )
        for c in _REQUIRED[table]:
            rows.append(
                f"SELECT '{table}', 'not_null', '{c}', count(*) FROM w_{table} WHERE {c} IS NULL"
            )
        if table != "users":
            rows.append(
                f"SELECT '{table}', 'foreign_key', 'user_id', count(*) FROM w_{table} t "
                "WHERE user_id IS NOT NULL "
                "AND NOT EXISTS (SELECT 1 FROM w_users u WHERE u.user_id = t.user_id)"
            )
    return "\nUNION ALL\n".join(rows)


def _profile() -> str:
    cells = {
        "users": ("w_users", "user_id", ["user_id", "signup_date", "channel", "region", "device"]),
        "events": (
            "w_events",
            "event_id",
            ["event_id", "user_id", "event_time", "event_type", "session_duration"],
        ),
        "orders": (
            "w_transactions",
            "order_id",
            ["order_id", "user_id", "order_time", "amount", "refund_amount"],
        ),
    }
    rows = []
    for name, (table, key, columns) in cells.items():
        missing = " + ".join(f"(count(*) - count({c}))" for c in columns)
        rows.append(
            f"SELECT '{name}' AS table_name, count(*) AS rows, "
            f"count(*) - count(DISTINCT {key}) AS duplicate_keys, {missing} AS missing_cells "
            f"FROM {table}"
        )
    return "\nUNION ALL\n".join(rows)


_QUANTILES = ", ".join(
    f"quantile_cont(CAST(amount - refund_amount AS DOUBLE), {q}) AS {n}"
    for n, q in {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}.items()
)

# name -> (extra CTEs, body)
SHARED: dict[str, tuple[tuple[str, ...], str]] = {
    "kpi_dau": ((DAILY,), "SELECT date, dau FROM daily"),
    "kpi_wau": (
        (
            """
w_raw AS (
  SELECT CAST(event_time AS DATE) + CAST((8 - isodow(event_time)) % 7 AS INTEGER) AS week,
         count(DISTINCT user_id) AS wau
  FROM w_events GROUP BY 1
)""",
        ),
        """
SELECT CAST(g.d AS DATE) AS week, coalesce(wau, 0) AS wau
FROM (SELECT unnest(generate_series((SELECT min(week) FROM w_raw),
             (SELECT max(week) FROM w_raw), INTERVAL 7 DAY)) AS d) g
LEFT JOIN w_raw ON w_raw.week = CAST(g.d AS DATE)""",
    ),
    "kpi_mau": ((MAU,), "SELECT month, mau FROM mau"),
    "kpi_monthly": ((MONTHLY,), "SELECT * FROM monthly"),
    "kpi_dau_mau": ((DAILY, MAU, DAILY_KPIS), "SELECT * FROM daily_kpis"),
    "kpi_channel_revenue": (
        (),
        """
SELECT channel, CAST(sum(amount - refund_amount) AS DOUBLE) AS revenue,
       count(DISTINCT user_id) AS paying_users, count(DISTINCT order_id) AS orders
FROM w_transactions JOIN w_users USING (user_id) WHERE channel IS NOT NULL GROUP BY channel""",
    ),
    "kpi_headline": (
        (MONTHLY,),
        """
SELECT CAST(sum(CAST(revenue AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue,
       avg(mau) AS average_mau, arg_max(mau, month) AS latest_mau,
       (SELECT arpu FROM monthly ORDER BY month DESC LIMIT 1) AS latest_arpu,
       (SELECT paying_rate FROM monthly ORDER BY month DESC LIMIT 1) AS latest_paying_rate
FROM monthly""",
    ),
    "sql_dau": (
        (),
        """
SELECT CAST(event_time AS DATE) AS activity_date, count(DISTINCT user_id) AS dau
FROM w_events GROUP BY 1 ORDER BY 1""",
    ),
    "sql_dau_mau": (
        (DAILY, MAU),
        """
SELECT d_raw.date AS dt, d_raw.dau, m_raw.mau, CAST(d_raw.dau AS DOUBLE) / m_raw.mau AS dau_mau
FROM d_raw JOIN m_raw ON month = CAST(date_trunc('month', d_raw.date) AS DATE)""",
    ),
    "sql_monthly_finance": (
        (),
        """
SELECT month_start, revenue, revenue / nullif(active_users, 0) AS arpu,
       revenue / nullif(payers, 0) AS arppu, revenue / nullif(orders, 0) AS aov,
       CAST(payers AS DOUBLE) / nullif(active_users, 0) AS paying_rate
FROM (SELECT CAST(date_trunc('month', event_time) AS DATE) AS month_start,
             count(DISTINCT user_id) AS active_users FROM w_events GROUP BY 1)
LEFT JOIN (SELECT CAST(date_trunc('month', order_time) AS DATE) AS month_start,
                  CAST(sum(amount - refund_amount) AS DOUBLE) AS revenue,
                  count(DISTINCT user_id) AS payers, count(*) AS orders
           FROM w_transactions GROUP BY 1) USING (month_start)""",
    ),
    "sql_channel_revenue": (
        (),
        """
SELECT channel, CAST(sum(amount - refund_amount) AS DOUBLE) AS revenue,
       count(DISTINCT user_id) AS paying_users
FROM w_transactions JOIN w_users USING (user_id) GROUP BY channel ORDER BY revenue DESC""",
    ),
    "sql_user_orders_last_active": (
        (),
        """
SELECT u.user_id,
       (SELECT count(*) FROM w_transactions t WHERE t.user_id = u.user_id) AS order_count,
       (SELECT max(event_time) FROM w_events e WHERE e.user_id = u.user_id) AS last_active
FROM w_users u""",
    ),
    **{f"dq_{rule}": ((), f"SELECT {sql} AS violations") for rule, sql in _RULES.items()},
    "dq_report": (
        (),
        "\nUNION ALL\n".join(
            f"SELECT '{rule}' AS rule, {sql} AS violations" for rule, sql in _RULES.items()
        ),
    ),
    "dq_summary": (
        (),
        f"""
SELECT (SELECT count(*) FROM w_users) AS users, (SELECT count(*) FROM w_events) AS events,
       (SELECT count(*) FROM w_transactions) AS transactions,
       CASE WHEN {" + ".join(_RULES.values())} > 0 THEN 'invalid' ELSE 'valid' END AS status""",
    ),
    "dq_constraints": ((), _constraints()),
    "dq_profile": ((), _profile()),
    "retention_dn": ((), _dn()),
    "cohort_size": ((COHORTS,), "SELECT cohort, cohort_size FROM c_size"),
    "cohort_counts": ((COHORTS,), "SELECT cohort, period, active_users FROM c_counts"),
    "cohort_retention": (
        (COHORTS,),
        "SELECT cohort, period, cohort_size, retention FROM c_rates",
    ),
    "retention_by_channel": ((), _retention_by("channel")),
    "retention_by_device": ((), _retention_by("device")),
    "snapshot_spine": ((SNAPSHOTS,), "SELECT user_id, snap AS snapshot_date FROM spine"),
    "snapshots": ((SNAPSHOTS,), "SELECT * FROM snapshots"),
    "label_churn": (
        (SNAPSHOTS,),
        """
SELECT user_id, snap AS snapshot_date,
       CAST(CASE WHEN EXISTS (SELECT 1 FROM w_events e WHERE e.user_id = s.user_id
                 AND event_time >= snap AND event_time < snap + INTERVAL 30 DAY)
            THEN 0 ELSE 1 END AS INTEGER) AS churn_30d
FROM spine s""",
    ),
    "label_ltv": (
        (SNAPSHOTS,),
        """
SELECT user_id, snap AS snapshot_date,
       CAST(coalesce((SELECT sum(amount - refund_amount) FROM w_transactions t
            WHERE t.user_id = s.user_id AND order_time >= snap
            AND order_time < snap + INTERVAL 90 DAY), 0) AS DOUBLE) AS future_90d_revenue
FROM spine s""",
    ),
    "eda_totals": (
        (),
        """
SELECT (SELECT count(*) FROM w_users) AS users, (SELECT count(*) FROM w_events) AS events,
       count(*) AS orders, CAST(sum(amount - refund_amount) AS DOUBLE) AS net_revenue
FROM w_transactions""",
    ),
    "eda_revenue_describe": (
        (),
        f"""
SELECT count(amount - refund_amount) AS count,
       CAST(sum(amount - refund_amount) AS DOUBLE) / count(amount - refund_amount) AS mean,
       round(stddev_samp(CAST(amount - refund_amount AS DOUBLE)), 4) AS std,
       CAST(min(amount - refund_amount) AS DOUBLE) AS min,
       CAST(max(amount - refund_amount) AS DOUBLE) AS max, {_QUANTILES}
FROM w_transactions""",
    ),
    "eda_channel_mix": (
        (),
        """SELECT channel, count(*) AS users FROM w_users
WHERE channel IS NOT NULL GROUP BY 1""",
    ),
    "eda_device_mix": ((), "SELECT device, count(*) AS users FROM w_users GROUP BY 1"),
    "eda_monthly_trend": (
        (
            MAU,
            """
t_raw AS (
  SELECT CAST(date_trunc('month', order_time) AS DATE) AS month,
         CAST(sum(amount - refund_amount) AS DOUBLE) AS net_revenue
  FROM w_transactions GROUP BY 1
), e_raw AS (
  SELECT CAST(date_trunc('month', event_time) AS DATE) AS month, count(*) AS events
  FROM w_events GROUP BY 1
), e_full AS (
  SELECT mau.month, coalesce(events, 0) AS events FROM mau LEFT JOIN e_raw USING (month)
), t_full AS (
  SELECT CAST(g.d AS DATE) AS month, coalesce(net_revenue, 0) AS net_revenue
  FROM (SELECT unnest(generate_series((SELECT min(month) FROM t_raw),
               (SELECT max(month) FROM t_raw), INTERVAL 1 MONTH)) AS d) g
  LEFT JOIN t_raw ON t_raw.month = CAST(g.d AS DATE)
)""",
        ),
        """SELECT coalesce(e_full.month, t_full.month) AS month, events, net_revenue
FROM e_full FULL JOIN t_full ON e_full.month = t_full.month""",
    ),
    "eda_event_funnel": (
        (),
        """
SELECT CAST(list_position(['browse', 'search', 'add_to_cart', 'purchase', 'login'], event_type)
            AS INTEGER) AS stage, event_type, count(*) AS events
FROM w_events WHERE event_type IN ('browse', 'search', 'add_to_cart', 'purchase', 'login')
GROUP BY event_type ORDER BY stage""",
    ),
    "bi_calendar": (
        (),
        """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       CAST(date_trunc('month', d) AS DATE) AS month_start,
       CAST(d AS DATE) + CAST((8 - isodow(d)) % 7 AS INTEGER) AS week_ending
FROM (SELECT unnest(generate_series(
        (SELECT least((SELECT min(CAST(event_time AS DATE)) FROM w_events),
                      (SELECT min(CAST(order_time AS DATE)) FROM w_transactions))),
        (SELECT greatest((SELECT max(CAST(event_time AS DATE)) FROM w_events),
                         (SELECT max(CAST(order_time AS DATE)) FROM w_transactions))),
        INTERVAL 1 DAY)) AS d)""",
    ),
    "run_manifest": (
        (),
        """
SELECT (SELECT count(*) FROM w_users) AS users, (SELECT count(*) FROM w_events) AS events,
       (SELECT count(*) FROM w_transactions) AS orders,
       least((SELECT min(CAST(signup_date AS TIMESTAMP)) FROM w_users),
             (SELECT min(event_time) FROM w_events)) AS date_start,
       greatest((SELECT max(event_time) FROM w_events),
                (SELECT max(order_time) FROM w_transactions)) AS date_end,
       CAST(42 AS INTEGER) AS seed""",
    ),
    "kpi_trend": (
        (DAILY, MONTHLY, DAILY_KPIS),
        """
SELECT k.date, k.dau, k.dau_mau, m.mau, m.revenue AS month_revenue
FROM daily_kpis k
LEFT JOIN monthly m ON m.month = CAST(date_trunc('month', k.date) AS DATE)""",
    ),
}

# Statements on the commerce world ------------------------------------------------------

_CLASSIFICATION = """
SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
       coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
       coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
       coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1
FROM (SELECT count(*) FILTER (y = 1 AND p >= t) AS tp, count(*) FILTER (y = 0 AND p >= t) AS fp,
             count(*) FILTER (y = 1 AND p < t) AS fn, count(*) FILTER (y = 0 AND p < t) AS tn
      FROM churn_test CROSS JOIN (SELECT CAST({t} AS DOUBLE) AS t))"""

_AUC = """CAST(sum(CAST(n - pos AS HUGEINT) * (2 * cp - pos)) AS DOUBLE) / 2
  / (CAST(any_value(tp) AS DOUBLE) * CAST(any_value(tn) - any_value(tp) AS DOUBLE))"""
_AP = "sum(CAST(pos AS DOUBLE) / tp * (CAST(cp AS DOUBLE) / cn))"
_STEP_JOIN = "steps CROSS JOIN (SELECT n AS tn, CAST(pos AS BIGINT) AS tp FROM tot)"
_TOP = """
SELECT hits / k AS precision_at_top_10pct, hits / greatest(1, pos) AS recall_at_top_10pct,
       (hits / k) / (pos / n) AS lift_at_top_10pct
FROM (SELECT CAST(sum(y) AS DOUBLE) AS hits, any_value(k) AS k, any_value(pos) AS pos,
             any_value(n) AS n
      FROM ranked CROSS JOIN (SELECT pos, CAST(n AS DOUBLE) AS n,
        greatest(1, ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE))) AS k FROM tot)
      WHERE rank <= k)"""
_BRIER = """
SELECT round(avg((p - y) * (p - y)), 9) AS brier_score,
       CAST(sum(y) AS DOUBLE) / count(*) AS prevalence,
       CAST(sum(y) AS DOUBLE) / count(*) AS no_skill_pr_auc
FROM churn_test"""
_GRID = """
SELECT t AS threshold, coalesce(CAST(2 * tp AS DOUBLE) / nullif(flagged + positives, 0), 0) AS f1
FROM (SELECT t, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t) AS flagged,
             count(*) FILTER (y = 1) AS positives
      FROM churn_val CROSS JOIN (SELECT CAST(0.1 AS DOUBLE) + i * CAST(0.005 AS DOUBLE) AS t
                                 FROM range(161) r(i)) GROUP BY t)"""


def _histogram(table: str, column: str, bins: int) -> str:
    return f"""
SELECT b.bin, lo + b.bin * ((hi - lo) / {bins}) AS left_edge,
       lo + (b.bin + 1) * ((hi - lo) / {bins}) AS right_edge, coalesce(c.rows, 0) AS rows
FROM (SELECT CAST(i AS BIGINT) AS bin FROM range({bins}) r(i)) b
CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) e
LEFT JOIN (SELECT CAST(least(floor(({column} - lo) / (hi - lo) * {bins}), {bins - 1}) AS BIGINT) AS bin,
                  count(*) AS rows
           FROM {table} CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})
           GROUP BY 1) c ON c.bin = b.bin"""


_EDGES = ", ".join(f"quantile_cont(p, {i / 10}) AS q{i}" for i in range(1, 10))
_SLOT = " + ".join(f"CAST(p > q{i} AS INTEGER)" for i in range(1, 10))


def _measures(channel: str | None) -> str:
    """Cards recompute everything from the members' rows."""
    keep = f"WHERE channel = '{channel}'" if channel else ""
    return f"""
, m_users AS (SELECT * FROM w_users {keep}),
m_events AS (SELECT e.* FROM w_events e SEMI JOIN m_users USING (user_id)),
m_tx AS (SELECT t.* FROM w_transactions t SEMI JOIN m_users USING (user_id)),
m_days AS (SELECT CAST(event_time AS DATE) AS d, count(DISTINCT user_id) AS dau FROM m_events GROUP BY 1),
m_mau AS (SELECT date_trunc('month', event_time) AS m, count(DISTINCT user_id) AS mau FROM m_events GROUP BY 1),
m_sales AS (SELECT date_trunc('month', order_time) AS m, sum(amount - refund_amount) AS rev,
                   count(DISTINCT user_id) AS payers FROM m_tx GROUP BY 1),
m_one AS (
  SELECT (SELECT count(DISTINCT user_id) FROM m_users) AS total_users,
    (SELECT CAST(coalesce(sum(rev), 0) AS DOUBLE) FROM m_sales WHERE m IN (SELECT m FROM m_mau)) AS revenue,
    (SELECT CAST(sum(mau) AS BIGINT) FROM m_mau) AS mau,
    (SELECT CAST(coalesce(sum(payers), 0) AS BIGINT) FROM m_sales WHERE m IN (SELECT m FROM m_mau)) AS paying_users,
    (SELECT CAST(sum(dau) AS BIGINT) FROM m_days) AS dau,
    (SELECT CAST(sum(churn_30d) AS DOUBLE) / count(churn_30d) FROM ltv_test SEMI JOIN m_users USING (user_id)) AS churn_rate,
    (SELECT round(avg(predicted_ltv), 4) FROM segments SEMI JOIN m_users USING (user_id)) AS avg_predicted_ltv,
    (SELECT count(DISTINCT user_id) FROM segments SEMI JOIN m_users USING (user_id)
     WHERE risk_segment = 'High Risk') AS high_risk_users
), measures AS (
  SELECT *, revenue / nullif(mau, 0) AS arpu, revenue / nullif(paying_users, 0) AS arppu,
         CAST(dau AS DOUBLE) / nullif(mau, 0) AS dau_mau FROM m_one)"""


_CARDS = (
    """
SELECT total_users, mau, dau_mau, revenue, arpu, churn_rate, avg_predicted_ltv,
       d1_retention, d7_retention, d30_retention
FROM measures CROSS JOIN ("""
    + _dn().replace("w_events", "m_events").replace("w_users", "m_users")
    + ")"
)


def _commerce() -> dict[str, str]:
    base = (COMMERCE, SNAPSHOTS.format(dates=SNAPSHOT_DATES["commerce"]), SPLITS)
    scored = (*base, SCORED)
    steps, ranked = (*scored, STEPS), (*scored, RANKED)
    seg = (*scored, SEGMENTS)
    target = "(SELECT future_90d_revenue AS v FROM split_rows WHERE ltv_split IN ('train', 'validation'))"
    checks = [
        f"SELECT 'rows_{t}' AS check_name, CAST(count(*) AS DOUBLE) AS expected, "
        f"CAST(count(*) AS DOUBLE) AS actual, true AS ok FROM {s}"
        for t, s in {
            "users": "w_users",
            "events": "w_events",
            "transactions": "w_transactions",
            "user_snapshots": "snapshots",
        }.items()
    ]
    for name, table in {"orphan_events": "w_events", "orphan_transactions": "w_transactions"}.items():
        checks.append(
            f"SELECT '{name}', CAST(0 AS DOUBLE), CAST(count(*) AS DOUBLE), count(*) = 0 FROM {table} t "
            "WHERE NOT EXISTS (SELECT 1 FROM w_users u WHERE u.user_id = t.user_id)"
        )
    checks.append(
        "SELECT 'net_revenue', (SELECT CAST(sum(CAST(revenue AS DECIMAL(20,2))) AS DOUBLE) FROM monthly), "
        "CAST(sum(amount - refund_amount) AS DOUBLE), true FROM w_transactions"
    )
    f = _with
    return {
        "snapshots_from_state": f(*base[:2], body="SELECT * FROM snapshots"),
        "cohort_matrix": f(
            COMMERCE,
            COHORTS,
            body="""
SELECT cohort, CAST((SELECT max(period) + 1 FROM c_rates) AS INTEGER) AS periods,
       string_agg(coalesce(CAST(CAST(retention AS DECIMAL(12,9)) AS VARCHAR), ''), ',' ORDER BY period) AS rates
FROM c_rates GROUP BY cohort""",
        ),
        **{
            f"model_{target}_design": f(
                *base,
                body=f"""
SELECT '{target}_split' AS split_column,
       (SELECT string_agg(d, ',' ORDER BY d) FROM
          (SELECT DISTINCT strftime(snapshot_date, '%Y-%m-%d') AS d FROM split_rows
           WHERE {target}_split = 'train')) AS train_snapshots,
       strftime({date}, '%Y-%m-%d') AS validation_snapshot, strftime(test, '%Y-%m-%d') AS test_snapshot,
       {days} AS label_horizon_days
FROM sp_dates""",
            )
            for target, date, days in (("ltv", "lv", 90), ("churn", "cv", 30))
        },
        "model_ols_log1p": f(
            *base,
            body="""
SELECT round(regr_slope(y, x), 9) AS slope, round(regr_intercept(y, x), 6) AS intercept
FROM (SELECT ln(1 + CAST(future_90d_revenue AS DOUBLE)) AS y, CAST(historical_ltv AS DOUBLE) AS x
      FROM split_rows WHERE ltv_split = 'train')""",
        ),
        "model_scale_moments": f(
            *base,
            body="\nUNION ALL\n".join(
                f"SELECT '{c}' AS feature, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
                f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std FROM split_rows WHERE churn_split = 'train'"
                for c in ("tenure_days", "active_days_30d", "revenue_90d")
            ),
        ),
        "model_platt_map": f(
            *scored,
            body="""
SELECT user_id, round(1 / (1 + exp(-(ln(p / (1 - p)) * CAST(0.8 AS DOUBLE) - CAST(0.3 AS DOUBLE)))), 9)
         AS calibrated
FROM churn_test""",
        ),
        "model_hurdle_product": f(
            *scored,
            body="""
SELECT user_id, round(churn_probability * greatest(0, exp(ln(1 + predicted_ltv) / 2 - 1) - 1), 6)
         AS predicted
FROM ltv_test""",
        ),
        "split_audit_leaky": f(
            *base,
            body="""
SELECT 'ltv' AS target, count(*) FILTER (ltv_split IN ('train', 'embargo') AND ltv_label_mature_date > lv) AS late_train,
       CAST(0 AS BIGINT) AS late_validation
FROM split_rows CROSS JOIN sp_dates
UNION ALL
SELECT 'churn', count(*) FILTER (churn_split IN ('train', 'embargo') AND churn_label_mature_date > cv), CAST(0 AS BIGINT)
FROM split_rows CROSS JOIN sp_dates""",
        ),
        "cohort_heatmap": f(
            COMMERCE,
            COHORTS,
            body="SELECT cohort, period, cohort_size, retention FROM c_rates WHERE period < 12",
        ),
        "kpi_last_months": f(
            COMMERCE, MONTHLY, body="SELECT * FROM monthly ORDER BY month DESC LIMIT 5"
        ),
        "reconcile": f(*base, MONTHLY, body="\nUNION ALL\n".join(checks)),
        "reconcile_digests": f(
            *base,
            body="\nUNION ALL\n".join(
                f"SELECT '{t}' AS table_name, {RANGES}, true AS ok FROM {_ranged(view, key)}"
                for t, view, key in (
                    ("users", "w_users", "user_id"),
                    ("events", "w_events", "event_id"),
                    ("transactions", "w_transactions", "order_id"),
                    ("user_snapshots", "snapshots", "user_id"),
                )
            ),
        ),
        "reconcile_swapped": f(
            COMMERCE,
            body=f"""
SELECT {RANGES}, NOT (holds_end AND two) AS ok
FROM {_ranged("w_transactions", "order_id")}
CROSS JOIN (SELECT count(DISTINCT amount) = 2 AS two FROM w_transactions
            WHERE order_id IN ((SELECT min(order_id) FROM w_transactions), (SELECT max(order_id) FROM w_transactions)))""",
        ),
        "temporal_splits": f(*base, body="SELECT * FROM split_rows"),
        "split_audit": f(
            *base,
            body="""
SELECT 'ltv' AS target,
       count(*) FILTER (ltv_split = 'train' AND ltv_label_mature_date > lv) AS late_train,
       count(*) FILTER (ltv_split = 'validation' AND ltv_label_mature_date > test) AS late_validation
FROM split_rows CROSS JOIN sp_dates
UNION ALL
SELECT 'churn',
       count(*) FILTER (churn_split = 'train' AND churn_label_mature_date > cv),
       count(*) FILTER (churn_split = 'validation' AND churn_label_mature_date > test)
FROM split_rows CROSS JOIN sp_dates""",
        ),
        "split_counts": f(
            *base,
            body="""
SELECT snapshot_date, count(*) FILTER (ltv_split = 'train') AS train,
       count(*) FILTER (ltv_split = 'embargo') AS embargo,
       count(*) FILTER (ltv_split = 'validation') AS validation,
       count(*) FILTER (ltv_split = 'test') AS test
FROM split_rows GROUP BY snapshot_date""",
        ),
        "churn_rate_by_split": f(
            *base,
            body="""SELECT churn_split, CAST(sum(churn_30d) AS DOUBLE) / count(*) AS churn_rate
FROM split_rows GROUP BY churn_split""",
        ),
        "ltv_baselines": f(
            *base,
            body=f"""
SELECT CAST(0 AS DOUBLE) AS zero_baseline, round(avg(v), 4) AS mean_baseline,
       quantile_cont(v, 0.5) AS median_baseline FROM {target}""",
        ),
        "class_weights": f(
            *base,
            body="""
SELECT churn_30d AS label, count(*) AS rows,
       CAST((SELECT count(*) FROM split_rows WHERE churn_split = 'train') AS DOUBLE)
         / (2 * count(*)) AS weight
FROM split_rows WHERE churn_split = 'train' GROUP BY churn_30d""",
        ),
        "metric_regression": f(
            *scored,
            body="""
SELECT model, round(avg(abs(a - p)), 4) AS mae, round(sqrt(avg((a - p) * (a - p))), 4) AS rmse,
       round(1 - avg((a - p) * (a - p)) / var_pop(a), 9) AS r2
FROM (SELECT 'zero_baseline' AS model, future_90d_revenue AS a, CAST(0 AS DOUBLE) AS p FROM ltv_test
      UNION ALL SELECT 'pace', future_90d_revenue, predicted_ltv FROM ltv_test) GROUP BY model""",
        ),
        "metric_classification": f(*scored, body=_CLASSIFICATION.format(t="0.6")),
        "metric_classification_fixed": f(*scored, body=_CLASSIFICATION.format(t="0.5")),
        "metric_roc_auc": f(*steps, body=f"SELECT {_AUC} AS roc_auc FROM {_STEP_JOIN}"),
        "metric_average_precision": f(
            *steps,
            body=f"""SELECT round({_AP}, 9) AS pr_auc,
       round({_AP} / (CAST(any_value(tp) AS DOUBLE) / any_value(tn)), 9) AS pr_auc_lift
FROM {_STEP_JOIN}""",
        ),
        "metric_brier": f(*scored, body=_BRIER),
        "metric_top_decile": f(*ranked, body=_TOP),
        "metric_table": f(
            *steps,
            RANKED[RANKED.index("ranked AS") :],
            body=f"""
SELECT 'selected' AS cutoff, CAST(0.6 AS DOUBLE) AS threshold, a.*, s.*, b.*, t.*
FROM ({_CLASSIFICATION.format(t="0.6")}) a
CROSS JOIN (SELECT {_AUC} AS roc_auc, round({_AP}, 9) AS pr_auc,
            round({_AP} / (CAST(any_value(tp) AS DOUBLE) / any_value(tn)), 9) AS pr_auc_lift
            FROM {_STEP_JOIN}) s
CROSS JOIN ({_BRIER}) b CROSS JOIN ({_TOP}) t
UNION ALL
SELECT 'fixed_0_5', CAST(0.5 AS DOUBLE), a.*, s.*, b.*, t.*
FROM ({_CLASSIFICATION.format(t="0.5")}) a
CROSS JOIN (SELECT {_AUC} AS roc_auc, round({_AP}, 9) AS pr_auc,
            round({_AP} / (CAST(any_value(tp) AS DOUBLE) / any_value(tn)), 9) AS pr_auc_lift
            FROM {_STEP_JOIN}) s
CROSS JOIN ({_BRIER}) b CROSS JOIN ({_TOP}) t""",
        ),
        "threshold_search": f(
            *scored, body=f"SELECT * FROM ({_GRID}) ORDER BY f1 DESC, threshold LIMIT 1"
        ),
        "threshold_grid": f(*scored, body=_GRID),
        "confusion_matrix": f(
            *scored,
            body="""
SELECT y AS label, CAST(p >= CAST(0.6 AS DOUBLE) AS INTEGER) AS predicted, count(*) AS rows
FROM churn_test GROUP BY 1, 2""",
        ),
        "roc_curve": f(
            *steps,
            body=f"""
SELECT p AS threshold, CAST(cn - cp AS DOUBLE) / (tn - tp) AS fpr, CAST(cp AS DOUBLE) / tp AS tpr
FROM {_STEP_JOIN}
UNION ALL SELECT NULL, 0, 0""",
        ),
        "pr_curve": f(
            *steps,
            body=f"""
SELECT p AS threshold, CAST(cp AS DOUBLE) / cn AS precision, CAST(cp AS DOUBLE) / tp AS recall
FROM {_STEP_JOIN}
UNION ALL SELECT NULL, 1, 0""",
        ),
        "calibration_curve": f(
            *scored,
            body=f"""
SELECT {_SLOT} AS bin, round(avg(p), 9) AS mean_predicted,
       CAST(sum(y) AS DOUBLE) / count(*) AS observed_rate, count(*) AS rows
FROM churn_test CROSS JOIN (SELECT {_EDGES} FROM churn_test) GROUP BY 1""",
        ),
        "lift_curve": f(
            *ranked,
            body="""
SELECT user_id, rank, rank / CAST(n AS DOUBLE) AS population,
       (CAST(hits AS DOUBLE) / rank) / (pos / CAST(n AS DOUBLE)) AS lift
FROM ranked CROSS JOIN tot""",
        ),
        "ltv_top_errors": f(
            *scored,
            body="""
SELECT user_id, future_90d_revenue, predicted_ltv,
       abs(future_90d_revenue - predicted_ltv) AS absolute_error
FROM ltv_test ORDER BY absolute_error DESC, user_id LIMIT 15""",
        ),
        "ltv_histogram": f(*scored, body=_histogram("ltv_test", "future_90d_revenue", 60)),
        "target_histogram": f(*base, body=_histogram(target, "v", 40)),
        "segment_default_threshold": f(
            *base,
            body="""
SELECT coalesce(quantile_cont(future_90d_revenue, 0.5), 1) AS value_threshold
FROM split_rows WHERE ltv_split = 'train' AND future_90d_revenue > 0""",
        ),
        "segments": f(*seg, body="SELECT * FROM segments"),
        "segment_counts": f(
            *seg, body="SELECT customer_segment, count(*) AS users FROM segments GROUP BY 1"
        ),
        "customer_predictions": f(
            *seg,
            body="""
SELECT user_id, snapshot_date, t.predicted_ltv, t.churn_probability, customer_segment
FROM ltv_test t JOIN segments USING (user_id)""",
        ),
        "bi_customer_features": f(*base, body="SELECT * FROM split_rows WHERE split = 'test'"),
        "bi_measures": f(*seg, body=_measures(None) + "SELECT * FROM measures"),
        "bi_executive_cards": f(*seg, body=_measures(None) + _CARDS),
        "bi_channel_cards": f(*seg, body=_measures("MACHINERY") + _CARDS),
        "bi_ltv_by_channel": f(
            *seg,
            body="""
SELECT channel, round(avg(predicted_ltv), 4) AS avg_predicted_ltv, count(*) AS users
FROM segments JOIN w_users USING (user_id) GROUP BY channel""",
        ),
        "bi_value_segments": f(
            *seg, body="SELECT value_segment, count(*) AS users FROM segments GROUP BY 1"
        ),
        "bi_probability_histogram": f(*seg, body=_histogram("segments", "churn_probability", 40)),
        "bi_high_risk": f(
            *seg,
            body="""
SELECT s.user_id, channel, device, s.churn_probability, s.predicted_ltv, customer_segment,
       recommended_action, days_since_last_active, historical_ltv
FROM segments s JOIN w_users USING (user_id) JOIN ltv_test USING (user_id)
WHERE risk_segment = 'High Risk'""",
        ),
        "ltv_actual_vs_predicted": f(
            *scored, body="SELECT user_id, future_90d_revenue, predicted_ltv FROM ltv_test"
        ),
        "value_risk_points": f(
            *seg,
            body="SELECT user_id, predicted_ltv, churn_probability, customer_segment FROM segments",
        ),
    }


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (parts, body) in SHARED.items():
        for world, suffix in (("commerce", ""), ("activity", "_activity")):
            filled = [p.replace("{dates}", SNAPSHOT_DATES[world]) for p in parts]
            raw = "_raw" if name.startswith("dq_") and name != "dq_summary" else ""
            out[name + suffix] = _with(WORLDS[world + raw], *filled, body=body)
        if name.startswith(("kpi_", "sql_", "cohort_", "retention_")):
            filled = [p.replace("{dates}", SNAPSHOT_DATES["commerce"]) for p in parts]
            out[f"{name}_raw"] = _with(WORLDS["commerce_raw"], *filled, body=body)
    out.update(_commerce())
    return out
