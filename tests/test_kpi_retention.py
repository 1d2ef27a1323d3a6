import datetime as dt

import pytest

from tests.conftest import EVENTS, USERS, day, frame, ts
from valuetide.operators import kpi, retention
from valuetide.sources import schemas, sinks


def rows(df, *keys):
    return [tuple(r[k] for k in keys) for r in df.orderBy(keys[0]).collect()]


def test_monthly_kpis(sample):
    _, events, orders = sample
    found = {r["month"]: r for r in kpi.monthly_kpis(events, orders).collect()}
    feb = found[day("2024-02-01")]
    assert (feb["revenue"], feb["aov"], feb["mau"], feb["paying_rate"]) == (90.0, 90.0, 1, 1.0)
    jan = found[day("2024-01-01")]
    assert (jan["revenue"], jan["orders"], jan["aov"], jan["arpu"]) == (0.0, 0, None, 0.0)


def test_no_orders_at_all(spark, sample):
    monthly = kpi.monthly_kpis(sample[1], schemas.empty(spark, "transactions"))
    assert [r["revenue"] for r in monthly.collect()] == [0.0, 0.0]


def test_gap_days_weeks_and_months_are_zero(spark):
    events = frame(
        spark,
        [(1, 1, ts("2024-01-01T10:00"), "login", 1.0), (2, 1, ts("2024-03-05"), "login", 1.0)],
        EVENTS,
    )
    daily = rows(kpi.dau(events), "date", "dau")
    assert len(daily) == 65 and daily[1] == (day("2024-01-02"), 0)
    assert rows(kpi.mau(events), "month", "mau") == [
        (day("2024-01-01"), 1),
        (day("2024-02-01"), 0),
        (day("2024-03-01"), 1),
    ]
    weekly = rows(kpi.wau(events), "week", "wau")
    assert weekly[0] == (day("2024-01-01"), 1)
    assert weekly[-1] == (day("2024-03-11"), 1)
    assert len(weekly) == 11


@pytest.mark.parametrize(
    "moment,label",
    [
        ("2024-01-01T23:59", "2024-01-01"),  # Monday closes its week
        ("2024-01-02", "2024-01-08"),  # Tuesday opens the next
        ("2024-01-07", "2024-01-08"),
    ],
)
def test_weeks_run_tuesday_to_monday(spark, moment, label):
    events = frame(spark, [(1, 1, ts(moment), "login", 1.0)], EVENTS)
    assert rows(kpi.wau(events), "week", "wau") == [(day(label), 1)]


def test_stickiness_uses_the_month_of_the_day(sample):
    daily = {r["date"]: r["dau_mau"] for r in kpi.daily_kpis(sample[1]).collect()}
    assert daily[day("2024-01-01")] == 0.5
    assert daily[day("2024-02-01")] == 1.0
    assert daily[day("2024-01-05")] == 0.0


def test_shared_rollup_gives_the_same_kpis(sample):
    _, events, orders = sample
    days = kpi.user_days(events)
    direct, shared = kpi.monthly_kpis(events, orders), kpi.monthly_kpis(days, orders)
    assert rows(direct, "month", "mau", "arpu") == rows(shared, "month", "mau", "arpu")


def test_channel_revenue_counts_an_order_id_once_per_channel(spark, sample):
    users, _, orders = sample
    twice = orders.unionByName(orders)
    found = kpi.channel_revenue(users, twice).collect()
    assert [(r["channel"], r["revenue"], r["orders"]) for r in found] == [("organic", 180.0, 1)]


def test_day_7_retention(sample):
    users, events, _ = sample
    row = retention.day_n_retention(users, events).first()
    assert row["d7_retention"] == 0.5
    assert row["d1_retention"] == 0.5
    assert row["d30_retention"] == 0.0


def test_nobody_matured_is_null(spark):
    users = frame(spark, [(1, day("2024-01-01"), "a", "Web")], USERS)
    events = frame(spark, [(1, 1, ts("2024-01-02"), "login", 1.0)], EVENTS)
    row = retention.day_n_retention(users, events).first()
    assert (row["d1_retention"], row["d7_retention"]) == (1.0, None)


@pytest.fixture
def censoring(spark):
    users = frame(
        spark,
        [
            (1, day("2024-01-01"), "a", "Web"),
            (2, day("2024-01-01"), "a", "Web"),
            (3, day("2024-03-01"), "a", "Web"),
        ],
        USERS,
    )
    events = frame(
        spark,
        [(1, ts("2024-01-01")), (2, ts("2024-03-15")), (3, ts("2024-03-15"))],
        "user_id long, event_time timestamp_ntz",
    )
    return users, events


def test_unmatured_is_null_and_matured_silence_is_zero(censoring):
    cells = {
        (r["cohort"], r["period"]): r["retention"]
        for r in retention.cohort_retention(*censoring).collect()
    }
    assert cells["2024-03", 1] is None
    assert cells["2024-01", 1] == 0.0
    assert cells["2024-01", 2] == 0.5


def test_silent_cohort_is_null_throughout(spark, censoring):
    users, events = censoring
    silent = frame(spark, [(9, day("2024-02-01"), "a", "Web")], USERS)
    cells = retention.cohort_retention(users.unionByName(silent), events)
    found = cells.where("cohort = '2024-02'").collect()
    assert len(found) == 3 and all(r["retention"] is None for r in found)


def test_matrix_has_one_column_per_period(censoring):
    matrix = retention.cohort_matrix(retention.cohort_retention(*censoring))
    assert matrix.columns == ["cohort", "0", "1", "2"]
    assert [tuple(r) for r in matrix.orderBy("cohort").collect()] == [
        ("2024-01", 0.5, 0.0, 0.5),
        ("2024-03", 1.0, None, None),
    ]
    wide = retention.cohort_matrix(retention.cohort_retention(*censoring), periods=400)
    assert len(wide.columns) == 401 and wide.select("399").first()[0] is None


def test_dimension_without_hits_is_null_and_missing_day_zero(spark, sample):
    users, events, _ = sample
    quiet = frame(spark, [(7, day("2024-01-01"), "ads", "Web")], USERS)
    found = {
        r["channel"]: (r["day_1"], r["day_7"], r["day_30"])
        for r in retention.retention_by(users.unionByName(quiet), events, "channel").collect()
    }
    assert found == {
        "organic": (0.0, 1.0, 0.0),
        "search": (1.0, 0.0, 0.0),
        "ads": (None, None, None),
    }


def test_hot_user_is_one_row_per_day(spark):
    hot = spark.range(30_000).selectExpr(
        "1L AS user_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 3) AS event_time",
    )
    assert kpi.user_days(hot).count() == 3
    assert [r["dau"] for r in kpi.dau(hot).collect()] == [1, 1, 1]


def test_one_pass_counts_equal_distinct_users(spark):
    """Weeks, months and days of made user-days, NULL users and dates among them, by brute force."""
    import random

    rng = random.Random(2)
    start = dt.date(2023, 12, 20)
    rows = {(rng.choice([1, 2, 3, 4, 5, None]), start + dt.timedelta(rng.randrange(90))) for _ in range(150)}
    rows |= {(7, None), (1, start), (None, start - dt.timedelta(3))}
    days = frame(spark, sorted(rows, key=repr), "user_id long, date date")
    held = [(u, d) for u, d in rows if d]
    monday = lambda d: d + dt.timedelta((7 - d.weekday()) % 7)
    for found, bucket in (
        (kpi.dau(days), lambda d: d),
        (kpi.wau(days), monday),
        (kpi.mau(days), lambda d: d.replace(day=1)),
    ):
        want = {}
        for u, d in held:
            want.setdefault(bucket(d), set()).update({u} - {None})
        got = {tuple(r)[0]: tuple(r)[1] for r in found.collect()}
        assert {k: v for k, v in got.items() if v} == {k: len(v) for k, v in want.items() if v}
        assert min(got) == min(want) and max(got) == max(want)


def test_user_days_are_exchanged_once(spark, sample):
    users, events, _ = sample
    days = sinks.materialize(kpi.user_days(events), "days")
    plan = kpi.daily_activity(days)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1 and "Expand" not in plan
    kept = retention.calculate_retention(users, events)
    alone = retention.day_n_retention(users, events).collect()
    assert kept.summary.collect() == alone
    for name in ("channel", "device"):
        one = retention.retention_by(users, events, name)
        assert sorted(one.collect()) == sorted(getattr(kept, f"by_{name}").collect())


def test_repeated_users_count_once(spark, censoring):
    users, events = censoring
    again = users.unionByName(frame(spark, [(2, day("2024-01-20"), "b", "Web")], USERS))
    cells = {(r["cohort"], r["period"]): r["active_users"] for r in retention.cohort_counts(again, events).collect()}
    assert cells == {(day("2024-01-01"), 0): 1, (day("2024-01-01"), 1): 0, (day("2024-01-01"), 2): 1, (day("2024-03-01"), 0): 1, (day("2024-03-01"), 1): 0, (day("2024-03-01"), 2): 0}


def test_headline(sample):
    row = kpi.headline(kpi.monthly_kpis(sample[1], sample[2])).first()
    assert (row["total_revenue"], row["average_mau"], row["latest_mau"]) == (90.0, 1.5, 1)
    assert row["latest_arpu"] == 90.0


def test_daily_window_input_is_bounded_by_the_calendar(spark):
    span = kpi.dau(
        frame(
            spark,
            [(1, 1, ts("2000-01-01"), "login", 1.0), (2, 1, ts("2009-12-31"), "login", 1.0)],
            EVENTS,
        )
    )
    assert span.count() == (dt.date(2009, 12, 31) - dt.date(2000, 1, 1)).days + 1


def test_a_buyer_of_most_orders_reaches_the_join_once(spark):
    users = spark.range(5).selectExpr("id AS user_id", "IF(id % 2 = 0, 'a', 'b') AS channel")
    orders = spark.range(2000).selectExpr(
        "id AS order_id", "IF(id < 1900, 0L, id % 6) AS user_id", "timestamp_ntz'2024-01-02 00:00:00' AS order_time",
        "CAST(2 AS DECIMAL(12,2)) AS amount", "CAST(0 AS DECIMAL(12,2)) AS refund_amount",
    )
    rows = {r["channel"]: tuple(r)[1:] for r in kpi.channel_revenue(users, orders).collect()}
    owners = [0] * 1900 + [k % 6 for k in range(1900, 2000)]
    for name, ids in {"a": (0, 2, 4), "b": (1, 3)}.items():
        n = sum(o in ids for o in owners)
        assert rows[name] == (2.0 * n, len(ids), n)
    for df in (kpi.channel_revenue(users, orders), kpi.monthly_revenue(orders)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_retention_counts_hits_of_repeated_and_unknown_users_once(spark):
    """Rows of a user come together before they are counted: nothing is expanded for distinct counts."""
    users = frame(
        spark,
        [
            (1, day("2024-01-01"), "a", "Web"),
            (1, day("2024-01-02"), "a", "Web"),
            (2, day("2024-01-01"), None, "Web"),
            (3, day("2024-01-01"), "b", "iOS"),
            (None, day("2024-01-01"), "a", "iOS"),
        ],
        USERS,
    )
    moments = [(1, "2024-01-02"), (1, "2024-01-03"), (1, "2024-01-08"), (2, "2024-01-02"), (None, "2024-01-02"), (3, "2024-03-01")]
    events = frame(spark, [(k, u, ts(t), "login", 1.0) for k, (u, t) in enumerate(moments)], EVENTS)
    by = retention.retention_by(users, events, "channel")
    assert {r[0]: tuple(r)[1:] for r in by.collect()} == {"a": (1.0, 1.0, 0.0), "b": (None, None, None)}
    whole = retention.day_n_retention(users, events)
    assert tuple(whole.first()) == (2 / 5, 1 / 5, 0.0)
    for found in (by, whole):
        hits = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in hits and "hits" in hits
    months = retention.user_months(users, events, "channel")
    assert sorted(retention.retention_by(users, events, "channel", months).collect(), key=str) == sorted(by.collect(), key=str)
