import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import EVENTS, ORDERS, USERS, day, frame, ts
from valuetide.operators import snapshots, splits

MONTHS = [dt.date(2024, m, 1) for m in range(7, 13)] + [dt.date(2025, m, 1) for m in (1, 2, 3)]


def test_order_at_the_snapshot_instant_is_future(sample):
    rows = snapshots.build_snapshots(*sample, [day("2024-02-01")])
    first = rows.where("user_id = 1").first()
    assert (first["historical_ltv"], first["future_90d_revenue"]) == (0.0, 90.0)
    assert first["churn_30d"] == 0
    assert not set(snapshots.TARGETS) & set(snapshots.feature_columns(rows))
    assert snapshots.feature_columns(rows) == snapshots.FEATURES


def test_never_bought_has_recency_zero(sample):
    rows = snapshots.build_snapshots(*sample, [day("2024-02-01")])
    assert {r["days_since_last_purchase"] for r in rows.collect()} == {0}


def test_elapsed_days_are_floored(spark, sample):
    users, _, orders = sample
    events = frame(spark, [(1, 1, ts("2024-01-30T12:00"), "login", 1.0)], EVENTS)
    rows = snapshots.build_snapshots(users, events, orders, [day("2024-02-01")])
    assert rows.where("user_id = 1").first()["days_since_last_active"] == 1


def _random_tables(spark, seed=7, users=12, facts=400):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    kinds = ["login", "browse", "search", "favorite", "add_to_cart", "purchase"]
    # User 0 is hot: a third of all rows.
    pick = lambda: 0 if rng.random() < 1 / 3 else rng.randrange(users + 2)
    moment = lambda: start + dt.timedelta(minutes=rng.randrange(400 * 1440))
    u = [
        (i, (start + dt.timedelta(days=rng.randrange(250))).date(), "a", "Web")
        for i in range(users)
    ]
    e = [
        (i, pick(), moment(), rng.choice(kinds), rng.choice([None, float(rng.randrange(90))]))
        for i in range(facts)
    ]
    t = [
        (i, pick(), moment(), Decimal(rng.randrange(1, 9999)) / 100, Decimal("0.25"), None)
        for i in range(facts // 2)
    ]
    return u, e, t


def _brute_force(u, e, t, snap):
    out = {}
    midnight = dt.datetime.combine(snap, dt.time())
    for uid, signup, *_ in u:
        if signup >= snap:
            continue
        mine = [x for x in e if x[1] == uid]
        buys = [x for x in t if x[1] == uid]
        past = [x for x in mine if x[2] < midnight]
        bought = [x for x in buys if x[2] < midnight]
        within = lambda rows, d: [x for x in rows if x[2] >= midnight - dt.timedelta(days=d)]
        net = lambda rows: float(sum(x[3] - x[4] for x in rows))
        sessions = [x[4] for x in past if x[4] is not None]
        tenure = (snap - signup).days
        kinds = {"login": "login", "browse": "browse", "search": "search", "cart": "add_to_cart"}
        row = {"tenure_days": tenure}
        for d in (7, 30, 90):
            row[f"active_days_{d}d"] = len({x[2].date() for x in within(past, d)})
        for name, kind in kinds.items():
            row[f"{name}_count_30d"] = sum(x[3] == kind for x in within(past, 30))
        for d in (30, 90):
            row[f"purchase_count_{d}d"] = len(within(bought, d))
            row[f"revenue_{d}d"] = net(within(bought, d))
        row["days_since_last_active"] = (midnight - max(x[2] for x in past)).days if past else 0
        row["days_since_last_purchase"] = (
            (midnight - max(x[2] for x in bought)).days if bought else 0
        )
        row["avg_session_duration"] = sum(sessions) / len(sessions) if sessions else 0.0
        row["avg_order_value"] = net(bought) / len(bought) if bought else 0.0
        row["purchase_frequency"] = len(bought) / max(tenure / 30, 1)
        row["historical_ltv"] = net(bought)
        ahead = lambda rows, d: [
            x for x in rows if midnight <= x[2] < midnight + dt.timedelta(days=d)
        ]
        row["churn_30d"] = int(not ahead(mine, 30))
        row["future_90d_revenue"] = net(ahead(buys, 90))
        out[uid, snap] = row
    return out


@pytest.mark.parametrize("dates", [MONTHS, [dt.date(2024, 9, d) for d in range(1, 30, 3)]])
def test_matches_brute_force_on_unvalidated_rows(spark, dates):
    u, e, t = _random_tables(spark)
    rows = snapshots.build_snapshots(
        frame(spark, u, USERS), frame(spark, e, EVENTS), frame(spark, t, ORDERS), dates
    ).collect()
    expected = {}
    for snap in dates:
        expected.update(_brute_force(u, e, t, snap))
    assert len(rows) == len(expected)
    for r in rows:
        want = expected[r["user_id"], r["snapshot_date"]]
        got = r.asDict()
        for name, value in want.items():
            assert got[name] == pytest.approx(value, abs=1e-9), (name, r)


def test_rows_after_the_snapshot_do_not_change_features(spark):
    u, e, t = _random_tables(spark)
    snap = day("2024-09-01")
    cut = dt.datetime.combine(snap, dt.time())
    users = frame(spark, u, USERS)

    def features(events, orders):
        rows = snapshots.build_snapshots(
            users, frame(spark, events, EVENTS), frame(spark, orders, ORDERS), [snap]
        )
        return sorted(rows.select("user_id", *snapshots.FEATURES).collect())

    earlier = features([x for x in e if x[2] < cut], [x for x in t if x[2] < cut])
    assert features(e, t) == earlier


def test_window_input_is_one_row_per_user_day(spark):
    hot = spark.range(50_000).select(
        F.col("id").alias("event_id"),
        F.lit(1).cast("long").alias("user_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 5)").alias(
            "event_time"
        ),
        F.lit("login").alias("event_type"),
        F.lit(1.0).alias("session_duration"),
    )
    none = frame(spark, [], ORDERS)
    rollup = snapshots.daily_rollup(hot, none, day("2024-12-31"))
    assert rollup.count() == 5
    assert rollup.agg(F.sum("login_count")).first()[0] == 50_000


def test_plan_has_no_nested_loop_join(spark, sample):
    rows = snapshots.build_snapshots(*sample, MONTHS)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Window [") == 1


@pytest.fixture
def maturity(spark):
    rows = [(i, d) for i, d in enumerate(MONTHS)]
    return splits.assign_temporal_splits(frame(spark, rows, "user_id long, snapshot_date date"))


def test_split_labels(maturity):
    found = {r["snapshot_date"]: (r["ltv_split"], r["churn_split"]) for r in maturity.collect()}
    assert [found[d] for d in MONTHS] == [
        ("train", "train"),
        ("train", "train"),
        ("train", "train"),
        ("embargo", "train"),
        ("embargo", "train"),
        ("validation", "train"),
        ("embargo", "validation"),
        ("embargo", "embargo"),
        ("test", "test"),
    ]
    assert all(r["split"] == r["ltv_split"] for r in maturity.collect())


def test_audit_finds_late_labels(maturity):
    clean = splits.split_audit(maturity).collect()
    assert all(r["late_train"] == r["late_validation"] == 0 for r in clean)
    leaky = maturity.withColumn(
        "ltv_split", F.regexp_replace("ltv_split", "embargo", "train")
    )
    late = {r["target"]: r["late_train"] for r in splits.split_audit(leaky).collect()}
    assert late == {"ltv": 4, "churn": 0}


def test_few_dates_are_all_test(spark):
    rows = frame(spark, [(1, MONTHS[0]), (1, MONTHS[1])], "user_id long, snapshot_date date")
    found = splits.assign_temporal_splits(rows)
    assert "ltv_label_mature_date" not in found.columns
    assert {(r["ltv_split"], r["churn_split"], r["split"]) for r in found.collect()} == {
        ("test",) * 3
    }


def test_short_range_is_an_error(spark):
    rows = [(1, day("2024-01-01") + dt.timedelta(days=i)) for i in range(5)]
    with pytest.raises(ValueError, match="old enough"):
        splits.assign_temporal_splits(frame(spark, rows, "user_id long, snapshot_date date"))


def test_single_test_snapshot_is_required(spark, maturity):
    with pytest.raises(ValueError, match="instead of one"):
        splits.require_single_test_snapshot(maturity, "LTV")
    assert splits.require_single_test_snapshot(maturity.where("split = 'test'"), "LTV") == MONTHS[-1]


def test_split_column_fallback(maturity):
    assert splits.split_column(maturity, "churn") == "churn_split"
    assert splits.split_column(maturity.drop("churn_split"), "churn") == "split"


def test_users_and_facts_dealt_into_pieces_give_the_same_rows_by_one_exchange(spark, sample):
    """Days were dealt twice, into a number of tasks that did not grow with the facts."""
    users, events, orders = sample
    dates = [day("2024-01-05"), day("2024-02-10"), day("2024-03-01")]
    dealt = snapshots.build_snapshots(users, events, orders, dates, pieces=13)
    assert sorted(dealt.collect()) == sorted(snapshots.build_snapshots(users, events, orders, dates).collect())
    plan = dealt._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    exchanges = [x for x in plan.splitlines() if "Exchange " in x]
    assert len(exchanges) == 2 and all("REPARTITION_BY_NUM" in x and ", 13)" in x for x in exchanges)
