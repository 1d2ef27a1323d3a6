from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import ts
from valuetide.operators import kpi, quality, reconcile
from valuetide.plans import registry
from valuetide.sources import schemas


def set_where(df, condition, **values):
    return df.withColumns(
        {
            c: F.when(F.expr(condition), F.lit(v)).otherwise(F.col(c)).cast(df.schema[c].dataType)
            for c, v in values.items()
        }
    )


def test_valid_data(sample):
    row = quality.validate(*sample).first()
    assert row.asDict() == {"users": 2, "events": 4, "transactions": 1, "status": "valid"}


MUTATIONS = {
    "duplicate": ("users", "user_id = 2", {"user_id": 1}, "missing or repeated"),
    "null_user": ("users", "user_id = 2", {"user_id": None}, "missing or repeated"),
    "unknown": ("events", "event_id = 1", {"user_id": 999}, "1 user ids of events"),
    "event_before": ("events", "event_id = 1", {"event_time": ts("2023-12-31")}, "events lie before"),
    "negative_session": ("events", "event_id = 1", {"session_duration": -1.0}, "1 session durations"),
    "null_session": ("events", "event_id = 1", {"session_duration": None}, "1 session durations"),
    "unknown_buyer": ("orders", "order_id = 1", {"user_id": 999}, "1 user ids of transactions"),
    "order_before": ("orders", "order_id = 1", {"order_time": ts("2023-12-31")}, "orders lie before"),
    "bad_amount": ("orders", "order_id = 1", {"amount": Decimal(0)}, "1 amounts"),
    "bad_refund": ("orders", "order_id = 1", {"refund_amount": Decimal(101)}, "1 refunds"),
    "null_refund": ("orders", "order_id = 1", {"refund_amount": None}, "1 refunds"),
    "negative_refund": ("orders", "order_id = 1", {"refund_amount": Decimal(-1)}, "1 refunds"),
}


@pytest.mark.parametrize("name", MUTATIONS)
def test_each_rule_raises(sample, name):
    table, condition, values, message = MUTATIONS[name]
    tables = dict(zip(("users", "events", "orders"), sample))
    tables[table] = set_where(tables[table], condition, **values)
    with pytest.raises(ValueError, match=message):
        quality.validate(*tables.values())


def test_the_summary_of_invalid_data_is_a_row(spark, sample, tmp_path):
    """A purchase of less than half a cent breaks the amount rule; the query says so as its SQL does."""
    events = spark.createDataFrame(
        [(1, ts("2024-01-03"), 5, "purchase", 0.004), (2, ts("2024-01-04"), 5, "view", 3.0)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    for name, row, ddl in (
        ("customer", (5, 1, "MACHINERY"), "c_custkey long, c_nationkey int, c_mktsegment string"),
        ("nation", (1, 1), "n_nationkey int, n_regionkey int"),
        ("region", (1, "ASIA"), "r_regionkey int, r_name string"),
    ):
        spark.createDataFrame([row], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    row = registry.queries()["dq_summary_activity"](spark, str(tmp_path)).first()
    assert row.asDict() == {"users": 1, "events": 2, "transactions": 1, "status": "invalid"}
    assert quality.validate(*sample, strict=False).first()["status"] == "valid"


def test_violations_are_reported_together_but_a_broken_key_alone(sample):
    users, events, orders = sample
    events = set_where(events, "event_id = 1", session_duration=-1.0)
    orders = set_where(orders, "order_id = 1", amount=Decimal(0))
    with pytest.raises(ValueError) as both:
        quality.validate(users, events, orders)
    assert "session durations" in str(both.value) and "amounts" in str(both.value)
    with pytest.raises(ValueError) as alone:
        quality.validate(set_where(users, "user_id = 2", user_id=1), events, orders)
    assert "repeated" in str(alone.value) and "session durations" not in str(alone.value)


def test_missing_user_ids_count_as_one_unknown(spark, sample):
    users, events, _ = sample
    nobody = spark.createDataFrame(
        [(8, None, ts("2024-01-05"), "login", 1.0), (9, None, ts("2024-01-06"), "login", 1.0)],
        events.schema,
    )
    row = quality.event_violations(users, events.unionByName(nobody)).first()
    assert row["orphans"] == 1


def test_empty_facts_are_valid(spark, sample):
    row = quality.validate(
        sample[0], schemas.empty(spark, "events"), schemas.empty(spark, "transactions")
    ).first()
    assert (row["events"], row["transactions"], row["status"]) == (0, 0, "valid")


def test_constraints(sample):
    users, events, orders = sample
    tables = {
        "users": set_where(users, "user_id = 2", signup_date=None),
        "events": set_where(events, "event_id = 2", event_id=1, user_id=77),
        "transactions": orders,
    }
    found = {
        (r["table_name"], r["constraint_type"], r["columns"]): r["violations"]
        for r in quality.constraint_violations(tables).collect()
    }
    assert found["users", "not_null", "signup_date"] == 1
    assert found["events", "primary_key", "event_id"] == 1
    assert found["events", "foreign_key", "user_id"] == 1
    assert sum(found.values()) == 3


def test_profile(sample):
    users, events, _ = sample
    found = quality.table_profile(
        {
            "users": (users, "user_id"),
            "events": (set_where(events, "event_id = 2", event_id=1, event_type=None), "event_id"),
        }
    )
    assert [tuple(r) for r in found.orderBy("table_name").collect()] == [
        ("events", 4, 1, 1),
        ("users", 2, 0, 0),
    ]


def test_reconcile_passes_and_fails(spark, sample):
    users, events, orders = sample
    frames = {"users": users, "events": events, "transactions": orders}
    monthly = kpi.monthly_kpis(events, orders)
    reconcile.require_reconciled(reconcile.reconcile(frames, frames, monthly))
    dearer = {**frames, "transactions": set_where(orders, "order_id = 1", amount=Decimal(101))}
    with pytest.raises(ValueError, match="net_revenue"):
        reconcile.require_reconciled(reconcile.reconcile(frames, dearer, monthly))
    lost = {**frames, "users": users.where("user_id = 2")}
    with pytest.raises(ValueError, match="orphan_events"):
        reconcile.require_reconciled(reconcile.reconcile(frames, lost, monthly))


def test_require_rows(spark, sample):
    quality.require_rows({"users": sample[0]})
    with pytest.raises(ValueError, match="events"):
        quality.require_rows({"users": sample[0], "events": schemas.empty(spark, "events")})


