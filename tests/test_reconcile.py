"""Order-independent digests by key range, and validation with and without a broadcast."""

import pytest
from pyspark.sql import functions as F

from valuetide.operators import quality, reconcile
from valuetide.sources import sinks


@pytest.fixture
def orders(spark):
    return spark.range(1000).selectExpr("id + 5 AS order_id", "CAST(id % 97 AS DECIMAL(12,2)) AS amount", "IF(id % 7 = 0, NULL, 'x') AS note")


def broken(found):
    return sorted(r["range"] for r in found.where("NOT ok").collect())


def test_order_and_partitions_do_not_matter(orders):
    again = orders.orderBy(F.rand(3)).repartition(7).select("note", "order_id", "amount")
    found = reconcile.compare_digests(orders, again, "order_id")
    assert broken(found) == [] and found.count() == reconcile.KEY_RANGES
    assert found.agg(F.sum("actual_rows")).first()[0] == 1000


def test_swapped_values_are_found_and_their_ranges_named(orders):
    """Two orders swap amounts: counts, sums and even the multiset of amounts stay."""
    amounts = {r.order_id: int(r.amount) for r in orders.where("order_id IN (10, 900)").collect()}
    swap = F.when(F.col("order_id") == 10, amounts[900]).when(F.col("order_id") == 900, amounts[10])
    swapped = orders.withColumn("amount", F.coalesce(swap, "amount").cast("decimal(12,2)"))
    assert orders.agg(F.sum("amount")).first() == swapped.agg(F.sum("amount")).first()
    found = reconcile.compare_digests(orders, swapped, "order_id")
    named = [(r["key_from"], r["key_to"]) for r in found.where("NOT ok").orderBy("range").collect()]
    assert len(named) == 2 and named[0][0] <= 10 <= named[0][1] and named[1][0] <= 900 <= named[1][1]


def test_lost_repeated_and_null_rows_are_found(spark, orders):
    assert broken(reconcile.compare_digests(orders, orders.where("order_id <> 500"), "order_id")) == [7]
    assert broken(reconcile.compare_digests(orders, orders.union(orders.where("order_id = 6")), "order_id")) == [0]
    moved = orders.withColumn("note", F.when(F.col("order_id") == 7, None).otherwise(F.col("note")))
    assert broken(reconcile.compare_digests(orders, moved, "order_id")) == [0]
    none = orders.limit(0)
    assert reconcile.compare_digests(none, none, "order_id").count() == 0
    keyless = orders.union(orders.limit(1).withColumn("order_id", F.lit(None).cast("long")))
    assert broken(reconcile.compare_digests(orders, keyless, "order_id")) == [-1]
    assert broken(reconcile.compare_digests(keyless, keyless, "order_id")) == []


def test_ranges_of_keys_beyond_an_int(spark):
    """A range's width fits an int, its start does not; int keys may lie further apart than an int."""
    wide = spark.range(100).selectExpr("id * 90000000 AS order_id")
    found = reconcile.compare_digests(wide, wide, "order_id").orderBy("range").collect()
    assert broken(reconcile.compare_digests(wide, wide, "order_id")) == []
    assert found[-1]["key_from"] <= 99 * 90000000 <= found[-1]["key_to"]
    ints = spark.range(2).selectExpr("CAST(id * 4000000000 - 2000000000 AS INT) AS order_id")
    assert [r["range"] for r in reconcile.compare_digests(ints, ints, "order_id").orderBy("range").collect()] == [0, 15]


def test_validation_is_the_same_without_a_broadcast(sample, monkeypatch):
    users, events, orders = sample
    strangers = events.withColumn("user_id", F.when(F.col("event_id") < 3, 99).otherwise(F.col("user_id")))
    early = strangers.withColumn("session_duration", -F.col("session_duration"))
    want = sorted(quality.quality_report(users, early, orders).collect())
    assert dict(want)["orphan_events"] == 1 and dict(want)["session_duration"] == 4
    lost = reconcile.orphan_rows(early, users).first()
    for module in (quality, reconcile):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    assert sorted(quality.quality_report(users, early, orders).collect()) == want
    assert reconcile.orphan_rows(early, users).first() == lost


def test_facts_are_not_shuffled_by_user_where_users_are_small(sample):
    users, events, _ = sample
    users = sinks.materialize(users, "users")
    plan = quality.event_violations(users, events)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
