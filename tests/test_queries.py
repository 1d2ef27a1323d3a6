"""Every query with a SQL twin must match it exactly on the small scale factor."""

import datetime as dt
import re
from pathlib import Path

import pytest

from tests.compare import connect, differences
from valuetide import session
from valuetide.operators import reporting
from valuetide.plans import daystate, oracles, registry
from valuetide.sources import schemas, sinks, worlds
from valuetide.sources.worlds import World

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
SQL = oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_only_training_queries_lack_a_twin():
    assert set(SQL) <= set(QUERIES)
    assert all(n.startswith("model_") for n in set(QUERIES) - set(SQL))


SHARED = (
    "customer_predictions bi_measures bi_executive_cards bi_channel_cards bi_high_risk bi_ltv_by_channel "
    "bi_probability_histogram segments value_risk_points segment_counts bi_value_segments"
).split()


@pytest.mark.parametrize("name", SHARED)
def test_scored_snapshots_are_built_once(spark, monkeypatch, name):
    """Features, both test splits and segments of a query come from one stored table."""
    calls = []

    def table(spark, folder):
        calls.append(folder)
        rows = [(1, dt.date(2001, 3, 1), "test", "test", "test", 0.9, 5.0, 1, 2, 3.0, 4.0)]
        ddl = (
            "user_id long, snapshot_date date, split string, ltv_split string, churn_split string, "
            "churn_probability double, predicted_ltv double, churn_30d int, days_since_last_active int, "
            "historical_ltv double, future_90d_revenue double"
        )
        return spark.createDataFrame(rows, ddl)

    user = "user_id long, signup_date date, channel string, region string, device string"
    nobody = spark.createDataFrame([(1, dt.date(1999, 1, 1), "MACHINERY", "ASIA", "Web")], user)
    empty = schemas.empty(spark, "events"), schemas.empty(spark, "transactions")
    monkeypatch.setattr(registry, "scored", table)
    monkeypatch.setattr(registry, "world", lambda *_: World(nobody, *empty, []))
    assert QUERIES[name](spark, "anywhere").columns
    assert calls == ["anywhere"]


@pytest.mark.parametrize("name", ["reconcile", "reconcile_digests", "snapshots_from_state"])
def test_roles_are_made_once(spark, monkeypatch, tmp_path, name):
    """Later passes read stored roles: the tables are read by one commerce world only."""
    day = dt.datetime(2000, 9, 5)
    tables = {
        "customer": ([(5, 1, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(1, "ASIA")], "r_regionkey int, r_name string"),
        "orders": ([(8, 5, 20.0, day)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "lineitem": (
            [(8, 1, 1, 1, 2.0, 9.0, "R", day), (8, 2, 1, 2, 1.0, 3.0, "N", day)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
        ),
    }
    for table, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{table}.parquet")
    read, whole = [], worlds._table
    monkeypatch.setattr(worlds, "_table", lambda s, d, t: read.append(t) or whole(s, d, t))
    facts, add = [], daystate.DayState.add

    def seen(state, name, events, transactions):
        facts.extend([*events.inputFiles(), *transactions.inputFiles()])
        return add(state, name, events, transactions)

    monkeypatch.setattr(daystate.DayState, "add", seen)
    found = QUERIES[name](spark, str(tmp_path)).collect()
    assert read.count("lineitem") == 1 and not any("lineitem.parquet" in f for f in facts)
    assert all(r["ok"] for r in found) if "ok" in found[0] else len(found) == 6


NEEDED = {
    "segments": registry.SEGMENT_COLUMNS,
    "value_risk_points": registry.SEGMENT_COLUMNS,
    "bi_measures": registry.CARD_COLUMNS,
    "bi_executive_cards": registry.CARD_COLUMNS,
    "bi_channel_cards": registry.CARD_COLUMNS,
}


@pytest.mark.parametrize("name", sorted(NEEDED))
def test_only_what_a_query_takes_is_stored(spark, monkeypatch, name):
    """Scored snapshots without the features no column comes from; facts of the cards once each."""
    stored, whole = {}, sinks.materialize

    def materialize(df, label, *rest):
        assert label not in stored
        stored[label] = set(df.columns)
        return whole(df, label, *rest)

    for module in (sinks, reporting):
        monkeypatch.setattr(module, "materialize", materialize)
    QUERIES[name](spark, FOLDER)
    assert stored.pop("scored") == set(NEEDED[name])
    facts = {"users", "user-days", "daily-activity"} if name.endswith("cards") else {"daily-activity"}
    assert set(stored) == (facts if name.startswith("bi_") else set())


def test_orders_and_lines_are_dealt_by_their_size(spark, monkeypatch):
    """A larger table makes more pieces, not larger ones."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    assert session.pieces_of(lines) == [1]
    size = session.estimated_bytes(lines)
    monkeypatch.setattr(session, "PIECE_BYTES", -(-size // 7))
    assert session.pieces_of(lines) == [7]
    plan = worlds.commerce_world(spark, FOLDER).transactions._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((\w)_orderkey#\w+, 7\), REPARTITION_BY_NUM", plan)
    assert sorted(dealt) == ["l", "o"]


def test_cards_of_a_channel_store_the_facts_of_its_customers_only(spark, monkeypatch):
    """The facts of all customers were dealt and grouped, for every pass anew."""
    from valuetide.operators import reporting
    from valuetide.plans import registry

    seen, cards = {}, reporting.executive_cards

    def spy(users, events, transactions, *rest):
        seen.update(users=users, events=events, transactions=transactions)
        return cards(users, events, transactions, *rest)

    monkeypatch.setattr(reporting, "executive_cards", spy)
    found = registry.queries()["bi_channel_cards"](spark, "/root/testdata/sf0.001").collect()
    assert {r["channel"] for r in seen["users"].select("channel").distinct().collect()} == {registry.CARD_CHANNEL}
    for name in ("events", "transactions"):
        assert seen[name].join(seen["users"], "user_id", "left_anti").count() == 0
        assert "orders.parquet" not in "".join(seen[name].inputFiles())
    w = registry.world("commerce", spark, "/root/testdata/sf0.001")
    table = registry.stored_scores(spark, "/root/testdata/sf0.001", *registry.CARD_COLUMNS)
    whole = cards(*w.tables, registry._features_of(table), registry._segments_of(table), registry.CARD_CHANNEL)
    assert registry.rounded(whole, 4, "avg_predicted_ltv").collect() == found
