import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import EVENTS, USERS, day, frame, ts
from valuetide import session
from valuetide.operators import reporting, snapshots
from valuetide.operators.modeling import TreeSettings
from valuetide.plans import job
from valuetide.sources import readers, schemas, sinks, worlds

FOLDER = "/root/testdata/sf0.001"


def test_csv_round_trip_keeps_types_and_drops_unknown_columns(spark, tmp_path):
    (tmp_path / "users.csv").write_text(
        "user_id,signup_date,channel,region,device,age_group,acquisition_cost\n"
        "1,2024-01-01,organic,EU,Web,25-34,1.50\n2,2024-01-02,search,,iOS,,\n"
    )
    (tmp_path / "events.csv").write_text(
        "event_id,user_id,event_time,event_type,session_duration\n"
        "1,1,2024-01-01 10:20:30,login,10.25\n"
    )
    (tmp_path / "transactions.csv").write_text(
        "order_id,user_id,order_time,amount,refund_amount,product_category\n"
        "1,1,2024-02-01 00:00:00,100.00,10.00,Home\n"
    )
    tables = readers.read_tables(spark, str(tmp_path))
    for name, df in tables.items():
        assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.struct(name)]
    assert tables["users"].where("region IS NULL").count() == 1
    assert tables["events"].first()["event_time"] == ts("2024-01-01T10:20:30")


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("user_id,signup_date\nx,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), "user_id BIGINT, signup_date DATE").collect()


def test_csv_export_leaves_nulls_blank(spark, tmp_path):
    df = frame(spark, [("2024-01", None, ts("2024-01-01T00:00:05"))], "c string, r double, t timestamp_ntz")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text().splitlines()
    assert text == ["c,r,t", "2024-01,,2024-01-01 00:00:05"]


def test_metric_documents(spark, tmp_path):
    df = frame(spark, [("a", 1.5), ("b", None)], "model string, mae double")
    sinks.write_metrics(df.coalesce(1), str(tmp_path / "m"))
    lines = next((tmp_path / "m").glob("*.json")).read_text().splitlines()
    assert [json.loads(x) for x in lines] == [{"model": "a", "mae": 1.5}, {"model": "b", "mae": None}]
    document = tmp_path / "doc.json"
    document.write_text('{\n "mae": 1.5,\n "model": "a"\n}')
    assert readers.read_metrics(spark, str(document), document=True).first()["mae"] == 1.5


def test_refresh_replaces_tables_and_empties_missing_ones(spark, sample):
    users, events, orders = sample
    for _ in range(2):
        sinks.refresh_tables(
            spark, "refresh_db", {"users": users, "events": events, "transactions": orders}
        )
    assert spark.table("refresh_db.users").count() == 2
    assert spark.table("refresh_db.events").schema["session_duration"].dataType.scale == 2
    assert spark.table("refresh_db.user_snapshots").count() == 0
    sinks.refresh_tables(spark, "refresh_db", {"users": users})
    assert spark.table("refresh_db.events").count() == 0


def test_csv_is_read_by_column_name(spark, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text("device,user_id,note,signup_date,channel\niOS,7,x,2024-01-02,search\n")
    df = readers.read_csv(spark, str(path), schemas.TABLES["users"])
    assert df.columns == ["user_id", "signup_date", "channel", "device"]
    assert tuple(df.first()) == (7, day("2024-01-02"), "search", "iOS")
    path.write_text("user_id,signup_date\nseven,2024-01-02\n")
    with pytest.raises(Exception, match="seven"):
        readers.read_csv(spark, str(path), schemas.TABLES["users"]).collect()


def test_metrics_round_trip_with_several_rows_in_a_file(spark, tmp_path):
    rows = spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS gap", "id / 2 AS half").coalesce(1)
    sinks.write_metrics(rows, str(tmp_path / "m"))
    found = readers.read_metrics(spark, str(tmp_path / "m"))
    assert sorted(r["id"] for r in found.collect()) == list(range(5))
    (tmp_path / "one.json").write_text('{\n  "a": 1\n}')
    assert readers.read_metrics(spark, str(tmp_path / "one.json"), document=True).first()["a"] == 1


def test_jdbc_refresh_touches_all_tables(sample):
    steps = sinks.jdbc_steps({"users": sample[0], "events": sample[1]})
    assert [t for t, f in steps if f is None] == list(reversed(schemas.TABLES))
    assert [t for t, f in steps if f is not None] == ["users", "events"]


def test_job_refuses_a_repeated_order(sample, tmp_path):
    users, events, orders = sample
    with pytest.raises(ValueError, match="order_id"):
        job.run(users, events, orders.union(orders), str(tmp_path))
    with pytest.raises(ValueError, match="Empty"):
        job.run(users, events, orders.limit(0), str(tmp_path))


def test_jdbc_batches(sample):
    assert sinks.BATCH_ROWS["users"] == 5000 and sinks.BATCH_ROWS["user_snapshots"] == 3000
    assert sinks.jdbc_writer(sample[0], "users", "jdbc:none:") is not None


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    assert session.scratch_path(spark, "x").startswith(f"{configured}/x-")


def test_typed_empty_relation(spark):
    assert schemas.empty(spark, "transactions").columns[0] == "order_id"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not present")
@pytest.mark.parametrize("name", ["commerce", "activity"])
def test_role_columns(spark, name):
    w = worlds.WORLDS[name](spark, FOLDER)
    assert w.users.columns == ["user_id", "signup_date", "channel", "region", "device"]
    assert w.users.count() == w.users.select("user_id").distinct().count()
    assert set(w.events.select("event_type").distinct().toPandas()["event_type"]) <= set(
        schemas.EVENT_TYPES
    )
    assert w.transactions.where("refund_amount > amount OR refund_amount < 0").count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not present")
def test_whole_job(spark, tmp_path):
    w = worlds.commerce_world(spark, FOLDER)
    out = job.run(
        *w.tables,
        str(tmp_path),
        w.snapshot_dates,
        database="job_db",
        trees=TreeSettings(depth=3),
    )
    users = w.users.count()
    assert spark.read.parquet(out.paths["customer_segments"]).count() == out.segments.count()
    assert out.segments.count() <= users
    assert spark.read.parquet(out.paths["reconciliation"]).where("NOT ok").count() == 0
    assert spark.table("job_db.user_snapshots").count() == spark.read.parquet(
        out.paths["user_snapshots"]
    ).count()
    assert spark.table("job_db.customer_predictions").count() == out.segments.count()
    matrix = readers.read_result(
        spark, out.paths["customer_segments_csv"], "user_id BIGINT, predicted_ltv DOUBLE, "
        "churn_probability DOUBLE, value_segment STRING, risk_segment STRING, "
        "customer_segment STRING, recommended_action STRING"
    )
    assert matrix.count() == out.segments.count()
    again = job.stored_segments(spark, str(tmp_path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.segments.select(again.columns).collect()))
    summary = readers.read_metrics(spark, out.paths["run_summary"]).collect()
    assert {(r["target"], r["selected_model"]) for r in summary} == {
        ("ltv", out.ltv.selected),
        ("churn", out.churn.selected),
    }
    for name in ("ltv_importance", "churn_importance", "ltv_validation"):
        assert readers.read_metrics(spark, out.paths[name]).count() > 0
    assert {p.name for p in (tmp_path / "models" / "v=1" / "models").iterdir()} >= {
        "ltv_linear_regression",
        "ltv_random_forest",
        "churn_logistic_regression",
        "churn_random_forest",
    }
    rows = spark.read.parquet(out.paths["user_snapshots"])
    newest = rows.where(F.col("snapshot_date") == rows.agg(F.max("snapshot_date")).first()[0])
    fresh = job.score(newest.drop("churn_30d", "future_90d_revenue"), str(tmp_path))
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, out.segments.select(fresh.columns).collect()))


class Stopped(Exception):
    pass


def test_a_stopped_run_goes_on_behind_its_finished_stages(spark, sample, tmp_path, monkeypatch):
    users, events, orders = sample
    dates = [day("2024-01-15"), day("2024-02-01")]
    calls = []
    build = job.build_snapshots

    def counted(*args):
        calls.append(args)
        return build(*args)

    def stop(*args):
        raise Stopped

    monkeypatch.setattr(job, "build_snapshots", counted)
    monkeypatch.setattr(job, "assign_temporal_splits", lambda rows, dates: rows)
    monkeypatch.setattr(job.ltv, "train_ltv", stop)

    def run(*tables):
        with pytest.raises(Stopped):
            job.run(*tables, str(tmp_path), dates)
        return spark.read.parquet(str(tmp_path / "user_snapshots")).count()

    rows = run(users, events, orders)
    assert len(calls) == 1 and rows > 0
    # The same content in another order and layout: nothing is computed again.
    assert run(users, events.repartition(3), orders) == rows and len(calls) == 1
    monkeypatch.setattr(job.kpi, "calculate_kpis", stop)
    assert run(users, events, orders) == rows and len(calls) == 1
    monkeypatch.undo()
    monkeypatch.setattr(job, "build_snapshots", counted)
    monkeypatch.setattr(job, "assign_temporal_splits", lambda rows, dates: rows)
    monkeypatch.setattr(job.ltv, "train_ltv", stop)
    more = events.union(events.where("event_id = 2").withColumn("event_id", F.lit(77).cast("long")))
    run(users, more, orders)
    assert len(calls) == 2


def test_reporting_edges(spark, sample):
    users, events, orders = sample
    funnel = reporting.event_funnel(events).collect()
    assert [(r["event_type"], r["events"]) for r in funnel] == [
        ("browse", 1),
        ("purchase", 1),
        ("login", 2),
    ]
    trend = reporting.monthly_trend(events, orders).orderBy("month").collect()
    assert [tuple(r) for r in trend] == [
        (day("2024-01-01"), 3, None),
        (day("2024-02-01"), 1, 90.0),
    ]
    manifest = reporting.run_manifest(users, events, orders, 42).first()
    assert (manifest["date_start"], manifest["date_end"]) == (ts("2024-01-01"), ts("2024-02-01"))
    calendar = reporting.calendar(events, orders)
    assert calendar.count() == 32


def test_channel_cards_match_filtering_by_hand(spark, sample):
    users, events, orders = sample
    features = snapshots.build_snapshots(*sample, [day("2024-02-01")])
    people = users.select("user_id").selectExpr(
        "user_id", "5.0D AS predicted_ltv", "'High Risk' AS risk_segment"
    )
    row = reporting.executive_cards(users, events, orders, features, people, "search").first()
    assert (row["total_users"], row["mau"], row["revenue"]) == (1, 1, 0.0)
    assert row["d1_retention"] == 1.0
    whole = reporting.executive_cards(users, events, orders, features, people).first()
    assert (whole["total_users"], whole["mau"], whole["revenue"]) == (2, 3, 90.0)


def test_trained_queries_notice_changed_tables(spark, tmp_path):
    from valuetide.plans import models

    for name in ("customer", "nation", "region", "orders", "lineitem"):
        spark.range(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = models.table_state(spark, str(tmp_path))
    assert before == models.table_state(spark, str(tmp_path))
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert before != models.table_state(spark, str(tmp_path))
