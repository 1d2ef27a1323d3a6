import datetime as dt
import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import day, frame
from valuetide.operators import churn, ltv, modeling, reporting, segments
from valuetide.operators.modeling import TreeSettings
from valuetide.plans import modelstore
from valuetide.sources import sinks

SMALL = TreeSettings(depth=4)
SCHEMA = (
    "user_id long, snapshot_date date, tenure_days int, active_days_7d int, active_days_30d int, "
    "historical_ltv int, churn_30d int, future_90d_revenue double, split string"
)


def synthetic(n=180, seed=42):
    """Six monthly snapshots of 30 rows: four train, one validation, one test."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        month = i // (n // 6)
        x = int(rng.poisson(5))
        gone = int(rng.random() < 0.65 - 0.05 * min(x, 8))
        revenue = max(0.0, x * 8 + float(rng.normal(0, 15)))
        split = "train" if month < 4 else ("validation" if month == 4 else "test")
        rows.append(
            (i, dt.date(2024, month + 1, 1), int(rng.integers(30, 400)), x, 2 * x, 12 * x, gone,
             revenue, split)
        )
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return sinks.materialize(frame(spark, synthetic(), SCHEMA), "synthetic")


@pytest.fixture(scope="module")
def value(table):
    return ltv.train_ltv(table, trees=SMALL)


@pytest.fixture(scope="module")
def risk(table):
    return churn.train_churn(table, trees=SMALL)


def test_ltv_bake_off(value):
    found = {r["model"]: r for r in value.metrics.collect()}
    assert set(found) == {*ltv.BASELINES, *ltv.CANDIDATES}
    validation = {r["model"]: r["mae"] for r in value.validation_metrics.collect()}
    assert value.selected == min(ltv.CANDIDATES, key=validation.__getitem__)
    assert found[value.selected]["mae"] < found["zero_baseline"]["mae"]
    assert value.features == ["tenure_days", "active_days_7d", "active_days_30d", "historical_ltv"]


def test_ltv_predictions(value):
    rows = value.predictions
    assert rows.count() == 30
    assert rows.where("predicted_ltv < 0").count() == 0
    same = F.col("predicted_ltv") == F.col(f"{value.selected}_prediction")
    assert rows.where(~same).count() == 0


def test_value_threshold_is_an_in_sample_quantile(value, table):
    development = table.where("split != 'test'")
    column = f"{value.selected}_prediction"
    scored = value.models.predict(development, "user_id").toPandas()[column]
    assert value.value_threshold == pytest.approx(np.quantile(scored, 0.75))


def test_baselines(table):
    row = ltv.baseline_values(table).first()
    known = [r[7] for r in synthetic() if r[8] != "test"]
    assert row["zero_baseline"] == 0.0
    assert row["mean_baseline"] == pytest.approx(np.mean(known))
    assert row["median_baseline"] == pytest.approx(np.median(known))


def test_design_rows(value, risk):
    row = value.design.first()
    assert row["split_column"] == "split"
    assert row["train_snapshots"] == [f"2024-0{m}-01" for m in (1, 2, 3, 4)]
    assert (row["validation_snapshot"], row["test_snapshot"]) == ("2024-05-01", "2024-06-01")
    assert risk.design.first()["label_horizon_days"] == 30


def test_churn_bake_off(risk):
    found = risk.metrics.collect()
    assert {r["model"] for r in found} == set(churn.CANDIDATES)
    assert len(found) == 4
    assert all(0.1 <= t <= 0.9 for t in risk.thresholds.values())
    assert all(c.slope > 0 for c in risk.calibrations.values())


def test_churn_predictions_follow_the_threshold(risk):
    t = risk.thresholds[risk.selected]
    wrong = (F.col("churn_probability") >= t).cast("int") != F.col("churn_prediction")
    assert risk.predictions.count() == 30
    assert risk.predictions.where(wrong).count() == 0
    assert risk.predictions.where("churn_probability NOT BETWEEN 0 AND 1").count() == 0


def test_calibration_keeps_the_validation_rate(risk, table):
    """An unpenalised intercept makes the mean calibrated score equal the base rate."""
    validation = table.where("split = 'validation'")
    raw = risk.models.raw_scores(validation, "user_id", "churn_30d")
    calibrated = risk.calibrations[risk.selected].apply(F.col(f"{risk.selected}_raw"))
    row = raw.agg(F.avg(calibrated).alias("p"), F.avg("churn_30d").alias("y")).first()
    assert row["p"] == pytest.approx(row["y"], abs=1e-3)


def test_class_weights(table):
    train = table.where("split = 'train'")
    found = {r["label"]: r for r in churn.class_weights(train, "churn_30d").collect()}
    for r in found.values():
        assert r["weight"] == pytest.approx(120 / (2 * r["rows"]))
    assert sum(r["weight"] * r["rows"] for r in found.values()) == pytest.approx(120)


def test_importance(value):
    top = reporting.top_features(value.importance, 3).collect()
    assert len(top) == 3
    assert value.importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_models_survive_saving(spark, value, table, tmp_path):
    sinks.save_models(value.models.pipelines(), str(tmp_path))
    again = PipelineModel.load(str(tmp_path / "ltv_random_forest"))
    row = table.where("user_id = 0")
    forest = modeling.Forest(tuple(again.stages[2:]), "forest_log")
    assert sum(forest.sizes) == 120 and len(forest.models) == modeling.MOST_PARTS
    rows = forest.transform(PipelineModel(again.stages[:2]).transform(row))
    saved = rows.select(F.expr("greatest(0, expm1(forest_log))")).first()[0]
    live = value.models.predict(row, "user_id").first()["random_forest_prediction"]
    assert saved == pytest.approx(live)


KEYS = ("user_id", "snapshot_date")


@pytest.fixture(scope="module")
def stored(spark, table, value, risk, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    assert modelstore.publish(folder, table, value, risk) == 1
    return folder


def test_a_stored_version_scores_the_same_rows(spark, stored, value, risk, table):
    models = modelstore.load(spark, stored)
    test = table.where("split = 'test'")
    again = models.ltv_predictions(test, *KEYS, ltv.TARGET)
    assert again.columns == value.predictions.columns
    assert sorted(again.collect()) == sorted(value.predictions.collect())
    again = models.churn_predictions(test, *KEYS, churn.TARGET)
    assert sorted(again.collect()) == sorted(risk.predictions.collect())
    live = segments.segment_customers(
        value.predictions,
        risk.predictions,
        value_threshold=value.value_threshold,
        risk_threshold=risk.thresholds[risk.selected],
    )
    unlabelled = test.select(*KEYS, *models.features)
    assert sorted(models.segments(unlabelled).collect()) == sorted(live.collect())
    assert sorted(models.table(spark, "ltv_validation").collect()) == sorted(value.validation_metrics.collect())


def test_another_process_scores_without_training(stored, value, table, tmp_path):
    """A second session, in a process of its own, that never saw the training rows."""
    rows = str(tmp_path / "rows")
    table.where("split = 'test'").drop("churn_30d", "future_90d_revenue", "split").write.parquet(rows)
    script = f"""
from valuetide.plans import modelstore
from valuetide.session import build_session
spark = build_session("second", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions=2)
rows = spark.read.parquet({rows!r})
found = modelstore.load(spark, {stored!r}).ltv_predictions(rows, "user_id").select("user_id", "predicted_ltv")
print("RESULT", json.dumps(sorted([r.user_id, r.predicted_ltv] for r in found.collect())))
"""
    done = subprocess.run(
        [sys.executable, "-c", "import json" + script],
        cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=300, check=True,
    )
    line = next(x for x in done.stdout.splitlines() if x.startswith("RESULT "))
    live = value.predictions.select("user_id", "predicted_ltv").collect()
    assert json.loads(line[7:]) == sorted([r.user_id, r.predicted_ltv] for r in live)


def test_a_changed_schema_is_an_error(spark, stored, table):
    models = modelstore.load(spark, stored)
    with pytest.raises(modelstore.SchemaChanged, match="active_days_7d"):
        models.ltv_predictions(table.drop("active_days_7d"), "user_id")
    with pytest.raises(modelstore.SchemaChanged, match="types"):
        models.churn_scores(table.withColumn("tenure_days", F.col("tenure_days").cast("string")), "user_id")


def test_versions_follow_each_other_and_broken_ones_are_passed_over(spark, stored, table, value, risk, tmp_path):
    folder = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        modelstore.load(spark, folder)
    assert modelstore.publish(folder, table, value, risk) == 1
    (tmp_path / "store" / "v=2" / "models").mkdir(parents=True)
    assert modelstore.versions(spark, folder) == [1] and modelstore.load(spark, folder).version == 1
    assert modelstore.publish(folder, table, value, risk) == 3
    assert modelstore.versions(spark, folder) == [1, 3]
    assert modelstore.load(spark, folder).version == 3 and modelstore.load(spark, folder, 1).version == 1


def test_one_class_models_are_stored(spark, table, tmp_path):
    flat = table.withColumns({"future_90d_revenue": F.lit(0.0), "churn_30d": F.lit(0)})
    value, risk = ltv.train_ltv(flat, trees=SMALL), churn.train_churn(flat, trees=SMALL)
    modelstore.publish(str(tmp_path), flat, value, risk)
    models = modelstore.load(spark, str(tmp_path))
    test = flat.where("split = 'test'")
    again = models.churn_predictions(test, *KEYS, churn.TARGET)
    assert sorted(again.collect()) == sorted(risk.predictions.collect())
    again = models.ltv_predictions(test, *KEYS, ltv.TARGET)
    assert sorted(again.collect()) == sorted(value.predictions.collect())


def test_no_positive_revenue_and_no_churn_fall_back_to_constants(table):
    flat = table.withColumns({"future_90d_revenue": F.lit(0.0), "churn_30d": F.lit(0)})
    fitted = ltv.fit_candidates(flat, ["tenure_days", "active_days_7d"], 1, SMALL)
    assert fitted.classifier is None and fitted.amount is None
    row = fitted.predict(flat, "user_id").first()
    assert row["two_stage_hurdle_prediction"] == 0.0
    risk = churn.train_churn(flat, trees=SMALL)
    assert risk.importance.count() == 0
    assert risk.predictions.where("churn_probability > 0.001").count() == 0
    assert risk.metrics.where("roc_auc IS NOT NULL OR lift_at_top_10pct IS NOT NULL").count() == 0


def test_two_test_snapshots_are_rejected(table):
    two = table.withColumn("split", F.regexp_replace("split", "validation", "test"))
    with pytest.raises(ValueError, match="instead of one"):
        ltv.train_ltv(two)


def test_segments_from_models(value, risk, table):
    rows = segments.segment_customers(
        value.predictions, risk.predictions, table.where("split = 'train'")
    )
    names = {n for n, _ in segments.SEGMENTS.values()}
    assert {r["customer_segment"] for r in rows.collect()} <= names
    assert segments.segment_counts(rows).agg(F.sum("users")).first()[0] == rows.count() == 30
    table = segments.customer_predictions(value.predictions, risk.predictions, rows)
    assert table.count() == 30


# Segmentation rules ------------------------------------------------------------------


@pytest.fixture
def scores(spark):
    d1, d2 = day("2024-01-01"), day("2024-02-01")
    rows = [
        (1, d1, 0.0, 0.9),
        (1, d2, 10.0, 0.5),
        (2, d1, 10.0, 0.49),
        (3, d1, 9.99, 0.5),
        (4, d1, 0.0, 0.0),
    ]
    both = frame(
        spark, rows, "user_id long, snapshot_date date, predicted_ltv double, churn_probability double"
    )
    return both.drop("churn_probability"), both.drop("predicted_ltv")


def test_flags_include_the_threshold_and_the_latest_row_wins(scores):
    found = segments.segment_customers(*scores, value_threshold=10.0).orderBy("user_id").collect()
    assert [(r["user_id"], r["customer_segment"]) for r in found] == [
        (1, "Priority Retention"),
        (2, "VIP Maintenance"),
        (3, "Automated Reactivation"),
        (4, "Growth/Nurture"),
    ]
    assert found[0]["recommended_action"] == "Personal outreach and retention offer"


def test_default_value_threshold(spark):
    ddl = "future_90d_revenue double"
    some = frame(spark, [(0.0,), (1.0,), (4.0,)], ddl)
    assert segments.default_value_threshold(some).first()[0] == 2.5
    assert segments.default_value_threshold(frame(spark, [(0.0,)], ddl)).first()[0] == 1.0


def test_unmatched_predictions_drop_out(spark, scores):
    value, risk = scores
    found = segments.segment_customers(value, risk.where("user_id != 4"), value_threshold=1.0)
    assert found.count() == 3


def test_parts_of_a_forest_follow_from_its_rows():
    assert modeling.forest_parts(1000, 120) == [30] * 4
    assert modeling.forest_parts(1000, 3) == [1, 1, 1]
    assert modeling.forest_parts(150_000, 160) == [80, 80]
    assert modeling.forest_parts(10**9, 160) == [160]


def test_a_forest_of_parts_is_the_mean_of_its_trees(value, table):
    rows = table.where("split = 'test'")
    data = value.models.featurizer.transform(rows, "user_id")
    found = {r["user_id"]: r["forest_log"] for r in value.models.forest.transform(data).collect()}
    trees = [t for m in value.models.forest.models for t in m.trees]
    for r in data.limit(5).collect():
        own = np.mean([t.predict(r["features"]) for t in trees])
        assert found[r["user_id"]] == pytest.approx(own)


def test_forests_grow_until_leaves_are_small(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(6000).selectExpr("id % 997 AS x", "id % 89 AS z", "CAST(hash(id % 997) % 100 AS DOUBLE) AS y")
    data = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows)
    forest = ltv._forest({"trees": 2, "leaf": 1}, 1, TreeSettings(), labelCol="y").fit(data)
    assert max(t.depth for t in forest.trees) > 7
