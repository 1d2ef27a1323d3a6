"""Queries of the model path.

Fitted forests and logistic models have no SQL twin; rows and invariants are
checked instead.  What is fixed arithmetic around them has one: designs,
scaling, least squares, the hurdle product, the Platt map.

Trained models are an explicit, stored input: ``trained`` looks for a version
in the model store below the shared folder that was fitted on exactly these
files, and trains and publishes one where there is none.  Every query then
scores the snapshots itself, from the stored models.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import non_negative_expm1
from ..operators import churn, evaluation, ltv, reporting, segments
from ..operators.modeling import VECTOR, Featurizer, fit_together, importance_table
from ..operators.snapshots import CHURN_HORIZON_DAYS, LTV_HORIZON_DAYS
from ..operators.splits import TEST, TRAIN, require_single_test_snapshot
from ..session import delete_at_exit, shared_dir
from ..sources.sinks import materialize
from . import modelstore


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Split snapshots, stored for the passes of training."""
    from .registry import split_snapshots

    return materialize(split_snapshots(spark, folder), "snapshots")


def table_state(spark: SparkSession, folder: str) -> str:
    """Digest of path, length and time of every file behind the role tables."""
    found = []
    for name in ("customer", "nation", "region", "orders", "lineitem"):
        for file in spark.read.parquet(f"{folder}/{name}.parquet").inputFiles():
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
            found.append((file, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:16]


def store_folder(spark: SparkSession, folder: str) -> str:
    return f"{shared_dir(spark)}/models-{table_state(spark, folder)}"


def train_and_publish(rows: DataFrame, store: str) -> int:
    both = fit_together(rows.sparkSession, lambda: ltv.train_ltv(rows), lambda: churn.train_churn(rows))
    return modelstore.publish(store, rows, *both)


def trained(spark: SparkSession, folder: str, rows: DataFrame) -> modelstore.Stored:
    """The latest version fitted on these files; fits and publishes the first."""
    store = store_folder(spark, folder)
    if not modelstore.versions(spark, store):
        train_and_publish(rows, store)
        delete_at_exit(spark, store)
    return modelstore.load(spark, store)


def _test_rows(rows: DataFrame, target: str) -> DataFrame:
    return rows.where(F.col(f"{target}_split") == TEST)


def _scoring(query):
    """A query on the stored models and the snapshots of the folder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = _snapshots(spark, folder)
        return query(trained(spark, folder, rows), rows)

    return run


KEEP = ("user_id", "snapshot_date")


def ltv_predictions(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return models.ltv_predictions(_test_rows(rows, "ltv"), *KEEP, ltv.TARGET)


def churn_predictions(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return models.churn_predictions(_test_rows(rows, "churn"), *KEEP, churn.TARGET)


def churn_scores(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    scores = models.churn_scores(_test_rows(rows, "churn"), *KEEP, churn.TARGET)
    return materialize(scores, "churn-scores")


def ltv_metrics(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return modelstore.ltv_metrics(materialize(ltv_predictions(models, rows), "ltv-predictions"))


def churn_metrics(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return churn.metric_reports(churn_scores(models, rows), models.record["churn"]["thresholds"])


def churn_thresholds(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return churn.calibration_rows(rows.sparkSession, models.calibrations, models.record["churn"]["thresholds"])


def ltv_importance(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return reporting.top_features(importance_table(rows, models.value.featurizer.columns, models.value.forest))


def churn_importance(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return reporting.top_features(churn.importance(rows, models.risk))


def churn_calibration(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return evaluation.calibration_curve(churn_scores(models, rows), churn.TARGET, models.record["churn"]["selected"])


def _segments_of(models: modelstore.Stored, value: DataFrame, risk: DataFrame) -> DataFrame:
    return segments.segment_customers(
        value,
        risk,
        value_threshold=models.record["ltv"]["threshold"],
        risk_threshold=models.churn_threshold,
    )


def _both(models: modelstore.Stored, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    value = models.predicted_ltv(_test_rows(rows, "ltv"), *KEEP)
    return value, churn_predictions(models, rows)


def model_segments(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    return _segments_of(models, *_both(models, rows))


def customer_predictions(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    value, risk = _both(models, rows)
    value, risk = materialize(value, "ltv-predictions"), materialize(risk, "churn-predictions")
    return segments.customer_predictions(value, risk, _segments_of(models, value, risk))


def stored_scores(models: modelstore.Stored, rows: DataFrame) -> DataFrame:
    """Segments of the newest snapshot without its labels, as a later session scores it."""
    newest = rows.agg(F.max("snapshot_date")).first()[0]
    fresh = rows.where(F.col("snapshot_date") == newest).select(*KEEP, *models.features)
    return models.segments(fresh)


# Inputs of the checked arithmetic.
PLATT = churn.Calibration(0.8, -0.3)
OLS_FEATURE = "historical_ltv"
SCALED = ("tenure_days", "active_days_30d", "revenue_90d")


def _design(target: str, horizon: int):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows, split = _snapshots(spark, folder), f"{target}_split"
        test = require_single_test_snapshot(rows.where(F.col(split) == TEST), target)
        found = ltv.temporal_design(rows, split, horizon, test)
        return found.withColumn("train_snapshots", F.array_join("train_snapshots", ","))

    return run


def model_ols_log1p(spark: SparkSession, folder: str) -> DataFrame:
    rows = _snapshots(spark, folder).where(F.col("ltv_split") == TRAIN)
    target = F.log1p(F.col(ltv.TARGET).cast("double"))
    data = Featurizer.fit(rows, [OLS_FEATURE]).transform(rows.withColumn("log_target", target), "log_target")
    model = ltv.least_squares().fit(data)
    found = [(round(float(model.coefficients[0]), 9), round(model.intercept, 6))]
    return spark.createDataFrame(found, "slope double, intercept double")


def model_scale_moments(spark: SparkSession, folder: str) -> DataFrame:
    rows = _snapshots(spark, folder).where(F.col("churn_split") == TRAIN)
    data = Featurizer.fit(rows, list(SCALED)).transform(rows)
    fitted = StandardScaler(inputCol=VECTOR, outputCol="scaled", withMean=True).fit(data)
    found = [(c, round(float(m), 6), round(float(s), 6)) for c, m, s in zip(SCALED, fitted.mean, fitted.std)]
    return spark.createDataFrame(found, "feature string, mean double, std double")


def model_platt_map(spark: SparkSession, folder: str) -> DataFrame:
    from .registry import churn_test

    mapped = PLATT.apply(F.col("churn_probability"))
    return churn_test(spark, folder).select("user_id", F.round(mapped, 9).alias("calibrated"))


def model_hurdle_product(spark: SparkSession, folder: str) -> DataFrame:
    from .registry import ltv_test

    amount = non_negative_expm1(F.log1p(F.col("predicted_ltv")) / 2 - 1)
    product = F.col("churn_probability") * amount
    return ltv_test(spark, folder).select("user_id", F.round(product, 6).alias("predicted"))


QUERIES = {
    "model_ltv_predictions": _scoring(ltv_predictions),
    "model_ltv_metrics": _scoring(ltv_metrics),
    "model_ltv_validation": _scoring(lambda m, rows: m.table(rows.sparkSession, "ltv_validation")),
    "model_ltv_importance": _scoring(ltv_importance),
    "model_ltv_design": _design("ltv", LTV_HORIZON_DAYS),
    "model_churn_predictions": _scoring(churn_predictions),
    "model_churn_metrics": _scoring(churn_metrics),
    "model_churn_importance": _scoring(churn_importance),
    "model_churn_thresholds": _scoring(churn_thresholds),
    "model_churn_calibration": _scoring(churn_calibration),
    "model_churn_design": _design("churn", CHURN_HORIZON_DAYS),
    "model_ols_log1p": model_ols_log1p,
    "model_scale_moments": model_scale_moments,
    "model_platt_map": model_platt_map,
    "model_hurdle_product": model_hurdle_product,
    "model_segments": _scoring(model_segments),
    "model_segment_counts": _scoring(lambda m, rows: segments.segment_counts(model_segments(m, rows))),
    "model_customer_predictions": _scoring(customer_predictions),
    "model_stored_scores": _scoring(stored_scores),
}
