"""Churn bake-off: weighted logistic regression and forest, Platt-calibrated."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import logit
from ..sources.sinks import materialize
from . import evaluation
from .ltv import temporal_design
from .modeling import (
    VECTOR,
    Featurizer,
    Forest,
    TableForest,
    TreeSettings,
    balanced_weight,
    fit_forest,
    fit_together,
    importance_table,
    keep_in_memory,
    positive_probability,
    training_rows,
)
from .snapshots import CHURN_HORIZON_DAYS, feature_columns
from .splits import TEST, TRAIN, VALIDATION, require_single_test_snapshot, split_column

# Target, model names in order of preference, sizes, cut-off.
TARGET = "churn_30d"
LOGISTIC, FOREST = "logistic_regression", "random_forest"
CANDIDATES = (LOGISTIC, FOREST)
FOREST_SIZE = {"trees": 160, "leaf": 8}
MAX_ITERATIONS = 1000
FIXED_THRESHOLD = 0.5


@dataclass(frozen=True)
class Calibration:
    """Platt map of one model: slope and intercept on the log odds of raw scores."""

    slope: float
    intercept: float

    def apply(self, raw: Column) -> Column:
        return 1 / (1 + F.exp(-(logit(raw) * self.slope + self.intercept)))


@dataclass
class ChurnModels:
    featurizer: Featurizer
    scaler: object
    logistic: object | None
    forest: Forest | TableForest | None
    certain: float

    def raw_scores(self, frame: DataFrame, *keep: str) -> DataFrame:
        """``keep`` columns plus one uncalibrated ``<model>_raw`` column per model."""
        out = self.featurizer.transform(frame, *keep)
        if self.logistic is None:
            return out.select(*keep, *[F.lit(self.certain).alias(f"{m}_raw") for m in CANDIDATES])
        out = self.logistic.transform(self.scaler.transform(self.forest.transform(out)))
        return out.select(
            *keep,
            positive_probability("logistic_probability").alias(f"{LOGISTIC}_raw"),
            F.col("forest_positive").alias(f"{FOREST}_raw"),
        )

    def forests(self) -> dict[str, Forest | TableForest]:
        return {} if self.forest is None else {f"churn_{FOREST}": self.forest}

    def pipelines(self) -> dict:
        if self.logistic is None:
            return {}
        return {
            f"churn_{LOGISTIC}": self.featurizer.pipeline(self.scaler, self.logistic),
            f"churn_{FOREST}": self.featurizer.pipeline(*self.forest.stages),
        }


@dataclass
class ChurnResult:
    selected: str
    thresholds: dict[str, float]
    calibrations: dict[str, Calibration]
    predictions: DataFrame
    scores: DataFrame
    metrics: DataFrame
    importance: DataFrame
    design: DataFrame
    models: ChurnModels
    features: list[str]

    def calibration_table(self) -> DataFrame:
        """What the saved models lack: Platt map and threshold per model."""
        return calibration_rows(self.predictions.sparkSession, self.calibrations, self.thresholds)


def calibration_rows(
    spark: SparkSession, calibrations: dict[str, Calibration], thresholds: dict[str, float]
) -> DataFrame:
    rows = [(m, c.slope, c.intercept, thresholds[m]) for m, c in calibrations.items()]
    return spark.createDataFrame(
        rows, "model string, slope double, intercept double, threshold double"
    )


def importance(frame: DataFrame, models: ChurnModels) -> DataFrame:
    """(feature, importance) of the forest; no rows where one class needed none."""
    if models.forest is None:
        return frame.sparkSession.createDataFrame([], "feature string, importance double")
    return importance_table(frame, models.featurizer.columns, models.forest)


def metric_reports(scores: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Every metric of every model, at its own and at the fixed threshold."""
    reports = [
        evaluation.classifier_report(
            scores, TARGET, m, {"selected": thresholds[m], "fixed_0_5": FIXED_THRESHOLD}
        ).select(F.lit(m).alias("model"), "*")
        for m in CANDIDATES
    ]
    return reduce(DataFrame.unionByName, reports)


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """(label, rows, weight) with weight n / (2 n_c); two rows for a binary label."""
    counts = train.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count("*").alias("rows")
    )
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("weight", total / (2 * F.col("rows")))


def fit_models(
    train: DataFrame, features: list[str], seed: int, trees: TreeSettings = TreeSettings()
) -> ChurnModels:
    """Fit both families with balanced classes; one-class data yields a constant."""
    featurizer = Featurizer.fit(train, features)
    label = F.col(TARGET).cast("double")
    data = training_rows(featurizer.transform(train.select("*", label.alias("label")), "label"))
    counts = data.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).first()
    n, pos = counts["n"], int(counts["pos"] or 0)
    scaler = StandardScaler(
        inputCol=VECTOR, outputCol="scaled", withMean=True, withStd=True
    ).fit(data)
    if not 0 < pos < n:
        data.unpersist()
        return ChurnModels(featurizer, scaler, None, None, 1.0 if pos else 0.0)
    weighted = data.withColumn("weight", balanced_weight(F.col("label"), n, pos))

    def fit_logistic():
        # Spark averages the loss over the weights (which sum to n) while the
        # usual C = 1 penalty is added to their sum, hence 1 / n.
        scaled = keep_in_memory(scaler.transform(weighted).select("scaled", "label", "weight"))
        model = LogisticRegression(
            featuresCol="scaled",
            labelCol="label",
            weightCol="weight",
            predictionCol="logistic_class",
            probabilityCol="logistic_probability",
            rawPredictionCol="logistic_raw_score",
            regParam=1.0 / n,
            elasticNetParam=0.0,
            standardization=False,
            maxIter=MAX_ITERATIONS,
        ).fit(scaled)
        scaled.unpersist()
        return model

    def estimator(size, own_seed, suffix):
        return RandomForestClassifier(
            featuresCol=VECTOR,
            labelCol="label",
            weightCol="weight",
            predictionCol="forest_class" + suffix,
            probabilityCol="forest_probability" + suffix,
            rawPredictionCol="forest_raw_score" + suffix,
            numTrees=size,
            minInstancesPerNode=FOREST_SIZE["leaf"],
            featureSubsetStrategy="sqrt",
            seed=own_seed,
            **trees.params(),
        )

    def grow():
        return fit_forest(estimator, weighted, n, FOREST_SIZE["trees"], seed, "forest_positive")

    logistic, forest = fit_together(train.sparkSession, fit_logistic, grow)
    data.unpersist()
    return ChurnModels(featurizer, scaler, logistic, forest, 0.0)


def fit_calibration(validation: DataFrame, raw: str) -> Calibration:
    """Platt scaling; with one class only, the constant at its clipped log odds."""
    data = validation.select(
        F.col(TARGET).cast("double").alias("label"), logit(F.col(raw)).alias("z")
    )
    counts = data.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).first()
    n, pos = counts["n"], int(counts["pos"] or 0)
    if not 0 < pos < n:
        constant = data.select(logit(F.lit(float(pos > 0)))).first()
        return Calibration(0.0, constant[0] if constant else 0.0)
    fitted = LogisticRegression(
        featuresCol="z_vector",
        labelCol="label",
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
    ).fit(VectorAssembler(inputCols=["z"], outputCol="z_vector").transform(data))
    return Calibration(float(fitted.coefficients[0]), float(fitted.intercept))


def train_churn(
    snapshots: DataFrame, seed: int = 42, trees: TreeSettings = TreeSettings()
) -> ChurnResult:
    """Fit on train, calibrate and choose thresholds on validation, score the test snapshot.

    The selected model has the highest average precision on validation; models
    are not refitted.
    """
    features = feature_columns(snapshots)
    split = split_column(snapshots, "churn")
    train, validation, test = (
        snapshots.where(F.col(split) == s) for s in (TRAIN, VALIDATION, TEST)
    )
    test_date = require_single_test_snapshot(test, "Churn")
    models = fit_models(train, features, seed, trees)

    raw_validation = materialize(models.raw_scores(validation, "user_id", TARGET), "churn-validation")
    calibrations = dict(
        zip(
            CANDIDATES,
            fit_together(
                snapshots.sparkSession,
                *[partial(fit_calibration, raw_validation, f"{m}_raw") for m in CANDIDATES],
            ),
        )
    )
    calibrated = keep_in_memory(calibrate(raw_validation, calibrations, "user_id", TARGET))
    thresholds, precision = {}, {}
    for m in CANDIDATES:
        thresholds[m] = evaluation.best_threshold(calibrated, TARGET, m).first()["threshold"]
        precision[m] = evaluation.ranking_metrics(calibrated, TARGET, m).first()["pr_auc"] or 0.0
    calibrated.unpersist()
    selected = max(CANDIDATES, key=precision.__getitem__)

    scores = materialize(
        calibrate(
            models.raw_scores(test, "user_id", "snapshot_date", TARGET),
            calibrations,
            "user_id",
            "snapshot_date",
            TARGET,
        ),
        "churn-scores",
    )
    probability = F.col(selected)
    predictions = scores.select(
        "user_id",
        "snapshot_date",
        TARGET,
        probability.alias("churn_probability"),
        (probability >= thresholds[selected]).cast("int").alias("churn_prediction"),
    )
    return ChurnResult(
        selected=selected,
        thresholds=thresholds,
        calibrations=calibrations,
        predictions=predictions,
        scores=scores,
        metrics=metric_reports(scores, thresholds),
        importance=importance(snapshots, models),
        design=temporal_design(snapshots, split, CHURN_HORIZON_DAYS, test_date),
        models=models,
        features=features,
    )


def calibrate(raw: DataFrame, calibrations: dict[str, Calibration], *keep: str) -> DataFrame:
    return raw.select(
        *keep, *[c.apply(F.col(f"{m}_raw")).alias(m) for m, c in calibrations.items()]
    )
