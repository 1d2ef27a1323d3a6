"""Lifetime-value bake-off: baselines, linear, forest and two-stage hurdle."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import exact_quantiles
from ..functions.numbers import non_negative_expm1
from ..sources.sinks import materialize
from .evaluation import regression_metrics
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
    training_rows,
    with_forests,
)
from .snapshots import LTV_HORIZON_DAYS, feature_columns
from .splits import TEST, TRAIN, VALIDATION, require_single_test_snapshot, split_column

# Target, model names in order of preference, forest sizes, cut-off.
TARGET = "future_90d_revenue"
LINEAR, FOREST, HURDLE = "linear_regression", "random_forest", "two_stage_hurdle"
CANDIDATES = (LINEAR, FOREST, HURDLE)
BASELINES = ("zero_baseline", "mean_baseline", "median_baseline")
FOREST_SIZE = {"trees": 120, "leaf": 8}
HURDLE_CLASSIFIER = {"trees": 120, "leaf": 10}
HURDLE_AMOUNT = {"trees": 120, "leaf": 6}
FEATURE_SHARE = "0.75"
VALUE_QUANTILE = 0.75


@dataclass
class Fitted:
    """One frame's featurizer and models; ``certain`` replaces a one-class classifier."""

    featurizer: Featurizer
    linear: object
    forest: Forest | TableForest
    classifier: Forest | TableForest | None
    amount: Forest | TableForest | None
    certain: float = 0.0

    def predict(self, frame: DataFrame, *keep: str, candidates: tuple[str, ...] = CANDIDATES) -> DataFrame:
        """``keep`` columns plus one ``<model>_prediction`` column per candidate."""
        needed = {FOREST: (self.forest,), HURDLE: (self.classifier, self.amount)}
        forests = [f for c in candidates for f in needed.get(c, ()) if f is not None]
        out = self.linear.transform(with_forests(self.featurizer.transform(frame, *keep), *forests))
        hurdle = F.lit(self.certain)
        if self.classifier is not None:
            hurdle = F.col("hurdle_positive")
        if self.amount is not None:
            hurdle = hurdle * non_negative_expm1(F.col("hurdle_log_amount"))
        found = {
            LINEAR: non_negative_expm1(F.col("linear_log")),
            FOREST: non_negative_expm1(F.col("forest_log")),
            HURDLE: hurdle,
        }
        return out.select(*keep, *[found[c].alias(f"{c}_prediction") for c in candidates])

    def forests(self) -> dict[str, Forest | TableForest]:
        found = {
            f"ltv_{FOREST}": self.forest,
            f"ltv_{HURDLE}_classifier": self.classifier,
            f"ltv_{HURDLE}_amount": self.amount,
        }
        return {k: f for k, f in found.items() if f is not None}

    def pipelines(self) -> dict[str, PipelineModel]:
        stages = {f"ltv_{LINEAR}": (self.linear,), **{k: f.stages for k, f in self.forests().items()}}
        return {k: self.featurizer.pipeline(*m) for k, m in stages.items()}


@dataclass
class LtvResult:
    selected: str
    value_threshold: float
    predictions: DataFrame
    metrics: DataFrame
    validation_metrics: DataFrame
    importance: DataFrame
    design: DataFrame
    models: Fitted
    features: list[str] = field(default_factory=list)


def _forest(size: dict, seed: int, trees: TreeSettings, **columns) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=VECTOR,
        numTrees=size["trees"],
        minInstancesPerNode=size["leaf"],
        featureSubsetStrategy=FEATURE_SHARE,
        seed=seed,
        **trees.params(),
        **columns,
    )


def least_squares() -> LinearRegression:
    return LinearRegression(
        featuresCol=VECTOR,
        labelCol="log_target",
        predictionCol="linear_log",
        solver="normal",
        regParam=0.0,
    )


def fit_candidates(
    frame: DataFrame, features: list[str], seed: int, trees: TreeSettings = TreeSettings()
) -> Fitted:
    """Fit the three model families on the log1p target of one frame.

    Without any positive target the hurdle predicts zero; without any zero its
    first stage is certain.
    """
    featurizer = Featurizer.fit(frame, features)
    target = F.col(TARGET).cast("double")
    labelled = frame.select(
        "*", F.log1p(target).alias("log_target"), (target > 0).cast("double").alias("is_positive")
    )
    data = training_rows(featurizer.transform(labelled, "log_target", "is_positive"))
    counts = data.agg(F.count("*").alias("n"), F.sum("is_positive").alias("pos")).first()
    n, pos = counts["n"], int(counts["pos"] or 0)

    def fit_linear():
        return least_squares().fit(data)

    def regression(size: dict, rows: DataFrame, count: int, column: str) -> TableForest:
        def estimator(n, own_seed, suffix):
            columns = {"labelCol": "log_target", "predictionCol": column + suffix}
            return _forest({**size, "trees": n}, own_seed, trees, **columns)

        return fit_forest(estimator, rows, count, size["trees"], seed, column)

    def fit_classifier():
        if not 0 < pos < n:
            return None
        weighted = data.withColumn("weight", balanced_weight(F.col("is_positive"), n, pos))

        def estimator(size, own_seed, suffix):
            return RandomForestClassifier(
                featuresCol=VECTOR,
                labelCol="is_positive",
                weightCol="weight",
                predictionCol="hurdle_class" + suffix,
                probabilityCol="hurdle_probability" + suffix,
                rawPredictionCol="hurdle_raw" + suffix,
                numTrees=size,
                minInstancesPerNode=HURDLE_CLASSIFIER["leaf"],
                seed=own_seed,
                **trees.params(),
            )

        return fit_forest(estimator, weighted, n, HURDLE_CLASSIFIER["trees"], seed, "hurdle_positive")

    def fit_amount():
        if not pos:
            return None
        return regression(HURDLE_AMOUNT, data.where(F.col("is_positive") == 1), pos, "hurdle_log_amount")

    linear, forest, classifier, amount = fit_together(
        frame.sparkSession,
        fit_linear,
        lambda: regression(FOREST_SIZE, data, n, "forest_log"),
        fit_classifier,
        fit_amount,
    )
    data.unpersist()
    return Fitted(featurizer, linear, forest, classifier, amount, 1.0 if pos else 0.0)


def baseline_values(snapshots: DataFrame) -> DataFrame:
    """One row: the constants predicted by the naive baselines."""
    split = F.col(split_column(snapshots, "ltv"))
    development = snapshots.where(split.isin(TRAIN, VALIDATION))
    mean = development.agg(F.avg(F.col(TARGET).cast("double")).alias("mean_baseline"))
    median = exact_quantiles(development, TARGET, {"median_baseline": 0.5})
    one = F.lit(1).alias("_one")
    return (
        mean.select("*", one)
        .join(median.select("*", one), "_one")
        .select(F.lit(0.0).alias("zero_baseline"), "mean_baseline", "median_baseline")
    )


def _columns(names: tuple[str, ...]) -> dict[str, str]:
    return {name: f"{name}_prediction" for name in names}


def train_ltv(
    snapshots: DataFrame, seed: int = 42, trees: TreeSettings = TreeSettings()
) -> LtvResult:
    """Select on validation MAE, refit on train + validation, score the test snapshot.

    The value threshold is the 75th percentile of the selected model's
    predictions for the rows it was refitted on.  Give it a stored table (see
    ``sinks.materialize``): every fit scans the rows many times.
    """
    features = feature_columns(snapshots)
    split = split_column(snapshots, "ltv")
    train, validation, test = (
        snapshots.where(F.col(split) == s) for s in (TRAIN, VALIDATION, TEST)
    )
    development = snapshots.where(F.col(split).isin(TRAIN, VALIDATION))
    test_date = require_single_test_snapshot(test, "LTV")

    # The refit covers all candidates, so it need not wait for the selection.
    first, final = fit_together(
        snapshots.sparkSession,
        lambda: fit_candidates(train, features, seed, trees),
        lambda: fit_candidates(development, features, seed, trees),
    )
    validation_metrics = regression_metrics(
        first.predict(validation, TARGET), TARGET, _columns(CANDIDATES)
    )
    found = {r["model"]: r["mae"] for r in validation_metrics.collect()}
    selected = min(CANDIDATES, key=found.__getitem__)

    constants = baseline_values(snapshots).first()
    scored = final.predict(test, "user_id", "snapshot_date", TARGET)
    baselines = [F.lit(constants[b]).cast("double").alias(f"{b}_prediction") for b in BASELINES]
    candidates = [F.col(f"{c}_prediction") for c in CANDIDATES]
    predictions = materialize(
        scored.select(
            "user_id",
            "snapshot_date",
            TARGET,
            *baselines,
            *candidates,
            F.col(f"{selected}_prediction").alias("predicted_ltv"),
        ),
        "ltv-predictions",
    )
    in_sample = final.predict(development, candidates=(selected,))
    threshold = exact_quantiles(
        in_sample, f"{selected}_prediction", {"threshold": VALUE_QUANTILE}
    ).first()[0]
    return LtvResult(
        selected=selected,
        value_threshold=threshold,
        predictions=predictions,
        metrics=regression_metrics(predictions, TARGET, _columns((*BASELINES, *CANDIDATES))),
        validation_metrics=validation_metrics,
        importance=importance_table(snapshots, final.featurizer.columns, final.forest),
        design=temporal_design(snapshots, split, LTV_HORIZON_DAYS, test_date),
        models=final,
        features=features,
    )


def temporal_design(snapshots: DataFrame, split: str, horizon_days: int, test_date) -> DataFrame:
    """One row: split column, train snapshots, validation and test snapshot, horizon."""
    label = F.col(split)
    per_date = snapshots.select("snapshot_date", split).distinct()

    def dates(kind: str) -> Column:
        found = F.collect_set(F.when(label == kind, F.col("snapshot_date").cast("string")))
        return F.array_sort(found)

    return per_date.agg(
        F.lit(split).alias("split_column"),
        dates(TRAIN).alias("train_snapshots"),
        F.min(F.when(label == VALIDATION, F.col("snapshot_date").cast("string"))).alias(
            "validation_snapshot"
        ),
        F.lit(str(test_date)).alias("test_snapshot"),
        F.lit(horizon_days).alias("label_horizon_days"),
    )
