"""Versioned store of fitted models, and scoring plans that start from it.

A version is a folder ``v=<number>`` that never changes once it is complete:
one saved pipeline for each model, the trees of each forest as the table it is
scored from, the tables that only training can give, and a manifest.  The manifest is written last, so a version without one is the
rest of a run that broke off and is passed over.  It holds what the pipelines
lack: selected models, cut-offs, Platt maps, constants for one-class data, the
features with their types, and a digest of these, which the rows to be scored
must match.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import churn, ltv, segments
from ..operators.evaluation import regression_metrics
from ..operators.forest import Grown
from ..operators.modeling import Featurizer, Forest, TableForest
from ..sources import sinks

MANIFEST = "manifest string"
TABLES = ("ltv_validation", "temporal_design")


class SchemaChanged(ValueError):
    """Rows to be scored have not the features that the models were fitted on."""


def schema_digest(frame: DataFrame, features: list[str]) -> str:
    """Digest of the features' names and types, in order."""
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    return hashlib.sha256(json.dumps([[c, kinds.get(c)] for c in features]).encode()).hexdigest()


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions, in order."""
    files, root = _files(spark, folder)
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    numbers = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
    return sorted(n for n in numbers if files.exists(_files(spark, f"{folder}/v={n}/manifest/_SUCCESS")[1]))


def publish(
    folder: str, snapshots: DataFrame, value: ltv.LtvResult, risk: churn.ChurnResult
) -> int:
    """Save both bake-offs as the next version and give its number.

    Everything is written to a draft and renamed when the manifest is there,
    so readers see a whole version or none, and two writers cannot mix.
    """
    spark = snapshots.sparkSession
    draft = f"{folder}/_draft-{uuid.uuid4().hex[:12]}"
    pipelines = {
        "ltv_features": value.models.featurizer.pipeline(),
        "churn_features": risk.models.featurizer.pipeline(risk.models.scaler),
        **value.models.pipelines(),
        **risk.models.pipelines(),
    }
    forests = {k: f for k, f in {**value.models.forests(), **risk.models.forests()}.items() if isinstance(f, TableForest)}

    def save_trees(name: str) -> None:
        sinks.write_parquet(forests[name].grown.trees, f"{draft}/trees/{name}")

    sinks.save_models(pipelines, f"{draft}/models")
    sinks.side_by_side(save_trees, forests)
    sinks.write_parquet(value.validation_metrics, f"{draft}/ltv_validation")
    sinks.write_parquet(value.design.unionByName(risk.design), f"{draft}/temporal_design")
    baselines = ltv.baseline_values(snapshots).first().asDict()
    record = {
        "models": sorted(pipelines),
        "forests": {k: f.grown.record() for k, f in forests.items()},
        "features": value.features,
        "schema": schema_digest(snapshots, value.features),
        "ltv": {
            "selected": value.selected,
            "threshold": float(value.value_threshold),
            "certain": value.models.certain,
            "baselines": {k: None if v is None else float(v) for k, v in baselines.items()},
        },
        "churn": {
            "selected": risk.selected,
            "certain": risk.models.certain,
            "thresholds": {m: float(t) for m, t in risk.thresholds.items()},
            "calibrations": {m: [c.slope, c.intercept] for m, c in risk.calibrations.items()},
        },
    }
    sinks.write_parquet(spark.createDataFrame([(json.dumps(record),)], MANIFEST), f"{draft}/manifest")
    files, source = _files(spark, draft)
    number = max([0, *versions(spark, folder)])
    while True:
        number += 1
        target = _files(spark, f"{folder}/v={number}")[1]
        # A rename onto a version that another writer took meanwhile fails or nests.
        if not files.exists(target) and files.rename(source, target):
            return number


@dataclass(frozen=True)
class Stored:
    """A version, ready to score."""

    version: int
    folder: str
    record: dict
    value: ltv.Fitted
    risk: churn.ChurnModels

    @property
    def features(self) -> list[str]:
        return self.record["features"]

    @property
    def calibrations(self) -> dict[str, churn.Calibration]:
        return {m: churn.Calibration(*c) for m, c in self.record["churn"]["calibrations"].items()}

    @property
    def churn_threshold(self) -> float:
        return self.record["churn"]["thresholds"][self.record["churn"]["selected"]]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}")

    def require(self, rows: DataFrame) -> None:
        """Raise unless ``rows`` have the features of training, by name and type."""
        missing = [c for c in self.features if c not in rows.columns]
        if missing:
            raise SchemaChanged(f"version {self.version} needs the columns {', '.join(missing)}")
        if schema_digest(rows, self.features) != self.record["schema"]:
            raise SchemaChanged(f"the feature types are not those of version {self.version}")

    def predicted_ltv(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and the selected model's prediction as ``predicted_ltv``; no other model scores."""
        self.require(rows)
        selected = self.record["ltv"]["selected"]
        scored = self.value.predict(rows, *keep, candidates=(selected,))
        return scored.select(*keep, F.col(f"{selected}_prediction").alias("predicted_ltv"))

    def ltv_predictions(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep``, baselines, every model's prediction and the selected one's as ``predicted_ltv``."""
        self.require(rows)
        own = self.record["ltv"]
        scored = self.value.predict(rows, *keep)
        baselines = [
            F.lit(own["baselines"][b]).cast("double").alias(f"{b}_prediction") for b in ltv.BASELINES
        ]
        return scored.select(
            *keep,
            *baselines,
            *[f"{c}_prediction" for c in ltv.CANDIDATES],
            F.col(f"{own['selected']}_prediction").alias("predicted_ltv"),
        )

    def churn_scores(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and every model's calibrated probability."""
        self.require(rows)
        return churn.calibrate(self.risk.raw_scores(rows, *keep), self.calibrations, *keep)

    def churn_predictions(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep``, the selected model's probability and whether it reaches the threshold."""
        probability = F.col(self.record["churn"]["selected"])
        return self.churn_scores(rows, *keep).select(
            *keep,
            probability.alias("churn_probability"),
            (probability >= self.churn_threshold).cast("int").alias("churn_prediction"),
        )

    def segments(self, rows: DataFrame) -> DataFrame:
        """Segments of scored rows (user_id, snapshot_date and the features), no label needed."""
        keep = ("user_id", "snapshot_date")
        return segments.segment_customers(
            self.predicted_ltv(rows, *keep),
            self.churn_predictions(rows, *keep),
            value_threshold=self.record["ltv"]["threshold"],
            risk_threshold=self.churn_threshold,
        )


def load(spark: SparkSession, folder: str, version: int | None = None) -> Stored:
    """A version of the store, the latest complete one by default; nothing is fitted."""
    found = versions(spark, folder)
    number = version if version is not None else (found[-1] if found else None)
    if number not in found:
        raise FileNotFoundError(f"no complete version {number or ''} below {folder}")
    place = f"{folder}/v={number}"
    record = json.loads(spark.read.parquet(f"{place}/manifest").first()["manifest"])
    tables = record.get("forests", {})

    def pipeline(name: str) -> list:
        return PipelineModel.load(f"{place}/models/{name}").stages

    # Versions from before forests were stored as tables have Spark ML's models only.
    whole = [m for m in record["models"] if m not in tables]
    stages = dict(zip(whole, sinks.side_by_side(pipeline, whole)))

    def last(name: str):
        return stages[name][-1] if name in stages else None

    def forest(name: str, column: str) -> Forest | TableForest | None:
        if name in tables:
            grown = Grown.of(spark.read.parquet(f"{place}/trees/{name}"), tables[name])
            return TableForest(grown, column, lambda: tuple(pipeline(name)[2:]))
        return Forest(tuple(stages[name][2:]), column) if name in stages else None

    def featurizer(name: str) -> Featurizer:
        imputer, assembler = stages[name][:2]
        return Featurizer(imputer, assembler, tuple(imputer.getInputCols()))

    value = ltv.Fitted(
        featurizer("ltv_features"),
        last(f"ltv_{ltv.LINEAR}"),
        forest(f"ltv_{ltv.FOREST}", "forest_log"),
        forest(f"ltv_{ltv.HURDLE}_classifier", "hurdle_positive"),
        forest(f"ltv_{ltv.HURDLE}_amount", "hurdle_log_amount"),
        record["ltv"]["certain"],
    )
    risk = churn.ChurnModels(
        featurizer("churn_features"),
        stages["churn_features"][2],
        last(f"churn_{churn.LOGISTIC}"),
        forest(f"churn_{churn.FOREST}", "forest_positive"),
        record["churn"]["certain"],
    )
    return Stored(number, place, record, value, risk)


def ltv_metrics(predictions: DataFrame) -> DataFrame:
    """Metrics of every baseline and model on labelled predictions."""
    names = (*ltv.BASELINES, *ltv.CANDIDATES)
    return regression_metrics(predictions, ltv.TARGET, {n: f"{n}_prediction" for n in names})
