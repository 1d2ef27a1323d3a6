"""End-to-end job: validate, KPIs, retention, snapshots, models, segments, exports.

Intermediate tables that several stages read (user-days, snapshots) are written
once to the output folder and read back, so later stages start from stored
rows: a lost executor recomputes a scan, not the whole history.  A run that
broke off goes on behind the last finished table (see ``stages``); models are
fitted anew, as their folder holds whole versions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..operators import churn, kpi, ltv, quality, reconcile, reporting, retention, segments
from ..operators.modeling import TreeSettings
from ..operators.snapshots import DEFAULT_SNAPSHOTS, build_snapshots
from ..operators.splits import assign_temporal_splits
from ..sources import readers, sinks
from . import modelstore
from .stages import Stages, run_key


@dataclass(frozen=True)
class Outcome:
    ltv: ltv.LtvResult
    churn: churn.ChurnResult
    segments: DataFrame
    manifest: DataFrame
    paths: dict[str, str]


def run_summary(spark: SparkSession, value: ltv.LtvResult, risk: churn.ChurnResult) -> DataFrame:
    """(target, selected_model, calibration, cutoff): what segments are cut by."""
    rows = [
        ("ltv", value.selected, None, float(value.value_threshold)),
        ("churn", risk.selected, "platt", float(risk.thresholds[risk.selected])),
    ]
    return spark.createDataFrame(
        rows, "target string, selected_model string, calibration string, cutoff double"
    )


def stored_segments(spark: SparkSession, output: str) -> DataFrame:
    """The segment table again, from what a run has written below ``output``."""
    summary = readers.read_metrics(spark, f"{output}/metrics/run_summary")
    cutoff = {r["target"]: r["cutoff"] for r in summary.collect()}
    return segments.segment_customers(
        spark.read.parquet(f"{output}/ltv_predictions"),
        spark.read.parquet(f"{output}/churn_predictions"),
        value_threshold=cutoff["ltv"],
        risk_threshold=cutoff["churn"],
    )


def score(rows: DataFrame, output: str, version: int | None = None) -> DataFrame:
    """Segments of new snapshot rows by the models that a run has published below ``output``.

    Nothing is fitted and no labels are needed; rows whose features differ from
    those of training are an error.
    """
    return modelstore.load(rows.sparkSession, f"{output}/models", version).segments(rows)


def run(
    users: DataFrame,
    events: DataFrame,
    transactions: DataFrame,
    output: str,
    snapshot_dates=None,
    seed: int = 42,
    database: str | None = None,
    trees: TreeSettings = TreeSettings(),
) -> Outcome:
    """Run every stage and write its tables below ``output``.

    With ``database`` the five tables of the data model are also refreshed in
    the catalog, reloaded and reconciled; a mismatch raises ``ValueError``.
    """
    spark = users.sparkSession
    paths: dict[str, str] = {}
    inputs = {"users": users, "events": events, "transactions": transactions}
    quality.require_rows(inputs)
    stages = Stages(spark, output, run_key(inputs, snapshot_dates=snapshot_dates))

    def staged(name: str, make, partition_by: str | None = None) -> DataFrame:
        paths[name] = f"{output}/{name}"
        return stages.table(name, make, partition_by)

    def store(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{output}/{name}"
        sinks.write_parquet(df, paths[name])
        return spark.read.parquet(paths[name])

    def export(name: str, df: DataFrame) -> None:
        paths[name] = f"{output}/csv/{name}"
        sinks.write_csv(df, paths[name])

    def metrics(name: str, df: DataFrame) -> None:
        paths[name] = f"{output}/metrics/{name}"
        sinks.write_metrics(df, paths[name])

    def checked_days() -> DataFrame:
        quality.validate(users, events, transactions)
        # Orders are counted as rows of their key, so the key has to hold.
        quality.require_key(transactions, "transactions", ["order_id"])
        return kpi.user_days(events)

    days = staged("user_days", checked_days)
    kpis = lru_cache(lambda: kpi.calculate_kpis(users, days, transactions))
    daily = staged("daily_kpis", lambda: kpis().daily)
    monthly = staged("monthly_kpis", lambda: kpis().monthly)
    staged("weekly_kpis", lambda: kpis().weekly)
    staged("channel_revenue", lambda: kpis().channel)

    kept = lru_cache(lambda: retention.calculate_retention(users, days))
    staged("retention_summary", lambda: kept().summary)
    cohorts = staged("cohort_retention", lambda: kept().cohorts)
    staged("retention_by_channel", lambda: kept().by_channel)
    staged("retention_by_device", lambda: kept().by_device)

    def split_rows() -> DataFrame:
        rows = build_snapshots(users, events, transactions, snapshot_dates)
        return assign_temporal_splits(rows, snapshot_dates or DEFAULT_SNAPSHOTS)

    rows = staged("user_snapshots", split_rows, partition_by="snapshot_date")

    value = ltv.train_ltv(rows, seed, trees)
    risk = churn.train_churn(rows, seed, trees)
    ltv_rows = store("ltv_predictions", value.predictions)
    churn_rows = store("churn_predictions", risk.predictions)
    modelstore.publish(f"{output}/models", rows, value, risk)
    store("churn_calibration", risk.calibration_table())
    metrics("ltv_metrics", value.metrics)
    metrics("churn_metrics", risk.metrics)
    metrics("temporal_design", value.design.unionByName(risk.design))
    metrics("ltv_validation", value.validation_metrics)
    metrics("ltv_importance", value.importance)
    metrics("churn_importance", risk.importance)
    metrics("run_summary", run_summary(spark, value, risk))

    people = store(
        "customer_segments",
        segments.segment_customers(
            ltv_rows,
            churn_rows,
            value_threshold=value.value_threshold,
            risk_threshold=risk.thresholds[risk.selected],
        ),
    )
    metrics("segment_counts", segments.segment_counts(people))
    predictions = store(
        "customer_predictions", segments.customer_predictions(ltv_rows, churn_rows, people)
    )

    if database:
        frames = {
            "users": users,
            "events": events,
            "transactions": transactions,
            "user_snapshots": rows,
        }
        sinks.refresh_tables(spark, database, {**frames, "customer_predictions": predictions})
        loaded = {name: spark.table(f"{database}.{name}") for name in frames}
        checks = store("reconciliation", reconcile.reconcile(frames, loaded, monthly))
        metrics("reconciliation", checks)
        paths["reconciliation"] = f"{output}/reconciliation"
        reconcile.require_reconciled(checks)

    features = reporting.customer_features(rows)
    export("monthly_kpis_csv", monthly)
    export("daily_kpis_csv", daily)
    export("cohort_matrix_csv", retention.cohort_matrix(cohorts))
    export("customer_features_csv", features)
    export("users_csv", users)
    export("customer_segments_csv", people)
    manifest = reporting.run_manifest(users, events, transactions, seed)
    metrics("run_manifest", manifest)
    return Outcome(value, risk, people, manifest, paths)
