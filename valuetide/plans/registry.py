"""Named queries over a star-schema folder: ``name -> (spark, folder) -> DataFrame``.

Unsuffixed names run on the commerce roles, ``_activity`` names on the event
stream, ``_raw`` names and all rules but the last step of validation on tables
that break the rules.  Evaluation, segment and BI queries score users with fixed arithmetic
(``scored``), so every value can be checked in SQL; ``model_*`` queries train.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextvars import ContextVar
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    analyses,
    evaluation,
    kpi,
    quality,
    reconcile,
    reporting,
    retention,
    segments,
    snapshots,
    splits,
)
from ..session import delete_at_exit, scratch_path
from ..sources import sinks
from ..sources.worlds import WORLDS, World, stored_commerce, stored_facts
from . import daystate

Query = Callable[[SparkSession, str], DataFrame]

# Decision thresholds and export widths of the checked queries.
RISK_THRESHOLD = 0.6
FIXED_THRESHOLD = 0.5
VALUE_THRESHOLD = 100000.0
SEED = 42
CARD_CHANNEL = "MACHINERY"


# The roles that a query has made and whose snapshots it scores; else those of the folder.
MADE: ContextVar[World | None] = ContextVar("made", default=None)


def world(name: str, spark: SparkSession, folder: str, *more) -> World:
    return WORLDS[name](spark, folder, *more)


def _snapshots(w: World) -> DataFrame:
    return snapshots.build_snapshots(*w.tables, w.snapshot_dates, w.user_pieces)


def split_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    w = MADE.get() or world("commerce", spark, folder)
    rows = _snapshots(w)
    return splits.assign_temporal_splits(rows, w.snapshot_dates)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots with a churn score on a 0.001 grid and an LTV score."""
    recency = F.least("days_since_last_active", F.lit(89)) * 9
    churn = (100 + recency + F.col("user_id") % 10).cast("double") / 1000
    pace = F.col("historical_ltv") / F.greatest("tenure_days", F.lit(1)) * 45
    return split_snapshots(spark, folder).select(
        "*", churn.alias("churn_probability"), (F.col("revenue_90d") * 0.5 + pace).alias("predicted_ltv")
    )


# What segments, and cards beside them, take of the scored snapshots.
SEGMENT_COLUMNS = ("user_id", "snapshot_date", "ltv_split", "churn_split", "churn_probability", "predicted_ltv")
CARD_COLUMNS = (*SEGMENT_COLUMNS, "split", "churn_30d")


def stored_scores(spark: SparkSession, folder: str, *columns: str, w: World | None = None) -> DataFrame:
    """The scored snapshots, or the columns that a query takes of them, stored.

    Metrics, segments and BI tables all start from this table.  Each call
    stores its own, as the job stores its predictions, so a query calls it once
    and takes all its parts from there.  What feeds no column is neither
    shuffled nor stored.
    """
    made = MADE.set(w)
    try:
        return sinks.materialize(scored(spark, folder).select(*(columns or "*")), "scored")
    finally:
        MADE.reset(made)


def _features_of(table: DataFrame) -> DataFrame:
    return reporting.customer_features(table.drop("churn_probability", "predicted_ltv"))


def latest_features(spark: SparkSession, folder: str) -> DataFrame:
    return _features_of(stored_scores(spark, folder))


def _test_of(table: DataFrame, target: str) -> DataFrame:
    return table.where(F.col(f"{target}_split") == "test")


def churn_test(spark: SparkSession, folder: str) -> DataFrame:
    return _test_of(stored_scores(spark, folder), "churn")


def churn_validation(spark: SparkSession, folder: str) -> DataFrame:
    return stored_scores(spark, folder).where(F.col("churn_split") == "validation")


def ltv_test(spark: SparkSession, folder: str) -> DataFrame:
    return _test_of(stored_scores(spark, folder), "ltv")


def _segments_of(table: DataFrame) -> DataFrame:
    return segments.segment_customers(
        _test_of(table, "ltv"),
        _test_of(table, "churn"),
        value_threshold=VALUE_THRESHOLD,
        risk_threshold=RISK_THRESHOLD,
    )


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return _segments_of(stored_scores(spark, folder, *SEGMENT_COLUMNS))


def customer_predictions(spark: SparkSession, folder: str) -> DataFrame:
    table = stored_scores(spark, folder, *SEGMENT_COLUMNS)
    return segments.customer_predictions(
        _test_of(table, "ltv"), _test_of(table, "churn"), _segments_of(table)
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round float aggregates whose last bits depend on summation order."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# On both worlds ------------------------------------------------------------------

Shared = Callable[[World], DataFrame]

BOTH_WORLDS: dict[str, Shared] = {
    "kpi_dau": lambda w: kpi.dau(w.events),
    "kpi_wau": lambda w: kpi.wau(w.events),
    "kpi_mau": lambda w: kpi.mau(w.events),
    "kpi_monthly": lambda w: kpi.monthly_kpis(w.events, w.transactions),
    "kpi_dau_mau": lambda w: kpi.daily_kpis(w.events),
    "kpi_channel_revenue": lambda w: kpi.channel_revenue(w.users, w.transactions),
    "kpi_headline": lambda w: kpi.headline(kpi.monthly_kpis(w.events, w.transactions)),
    "sql_dau": lambda w: analyses.daily_active_users(w.events),
    "sql_dau_mau": lambda w: analyses.stickiness(w.events),
    "sql_monthly_finance": lambda w: analyses.monthly_finance(w.events, w.transactions),
    "sql_channel_revenue": lambda w: analyses.channel_sales(w.users, w.transactions),
    "sql_user_orders_last_active": lambda w: analyses.orders_and_last_activity(*w.tables),
    "dq_users_key": lambda w: quality.users_key_violations(w.users),
    "dq_orphan_events": lambda w: _rule(quality.event_violations(w.users, w.events), "orphans"),
    "dq_event_before_signup": lambda w: _rule(
        quality.event_violations(w.users, w.events), "before_signup"
    ),
    "dq_session_duration": lambda w: _rule(
        quality.event_violations(w.users, w.events), "session_duration"
    ),
    "dq_orphan_transactions": lambda w: _rule(
        quality.transaction_violations(w.users, w.transactions), "orphans"
    ),
    "dq_order_before_signup": lambda w: _rule(
        quality.transaction_violations(w.users, w.transactions), "before_signup"
    ),
    "dq_amount": lambda w: _rule(
        quality.transaction_violations(w.users, w.transactions), "amount"
    ),
    "dq_refund": lambda w: _rule(
        quality.transaction_violations(w.users, w.transactions), "refund"
    ),
    "dq_report": lambda w: quality.quality_report(*w.tables),
    "dq_summary": lambda w: quality.validate(*w.tables, strict=False),
    "dq_constraints": lambda w: quality.constraint_violations(_named(w)),
    "dq_profile": lambda w: quality.table_profile(
        {
            "users": (w.users, "user_id"),
            "events": (w.events, "event_id"),
            "orders": (w.transactions, "order_id"),
        }
    ),
    "retention_dn": lambda w: retention.day_n_retention(w.users, w.events),
    "cohort_size": lambda w: retention.cohort_size(w.users),
    "cohort_counts": lambda w: retention.cohort_counts(w.users, w.events),
    "cohort_retention": lambda w: retention.cohort_retention(w.users, w.events),
    "retention_by_channel": lambda w: retention.retention_by(w.users, w.events, "channel"),
    "retention_by_device": lambda w: retention.retention_by(w.users, w.events, "device"),
    "snapshot_spine": lambda w: snapshots.snapshot_spine(w.users, w.snapshot_dates).select(
        "user_id", "snapshot_date"
    ),
    "snapshots": lambda w: _snapshots(w),
    "label_churn": lambda w: _snapshots(w).select(
        "user_id", "snapshot_date", "churn_30d"
    ),
    "label_ltv": lambda w: _snapshots(w).select(
        "user_id", "snapshot_date", "future_90d_revenue"
    ),
    "eda_totals": lambda w: reporting.totals(*w.tables),
    "eda_revenue_describe": lambda w: rounded(
        reporting.revenue_describe(w.transactions), 4, "std"
    ),
    "eda_channel_mix": lambda w: reporting.mix(w.users, "channel"),
    "eda_device_mix": lambda w: reporting.mix(w.users, "device"),
    "eda_monthly_trend": lambda w: reporting.monthly_trend(w.events, w.transactions),
    "eda_event_funnel": lambda w: reporting.event_funnel(w.events),
    "bi_calendar": lambda w: reporting.calendar(w.events, w.transactions),
    "run_manifest": lambda w: reporting.run_manifest(*w.tables, seed=SEED),
    "kpi_trend": lambda w: reporting.kpi_trend(
        kpi.daily_kpis(w.events), kpi.monthly_kpis(w.events, w.transactions)
    ),
}


def _rule(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("violations"))


def _named(w: World) -> dict[str, DataFrame]:
    return {"users": w.users, "events": w.events, "transactions": w.transactions}


# On the commerce world -------------------------------------------------------------


def cohort_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table's cells in one column: nine decimals each, parted by commas, empty if NULL."""
    w = world("commerce", spark, folder)
    wide = retention.cohort_matrix(retention.cohort_retention(w.users, w.events))
    header = [c for c in wide.columns if c != "cohort"]
    cells = [F.coalesce(F.col(f"`{c}`").cast("decimal(12,9)").cast("string"), F.lit("")) for c in header]
    return wide.select("cohort", F.lit(len(header)).alias("periods"), F.concat_ws(",", *cells).alias("rates"))


def cohort_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    w = world("commerce", spark, folder)
    return reporting.heatmap(retention.cohort_retention(w.users, w.events))


def kpi_last_months(spark: SparkSession, folder: str) -> DataFrame:
    w = world("commerce", spark, folder)
    return reporting.last_months(kpi.monthly_kpis(w.events, w.transactions))


def _reloaded(spark: SparkSession, folder: str) -> tuple[World, dict, dict]:
    """Source frames of all tables, and the same written and read back.

    The frames are stored first: what is compared with them needs not make them again.
    """
    w = stored_commerce(spark, folder)
    rows = splits.assign_temporal_splits(_snapshots(w), w.snapshot_dates)
    frames = {**_named(w), "user_snapshots": sinks.materialize(rows, "user-snapshots")}
    base = scratch_path(spark, "reconcile")
    delete_at_exit(spark, base)
    for name, frame in frames.items():
        sinks.write_parquet(frame, f"{base}/{name}")
    return w, frames, {name: spark.read.parquet(f"{base}/{name}") for name in frames}


# Days that part the facts into batches, and the cut of the base.
STATE_BATCHES = (dt.date(1999, 1, 1), dt.date(2000, 10, 1))
STATE_CUT = dt.date(2000, 3, 1)


def snapshots_from_state(spark: SparkSession, folder: str) -> DataFrame:
    """Stored snapshots after late facts and appended dates, equal to a full rebuild.

    The middle batch comes last, when a base is there and early dates are made.
    """
    w = stored_commerce(spark, folder)
    state = daystate.DayState(spark, scratch_path(spark, "daystate"))
    delete_at_exit(spark, state.folder)
    first, second = (F.lit(d) for d in STATE_BATCHES)

    def add(name: str, part: Callable[[Column], Column]) -> None:
        state.add(name, w.events.where(part(F.col("event_time"))), w.transactions.where(part(F.col("order_time"))))

    add("early", lambda t: t < first)
    add("recent", lambda t: t >= second)
    state.compact(STATE_CUT)
    state.refresh(w.users, w.snapshot_dates[:4])
    add("late", lambda t: (t >= first) & (t < second))
    state.refresh(w.users, w.snapshot_dates)
    return state.stored(w.users)


def reconcile_reloaded(spark: SparkSession, folder: str) -> DataFrame:
    """Write every table, read it back, and compare with the source frames."""
    w, frames, loaded = _reloaded(spark, folder)
    return reconcile.reconcile(frames, loaded, kpi.monthly_kpis(w.events, w.transactions))


# Fixed value: the key whose ranges get a digest, by table.
DIGEST_KEYS = {"users": "user_id", "events": "event_id", "transactions": "order_id", "user_snapshots": "user_id"}


def reconcile_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the key ranges of every table, source against reloaded."""
    _, frames, loaded = _reloaded(spark, folder)
    return reconcile.reconcile_rows(frames, loaded, DIGEST_KEYS)


def reconcile_swapped(spark: SparkSession, folder: str) -> DataFrame:
    """The same for transactions in which two orders have swapped their amounts.

    Counts and sums stay; the ranges of the least and the greatest order differ.
    """
    rows = world("commerce", spark, folder).transactions
    ends = rows.agg(F.min("order_id").alias("a"), F.max("order_id").alias("b")).first()
    amounts = {r["order_id"]: r["amount"] for r in rows.where(F.col("order_id").isin(ends["a"], ends["b"])).collect()}
    swapped = F.when(F.col("order_id") == ends["a"], F.lit(amounts[ends["b"]])).when(
        F.col("order_id") == ends["b"], F.lit(amounts[ends["a"]])
    )
    changed = rows.withColumn("amount", F.coalesce(swapped, "amount").cast(rows.schema["amount"].dataType))
    return reconcile.compare_digests(rows, changed, "order_id")


def ltv_baselines(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators import ltv

    values = ltv.baseline_values(split_snapshots(spark, folder))
    return rounded(values, 4, "mean_baseline")


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators import churn

    train = split_snapshots(spark, folder).where(F.col("churn_split") == "train")
    return churn.class_weights(train, "churn_30d")


def metric_regression(spark: SparkSession, folder: str) -> DataFrame:
    test = ltv_test(spark, folder).withColumn("zero", F.lit(0.0))
    found = evaluation.regression_metrics(
        test, "future_90d_revenue", {"zero_baseline": "zero", "pace": "predicted_ltv"}
    )
    return rounded(rounded(found, 4, "mae", "rmse"), 9, "r2")


def metric_table(spark: SparkSession, folder: str) -> DataFrame:
    report = evaluation.classifier_report(
        churn_test(spark, folder),
        "churn_30d",
        "churn_probability",
        {"selected": RISK_THRESHOLD, "fixed_0_5": FIXED_THRESHOLD},
    )
    return rounded(report, 9, "pr_auc", "pr_auc_lift", "brier_score")


def metric_roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.ranking_metrics(
        churn_test(spark, folder), "churn_30d", "churn_probability"
    ).select("roc_auc")


def metric_average_precision(spark: SparkSession, folder: str) -> DataFrame:
    found = evaluation.ranking_metrics(
        churn_test(spark, folder), "churn_30d", "churn_probability"
    ).select("pr_auc", "pr_auc_lift")
    return rounded(found, 9, "pr_auc", "pr_auc_lift")


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    flagged = churn_test(spark, folder).withColumn(
        "churn_prediction", (F.col("churn_probability") >= RISK_THRESHOLD).cast("int")
    )
    return evaluation.confusion_matrix(flagged, "churn_30d", "churn_prediction")


def _churn_metric(function, *args, digits=None, columns=(), split="test") -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        table = churn_test(spark, folder) if split == "test" else churn_validation(spark, folder)
        out = function(table, "churn_30d", "churn_probability", *args)
        return rounded(out, digits, *columns) if digits else out

    return run


def bi_measures(spark: SparkSession, folder: str) -> DataFrame:
    w, table = world("commerce", spark, folder), stored_scores(spark, folder, *CARD_COLUMNS)
    daily = sinks.materialize(kpi.daily_activity(w.events), "daily-activity")
    out = reporting.measures(
        w.users,
        kpi.daily_kpis(daily),
        kpi.monthly_kpis(daily, w.transactions),
        _features_of(table),
        _segments_of(table),
    )
    return rounded(out, 4, "avg_predicted_ltv")


# What cards and the snapshots behind them take of events.
CARD_EVENTS = ("user_id", "event_time", "event_type", "session_duration")


def _cards(channel: str | None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        w = world("commerce", spark, folder, *([channel] if channel else []))
        if channel:
            # The facts of one channel are few beside all: they are stored once for all passes.
            w = stored_facts(w, CARD_EVENTS)
            w = replace(w, users=sinks.materialize(w.users, "users"))
        table = stored_scores(spark, folder, *CARD_COLUMNS, w=w)
        out = reporting.executive_cards(
            w.users if channel else sinks.materialize(w.users, "users"),
            w.events,
            w.transactions,
            _features_of(table),
            _segments_of(table),
            channel,
        )
        return rounded(out, 4, "avg_predicted_ltv")

    return run


def bi_ltv_by_channel(spark: SparkSession, folder: str) -> DataFrame:
    users = world("commerce", spark, folder).users
    out = reporting.ltv_by_channel(users, _segments(spark, folder))
    return rounded(out, 4, "avg_predicted_ltv")


def bi_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    table = stored_scores(spark, folder, *CARD_COLUMNS, "days_since_last_active", "historical_ltv")
    return reporting.high_risk_customers(
        world("commerce", spark, folder).users, _features_of(table), _segments_of(table)
    )


def split_audit_leaky(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of splits whose embargo is trained on."""
    rows = split_snapshots(spark, folder).replace("embargo", "train", ["ltv_split", "churn_split"])
    return splits.split_audit(rows)


COMMERCE: dict[str, Query] = {
    "cohort_matrix": cohort_matrix,
    "cohort_heatmap": cohort_heatmap,
    "kpi_last_months": kpi_last_months,
    "reconcile": reconcile_reloaded,
    "reconcile_digests": reconcile_digests,
    "reconcile_swapped": reconcile_swapped,
    "snapshots_from_state": snapshots_from_state,
    "temporal_splits": split_snapshots,
    "split_audit": lambda s, d: splits.split_audit(split_snapshots(s, d)),
    "split_audit_leaky": split_audit_leaky,
    "split_counts": lambda s, d: splits.split_counts(split_snapshots(s, d)),
    "churn_rate_by_split": lambda s, d: splits.churn_rate_by_split(split_snapshots(s, d)),
    "ltv_baselines": ltv_baselines,
    "class_weights": class_weights,
    "metric_regression": metric_regression,
    "metric_classification": _churn_metric(evaluation.classification_metrics, RISK_THRESHOLD),
    "metric_classification_fixed": _churn_metric(
        evaluation.classification_metrics, FIXED_THRESHOLD
    ),
    "metric_roc_auc": metric_roc_auc,
    "metric_average_precision": metric_average_precision,
    "metric_brier": _churn_metric(
        evaluation.probability_metrics, digits=9, columns=("brier_score",)
    ),
    "metric_top_decile": _churn_metric(evaluation.top_share_metrics),
    "metric_table": metric_table,
    "threshold_search": _churn_metric(evaluation.best_threshold, split="validation"),
    "threshold_grid": _churn_metric(evaluation.threshold_grid, split="validation"),
    "confusion_matrix": confusion,
    "roc_curve": _churn_metric(evaluation.roc_curve),
    "pr_curve": _churn_metric(evaluation.pr_curve),
    "calibration_curve": _churn_metric(
        evaluation.calibration_curve, digits=9, columns=("mean_predicted",)
    ),
    "lift_curve": _churn_metric(evaluation.lift_curve),
    "ltv_top_errors": lambda s, d: evaluation.top_errors(
        ltv_test(s, d), "future_90d_revenue", "predicted_ltv"
    ),
    "ltv_histogram": lambda s, d: reporting.ltv_histogram(ltv_test(s, d)),
    "target_histogram": lambda s, d: reporting.target_histogram(split_snapshots(s, d)),
    "segment_default_threshold": lambda s, d: segments.default_value_threshold(
        split_snapshots(s, d).where(F.col("ltv_split") == "train")
    ),
    "segments": _segments,
    "segment_counts": lambda s, d: segments.segment_counts(_segments(s, d)),
    "customer_predictions": customer_predictions,
    "bi_customer_features": latest_features,
    "bi_measures": bi_measures,
    "bi_executive_cards": _cards(None),
    "bi_channel_cards": _cards(CARD_CHANNEL),
    "bi_ltv_by_channel": bi_ltv_by_channel,
    "bi_value_segments": lambda s, d: reporting.value_segment_counts(_segments(s, d)),
    "bi_probability_histogram": lambda s, d: reporting.probability_histogram(_segments(s, d)),
    "bi_high_risk": bi_high_risk,
    "ltv_actual_vs_predicted": lambda s, d: reporting.actual_vs_predicted(ltv_test(s, d)),
    "value_risk_points": lambda s, d: reporting.value_risk_points(_segments(s, d)),
}


def queries() -> dict[str, Query]:
    from . import models

    named: dict[str, Query] = {}
    for name, shared in BOTH_WORLDS.items():
        # Rules are checked on raw tables, where each of them is broken.
        raw = "_raw" if name.startswith("dq_") and name != "dq_summary" else ""
        named[name] = _on(f"commerce{raw}", shared)
        named[f"{name}_activity"] = _on(f"activity{raw}", shared)
        if name.startswith(("kpi_", "sql_", "cohort_", "retention_")):
            named[f"{name}_raw"] = _on("commerce_raw", shared)
    named.update(COMMERCE)
    named.update(models.QUERIES)
    return named


def _on(name: str, shared: Shared) -> Query:
    return lambda spark, folder: shared(world(name, spark, folder))
