"""Value x risk customer segments and the activation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distribution import exact_quantiles

# Segment names, actions and default thresholds.
SEGMENTS = {
    ("High Value", "High Risk"): ("Priority Retention", "Personal outreach and retention offer"),
    ("High Value", "Low Risk"): ("VIP Maintenance", "VIP benefits and cross-sell"),
    ("Low Value", "High Risk"): ("Automated Reactivation", "Automated win-back campaign"),
    ("Low Value", "Low Risk"): ("Growth/Nurture", "Education and next-best-action nurture"),
}
DEFAULT_RISK_THRESHOLD = 0.5
DEFAULT_VALUE_THRESHOLD = 1.0


def default_value_threshold(train: DataFrame) -> DataFrame:
    """Median positive future revenue of the training rows, else 1.0; one row."""
    positive = train.where(F.col("future_90d_revenue") > 0)
    return exact_quantiles(positive, "future_90d_revenue", {"median": 0.5}).select(
        F.coalesce("median", F.lit(DEFAULT_VALUE_THRESHOLD)).alias("value_threshold")
    )


def latest_per_user(df: DataFrame) -> DataFrame:
    """One row per user, that of the latest snapshot.

    ``max_by`` combines on the map side, unlike a per-user sort.
    """
    others = [c for c in df.columns if c != "user_id"]
    packed = F.struct(*others)
    return (
        df.groupBy("user_id")
        .agg(F.max_by(packed, F.col("snapshot_date")).alias("row"))
        .select("user_id", "row.*")
    )


def segment_customers(
    ltv_predictions: DataFrame,
    churn_predictions: DataFrame,
    train_snapshots: DataFrame | None = None,
    value_threshold: float | None = None,
    risk_threshold: float | None = None,
) -> DataFrame:
    """Latest prediction per user with value flag, risk flag, segment and action.

    Without a value threshold the median positive training revenue is used;
    both comparisons include the threshold itself.
    """
    if value_threshold is None:
        value_threshold = default_value_threshold(train_snapshots).first()[0]
    if risk_threshold is None:
        risk_threshold = DEFAULT_RISK_THRESHOLD
    scores = churn_predictions.select("user_id", "snapshot_date", "churn_probability")
    joined = ltv_predictions.select("user_id", "snapshot_date", "predicted_ltv").join(
        scores, ["user_id", "snapshot_date"]
    )
    high_value = F.col("predicted_ltv") >= F.lit(float(value_threshold))
    high_risk = F.col("churn_probability") >= F.lit(float(risk_threshold))
    flagged = latest_per_user(joined).select(
        "user_id",
        "predicted_ltv",
        "churn_probability",
        F.when(high_value, "High Value").otherwise("Low Value").alias("value_segment"),
        F.when(high_risk, "High Risk").otherwise("Low Risk").alias("risk_segment"),
    )
    segment = action = None
    for (value, risk), (name, advice) in SEGMENTS.items():
        here = (F.col("value_segment") == value) & (F.col("risk_segment") == risk)
        segment = F.when(here, name) if segment is None else segment.when(here, name)
        action = F.when(here, advice) if action is None else action.when(here, advice)
    return flagged.select(
        "*", segment.alias("customer_segment"), action.alias("recommended_action")
    )


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("customer_segment").agg(F.count("*").alias("users"))


def customer_predictions(
    ltv_predictions: DataFrame, churn_predictions: DataFrame, segments: DataFrame
) -> DataFrame:
    """Activation table: both predictions per snapshot with the user's segment."""
    churn = churn_predictions.select("user_id", "snapshot_date", "churn_probability")
    return (
        ltv_predictions.select("user_id", "snapshot_date", "predicted_ltv")
        .join(churn, ["user_id", "snapshot_date"])
        .join(segments.select("user_id", "customer_segment"), "user_id")
    )
