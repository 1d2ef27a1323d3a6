"""Fixed schemas of the logical tables; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Table layouts, domains and write order of the data model.
USERS = (
    "user_id BIGINT, signup_date DATE, channel STRING, region STRING, device STRING, "
    "age_group STRING, acquisition_cost DECIMAL(10,2)"
)
EVENTS = (
    "event_id BIGINT, user_id BIGINT, event_time TIMESTAMP_NTZ, event_type STRING, "
    "session_duration DECIMAL(10,2)"
)
TRANSACTIONS = (
    "order_id BIGINT, user_id BIGINT, order_time TIMESTAMP_NTZ, amount DECIMAL(12,2), "
    "refund_amount DECIMAL(12,2), product_category STRING"
)
USER_SNAPSHOTS = (
    "user_id BIGINT, snapshot_date DATE, tenure_days INT, active_days_7d INT, "
    "active_days_30d INT, active_days_90d INT, login_count_30d INT, browse_count_30d INT, "
    "search_count_30d INT, cart_count_30d INT, purchase_count_30d INT, purchase_count_90d INT, "
    "revenue_30d DECIMAL(12,2), revenue_90d DECIMAL(12,2), days_since_last_active INT, "
    "days_since_last_purchase INT, avg_session_duration DECIMAL(12,2), "
    "avg_order_value DECIMAL(12,2), purchase_frequency DECIMAL(12,4), "
    "historical_ltv DECIMAL(14,2), churn_30d TINYINT, future_90d_revenue DECIMAL(14,2), "
    "ltv_label_mature_date DATE, churn_label_mature_date DATE, ltv_split STRING, "
    "churn_split STRING, split STRING"
)
CUSTOMER_PREDICTIONS = (
    "user_id BIGINT, snapshot_date DATE, predicted_ltv DECIMAL(14,2), "
    "churn_probability DECIMAL(8,6), customer_segment STRING"
)
TABLES = {
    "users": USERS,
    "events": EVENTS,
    "transactions": TRANSACTIONS,
    "user_snapshots": USER_SNAPSHOTS,
    "customer_predictions": CUSTOMER_PREDICTIONS,
}
PRIMARY_KEYS = {
    "users": ["user_id"],
    "events": ["event_id"],
    "transactions": ["order_id"],
    "user_snapshots": ["user_id", "snapshot_date"],
    "customer_predictions": ["user_id", "snapshot_date"],
}
NOT_NULL = {
    "users": ["signup_date", "channel"],
    "events": ["user_id", "event_time", "event_type", "session_duration"],
    "transactions": ["user_id", "order_time", "amount", "refund_amount"],
    "user_snapshots": [],
    "customer_predictions": [],
}
FOREIGN_KEYS = {
    "events": ("user_id", "users"),
    "transactions": ("user_id", "users"),
    "user_snapshots": ("user_id", "users"),
    "customer_predictions": ("user_id", "users"),
}
EVENT_TYPES = ["login", "browse", "search", "favorite", "add_to_cart", "purchase"]


def struct(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """Typed relation with no rows, e.g. for a period without orders."""
    return spark.createDataFrame([], struct(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Known columns of ``table`` in declared order, cast to declared types.

    Extra columns (such as generator-only attributes) are dropped; optional
    columns the input lacks stay absent.
    """
    fields = [f for f in struct(table).fields if f.name in df.columns]
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields])
