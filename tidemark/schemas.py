"""Declared record layouts and fixed feature lists. Nothing here is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _record(layout: str) -> T.StructType:
    pairs = [item.split() for item in layout.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The raw transaction record.
RAW_TRANSACTION = _record(
    "transaction_id string, user_id string, amount double, currency string, category string, merchant_id string, "
    "timestamp string, is_anomaly boolean, session_id string, device_type string, location_country string"
)

# The windowed feature record as a table ...
WINDOW_FEATURES = _record(
    "user_id string, window_start timestamp, window_end timestamp, window_label string, "
    "txn_count bigint, txn_sum double, txn_avg double, txn_max double, txn_min double, "
    "unique_categories bigint, unique_merchants bigint, unique_devices bigint, "
    "avg_inter_txn_ms double, min_inter_txn_ms double, anomaly_count bigint, "
    "max_amount_ratio double, high_amount_count bigint, computed_at timestamp"
)
# ... and on the wire, where the three times are epoch milliseconds.
WINDOW_TIME_FIELDS = ("window_start", "window_end", "computed_at")
WINDOW_FEATURES_WIRE = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name in WINDOW_TIME_FIELDS else f.dataType)
        for f in WINDOW_FEATURES.fields
    ]
)

# Windows of the stream job as (label, size, slide) in minutes.
WINDOW_SIZES = (("5m", 5, 1), ("15m", 15, 5), ("1h", 60, 15))
HIGH_AMOUNT = 300.0

# The model inputs in their order.
DAILY_FEATURES = (
    "daily_txn_count",
    "daily_txn_sum",
    "daily_txn_avg",
    "daily_txn_max",
    "daily_unique_categories",
    "daily_unique_merchants",
    "daily_unique_devices",
    "first_txn_hour",
    "last_txn_hour",
)
ROLLING_FEATURES = (
    "rolling_7d_txn_count",
    "rolling_7d_avg_amount",
    "rolling_30d_txn_count",
    "rolling_30d_avg_amount",
)
MODEL_FEATURES = DAILY_FEATURES + ROLLING_FEATURES
LABEL = "has_anomaly"

DAILY_VIEW = "user_daily_features"
ROLLING_VIEW = "user_rolling_features"
REALTIME_VIEW = "user_realtime_5m_features"
RISK_VIEW = "user_transaction_risk_context"
MODEL_REFS = tuple(f"{DAILY_VIEW}:{c}" for c in DAILY_FEATURES) + tuple(
    f"{ROLLING_VIEW}:{c}" for c in ROLLING_FEATURES
)
RISK_FEATURES = ("amount_over_daily_avg", "amount_over_30d_avg", "after_hours_txn", "rapid_repeat_txn")
# everything a scoring request looks up; the last six are served but not fed to the model
ONLINE_REFS = (
    MODEL_REFS
    + (f"{REALTIME_VIEW}:txn_count", f"{REALTIME_VIEW}:max_amount_ratio")
    + tuple(f"{RISK_VIEW}:{c}" for c in RISK_FEATURES)
)

# A scoring request and a scored answer.
REQUEST = _record(
    "user_id string, transaction_id string, amount double, category string, merchant_id string, "
    "device_type string, event_timestamp timestamp, ms_since_last_txn bigint"
)
PREDICTION_COLUMNS = ("transaction_id", "anomaly_score", "is_anomaly", "model_version")

# Accepted categories of the raw table.
CATEGORIES = (
    "electronics",
    "clothing",
    "groceries",
    "home_garden",
    "sports",
    "books",
    "beauty",
    "automotive",
    "jewelry",
    "gift_cards",
)


def require_columns(columns, required, what: str) -> None:
    """Fail before a plan is built when a frame lacks columns."""
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")
