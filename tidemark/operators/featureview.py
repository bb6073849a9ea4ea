"""Feature views: typed, time-stamped feature tables with a lifetime."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import (
    DAILY_FEATURES,
    DAILY_VIEW,
    REALTIME_VIEW,
    ROLLING_FEATURES,
    ROLLING_VIEW,
    require_columns,
)

# Field types and lifetimes of the three views.
_INT, _REAL, _TEXT = "bigint", "float", "string"
DAILY_FIELDS = {
    **{c: _REAL if c in ("daily_txn_sum", "daily_txn_avg", "daily_txn_max") else _INT for c in DAILY_FEATURES},
    "has_anomaly": _INT,
}
ROLLING_FIELDS = {c: _REAL if c.endswith("avg_amount") else _INT for c in ROLLING_FEATURES}
REALTIME_FIELDS = {
    "window_label": _TEXT,
    "txn_count": _INT,
    "txn_sum": _REAL,
    "txn_avg": _REAL,
    "txn_max": _REAL,
    "txn_min": _REAL,
    "unique_categories": _INT,
    "unique_merchants": _INT,
    "unique_devices": _INT,
    "avg_inter_txn_ms": _REAL,
    "min_inter_txn_ms": _REAL,
    "anomaly_count": _INT,
    "max_amount_ratio": _REAL,
    "high_amount_count": _INT,
}
DAILY_TTL = timedelta(days=90)
ROLLING_TTL = timedelta(days=365)
REALTIME_TTL = timedelta(hours=6)


@dataclass(frozen=True)
class FeatureView:
    name: str
    keys: tuple[str, ...]
    ts_col: str
    ttl: timedelta
    fields: dict[str, str]
    df: DataFrame = field(compare=False)

    def frame(self, columns=None) -> DataFrame:
        """Keys, event time and the chosen fields, cast to the declared types."""
        columns = list(self.fields) if columns is None else list(columns)
        require_columns(self.df.columns, [*self.keys, self.ts_col, *columns], f"source of {self.name}")
        return self.df.select(
            *self.keys,
            F.col(self.ts_col).cast("timestamp").alias("_ts"),
            *[F.col(c).cast(self.fields[c]).alias(c) for c in columns],
        )


def daily_view(daily: DataFrame) -> FeatureView:
    return FeatureView(DAILY_VIEW, ("user_id",), "event_date", DAILY_TTL, DAILY_FIELDS, daily)


def rolling_view(rolling: DataFrame) -> FeatureView:
    return FeatureView(ROLLING_VIEW, ("user_id",), "event_date", ROLLING_TTL, ROLLING_FIELDS, rolling)


def realtime_view(windows: DataFrame, name: str = REALTIME_VIEW) -> FeatureView:
    return FeatureView(name, ("user_id",), "window_end", REALTIME_TTL, REALTIME_FIELDS, windows)


def resolve_refs(refs, views) -> dict[str, list[str]]:
    """"view:feature" references to the columns asked of each view, in order."""
    known = {v.name: v for v in views}
    chosen: dict[str, list[str]] = {}
    for ref in refs:
        view, sep, feature = ref.partition(":")
        if not sep or view not in known or feature not in known[view].fields:
            raise ValueError(f"unknown feature reference: {ref}")
        wanted = chosen.setdefault(view, [])
        if feature not in wanted:
            wanted.append(feature)
    return chosen


def output_names(chosen: dict[str, list[str]], full_names: bool) -> dict[tuple[str, str], str]:
    """Column name of every chosen feature; plain names must not collide."""
    names = {(v, c): f"{v}__{c}" if full_names else c for v, cols in chosen.items() for c in cols}
    if len(set(names.values())) != len(names):
        raise ValueError("feature names collide between views; ask for full names")
    return names
