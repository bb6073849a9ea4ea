"""Per-user daily aggregates and their rolling roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_features(stg: DataFrame) -> DataFrame:
    """One row per user and day.

    Every aggregate combines on the map side. The three exact distinct counts are
    declared as such: Spark deduplicates (user, day, value) across the cluster before
    counting, so no task ever holds the set of one busy user.
    """
    total = F.sum("amount")
    return stg.groupBy("user_id", "event_date").agg(
        F.count("*").alias("daily_txn_count"),
        total.alias("daily_txn_sum"),
        (total.cast("double") / F.count("amount")).alias("daily_txn_avg"),
        F.max("amount").alias("daily_txn_max"),
        F.count_distinct("category").alias("daily_unique_categories"),
        F.count_distinct("merchant_id").alias("daily_unique_merchants"),
        F.count_distinct("device_type").alias("daily_unique_devices"),
        F.min("event_hour").alias("first_txn_hour"),
        F.max("event_hour").alias("last_txn_hour"),
        F.max(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("has_anomaly"),
    )


def rolling_features(daily: DataFrame, days: tuple[int, ...] = (7, 30), frame: str = "rows") -> DataFrame:
    """Trailing counts and mean daily averages per user.

    ``frame="rows"`` spans the last n active days, ``"calendar"`` the last n dates.
    All frames share one exchange and one sort. A user contributes at most one row
    per date, which bounds each window partition by the calendar, not by the traffic.
    """
    if frame not in ("rows", "calendar"):
        raise ValueError(f"unknown frame: {frame}")
    out = ["user_id", "event_date"]
    by_user = Window.partitionBy("user_id")
    for n in days:
        if frame == "rows":
            w = by_user.orderBy("event_date").rowsBetween(1 - n, 0)
        else:
            w = by_user.orderBy(F.unix_date("event_date")).rangeBetween(1 - n, 0)
        out.append(F.sum("daily_txn_count").over(w).alias(f"rolling_{n}d_txn_count"))
        out.append(F.avg("daily_txn_avg").over(w).alias(f"rolling_{n}d_avg_amount"))
    return daily.select(*out)
