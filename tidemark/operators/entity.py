"""Entity rows and dataset summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import end_of_day
from tidemark.schemas import LABEL


def entity_rows(daily: DataFrame, ordered: bool = True, lag_days: int = 0) -> DataFrame:
    """``(user_id, event_timestamp, has_anomaly)`` at the end of each active day (UTC).

    With ``lag_days`` the label is moved that many days after the features it is
    joined to, so that a day's own activity stays out of its features.
    """
    midnight = F.col("event_date").cast("timestamp")
    rows = daily.select(
        "user_id",
        (end_of_day(midnight) - F.make_dt_interval(F.lit(lag_days))).alias("event_timestamp"),
        F.col(LABEL).cast("int").alias(LABEL),
    )
    return rows.orderBy("event_timestamp", "user_id") if ordered else rows


def dataset_summary(rows: DataFrame) -> DataFrame:
    """Row, user, date and label counts with the label share in percent (0 when empty)."""
    n, positives = F.count("*"), F.coalesce(F.sum(LABEL), F.lit(0))
    return rows.agg(
        n.alias("total"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.to_date("event_timestamp")).alias("dates"),
        positives.cast("bigint").alias("anomalies"),
        F.when(n > 0, 100.0 * positives / n).otherwise(F.lit(0.0)).alias("anomaly_pct"),
    )


def class_balance(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Positives, negatives and the weight of a positive (1 when there is none)."""
    pos = F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0))
    neg = F.count(label) - pos
    weight = F.when(pos > 0, neg / pos).otherwise(F.lit(1.0))
    return rows.agg(pos.alias("positives"), neg.alias("negatives"), weight.alias("pos_weight"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, n)`` per table; each count is answered from file footers where it can be."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
