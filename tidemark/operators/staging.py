"""Typed, deduplicated transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import day_of_week
from tidemark.schemas import RAW_TRANSACTION, require_columns


def first_per_transaction(raw: DataFrame) -> DataFrame:
    """First row per transaction id in the order of the timestamp text.

    Remaining columns break ties, so the choice does not depend on the layout of the
    data. Spark keeps one row per id and input partition before the shuffle (window
    group limit), hence an id that was replayed a billion times stays cheap.
    """
    ties = [c for c in raw.columns if c not in ("transaction_id", "timestamp")]
    order = Window.partitionBy("transaction_id").orderBy("timestamp", *ties)
    return raw.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def staging(raw: DataFrame, dedup: bool = True) -> DataFrame:
    names = [f.name for f in RAW_TRANSACTION.fields]
    require_columns(raw.columns, names, "raw transactions")
    rows = raw.select(*names)
    if dedup:
        rows = first_per_transaction(rows)
    ts = F.try_to_timestamp("timestamp")
    typed = rows.withColumn("amount", F.col("amount").cast("decimal(10,2)")).withColumn("timestamp", ts)
    typed = typed.withColumnRenamed("timestamp", "event_timestamp")
    return typed.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
            "event_dow": day_of_week(F.col("event_timestamp")),
        }
    )
