"""Time since a user's previous transaction, over a batch."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import floor_div, micros
from tidemark.operators.skew import ROWS_PER_GROUP, with_pieces


def velocity_columns(delta: Column, strict_first: bool = False) -> dict[str, Column]:
    """-1 marks a user's first record; a negative gap reads as "first" too unless ``strict_first``."""
    ms = F.coalesce(delta, F.lit(-1)).cast("bigint")
    return {"ms_since_last_txn": ms, "is_first_txn": delta.isNull() if strict_first else ms < 0}


USER = ("_user", "_no_user")


def with_user_key(rows: DataFrame) -> DataFrame:
    """Two columns that are never null and tell users apart; rows without a user are one of them."""
    user = F.col("user_id")
    return rows.withColumns({"_user": F.coalesce(user.cast("string"), F.lit("")), "_no_user": user.isNull()})


def with_previous(
    rows: DataFrame, value: str, order_by: tuple[str, ...], cut: Column, rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Add ``_prev``: ``value`` of the user's previous row in ``order_by``, ``_bucket`` and the user key.

    Rows without a user follow each other like those of one user.

    ``cut`` must grow with the first order column. It cuts a user's history into
    buckets, so the busiest user is sorted in many tasks; a bucket of more than
    ``rows_per_group`` rows is cut again at quantiles of its rows. Only the last value of each
    bucket travels on to the next bucket with rows; that side is one small row per user
    and bucket, combined before its shuffle.
    """
    rows = with_user_key(rows).withColumn("_cut", F.coalesce(cut, F.lit(-(1 << 62))))
    rows = with_pieces(rows, [*USER, "_cut"], order_by[0], rows_per_group=rows_per_group)
    rows = rows.withColumn("_bucket", F.struct("_cut", "_piece")).drop("_cut", "_piece")
    last = F.max(value) if order_by[0] == value else F.max_by(value, F.struct(*order_by))
    ends = rows.groupBy(*USER, "_bucket").agg(last.alias("_end"))
    by_user = Window.partitionBy(*USER).orderBy("_bucket")
    carried = ends.select(*USER, "_bucket", F.lag("_end").over(by_user).alias("_carried"))
    inside = Window.partitionBy(*USER, "_bucket").orderBy(*order_by)
    rows = rows.withColumn("_inside", F.lag(value).over(inside)).join(carried, [*USER, "_bucket"], "left")
    return rows.withColumn("_prev", F.coalesce("_inside", "_carried")).drop("_inside", "_carried")


def velocity(
    txns: DataFrame,
    order_by: tuple[str, ...] = ("event_ts", "transaction_id"),
    strict_first: bool = False,
    bucket: timedelta | int = timedelta(hours=1),
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """Add ``ms_since_last_txn`` and ``is_first_txn``.

    The first order column is event time (then ``bucket`` is a duration) or an
    arrival number such as an offset (then ``bucket`` is a count); the rest break ties.
    """
    rows = txns.withColumn("_ms", F.unix_millis(F.col("event_ts").cast("timestamp")))
    order = tuple("_us" if c == "event_ts" else c for c in order_by)
    rows = rows.withColumn("_us", F.unix_micros(F.col("event_ts").cast("timestamp")))
    unit = micros(bucket) if isinstance(bucket, timedelta) else bucket
    value = "_us" if order[0] == "_us" else "_ms"
    rows = with_previous(rows, value, order, floor_div(F.col(order[0]).cast("bigint"), unit), rows_per_group)
    before = floor_div(F.col("_prev"), 1000) if value == "_us" else F.col("_prev")
    return rows.withColumns(velocity_columns(F.col("_ms") - before, strict_first)).select(
        *txns.columns, "ms_since_last_txn", "is_first_txn"
    )


def nested(enriched: DataFrame, fields: list[str]) -> DataFrame:
    """The enriched record as published: the transaction as a struct beside the two scalars."""
    return enriched.select(
        F.struct(*fields).alias("transaction"), "ms_since_last_txn", "is_first_txn"
    )


def text_form(enriched: DataFrame) -> DataFrame:
    """One line of text per enriched record."""
    line = F.concat(
        F.lit("EnrichedTransaction{userId='"),
        F.col("user_id"),
        F.lit("', amount="),
        F.col("amount").cast("string"),
        F.lit(", msSinceLast="),
        F.col("ms_since_last_txn").cast("string"),
        F.lit(", first="),
        F.col("is_first_txn").cast("string"),
        F.lit("}"),
    )
    return enriched.select(line.alias("value"))
