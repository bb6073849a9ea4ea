"""Queries over staging, daily, rolling and window features."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import daily as d
from tidemark.operators import decode as dec
from tidemark.operators import staging as stage
from tidemark.operators.velocity import nested, velocity
from tidemark.operators.windows import standard_window_features, window_features
from tidemark.session import scratch_dir
from tidemark.sources import readers, sinks
from tidemark.workload import fixtures as fx

STAGING = (
    "transaction_id string, user_id string, amount double, currency string, category string, merchant_id string, "
    "event_timestamp timestamp, is_anomaly string, session_id string, device_type string, location_country string, "
    "event_date date, event_hour bigint, event_dow bigint"
)
DAILY = (
    "user_id string, event_date date, daily_txn_count bigint, daily_txn_sum double, daily_txn_avg double, "
    "daily_txn_max double, daily_unique_categories bigint, daily_unique_merchants bigint, "
    "daily_unique_devices bigint, first_txn_hour bigint, last_txn_hour bigint, has_anomaly bigint"
)
ROLLING = (
    "user_id string, event_date date, rolling_7d_txn_count bigint, rolling_7d_avg_amount double, "
    "rolling_30d_txn_count bigint, rolling_30d_avg_amount double"
)
WINDOWS = (
    "user_id string, window_start timestamp, window_end timestamp, window_label string, txn_count bigint, "
    "txn_sum double, txn_avg double, txn_max double, txn_min double, unique_categories bigint, "
    "unique_merchants bigint, unique_devices bigint, avg_inter_txn_ms double7, min_inter_txn_ms double, "
    "anomaly_count bigint, max_amount_ratio double, high_amount_count bigint"
)
VELOCITY = "transaction_id string, user_id string, event_ts timestamp, ms_since_last_txn bigint, is_first_txn string"


def staged(spark, sf_dir):
    return stage.staging(fx.transactions(spark, sf_dir))


def daily(spark, sf_dir):
    return d.daily_features(staged(spark, sf_dir))


def rolling(spark, sf_dir):
    return d.rolling_features(daily(spark, sf_dir))


def staging_dedup(spark, sf_dir):
    return fx.shape(stage.staging(fx.replayed(spark, sf_dir)), STAGING)


def user_daily_features(spark, sf_dir):
    return fx.shape(daily(spark, sf_dir), DAILY)


def user_rolling_features(spark, sf_dir):
    return fx.shape(rolling(spark, sf_dir), ROLLING)


def user_rolling_calendar(spark, sf_dir):
    return fx.shape(d.rolling_features(daily(spark, sf_dir), frame="calendar"), ROLLING)


def _windows(label):
    return lambda spark, sf_dir: fx.shape(standard_window_features(fx.dense(spark, sf_dir), label), WINDOWS)


def window_features_tumbling(spark, sf_dir):
    return fx.shape(window_features(fx.dense(spark, sf_dir), timedelta(minutes=10)), WINDOWS)


def window_features_1h_by_1m(spark, sf_dir):
    """Sixty panes a window."""
    return fx.shape(window_features(fx.dense(spark, sf_dir), timedelta(hours=1), timedelta(minutes=1)), WINDOWS)


def velocity_batch(spark, sf_dir):
    return fx.shape(velocity(fx.transactions(spark, sf_dir)), VELOCITY)


def velocity_unnamed(spark, sf_dir):
    """Rows without a user follow each other like those of one user."""
    return fx.shape(velocity(fx.unnamed(fx.transactions(spark, sf_dir))), VELOCITY)


def staging_bad_times(spark, sf_dir):
    """A time that cannot be read becomes null and fails nothing."""
    txns = fx.transactions(spark, sf_dir)
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    odd = F.when(eid % 11 == 0, "yesterday").otherwise(F.col("timestamp"))
    return fx.shape(stage.staging(txns.withColumn("timestamp", odd)), STAGING)


DECODED = "offset bigint, transaction_id string, reason string"


def decode_bytes(spark, sf_dir):
    """Messages as bytes; some are no UTF-8, some are missing."""
    raw = fx.transactions(spark, sf_dir).drop("event_ts")
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    whole = F.to_json(F.struct(*raw.columns)).cast("binary")
    broken = F.concat(whole, F.unhex(F.lit("C328")))
    value = F.when(eid % 20 == 3, broken).when(eid % 20 == 4, F.lit(None)).otherwise(whole)
    good, bad = dec.decode(raw.select(value.alias("value"), eid.alias("offset")), keep=("offset",))
    good = good.select("offset", "transaction_id", F.lit(None).cast("string").alias("reason"))
    return fx.shape(good.unionByName(bad.select("offset", F.lit(None).cast("string").alias("transaction_id"), "reason")), DECODED)


EXPORTED = DAILY.replace("event_date date", "event_date timestamp")


def export_daily(spark, sf_dir):
    """Daily features exported to two targets; the second is read back."""
    first, second = scratch_dir(spark, "export"), scratch_dir(spark, "export-copy")
    sinks.export_features(daily(spark, sf_dir), first, second)
    return fx.shape(spark.read.parquet(second), EXPORTED)


def export_windows(spark, sf_dir):
    path = scratch_dir(spark, "export-windows")
    sinks.export_windows(standard_window_features(fx.dense(spark, sf_dir), "15m"), path)
    return fx.shape(readers.window_table(spark, path), WINDOWS)


def velocity_arrival(spark, sf_dir):
    """Arrival order differs from event order here, which makes negative gaps."""
    txns = fx.transactions(spark, sf_dir)
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    arrival = F.when(eid % 7 == 0, eid + 400).otherwise(eid)
    txns = txns.withColumn("arrival", arrival)
    return fx.shape(velocity(txns, order_by=("arrival", "transaction_id"), bucket=1000), VELOCITY)


_RAW = (
    "transaction_id string, user_id string, amount double, currency string, category string, merchant_id string, "
    "is_anomaly string, session_id string, device_type string, location_country string"
)


def _messages(spark, sf_dir):
    """Events as JSON text; some carry unknown keys, text numbers or missing fields, some are broken."""
    txns = fx.transactions(spark, sf_dir)
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    raw = txns.drop("event_ts")
    whole = F.to_json(F.struct(*raw.columns))
    odd = F.to_json(F.struct(*[c for c in raw.columns if c != "amount"], F.col("amount").cast("string").alias("amount"),
                             F.lit("x").alias("unknown_key")))
    bare = F.to_json(F.struct("transaction_id", "user_id", "timestamp"))
    value = (
        F.when(eid % 50 == 0, F.concat(F.lit("not json "), F.col("transaction_id")))
        .when(eid % 50 == 1, F.regexp_replace(whole, '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
        .when(eid % 50 == 2, F.regexp_replace(whole, '"amount":[-0-9.E]+', '"amount":"lots"'))
        .when(eid % 50 == 3, F.to_json(F.struct(*[c for c in raw.columns if c != "user_id"])))
        .when(eid % 10 == 4, odd)
        .when(eid % 10 == 5, bare)
        .otherwise(whole)
    )
    return raw.select(value.alias("value"), eid.alias("offset"))


def json_decode(spark, sf_dir):
    good, _ = dec.decode(_messages(spark, sf_dir), keep=("offset",))
    return fx.shape(good, "offset bigint, event_ts timestamp, event_ms bigint, " + _RAW)


def json_quarantine(spark, sf_dir):
    _, bad = dec.decode(_messages(spark, sf_dir), keep=("offset",))
    return fx.shape(bad, "offset bigint, reason string")


def to_json_features(spark, sf_dir):
    """Window features encoded for the wire and read back."""
    feats = standard_window_features(fx.dense(spark, sf_dir), "1h").drop("computed_at")
    wire = dec.encode(dec.to_wire(feats))
    from tidemark.schemas import WINDOW_FEATURES_WIRE

    back = wire.select(F.from_json("value", WINDOW_FEATURES_WIRE).alias("v")).select("v.*").drop("computed_at")
    return fx.shape(dec.from_wire(back), WINDOWS)


def to_json_enriched(spark, sf_dir):
    """Enriched records encoded as nested JSON and read back."""
    enriched = velocity(fx.transactions(spark, sf_dir))
    fields = [c for c in enriched.columns if c not in ("event_ts", "ms_since_last_txn", "is_first_txn")]
    wire = dec.encode(nested(enriched, fields))
    v = F.col("value")
    out = wire.select(
        F.get_json_object(v, "$.transaction.transaction_id").alias("transaction_id"),
        F.get_json_object(v, "$.transaction.user_id").alias("user_id"),
        F.get_json_object(v, "$.transaction.amount").cast("double").alias("amount"),
        F.get_json_object(v, "$.ms_since_last_txn").cast("bigint").alias("ms_since_last_txn"),
        F.get_json_object(v, "$.is_first_txn").alias("is_first_txn"),
    )
    return fx.shape(out, "transaction_id string, user_id string, amount double, ms_since_last_txn bigint, "
                         "is_first_txn string")


QUERIES = {
    "user_daily_features": user_daily_features,
    "staging_dedup": staging_dedup,
    "user_rolling_features": user_rolling_features,
    "user_rolling_calendar": user_rolling_calendar,
    "window_features_5m": _windows("5m"),
    "window_features_15m": _windows("15m"),
    "window_features_1h": _windows("1h"),
    "window_features_tumbling": window_features_tumbling,
    "window_features_1h_by_1m": window_features_1h_by_1m,
    "velocity_batch": velocity_batch,
    "velocity_arrival": velocity_arrival,
    "velocity_unnamed": velocity_unnamed,
    "staging_bad_times": staging_bad_times,
    "decode_bytes": decode_bytes,
    "export_daily": export_daily,
    "export_windows": export_windows,
    "json_decode": json_decode,
    "json_quarantine": json_quarantine,
    "to_json_features": to_json_features,
    "to_json_enriched": to_json_enriched,
}

_CALENDAR = """rolling as (
    select user_id, event_date,
           sum(daily_txn_count) over w7 as rolling_7d_txn_count,
           avg(daily_txn_avg) over w7 as rolling_7d_avg_amount,
           sum(daily_txn_count) over w30 as rolling_30d_txn_count,
           avg(daily_txn_avg) over w30 as rolling_30d_avg_amount
    from daily
    window w7 as (partition by user_id order by event_date
                  range between interval 6 days preceding and current row),
           w30 as (partition by user_id order by event_date
                   range between interval 29 days preceding and current row))"""


def _window_sql(size, slide, label):
    return fx.shape_sql(f"{fx.DENSE_SQL}, {fx.windows_sql(size, slide, label)}", "feats", WINDOWS)


LAG = """vel as (
    select *, coalesce(d, -1) as ms_since_last_txn, coalesce(d, -1) < 0 as is_first_txn
    from (select *, epoch_us(event_ts) // 1000
                 - lag(epoch_us(event_ts) // 1000) over (partition by user_id order by {order}) as d from txn))"""
_EID = "cast(substring(transaction_id, 5) as bigint)"
_ARRIVAL = f"case when {_EID} % 7 = 0 then {_EID} + 400 else {_EID} end, transaction_id"
_MESSAGES = f"msg as (select *, {_EID} as o from txn)"
_FULL = "o % 10 <> 5"

ORACLE = {
    "user_daily_features": fx.shape_sql(fx.MODEL_SQL, "daily", DAILY),
    "staging_dedup": fx.shape_sql(f"{fx.REPLAYED_SQL}, {fx.STAGING_SQL}", "stg", STAGING),
    "user_rolling_features": fx.shape_sql(fx.MODEL_SQL, "rolling", ROLLING),
    "user_rolling_calendar": fx.shape_sql(
        ", ".join((fx.TXN_SQL, fx.STAGING_SQL, fx.DAILY_SQL, _CALENDAR)), "rolling", ROLLING
    ),
    "window_features_5m": _window_sql(5, 1, "5m"),
    "window_features_15m": _window_sql(15, 5, "15m"),
    "window_features_1h": _window_sql(60, 15, "1h"),
    "window_features_tumbling": _window_sql(10, 10, "10m"),
    "window_features_1h_by_1m": _window_sql(60, 1, "60m"),
    "velocity_batch": fx.shape_sql(f"{fx.TXN_SQL}, {LAG.format(order='event_ts, transaction_id')}", "vel", VELOCITY),
    "velocity_arrival": fx.shape_sql(f"{fx.TXN_SQL}, {LAG.format(order=_ARRIVAL)}", "vel", VELOCITY),
    "velocity_unnamed": fx.shape_sql(
        f"{fx.UNNAMED_SQL}, {LAG.format(order='event_ts, transaction_id')}", "vel", VELOCITY
    ),
    "staging_bad_times": fx.shape_sql(
        f"""{fx.TXN_SQL.replace("txn as", "timely as")}, txn as (
            select * replace (case when {_EID} % 11 <> 0 then event_ts end as event_ts) from timely), {fx.STAGING_SQL}""",
        "stg",
        STAGING,
    ),
    "decode_bytes": fx.shape_sql(
        f"""{fx.TXN_SQL}, {_MESSAGES}, seen as (
            select o as "offset", case when o % 20 not in (3, 4) then transaction_id end as transaction_id,
                   case o % 20 when 3 then 'bad encoding' when 4 then 'empty' end as reason from msg)""",
        "seen",
        DECODED,
    ),
    "export_daily": fx.shape_sql(", ".join((fx.TXN_SQL, fx.STAGING_SQL, fx.DAILY_SQL)), "daily", EXPORTED),
    "export_windows": _window_sql(15, 5, "15m"),
    "json_decode": fx.shape_sql(
        f"""{fx.TXN_SQL}, {_MESSAGES}, ok as (
            select o as "offset", transaction_id, user_id, event_ts, epoch_us(event_ts) // 1000 as event_ms,
                   case when {_FULL} then amount else 0 end as amount,
                   case when {_FULL} then currency end as currency,
                   case when {_FULL} then category end as category,
                   case when {_FULL} then merchant_id end as merchant_id,
                   case when {_FULL} then is_anomaly else false end as is_anomaly,
                   case when {_FULL} then session_id end as session_id,
                   case when {_FULL} then device_type end as device_type,
                   case when {_FULL} then location_country end as location_country
            from msg where o % 50 > 3)""",
        "ok",
        "offset bigint, event_ts timestamp, event_ms bigint, " + _RAW,
    ),
    "json_quarantine": fx.shape_sql(
        f"""{fx.TXN_SQL}, {_MESSAGES}, bad as (
            select o as "offset", case o % 50 when 0 then 'bad json' when 1 then 'bad timestamp'
                                  when 2 then 'bad value' else 'no key' end as reason
            from msg where o % 50 <= 3)""",
        "bad",
        "offset bigint, reason string",
    ),
    "to_json_features": _window_sql(60, 15, "1h"),
    "to_json_enriched": fx.shape_sql(
        f"{fx.TXN_SQL}, {LAG.format(order='event_ts, transaction_id')}",
        "vel",
        "transaction_id string, user_id string, amount double, ms_since_last_txn bigint, is_first_txn string",
    ),
}
