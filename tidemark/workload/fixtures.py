"""The transactions view over the ``events`` table, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# 2024-01-01 in microseconds, the origin of the compressed variant.
DENSE_ORIGIN_US = 1704067200000000
DENSE_FACTOR = 60

# categories and range of the test events
EVENT_TYPES = ("view", "signup", "click", "error")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_transactions(events: DataFrame) -> DataFrame:
    """Raw transaction fields plus ``event_ts``."""
    eid, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    device = F.when(eid % 3 == 0, "mobile").when(eid % 3 == 1, "desktop").otherwise("tablet")
    country = F.when(eid % 5 == 0, "US").when(eid % 5 == 1, "CA").when(eid % 5 == 2, "GB").when(eid % 5 == 3, "DE")
    return events.select(
        F.concat(F.lit("txn_"), eid.cast("string")).alias("transaction_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("merchant_"), F.get_json_object("props", "$.k")).alias("merchant_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        (F.col("value") >= 150.0).alias("is_anomaly"),
        F.concat(
            F.lit("sess_"), F.col("user_id").cast("string"), F.lit("_"), F.to_date(ts).cast("string")
        ).alias("session_id"),
        device.alias("device_type"),
        country.otherwise("FR").alias("location_country"),
        ts.alias("event_ts"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(read(spark, sf_dir, "events"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time compressed sixty-fold, so that short windows hold several rows."""
    events = read(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    shrunk = F.expr(f"{DENSE_ORIGIN_US} + ((_us - {DENSE_ORIGIN_US}) div {DENSE_FACTOR})")
    return as_transactions(events.withColumn("_us", us).withColumn("ts", F.timestamp_micros(shrunk)))


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth transaction arrives once more, one second later."""
    events = read(spark, sf_dir, "events")
    again = events.filter("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("interval 1 second"))
    return as_transactions(events.unionByName(again))


def unnamed(txns: DataFrame) -> DataFrame:
    """Every ninth transaction has no user."""
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    return txns.withColumn("user_id", F.when(eid % 9 != 0, F.col("user_id")))


_TXN_COLUMNS = """
    concat('txn_', cast(event_id as varchar)) as transaction_id,
    concat('user_', cast(user_id as varchar)) as user_id,
    value as amount,
    'USD' as currency,
    event_type as category,
    concat('merchant_', json_extract_string(props, '$.k')) as merchant_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as timestamp,
    value >= 150.0 as is_anomaly,
    concat('sess_', cast(user_id as varchar), '_', cast(cast(ts as date) as varchar)) as session_id,
    case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end as device_type,
    case event_id % 5 when 0 then 'US' when 1 then 'CA' when 2 then 'GB' when 3 then 'DE' else 'FR' end
        as location_country,
    ts as event_ts"""

TXN_SQL = f"txn as (select {_TXN_COLUMNS} from events)"
DENSE_SQL = f"""txn as (select {_TXN_COLUMNS} from (
    select event_id, user_id, event_type, value, props,
           make_timestamp({DENSE_ORIGIN_US} + ((epoch_us(ts) - {DENSE_ORIGIN_US}) // {DENSE_FACTOR})) as ts
    from events))"""
_DROP_NAME = "case when cast(substring(transaction_id, 5) as bigint) % 9 <> 0 then user_id end as user_id"
UNNAMED_SQL = f"txn as (select * replace ({_DROP_NAME}) from (select {_TXN_COLUMNS} from events))"
UNNAMED_DENSE_SQL = DENSE_SQL.replace("txn as", "named as") + f", txn as (select * replace ({_DROP_NAME}) from named)"
REPLAYED_SQL = f"""txn as (select {_TXN_COLUMNS} from (
    select * from events
    union all
    select * replace (ts + interval 1 second as ts) from events where event_id % 10 = 0))"""
STAGING_SQL = """stg as (
    select transaction_id, user_id, cast(amount as decimal(10, 2)) as amount, currency, category, merchant_id,
           event_ts as event_timestamp, is_anomaly, session_id, device_type, location_country,
           cast(event_ts as date) as event_date,
           extract(hour from event_ts) as event_hour,
           extract(dow from event_ts) as event_dow
    from (select *, row_number() over (partition by transaction_id order by timestamp, user_id, amount, currency,
                 category, merchant_id, is_anomaly, session_id, device_type, location_country) as rn from txn)
    where rn = 1)"""
DAILY_SQL = """daily as (
    select user_id, event_date,
           count(*) as daily_txn_count,
           sum(amount) as daily_txn_sum,
           cast(sum(amount) as double) / count(amount) as daily_txn_avg,
           max(amount) as daily_txn_max,
           count(distinct category) as daily_unique_categories,
           count(distinct merchant_id) as daily_unique_merchants,
           count(distinct device_type) as daily_unique_devices,
           min(event_hour) as first_txn_hour,
           max(event_hour) as last_txn_hour,
           max(case when is_anomaly then 1 else 0 end) as has_anomaly
    from stg group by user_id, event_date)"""
ROLLING_SQL = """rolling as (
    select user_id, event_date,
           sum(daily_txn_count) over w7 as rolling_7d_txn_count,
           avg(daily_txn_avg) over w7 as rolling_7d_avg_amount,
           sum(daily_txn_count) over w30 as rolling_30d_txn_count,
           avg(daily_txn_avg) over w30 as rolling_30d_avg_amount
    from daily
    window w7 as (partition by user_id order by event_date rows between 6 preceding and current row),
           w30 as (partition by user_id order by event_date rows between 29 preceding and current row))"""
MODEL_SQL = ", ".join((TXN_SQL, STAGING_SQL, DAILY_SQL, ROLLING_SQL))


def windows_sql(size_min: int, slide_min: int, label: str) -> str:
    """Window features from ``txn`` as the relation ``feats``."""
    size, slide = size_min * 60000, slide_min * 60000
    return f"""spread as (
        select t.*, epoch_us(event_ts) // 1000 as ms, ws
        from txn t, unnest(generate_series(
            ((epoch_us(event_ts) // 1000) // {slide}) * {slide} - {size - slide},
            ((epoch_us(event_ts) // 1000) // {slide}) * {slide}, {slide})) as g(ws)),
    gaps as (select *, ms - lag(ms) over (partition by user_id, ws order by ms) as gap from spread),
    feats as (
        select user_id, make_timestamp(ws * 1000) as window_start, make_timestamp((ws + {size}) * 1000) as window_end,
               '{label}' as window_label,
               count(*) as txn_count, sum(amount) as txn_sum, sum(amount) / count(*) as txn_avg,
               max(amount) as txn_max, min(amount) as txn_min,
               count(distinct category) as unique_categories,
               count(distinct merchant_id) as unique_merchants,
               count(distinct device_type) as unique_devices,
               case when count(*) > 1 then (max(ms) - min(ms)) / (count(*) - 1.0) else 0 end as avg_inter_txn_ms,
               coalesce(min(gap), 0) as min_inter_txn_ms,
               count(*) filter (is_anomaly) as anomaly_count,
               case when sum(amount) = 0 then 0 else max(amount) / (sum(amount) / count(*)) end as max_amount_ratio,
               count(*) filter (amount > 300) as high_amount_count
        from gaps group by user_id, ws)"""


# -- output types: both engines cast every column, doubles are rounded once at the end.
# "double" keeps nine places, "double7" seven (milliseconds, where nine exceed the
# precision of a double), "double6" six.

_PLACES = {"double": 9, "double7": 7, "double6": 6}
_DUCK = {"bigint": "bigint", "string": "varchar", "date": "date", "timestamp": "timestamp"}


def shape(df: DataFrame, layout: str) -> DataFrame:
    """Select and cast ``name type`` pairs; timestamps leave as zone-less values."""
    out = []
    for item in layout.split(","):
        name, kind = item.split()
        c = F.col(f"`{name}`")
        if kind in _PLACES:
            c = F.round(c.cast("double"), _PLACES[kind])
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        else:
            c = c.cast(kind)
        out.append(c.alias(name))
    return df.select(*out)


def shape_sql(ctes: str, source: str, layout: str, tail: str = "") -> str:
    out = []
    for item in layout.split(","):
        name, kind = item.split()
        if kind in _PLACES:
            out.append(f'round(cast("{name}" as double), {_PLACES[kind]}) as "{name}"')
        else:
            out.append(f'cast("{name}" as {_DUCK[kind]}) as "{name}"')
    head = f"with {ctes} " if ctes else ""
    return f"{head}select {', '.join(out)} from {source} {tail}".strip()
