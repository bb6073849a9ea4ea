"""Streaming queries, drained over the whole tables and read back from their sinks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import micros, parse_iso
from tidemark.operators import decode as dec
from tidemark.operators.featureview import realtime_view
from tidemark.operators.velocity import nested, velocity
from tidemark.operators.windows import session_features as session_features_of
from tidemark.operators.windows import standard_window_features
from tidemark.plans import streaming_features as stream_plan
from tidemark.schemas import RAW_TRANSACTION, WINDOW_FEATURES
from tidemark.session import materialise, rocksdb_state, scratch_dir
from tidemark.sources import readers, sinks
from tidemark.streaming import features as sf
from tidemark.streaming import ingest as ing
from tidemark.streaming.sessions import stream_session_features as stream_sessions_of
from tidemark.workload import features as feat
from tidemark.workload import fixtures as fx

_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
SESSIONS = feat.WINDOWS
_GAP = (T.StructField("ms_since_last_txn", T.LongType()), T.StructField("is_first_txn", T.BooleanType()))


def _message_stream(spark, sf_dir):
    """The events table as a stream of JSON messages."""
    events = spark.readStream.schema(_EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return dec.encode(fx.as_transactions(events).drop("event_ts"))


def _run(df, name, start=sinks.stream_table):
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    sinks.drain(start(df, path, scratch_dir(spark, f"{name}-checkpoint"), every=None))
    return path


def _stream_windows(label):
    def query(spark, sf_dir):
        good, _ = dec.decode(_message_stream(spark, sf_dir))
        with rocksdb_state(spark):
            path = _run(sf.stream_window_features(good, label), f"windows-{label}")
        return fx.shape(readers.window_table(spark, path), feat.WINDOWS)

    return query


# Records arrive in slices of their arrival time; every thirteenth arrives forty minutes after its time.
SLICES = 4
_DELAY = timedelta(minutes=40)


def _run_slices(spark, sf_dir, name, build, start=sinks.stream_table, late=True):
    """Runs a stream once per slice of the events, each time from its checkpoint, and gives the folder it writes to."""
    txns = fx.transactions(spark, sf_dir)
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    us = F.unix_micros("event_ts") + F.when((eid % 13 == 0) & F.lit(late), micros(_DELAY)).otherwise(0)
    txns = txns.withColumn("us", us)
    lo, hi = txns.agg(F.min("us"), F.max("us")).first()
    number = F.lit(0) if lo is None else F.expr(f"least(({SLICES} * (us - {lo})) div {hi - lo + 1}, {SLICES - 1})")
    cut = txns.select(F.to_json(F.struct(*[c for c in txns.columns if c not in ("event_ts", "us")])).alias("value"),
                      number.alias("slice"))
    sliced = materialise(cut, f"{name}-slices", partition_by=("slice",))
    incoming, path, checkpoint = (scratch_dir(spark, f"{name}-{part}") for part in ("incoming", "table", "checkpoint"))
    for i in range(SLICES):
        sinks.publish_batch(sliced.filter(F.col("slice") == i), path=incoming)
        sinks.drain(start(build(readers.file_messages(spark, incoming)), path, checkpoint, every=None))
    return path


def _good(messages):
    return dec.decode(messages)[0]


def stream_windows_late(spark, sf_dir):
    """Hourly windows over several triggers; late records count in the windows that are still open."""
    with rocksdb_state(spark):
        path = _run_slices(spark, sf_dir, "windows-late", lambda m: sf.stream_window_features(_good(m), "1h"))
    return fx.shape(readers.window_table(spark, path), feat.WINDOWS)


def _velocity_table(spark, path, columns):
    rows = spark.read.schema(T.StructType([*columns, *_GAP])).option("recursiveFileLookup", True).parquet(path)
    return fx.shape(rows, feat.VELOCITY)


def stream_velocity_late(spark, sf_dir):
    """Several triggers, each in event order: a late record has a negative gap to the last one of an earlier trigger."""
    seen = []

    def build(messages):
        good = _good(messages)
        seen[:] = good.schema.fields
        return good

    def start(df, path, checkpoint, every):
        return sf.ordered_velocity_table(df, path, checkpoint, every=every)

    path = _run_slices(spark, sf_dir, "velocity-late", build, start)
    return _velocity_table(spark, path, seen)


def _velocity(good, **options):
    def start(df, path, checkpoint, every):
        return sf.ordered_velocity_table(df, path, checkpoint, every=every, **options)

    path = _run(good, "velocity", start)
    return _velocity_table(good.sparkSession, path, good.schema.fields)


def stream_velocity(spark, sf_dir):
    """Event order."""
    good, _ = dec.decode(_message_stream(spark, sf_dir))
    return _velocity(good)


def stream_velocity_arrival(spark, sf_dir):
    """Offset order, which differs from event order as in ``velocity_arrival``."""
    good, _ = dec.decode(_message_stream(spark, sf_dir))
    eid = F.expr("cast(substring(transaction_id, 5) as bigint)")
    good = good.withColumn("offset", F.when(eid % 7 == 0, eid + 400).otherwise(eid))
    return _velocity(good, order=("offset", "transaction_id"), bucket=1000)


LANDED = (
    "transaction_id string, user_id string, amount double, currency string, category string, merchant_id string, "
    "timestamp string, is_anomaly string, session_id string, device_type string, location_country string"
)


def stream_landing(spark, sf_dir):
    path = _run(dec.land_fields(_message_stream(spark, sf_dir)), "lake", sinks.land)
    return fx.shape(readers.raw_lake(spark, path).select(*RAW_TRANSACTION.fieldNames()), LANDED)


def lake_one_day(spark, sf_dir):
    """Landed over several triggers; the sixth day of the lake is compacted and read alone."""
    lake = readers.raw_lake(spark, _run_slices(spark, sf_dir, "lake-days", dec.land_fields, sinks.land))
    day = F.date_add(F.min("event_date"), 5)
    days, target = [r[0] for r in lake.agg(day).collect() if r[0]], scratch_dir(spark, "lake-compacted")
    sinks.compact_days(lake, target, days, file_bytes=1 << 20)
    compacted = readers.raw_lake(spark, target) if sinks.exists(spark, target) else lake
    one = compacted.filter(F.col("event_date").isin(days))
    return fx.shape(one, f"{LANDED}, event_date date")


def enriched_files(spark, sf_dir):
    """Published enriched records, written as a stream to files of a bounded size and read back."""
    published, path = scratch_dir(spark, "enriched"), scratch_dir(spark, "enriched-files")
    enriched = velocity(fx.transactions(spark, sf_dir))
    sinks.publish_batch(dec.encode(nested(enriched, RAW_TRANSACTION.fieldNames())), path=published)
    checkpoint = scratch_dir(spark, "enriched-checkpoint")
    sinks.drain(stream_plan.enriched_table(readers.file_messages(spark, published), path, checkpoint, None, 1 << 20))
    rows = spark.read.parquet(path).select("transaction.*", "ms_since_last_txn", "is_first_txn")
    return fx.shape(rows.withColumn("event_ts", parse_iso(F.col("timestamp"))), feat.VELOCITY)


LATEST = "user_id string, _ts timestamp, txn_count bigint, txn_sum double, unique_merchants bigint"


def stream_feature_ingest(spark, sf_dir):
    """Window features published as messages, read as a stream and folded to the latest row per user."""
    published = scratch_dir(spark, "features-5m")
    windows = standard_window_features(fx.dense(spark, sf_dir), "5m")
    sinks.publish_batch(dec.encode(dec.to_wire(windows)), path=published)
    view = realtime_view(windows)
    stream = readers.feature_stream(readers.file_messages(spark, published))
    store = scratch_dir(spark, "online-5m")
    sinks.drain(ing.ingest(stream, view, store, scratch_dir(spark, "online-5m-checkpoint")))
    return fx.shape(ing.current(spark, view, store, WINDOW_FEATURES), LATEST)


def session_features(spark, sf_dir):
    return fx.shape(session_features_of(fx.dense(spark, sf_dir), timedelta(minutes=10)), SESSIONS)


def session_unnamed(spark, sf_dir):
    """Rows without a user form sessions like those of one user."""
    txns = fx.unnamed(fx.dense(spark, sf_dir))
    return fx.shape(session_features_of(txns, timedelta(minutes=10)), SESSIONS)


def stream_session_features(spark, sf_dir):
    """Sessions over several triggers; they stay open between them."""
    with rocksdb_state(spark):
        path = _run_slices(
            spark, sf_dir, "sessions", lambda m: stream_sessions_of(_good(m), timedelta(minutes=90)), late=False
        )
    return fx.shape(readers.window_table(spark, path), SESSIONS)


QUERIES = {
    "stream_window_features_5m": _stream_windows("5m"),
    "stream_window_features_15m": _stream_windows("15m"),
    "stream_window_features_1h": _stream_windows("1h"),
    "stream_windows_late": stream_windows_late,
    "stream_velocity_late": stream_velocity_late,
    "stream_velocity": stream_velocity,
    "stream_velocity_arrival": stream_velocity_arrival,
    "stream_landing": stream_landing,
    "lake_one_day": lake_one_day,
    "enriched_files": enriched_files,
    "stream_feature_ingest": stream_feature_ingest,
    "session_features": session_features,
    "session_unnamed": session_unnamed,
    "stream_session_features": stream_session_features,
}

_CLOSED = "where window_end <= (select date_trunc('millisecond', max(event_ts)) - interval 5 second from txn)"


_SLICED = f"""arriving as (
        select *, epoch_us(event_ts) + case when cast(substring(transaction_id, 5) as bigint) % 13 = 0
                                            then {micros(_DELAY)} else 0 end as us from events_txn),
    sliced as (
        select *, least(({SLICES} * (us - min(us) over ())) // (max(us) over () - min(us) over () + 1), {SLICES - 1}) as slice
        from arriving),
    marks as (
        select slice + 1 as slice, max(max(epoch_us(event_ts) // 1000)) over (order by slice) - 5000 as closed_ms
        from sliced group by slice)"""
_NAMED = fx.TXN_SQL.replace("txn as", "events_txn as")
# a record counts in the windows that were open when its slice came
_LATE_WINDOWS = fx.windows_sql(60, 15, "1h").replace(
    "gaps as (select *,", "open_at as (select s.* from spread s left join marks using (slice)\n"
    "        where closed_ms is null or ws + 3600000 > closed_ms),\n    gaps as (select *,"
).replace("from spread)", "from open_at)")


def _closed(size, slide, label):
    return fx.shape_sql(f"{fx.TXN_SQL}, {fx.windows_sql(size, slide, label)}", "feats", feat.WINDOWS, _CLOSED)



def _sessions(txn_sql, minutes, tail=""):
    gap = minutes * 60_000_000
    return fx.shape_sql(
        f"""{txn_sql},
        prev as (select *, epoch_us(event_ts) as us, epoch_us(event_ts) // 1000 as ms,
                        lag(epoch_us(event_ts)) over (partition by user_id order by event_ts) as pus from txn),
        numbered as (select *, sum(case when pus is null or us - pus > {gap} then 1 else 0 end)
                               over (partition by user_id order by us) as sid,
                            ms - pus // 1000 as g from prev),
        feats as (
            select user_id, make_timestamp(min(us)) as window_start, make_timestamp(max(us) + {gap}) as window_end,
                   'session' as window_label,
                   count(*) as txn_count, sum(amount) as txn_sum, avg(amount) as txn_avg, max(amount) as txn_max,
                   min(amount) as txn_min, count(distinct category) as unique_categories,
                   count(distinct merchant_id) as unique_merchants, count(distinct device_type) as unique_devices,
                   case when count(*) > 1 then (max(ms) - min(ms)) / (count(*) - 1.0) else 0 end as avg_inter_txn_ms,
                   coalesce(min(g) filter (us - pus <= {gap}), 0) as min_inter_txn_ms,
                   count(*) filter (is_anomaly) as anomaly_count,
                   max(amount) / avg(amount) as max_amount_ratio,
                   count(*) filter (amount > 300) as high_amount_count
            from numbered group by user_id, sid)""",
        "feats",
        SESSIONS,
        tail,
    )


ORACLE = {
    "stream_window_features_5m": _closed(5, 1, "5m"),
    "stream_window_features_15m": _closed(15, 5, "15m"),
    "stream_window_features_1h": _closed(60, 15, "1h"),
    "stream_windows_late": fx.shape_sql(
        f"{_NAMED}, {_SLICED}, txn as (select * from sliced), {_LATE_WINDOWS}", "feats", feat.WINDOWS, _CLOSED
    ),
    "stream_velocity_late": fx.shape_sql(
        f"{_NAMED}, {_SLICED}, txn as (select * from sliced), {feat.LAG.format(order='slice, event_ts, transaction_id')}",
        "vel",
        feat.VELOCITY,
    ),
    "stream_velocity": feat.ORACLE["velocity_batch"],
    "stream_velocity_arrival": feat.ORACLE["velocity_arrival"],
    "stream_landing": fx.shape_sql(fx.TXN_SQL, "txn", LANDED),
    "lake_one_day": fx.shape_sql(
        f"{fx.TXN_SQL}, landed as (select *, cast(event_ts as date) as event_date from txn)",
        "landed",
        f"{LANDED}, event_date date",
        "where event_date = (select min(cast(event_ts as date)) + 5 from txn)",
    ),
    "enriched_files": feat.ORACLE["velocity_batch"],
    "stream_feature_ingest": fx.shape_sql(
        f"""{fx.DENSE_SQL}, {fx.windows_sql(5, 1, "5m")}, latest as (
            select *, window_end as _ts from feats
            qualify row_number() over (partition by user_id order by window_end desc) = 1)""",
        "latest",
        LATEST,
    ),
    "session_features": _sessions(fx.DENSE_SQL, 10),
    "session_unnamed": _sessions(fx.UNNAMED_DENSE_SQL, 10),
    "stream_session_features": _sessions(fx.TXN_SQL, 90, _CLOSED),
}
