"""Queries over data tests, entity rows, point-in-time joins, snapshots, lookups and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import entity, online, quality, training
from tidemark.operators.asof import asof_join
from tidemark.operators.featureview import daily_view, realtime_view, rolling_view
from tidemark.operators.velocity import velocity
from tidemark.operators.windows import standard_window_features
from tidemark.schemas import (
    DAILY_FEATURES,
    DAILY_VIEW,
    MODEL_FEATURES,
    MODEL_REFS,
    REALTIME_VIEW,
    RISK_FEATURES,
    RISK_VIEW,
    ROLLING_FEATURES,
    ROLLING_VIEW,
)
from tidemark.session import materialise
from tidemark.operators import daily as d
from tidemark.operators.staging import staging
from tidemark.workload import fixtures as fx
from tidemark.workload.features import daily

AS_OF, MARK = "2024-01-16 12:00:00", "2024-01-09 12:00:00"
# so early that some users have no features yet
LOOKUP_AT = "2024-01-30 12:00:00"
_REAL = {"daily_txn_sum", "daily_txn_avg", "daily_txn_max", "rolling_7d_avg_amount", "rolling_30d_avg_amount"}


def _layout(columns, prefix=""):
    return ", ".join(f"{prefix}{c} {'double' if c in _REAL else 'bigint'}" for c in columns)


def _models(spark, sf_dir):
    """Daily and rolling features as written tables, the way a feature run leaves them."""
    day = materialise(daily(spark, sf_dir), "daily")
    return day, materialise(d.rolling_features(day), "rolling")


# -- data tests


def _dq(spark, sf_dir):
    raw = fx.replayed(spark, sf_dir)
    day = materialise(d.daily_features(staging(raw)), "daily")
    tables = {"raw_transactions": raw, "user_daily_features": day, "user_rolling_features": d.rolling_features(day)}
    tests = quality.model_tests(day, fx.EVENT_TYPES)
    return tables, tests + [t for t in quality.generator_tests() if t.name not in {x.name for x in tests}]


def dq_results(spark, sf_dir):
    tables, tests = _dq(spark, sf_dir)
    return fx.shape(quality.run_tests(tables, tests), "test string, failures bigint, passed string")


def dq_failing_rows(spark, sf_dir):
    tables, tests = _dq(spark, sf_dir)
    test = next(t for t in tests if t.name == "accepted_values_raw_transactions_category")
    return fx.shape(quality.failing_rows(tables, test), "transaction_id string, event_ts timestamp, category string")


def dq_duplicate_keys(spark, sf_dir):
    tables, tests = _dq(spark, sf_dir)
    test = next(t for t in tests if t.name == "unique_raw_transactions_transaction_id")
    return fx.shape(quality.failing_rows(tables, test), "key string, n bigint")


# -- entity rows and summaries


def entity_rows(spark, sf_dir):
    return fx.shape(
        entity.entity_rows(daily(spark, sf_dir)), "user_id string, event_timestamp timestamp, has_anomaly bigint"
    )


def dataset_summary(spark, sf_dir):
    rows = entity.entity_rows(daily(spark, sf_dir), ordered=False)
    return fx.shape(
        entity.dataset_summary(rows),
        "total bigint, users bigint, dates bigint, anomalies bigint, anomaly_pct double",
    )


def class_balance(spark, sf_dir):
    rows = entity.entity_rows(daily(spark, sf_dir), ordered=False)
    return fx.shape(entity.class_balance(rows), "positives bigint, negatives bigint, pos_weight double")


def table_counts(spark, sf_dir):
    names = ("events", "documents", "embeddings", "lineitem")
    counted = entity.table_counts({t: fx.read(spark, sf_dir, t) for t in names})
    return fx.shape(counted, "table string, n bigint")


# -- point in time


def asof_daily_rolling(spark, sf_dir):
    """Every transaction with the features of the newest day at its time."""
    day, roll = _models(spark, sf_dir)
    spine = fx.transactions(spark, sf_dir).select(
        "transaction_id", "user_id", (F.col("event_ts") - F.expr("interval 1 day")).alias("event_timestamp")
    )
    joined = asof_join(spine, [daily_view(day), rolling_view(roll)], MODEL_REFS)
    return fx.shape(joined, "transaction_id string, event_timestamp timestamp, " + _layout(MODEL_FEATURES))


_RT = "txn_count bigint, txn_sum double, max_amount_ratio double, min_inter_txn_ms double6"


def asof_realtime(spark, sf_dir):
    """Every transaction with the newest closed five-minute window, at most six hours old."""
    txns = fx.dense(spark, sf_dir)
    view = realtime_view(materialise(standard_window_features(txns, "5m"), "windows"))
    spine = txns.select("transaction_id", "user_id", F.col("event_ts").alias("event_timestamp"))
    refs = [f"{REALTIME_VIEW}:{c}" for c in ("txn_count", "txn_sum", "max_amount_ratio", "min_inter_txn_ms")]
    return fx.shape(asof_join(spine, [view], refs), "transaction_id string, event_timestamp timestamp, " + _RT)


def _training_frame(spark, sf_dir):
    day, roll = _models(spark, sf_dir)
    spine = entity.entity_rows(day, ordered=False)
    return training.training_frame(spine, [daily_view(day), rolling_view(roll)])


TRAINING = "user_id string, event_timestamp timestamp, has_anomaly bigint, " + _layout(MODEL_FEATURES)


def training_frame(spark, sf_dir):
    return fx.shape(_training_frame(spark, sf_dir), TRAINING)


def train_split_counts(spark, sf_dir):
    parts = training.split(_training_frame(spark, sf_dir))
    counted = parts.groupBy("split", "has_anomaly").agg(F.count("*").alias("n"))
    return fx.shape(counted, "split string, has_anomaly bigint, n bigint")


def train_split_exact(spark, sf_dir):
    parts = training.stratified_split(_training_frame(spark, sf_dir))
    return fx.shape(parts, "user_id string, event_timestamp timestamp, has_anomaly bigint, split string")


# -- snapshots and lookups

DAILY_SNAP = "user_id string, _ts timestamp, " + _layout((*DAILY_FEATURES, "has_anomaly"))


def online_snapshot(spark, sf_dir):
    return fx.shape(online.snapshot(daily_view(daily(spark, sf_dir)), AS_OF), DAILY_SNAP)


def online_snapshot_incremental(spark, sf_dir):
    """The snapshot at the mark, written and then brought forward."""
    view = daily_view(daily(spark, sf_dir))
    previous = materialise(online.snapshot(view, MARK), "snapshot")
    return fx.shape(online.snapshot(view, AS_OF, previous=previous, since=MARK), DAILY_SNAP)


def _looked_up(spark, sf_dir):
    """All transactions as requests against the snapshots of the last day; every 97th is of a user never seen before."""
    day, roll = _models(spark, sf_dir)
    txns = fx.transactions(spark, sf_dir)
    live = realtime_view(standard_window_features(txns, "5m"))
    number = F.substring("transaction_id", 5, 20).cast("bigint")
    user = F.when(number % 97 == 0, F.concat(F.lit("new_"), F.col("user_id"))).otherwise(F.col("user_id"))
    requests = velocity(txns).select(
        user.alias("user_id"), "transaction_id", "amount", "category", "merchant_id", "device_type",
        F.col("event_ts").alias("event_timestamp"),
        F.when(F.col("ms_since_last_txn") >= 0, F.col("ms_since_last_txn")).alias("ms_since_last_txn"),
    )
    views = [daily_view(day), rolling_view(roll), live]
    snapshots = [(v, online.snapshot(v, LOOKUP_AT)) for v in views]
    return online.risk_context(online.online_lookup(online.request_rows(requests), snapshots))


LOOKUP = (
    "transaction_id string, request_amount double, request_hour bigint, request_ms_since_last_txn bigint, "
    + _layout(DAILY_FEATURES, f"{DAILY_VIEW}__")
    + ", "
    + _layout(ROLLING_FEATURES, f"{ROLLING_VIEW}__")
    + f", {REALTIME_VIEW}__txn_count bigint, {REALTIME_VIEW}__max_amount_ratio double"
)
RISK = "transaction_id string, " + ", ".join(
    f"{RISK_VIEW}__{c} {'double' if c.startswith('amount') else 'bigint'}" for c in RISK_FEATURES
)


def online_lookup(spark, sf_dir):
    return fx.shape(_looked_up(spark, sf_dir), LOOKUP)


def risk_context(spark, sf_dir):
    return fx.shape(_looked_up(spark, sf_dir), RISK)


INPUT = "transaction_id string, " + ", ".join(f"{c} double" for c in MODEL_FEATURES)


def model_input(spark, sf_dir):
    good, _ = online.model_input(_looked_up(spark, sf_dir), carry=("transaction_id",))
    return fx.shape(good, INPUT)


def model_input_rejects(spark, sf_dir):
    _, bad = online.model_input(_looked_up(spark, sf_dir), carry=("transaction_id",))
    return fx.shape(bad, "transaction_id string, error string")


# -- models


def _rule_scores(spark, sf_dir):
    """A fixed score in place of a model, so that the metrics can be checked in SQL."""
    frame = _training_frame(spark, sf_dir)
    rule = F.least(F.lit(1.0), F.col("daily_txn_avg").cast("double") / 100.0)
    return frame.withColumn("anomaly_score", rule)


def evaluate_metrics(spark, sf_dir):
    scored = materialise(_rule_scores(spark, sf_dir).select("anomaly_score", "has_anomaly"), "scored")
    return fx.shape(training.evaluate(scored), "metric string, value double")


def confusion_counts(spark, sf_dir):
    return fx.shape(training.confusion(_rule_scores(spark, sf_dir)), "tp bigint, fp bigint, fn bigint, tn bigint")


def predictions_by_result(spark, sf_dir):
    scored = _rule_scores(spark, sf_dir).withColumn("is_anomaly", F.col("anomaly_score") >= 0.3)
    return fx.shape(training.predictions_by_result(scored), "result string, predictions bigint")


def _fitted(spark, sf_dir, config=training.TrainingConfig()):
    frame = materialise(training.split(_training_frame(spark, sf_dir), config), "training")
    return frame, *training.fit(frame, config)


def score_requests(spark, sf_dir):
    _, model, _ = _fitted(spark, sf_dir, training.TrainingConfig())
    predictions, _ = training.score(_looked_up(spark, sf_dir), model)
    return predictions


def trained_metrics(spark, sf_dir):
    frame, model, metrics = _fitted(spark, sf_dir)
    test = training.evaluate(training.apply_model(model, frame.filter("split = 'test'")))
    numbers = {k: v for k, v in metrics.items() if not isinstance(v, str)}
    fitted = spark.createDataFrame(sorted(numbers.items()), "metric string, value double")
    return fitted.unionByName(test.withColumn("metric", F.concat(F.lit("test_"), "metric")))


QUERIES = {
    "dq_results": dq_results,
    "dq_failing_rows": dq_failing_rows,
    "dq_duplicate_keys": dq_duplicate_keys,
    "entity_rows": entity_rows,
    "dataset_summary": dataset_summary,
    "class_balance": class_balance,
    "table_counts": table_counts,
    "asof_daily_rolling": asof_daily_rolling,
    "asof_realtime": asof_realtime,
    "training_frame": training_frame,
    "train_split_counts": train_split_counts,
    "train_split_exact": train_split_exact,
    "online_snapshot": online_snapshot,
    "online_snapshot_incremental": online_snapshot_incremental,
    "online_lookup": online_lookup,
    "risk_context": risk_context,
    "model_input": model_input,
    "model_input_rejects": model_input_rejects,
    "evaluate_metrics": evaluate_metrics,
    "confusion_counts": confusion_counts,
    "predictions_by_result": predictions_by_result,
    "score_requests": score_requests,
    "trained_metrics": trained_metrics,
}

# -- SQL twins

_REPLAYED_MODELS = ", ".join((fx.REPLAYED_SQL, fx.STAGING_SQL, fx.DAILY_SQL, fx.ROLLING_SQL))


def _count(name, table, bad):
    return f"select '{name}' as test, count(*) as failures from {table} where {bad}"


def _dq_sql():
    raw, day, roll = "raw_transactions", "user_daily_features", "user_rolling_features"
    types = ", ".join(f"'{t}'" for t in fx.EVENT_TYPES)
    dup = "(select {k} as k from {t} where {k} is not null group by 1 having count(*) > 1)"
    parts = [_count(f"unique_{raw}_transaction_id", dup.format(k="transaction_id", t="txn"), "true")]
    columns = ("transaction_id", "user_id", "amount", "timestamp", "category", "merchant_id", "is_anomaly")
    parts += [_count(f"not_null_{raw}_{c}", "txn", f'"{c}" is null') for c in columns]
    parts.append(_count(f"accepted_values_{raw}_category", "txn", f"category not in ({types})"))
    parts += [_count(f"not_null_{day}_{c}", "daily", f"{c} is null") for c in ("user_id", "event_date", "daily_txn_count")]
    parts.append(_count(f"accepted_values_{day}_has_anomaly", "daily", "has_anomaly not in (0, 1)"))
    key = "user_id || '-' || event_date"
    parts.append(_count(f"unique_{day}_user_id_event_date", dup.format(k=f"({key})", t="daily"), "true"))
    parts += [_count(f"not_null_{roll}_{c}", "rolling", f"{c} is null") for c in ("user_id", "event_date")]
    parts.append(_count("assert_no_negative_sums", "daily", "daily_txn_sum < 0"))
    parts.append(_count(f"range_{raw}_amount_anomalous", "txn", "is_anomaly and not amount between 500 and 5000"))
    parts.append(_count(f"range_{raw}_amount_normal", "txn", "not is_anomaly and not amount between 5 and 200"))
    parts.append(_count(f"matches_{raw}_user_id", "txn", "not regexp_matches(user_id, '^user_[0-9]+$')"))
    zone = r"not regexp_matches(timestamp, '(Z|[+-][0-9]{2}:?[0-9]{2})$')"
    parts.append(_count(f"matches_{raw}_timestamp", "txn", zone))
    return (
        f"with {_REPLAYED_MODELS} select test, failures, cast(failures = 0 as varchar) as passed from ("
        + " union all ".join(parts)
        + ")"
    )


def _real(c):
    return f"cast(cast({c} as double) as float)" if c in _REAL else c


_ENTITY = """ent as (
    select user_id, cast(event_date as timestamp) + interval '23:59:59' as event_timestamp, has_anomaly from daily)"""


def _typed(source, columns, name):
    cols = ", ".join(f"{_real(c)} as {c}" for c in columns)
    return f"{name} as (select user_id, event_date, {cols} from {source})"


def _history(spine):
    return ", ".join(
        (
            _typed("daily", DAILY_FEATURES, "daily_t"),
            _typed("rolling", ROLLING_FEATURES, "rolling_t"),
            _plain_asof("j1", spine, "daily_t", DAILY_FEATURES, "event_date", "90 day"),
            _plain_asof("j2", "j1", "rolling_t", ROLLING_FEATURES, "event_date", "365 day"),
        )
    )


def _plain_asof(name, spine, source, columns, ts, ttl):
    kept = ", ".join(f"case when f._t >= s.event_timestamp - interval {ttl} then f.{c} end as {c}" for c in columns)
    return f"""{name} as (
    select s.*, {kept}
    from {spine} s asof left join (select *, cast({ts} as timestamp) as _t from {source}) f
    on s.user_id = f.user_id and s.event_timestamp >= f._t)"""


_FRAME = f"""{fx.MODEL_SQL}, {_ENTITY}, {_history('ent')},
    frame as (select * from j2 where {' and '.join(f'{c} is not null' for c in MODEL_FEATURES)})"""
_SPLIT = f"""{_FRAME}, share as (
    select *, cast(('0x' || substr(md5(user_id || '|' || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') || '|42'), 1, 8))
                   as bigint) / 4294967296.0 as s from frame),
    parts as (select *, case when s < 0.7 then 'train' when s < 0.85 then 'val' else 'test' end as split from share)"""
_SPINE = """spine as (
    select transaction_id, user_id, event_ts - interval 1 day as event_timestamp from txn)"""
_RT_SPINE = "spine as (select transaction_id, user_id, event_ts as event_timestamp from txn)"
_RT_FEATS = """feats_t as (
    select user_id, window_end, txn_count, cast(txn_sum as float) as txn_sum,
           cast(max_amount_ratio as float) as max_amount_ratio, cast(min_inter_txn_ms as float) as min_inter_txn_ms
    from feats)"""


def _snap(name, source, ts, columns, at=LOOKUP_AT):
    cols = ", ".join(f"{_real(c)} as {c}" for c in columns)
    return f"""{name} as (
    select user_id, cast({ts} as timestamp) as _ts, {cols} from {source}
    where {ts} <= timestamp '{at}'
    qualify row_number() over (partition by user_id order by {ts} desc) = 1)"""


_LOOKUP = f"""{fx.MODEL_SQL}, {fx.windows_sql(5, 1, '5m')},
    vel as (select * replace (case when cast(substr(transaction_id, 5) as bigint) % 97 = 0 then 'new_' || user_id
                                   else user_id end as user_id),
                   epoch_us(event_ts) // 1000
                   - lag(epoch_us(event_ts) // 1000) over (partition by user_id order by event_ts, transaction_id) as gap
            from txn),
    {_snap('ds', 'daily', 'event_date', DAILY_FEATURES)}, {_snap('rs', 'rolling', 'event_date', ROLLING_FEATURES)},
    {_snap('ws', 'feats', 'window_end', ('txn_count', 'max_amount_ratio'))},
    looked as (
        select transaction_id, cast(amount as float) as request_amount, extract(hour from event_ts) as request_hour,
               coalesce(gap, -1) as request_ms_since_last_txn,
               {', '.join(f'ds.{c} as {DAILY_VIEW}__{c}' for c in DAILY_FEATURES)},
               {', '.join(f'rs.{c} as {ROLLING_VIEW}__{c}' for c in ROLLING_FEATURES)},
               ws.txn_count as {REALTIME_VIEW}__txn_count,
               cast(ws.max_amount_ratio as float) as {REALTIME_VIEW}__max_amount_ratio
        from vel left join ds using (user_id) left join rs using (user_id) left join ws using (user_id))"""
_RISK = f"""{_LOOKUP}, risk as (
        select transaction_id,
               cast(cast(request_amount as double) / case when {DAILY_VIEW}__daily_txn_avg < 1 then 1.0
                    else cast({DAILY_VIEW}__daily_txn_avg as double) end as float) as {RISK_VIEW}__amount_over_daily_avg,
               cast(cast(request_amount as double) / case when {ROLLING_VIEW}__rolling_30d_avg_amount < 1 then 1.0
                    else cast({ROLLING_VIEW}__rolling_30d_avg_amount as double) end as float)
                    as {RISK_VIEW}__amount_over_30d_avg,
               case when request_hour < {DAILY_VIEW}__first_txn_hour or request_hour > {DAILY_VIEW}__last_txn_hour
                    then 1 else 0 end as {RISK_VIEW}__after_hours_txn,
               case when request_ms_since_last_txn >= 0 and request_ms_since_last_txn < 60000 then 1 else 0 end
                    as {RISK_VIEW}__rapid_repeat_txn
        from looked)"""
_PAIRS = [(c, f"{DAILY_VIEW if c in DAILY_FEATURES else ROLLING_VIEW}__{c}") for c in MODEL_FEATURES]
_INPUT = f"""{_LOOKUP}, inp as (
        select transaction_id, {', '.join(f'{full} as {c}' for c, full in _PAIRS)} from looked)"""
_COMPLETE = " and ".join(f"{c} is not null" for c in MODEL_FEATURES)
_MISSING = "concat_ws(', ', " + ", ".join(f"case when {c} is null then '{c}' end" for c in MODEL_FEATURES) + ")"
_SCORED = f"""{_FRAME}, scored as (
        select least(1.0, cast(daily_txn_avg as double) / 100.0) as score, has_anomaly as y from frame),
    conf as (select count(*) filter (score >= 0.5 and y = 1) as tp, count(*) filter (score >= 0.5 and y = 0) as fp,
                    count(*) filter (score < 0.5 and y = 1) as fn, count(*) filter (score < 0.5 and y = 0) as tn
             from scored)"""
_METRICS = f"""{_SCORED},
    ranked as (select y, (rank() over (order by score) + rank() over (order by score) +
                          count(*) over (partition by score) - 1) / 2.0 as r from scored),
    m as (select 'accuracy' as metric, (tp + tn) / (tp + fp + fn + tn) as value from conf
          union all select 'precision', case when tp + fp > 0 then tp / (tp + fp) else 0 end from conf
          union all select 'recall', case when tp + fn > 0 then tp / (tp + fn) else 0 end from conf
          union all select 'f1', case when tp > 0 then 2.0 * tp / (2 * tp + fp + fn) else 0 end from conf
          union all select 'roc_auc', (sum(r) filter (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))
                    from ranked)"""

ORACLE = {
    "dq_results": _dq_sql(),
    "dq_failing_rows": fx.shape_sql(
        fx.REPLAYED_SQL,
        "txn",
        "transaction_id string, event_ts timestamp, category string",
        "where category not in ('view', 'signup', 'click', 'error')",
    ),
    "dq_duplicate_keys": fx.shape_sql(
        f"{fx.REPLAYED_SQL}, dup as (select transaction_id as key, count(*) as n from txn group by 1 having n > 1)",
        "dup",
        "key string, n bigint",
    ),
    "entity_rows": fx.shape_sql(
        f"{fx.MODEL_SQL}, {_ENTITY}", "ent", "user_id string, event_timestamp timestamp, has_anomaly bigint"
    ),
    "dataset_summary": fx.shape_sql(
        f"""{fx.MODEL_SQL}, {_ENTITY}, s as (
            select count(*) as total, count(distinct user_id) as users,
                   count(distinct cast(event_timestamp as date)) as dates, sum(has_anomaly) as anomalies,
                   100.0 * sum(has_anomaly) / count(*) as anomaly_pct from ent)""",
        "s",
        "total bigint, users bigint, dates bigint, anomalies bigint, anomaly_pct double",
    ),
    "class_balance": fx.shape_sql(
        f"""{fx.MODEL_SQL}, {_ENTITY}, s as (
            select sum(has_anomaly) as positives, sum(1 - has_anomaly) as negatives,
                   sum(1 - has_anomaly) / sum(has_anomaly) as pos_weight from ent)""",
        "s",
        "positives bigint, negatives bigint, pos_weight double",
    ),
    "table_counts": " union all ".join(
        f"select '{t}' as \"table\", count(*) as n from {t}" for t in ("events", "documents", "embeddings", "lineitem")
    ),
    "asof_daily_rolling": fx.shape_sql(
        f"{fx.MODEL_SQL}, {_SPINE}, {_history('spine')}",
        "j2",
        "transaction_id string, event_timestamp timestamp, " + _layout(MODEL_FEATURES),
    ),
    "asof_realtime": fx.shape_sql(
        f"{fx.DENSE_SQL}, {fx.windows_sql(5, 1, '5m')}, {_RT_SPINE}, {_RT_FEATS}, "
        + _plain_asof(
            "j", "spine", "feats_t", ("txn_count", "txn_sum", "max_amount_ratio", "min_inter_txn_ms"), "window_end",
            "6 hour",
        ),
        "j",
        "transaction_id string, event_timestamp timestamp, " + _RT,
    ),
    "training_frame": fx.shape_sql(_FRAME, "frame", TRAINING),
    "train_split_counts": fx.shape_sql(
        f"{_SPLIT}, c as (select split, has_anomaly, count(*) as n from parts group by all)",
        "c",
        "split string, has_anomaly bigint, n bigint",
    ),
    "train_split_exact": fx.shape_sql(
        f"""{_SPLIT.replace('parts as', 'hashed as')}, placed as (
            select *, row_number() over (partition by has_anomaly order by s, user_id, event_timestamp) as place,
                   count(*) over (partition by has_anomaly) as total from share),
        parts as (select user_id, event_timestamp, has_anomaly,
                         case when place <= round(total * 0.7) then 'train' when place <= round(total * 0.85) then 'val'
                              else 'test' end as split from placed)""",
        "parts",
        "user_id string, event_timestamp timestamp, has_anomaly bigint, split string",
    ),
    "online_snapshot": fx.shape_sql(
        f"{fx.MODEL_SQL}, {_snap('snap', 'daily', 'event_date', (*DAILY_FEATURES, 'has_anomaly'), AS_OF)}", "snap", DAILY_SNAP
    ),
    "online_lookup": fx.shape_sql(_LOOKUP, "looked", LOOKUP),
    "risk_context": fx.shape_sql(_RISK, "risk", RISK),
    "model_input": fx.shape_sql(_INPUT, "inp", INPUT, f"where {_COMPLETE}"),
    "model_input_rejects": fx.shape_sql(
        f"""{_INPUT}, rej as (
            select transaction_id, 'Missing online features required for inference: ' || {_MISSING} as error
            from inp where not ({_COMPLETE}))""",
        "rej",
        "transaction_id string, error string",
    ),
    "evaluate_metrics": fx.shape_sql(_METRICS, "m", "metric string, value double"),
    "confusion_counts": fx.shape_sql(_SCORED, "conf", "tp bigint, fp bigint, fn bigint, tn bigint"),
    "predictions_by_result": fx.shape_sql(
        f"""{_SCORED}, c as (select case when score >= 0.3 then 'anomaly' else 'normal' end as result,
                             count(*) as predictions from scored group by 1)""",
        "c",
        "result string, predictions bigint",
    ),
}
ORACLE["online_snapshot_incremental"] = ORACLE["online_snapshot"]
