"""Whole runs, readers and sinks, written to the shared folder and read back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import daily as d
from tidemark.operators import decode as dec
from tidemark.operators import entity, online, training
from tidemark.operators import vectors as vec
from tidemark.plans import batch_features as bf
from tidemark.plans import retrieval as index_plan
from tidemark.plans import streaming_features as stream_plan
from tidemark.schemas import LABEL
from tidemark.session import materialise, scratch_dir
from tidemark.sources import readers, sinks
from tidemark.workload import features as feat
from tidemark.workload import fixtures as fx
from tidemark.workload import store, streams, texts

UNTIL = 1_706_659_200  # 2024-01-31, the end of the test events
ENTITY = "source string, user_id string, event_timestamp timestamp, has_anomaly bigint"
PREDICTED = "transaction_id string, anomaly_score double, is_anomaly string, model_version string"
ENCODED = "doc_id bigint, place bigint, weight double"
PEEKED = "offset bigint, is_json string, shown string"


def batch_run(spark, sf_dir):
    """Models, data tests, exports and latest values in one run; the mirrored export is read back."""
    layout, mirror = bf.Layout(scratch_dir(spark, "run")), bf.Layout(scratch_dir(spark, "mirror"))
    raw = fx.transactions(spark, sf_dir).drop("event_ts")
    bf.run(spark, raw, layout, UNTIL, mirror, categories=[*fx.EVENT_TYPES, "purchase"])
    return fx.shape(spark.read.parquet(mirror.export("user_daily_features")), feat.EXPORTED)


def written_tables(spark, sf_dir):
    """Staging as a view, daily features as a table that replaces what was there."""
    path = scratch_dir(spark, "daily-table")
    sinks.write_view(feat.staged(spark, sf_dir), "staged_transactions")
    for _ in range(2):
        sinks.write_table(d.daily_features(spark.table("staged_transactions")), path)
    return fx.shape(readers.feature_table(spark, path), feat.DAILY)


def entity_rows_from_file(spark, sf_dir):
    """Entity rows exported to Parquet, and to CSV with a date in place of the time."""
    day = materialise(feat.daily(spark, sf_dir), "daily")
    whole, text = scratch_dir(spark, "entity-rows"), f"{scratch_dir(spark, 'entity-rows')}.csv"
    sinks.export_entity_rows(entity.entity_rows(day, ordered=False), whole)
    day.select("user_id", "event_date", LABEL).write.option("header", True).csv(text)
    both = [readers.entity_rows(spark, p).withColumn("source", F.lit(s)) for p, s in ((whole, "parquet"), (text, "csv"))]
    return fx.shape(both[0].unionByName(both[1]), ENTITY)


def foreign_model_scores(spark, sf_dir):
    """Requests scored by a model from outside, in tasks; predictions are written and read back."""
    rows, _ = online.model_input(store._looked_up(spark, sf_dir), carry=("transaction_id",))

    def load():
        return lambda frame: frame["daily_txn_count"] / (frame["daily_txn_count"] + 10.0)

    scored = training.apply_foreign_model(rows, load)
    flags = {"is_anomaly": F.col("anomaly_score") >= 0.3, "model_version": F.lit("7")}
    path = scratch_dir(spark, "predictions")
    sinks.write_predictions(scored.withColumns(flags), path)
    return fx.shape(spark.read.parquet(path), PREDICTED)


def run_metrics(spark, sf_dir):
    """The metrics table of a training run, over fixed scores."""
    scored = materialise(store._rule_scores(spark, sf_dir).select("anomaly_score", LABEL), "scored")
    metrics = {r["metric"]: r["value"] for r in training.evaluate(scored).collect()}
    tables = training.run_tables(spark, {**metrics, "model": "rule"}, training.TrainingConfig())
    return fx.shape(tables["metrics"], "metric string, value double")


def section_index(spark, sf_dir):
    """Sections and vectors written as an index, searched with every user turn."""
    root = scratch_dir(spark, "index")
    index_plan.build_index(texts._documents(spark, sf_dir), root)
    return fx.shape(index_plan.search(spark, texts._questions(spark, sf_dir), root), texts.FOUND_SECTIONS)


def encoded_embedding(spark, sf_dir):
    """An encoder that is handed in: length, number of "a" and one, at unit length."""

    def load():
        return lambda values: np.array([[len(v), v.count("a"), 1.0] for v in values])

    rows = vec.encode_texts(texts._documents(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit(""))), "text", load)
    return fx.shape(rows.select("doc_id", F.posexplode("embedding").alias("place", "weight")), ENCODED)


def peek_messages(spark, sf_dir):
    """Every message shown; what is no JSON object as its first 200 characters."""
    value = F.col("value")
    long = F.when(value.startswith("{"), value).otherwise(F.concat(value, F.repeat(F.lit("x"), 300)))
    shown = readers.peek(feat._messages(spark, sf_dir).withColumn("value", long), 1 << 30)
    return fx.shape(shown.withColumn("shown", F.when(~F.col("is_json"), F.col("message"))), PEEKED)


def stream_job(spark, sf_dir):
    """All streams of the job at once; the published hourly windows are read back from their topic's folder."""
    root = scratch_dir(spark, "job")
    started = stream_plan.run(streams._message_stream(spark, sf_dir), root, every=None)
    sinks.drain(*started.values())
    published = spark.read.text(f"{root}/{readers.FEATURE_TOPICS['1h']}")
    return fx.shape(readers.feature_stream(published), feat.WINDOWS)


def stream_landing_limited(spark, sf_dir):
    """Landing with a limit of files per trigger."""
    incoming, lake = scratch_dir(spark, "landing-in"), scratch_dir(spark, "landing")
    raw = fx.transactions(spark, sf_dir).drop("event_ts").withColumn("part", F.pmod(F.xxhash64("transaction_id"), F.lit(6)))
    lines = raw.repartition(6, "part").select(F.to_json(F.struct(*[c for c in raw.columns if c != "part"])).alias("value"))
    sinks.publish_batch(lines, path=incoming)
    stream = dec.land_fields(readers.file_messages(spark, incoming, 2))
    sinks.drain(sinks.land(stream, lake, scratch_dir(spark, "landing-checkpoint"), every=None))
    return fx.shape(readers.raw_lake(spark, lake), streams.LANDED)


QUERIES = {
    f.__name__: f
    for f in (
        batch_run, written_tables, entity_rows_from_file, foreign_model_scores, run_metrics, section_index,
        encoded_embedding, peek_messages, stream_job, stream_landing_limited,
    )
}

_STAGED = ", ".join((fx.TXN_SQL, fx.STAGING_SQL, fx.DAILY_SQL))

ORACLE = {
    "batch_run": feat.ORACLE["export_daily"],
    "written_tables": feat.ORACLE["user_daily_features"],
    "entity_rows_from_file": fx.shape_sql(
        f"""{_STAGED}, e as (
            select 'parquet' as source, user_id, cast(event_date as timestamp) + interval 23 hour + interval 59 minute
                   + interval 59 second as event_timestamp, has_anomaly from daily
            union all
            select 'csv', user_id, cast(event_date as timestamp), has_anomaly from daily)""",
        "e",
        ENTITY,
    ),
    "foreign_model_scores": fx.shape_sql(
        f"""{store._INPUT}, p as (
            select *, daily_txn_count / (daily_txn_count + 10.0) as anomaly_score, '7' as model_version from inp
            where {store._COMPLETE}), q as (select *, anomaly_score >= 0.3 as is_anomaly from p)""",
        "q",
        PREDICTED,
    ),
    "run_metrics": store.ORACLE["evaluate_metrics"],
    "section_index": texts.ORACLE["section_search"],
    "encoded_embedding": fx.shape_sql(
        """v as (select doc_id, [length(t), length(t) - length(replace(t, 'a', '')), 1.0] as v
                 from (select doc_id, coalesce(text, '') as t from documents)),
        u as (select doc_id, unnest(range(3)) as place, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) as n from v),
        w as (select doc_id, place, v[(place + 1)::int] / n as weight from u)""",
        "w",
        ENCODED,
    ),
    "peek_messages": fx.shape_sql(
        f"""{fx.TXN_SQL}, m as (
            select {feat._EID} as "offset", {feat._EID} % 50 <> 0 as is_json,
                   case when {feat._EID} % 50 = 0 then left('not json ' || transaction_id || repeat('x', 300), 200) end
                   as shown from txn)""",
        "m",
        PEEKED,
    ),
    "stream_job": streams.ORACLE["stream_window_features_1h"],
    "stream_landing_limited": streams.ORACLE["stream_landing"],
}
