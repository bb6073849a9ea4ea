import collections
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entity, online, quality, training
from tidemark.operators.asof import asof_join
from tidemark.operators.featureview import FeatureView, resolve_refs
from tidemark.schemas import DAILY_VIEW, MODEL_FEATURES, REALTIME_VIEW, RISK_VIEW, ROLLING_VIEW
from tidemark.sources import readers

T0 = datetime(2025, 1, 1)
HOUR = timedelta(hours=1)


def view(spark, rows, ttl=6 * HOUR, name="v"):
    df = spark.createDataFrame(rows, "user_id string, at timestamp_ntz, x bigint")
    return FeatureView(name, ("user_id",), "at", ttl, {"x": "bigint"}, df)


def spine(spark, rows):
    return spark.createDataFrame(rows, "row int, user_id string, event_timestamp timestamp_ntz")


def brute_asof(spine_rows, feats, ttl):
    out = {}
    for row, user, at in spine_rows:
        ok = [(t, x) for u, t, x in feats if u == user and t <= at and t >= at - ttl]
        out[row] = max(ok)[1] if ok else None
    return out


@pytest.mark.parametrize("rows_per_group", [1 << 20, 9])
@pytest.mark.parametrize("bucket", [None, timedelta(minutes=7), timedelta(days=2)])
def test_asof_equals_brute_force(spark, rows_per_group, bucket):
    rnd = random.Random(9)
    feats = [(f"u{rnd.randrange(4)}", T0 + timedelta(minutes=rnd.randrange(3000)), rnd.randrange(1000)) for _ in range(120)]
    rows = [(i, "u0" if i % 2 else f"u{rnd.randrange(6)}", T0 + timedelta(minutes=rnd.randrange(4000))) for i in range(300)]
    got = asof_join(spine(spark, rows), [view(spark, feats)], ["v:x"], bucket=bucket, rows_per_group=rows_per_group).collect()
    assert len(got) == len(rows)
    assert {r.row: r.x for r in got} == brute_asof(rows, feats, 6 * HOUR)


def test_asof_of_a_user_with_a_third_of_all_rows(spark):
    """Nobody gives a salt; no task of the join gets more than a piece of the busy users' rows, the one without a name included."""
    rnd = random.Random(2)
    feats = [("hot", T0 + timedelta(minutes=30 * k), k) for k in range(20)] + [(f"u{k}", T0, k) for k in range(50)]
    names = ["hot", None, None] + [f"u{k}" for k in range(3)]
    rows = [(i, "hot" if i % 3 else rnd.choice(names), T0 + timedelta(minutes=rnd.randrange(600))) for i in range(3000)]
    day, views = timedelta(days=1), [view(spark, feats), view(spark, feats, timedelta(days=90), "w")]
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = asof_join(spine(spark, rows), views, ["v:x", "w:x"], full_names=True, bucket=day, rows_per_group=100)
        got = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.row: r.v__x for r in got} == brute_asof(rows, feats, 6 * HOUR) and len(got) == 3000
    assert {r.row: r.w__x for r in got} == brute_asof(rows, feats, timedelta(days=90))
    tasks = collections.Counter(r.task for r in got)
    assert max(tasks.values()) <= 500 and len(tasks) > 15


def test_asof_edges(spark):
    feats = [("u", T0, 1), ("u", T0, 5), ("u", T0 + 2 * HOUR, 7)]
    at = [T0, T0 - timedelta(microseconds=1), T0 + 2 * HOUR, T0 + 8 * HOUR, T0 + 8 * HOUR + timedelta(microseconds=1)]
    rows = [(i, "u", t) for i, t in enumerate(at)] + [(9, "u", T0), (9, "u", T0), (10, "nobody", T0)]
    got = asof_join(spine(spark, rows), [view(spark, feats)], ["v:x"]).collect()
    assert sorted((r.row, r.x) for r in got if r.row < 9) == [(0, 5), (1, None), (2, 7), (3, 7), (4, None)]
    assert [r.x for r in got if r.row == 9] == [5, 5]
    assert [r.x for r in got if r.row == 10] == [None]


def test_asof_of_two_views(spark):
    a, b = view(spark, [("u", T0, 1)], name="a"), view(spark, [("u", T0, 2)], timedelta(days=90), "b")
    rows = [(1, "u", T0 + HOUR), (2, "u", T0 + timedelta(days=3))]
    got = asof_join(spine(spark, rows), [a, b], ["b:x", "a:x"], full_names=True)
    assert got.columns == ["row", "user_id", "event_timestamp", "b__x", "a__x"]
    assert sorted((r.row, r.a__x, r.b__x) for r in got.collect()) == [(1, 1, 2), (2, None, 2)]
    with pytest.raises(ValueError, match="collide"):
        asof_join(spine(spark, rows), [a, b], ["b:x", "a:x"])


def test_refs(spark):
    v = view(spark, [("u", T0, 1)])
    assert resolve_refs(["v:x", "v:x"], [v]) == {"v": ["x"]}
    for bad in ("v:y", "w:x", "x"):
        with pytest.raises(ValueError, match="unknown feature reference"):
            resolve_refs([bad], [v])


def test_snapshot_full_equals_incremental(spark):
    rnd = random.Random(2)
    feats = [(f"u{rnd.randrange(5)}", T0 + timedelta(hours=rnd.randrange(100)), rnd.randrange(9)) for _ in range(80)]
    v, mark, now = view(spark, feats), T0 + 40 * HOUR, T0 + 77 * HOUR
    full = sorted(map(tuple, online.snapshot(v, str(now)).collect()))
    first = online.snapshot(v, str(mark))
    assert full == sorted(map(tuple, online.snapshot(v, str(now), first, str(mark)).collect()))
    for user, at, x in full:
        assert (at, x) == max((t, y) for u, t, y in feats if u == user and t <= now)


REQUESTS = (
    "user_id string, transaction_id string, amount double, event_timestamp timestamp_ntz, ms_since_last_txn bigint"
)


def test_request_rows(spark):
    df = spark.createDataFrame(
        [("u", "t1", 9.5, datetime(2025, 1, 15, 14, 30), 500), ("u", "t2", 1.0, None, None)], REQUESTS
    )
    now = F.lit("2025-01-15 07:00:00").cast("timestamp")
    a, b = online.request_rows(df, now).orderBy("transaction_id").collect()
    assert (a.request_hour, a.request_ms_since_last_txn, a.request_amount) == (14, 500, 9.5)
    assert (b.request_hour, b.request_ms_since_last_txn) == (7, -1)
    with pytest.raises(ValueError, match="unexpected"):
        online.request_rows(df.withColumn("extra", F.lit(1)))


def risk(spark, amount, hour, gap, daily_avg, rolling_avg, first, last):
    df = spark.createDataFrame(
        [(amount, hour, gap, daily_avg, rolling_avg, first, last)],
        f"request_amount float, request_hour bigint, request_ms_since_last_txn bigint, {DAILY_VIEW}__daily_txn_avg float, "
        f"{ROLLING_VIEW}__rolling_30d_avg_amount float, {DAILY_VIEW}__first_txn_hour bigint, "
        f"{DAILY_VIEW}__last_txn_hour bigint",
    )
    row = online.risk_context(df).first().asDict()
    return tuple(v for k, v in row.items() if k.startswith(RISK_VIEW))


def test_risk_context(spark):
    assert risk(spark, 50.0, 3, 100, 25.0, 0.5, 8, 20) == (2.0, 50.0, 1, 1)
    assert risk(spark, 50.0, 8, 60000, 25.0, 10.0, 8, 20) == (2.0, 5.0, 0, 0)
    assert risk(spark, 50.0, 21, -1, None, None, None, 20) == (None, None, 1, 0)
    assert risk(spark, 50.0, 21, 0, None, None, None, None) == (None, None, 0, 1)


def test_names_and_rejects(spark):
    cols = {f"{DAILY_VIEW if i < 9 else ROLLING_VIEW}__{c}": i for i, c in enumerate(MODEL_FEATURES)}
    df = spark.range(2).select(
        F.lit("u").alias("user_id"),
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        *[(F.when(F.col("id") == 0, v) if v in (2, 12) else F.lit(v)).alias(k) for k, v in cols.items()],
    )
    assert f"{DAILY_VIEW}:daily_txn_avg" in online.reference_names(df).columns
    good, bad = online.model_input(df, carry=("transaction_id",))
    row = good.first()
    assert good.columns == ["transaction_id", *MODEL_FEATURES] and list(row[1:]) == [float(i) for i in range(13)]
    assert bad.first().error == (
        "Missing online features required for inference: daily_txn_avg, rolling_30d_avg_amount"
    )


def test_lookup_with_lifetime(spark):
    v = view(spark, [("u", T0, 4)])
    snap = online.snapshot(v, str(T0 + HOUR))
    df = spark.createDataFrame([("u", "t1", 1.0, T0 + 7 * HOUR, None), ("w", "t2", 1.0, T0, None)], REQUESTS)
    got = {r.transaction_id: r.v__x for r in online.online_lookup(df, [(v, snap)]).collect()}
    assert got == {"t1": 4, "t2": None}
    alive = online.online_lookup(df, [(v, snap)], enforce_ttl=True).collect()
    assert {r.transaction_id: r.v__x for r in alive} == {"t1": None, "t2": None}
    assert REALTIME_VIEW.startswith("user_")


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3), (None, 900)], "k string, v int")
    tests = [
        quality.not_null("t", "k"), quality.unique("t", "k"), quality.accepted_values("t", "v", [1, 3]),
        quality.value_range("t", "v", 0, 10, F.col("k").isNull()), quality.matches("t", "k", "^a$"),
        quality.unique_on("t", "k_v", "k", "v"), quality.SingularTest("big", "t", df.filter("v > 5")),
    ]
    report = {r.test: (r.failures, r.passed) for r in quality.run_tests({"t": df}, tests).collect()}
    assert report == {
        "not_null_t_k": (2, False), "unique_t_k": (1, False), "accepted_values_t_v": (1, False),
        "range_t_v": (1, False), "matches_t_k": (0, True), "unique_t_k_v": (0, True), "big": (1, False),
    }
    assert quality.failing_rows({"t": df}, tests[2]).first().v == 900
    with pytest.raises(AssertionError, match="not_null_t_k"):
        quality.assert_passed(quality.run_tests({"t": df}, tests))
    quality.assert_passed(quality.run_tests({"t": df}, tests[4:6]))


def test_summaries_of_nothing(spark):
    empty = spark.createDataFrame([], "user_id string, event_timestamp timestamp, has_anomaly int")
    s = entity.dataset_summary(empty).first()
    assert (s.total, s.users, s.dates, s.anomalies, s.anomaly_pct) == (0, 0, 0, 0, 0.0)
    b = entity.class_balance(empty).first()
    assert (b.positives, b.negatives, b.pos_weight) == (0, 0, 1.0)


def test_entity_rows_from_files(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("user_id,event_date,has_anomaly\nu1,2025-01-02,1\nu2,2025-01-03,0\n")
    rows = readers.entity_rows(spark, str(tmp_path / "rows.csv")).orderBy("user_id").collect()
    assert [(r.user_id, r.event_timestamp, r.has_anomaly) for r in rows][0] == ("u1", datetime(2025, 1, 2), 1)
    (tmp_path / "bad.csv").write_text("user_id,event_timestamp\nu1,2025-01-02\n")
    with pytest.raises(ValueError, match="has_anomaly"):
        readers.entity_rows(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "none.csv").write_text("user_id,has_anomaly\nu1,1\n")
    with pytest.raises(ValueError, match="event_date"):
        readers.entity_rows(spark, str(tmp_path / "none.csv"))


def test_split(spark):
    df = spark.range(4000).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.lit("2025-01-01").alias("event_timestamp"),
        (F.col("id") % 5 == 0).cast("int").alias("has_anomaly"),
    )
    parts = training.split(df)
    n = {(r["split"], r.has_anomaly): r["count"] for r in parts.groupBy("split", "has_anomaly").count().collect()}
    for label, total in ((0, 3200), (1, 800)):
        assert n["train", label] / total == pytest.approx(0.70, abs=0.05)
        assert n["val", label] / total == pytest.approx(0.15, abs=0.04)
    again = training.split(df.repartition(7)).exceptAll(parts)
    assert again.count() == 0
    with pytest.raises(ValueError, match="do not make up the whole"):
        training.TrainingConfig(train_split=0.5)


def test_stratified_split(spark):
    df = spark.range(1003).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.lit("2025-01-01").alias("event_timestamp"),
        (F.col("id") % 10 == 0).cast("int").alias("has_anomaly"),
    )
    for bins in (1, 50):
        parts = training.stratified_split(df, bins=bins)
        n = {(r["split"], r.has_anomaly): r["count"] for r in parts.groupBy("split", "has_anomaly").count().collect()}
        assert (n["train", 0], n["val", 0], n["test", 0]) == (631, 136, 135)
        assert (n["train", 1], n["val", 1], n["test", 1]) == (71, 15, 15)


def test_foreign_model(spark):
    def load():
        return lambda pdf: pdf["daily_txn_sum"] / (pdf["daily_txn_sum"] + pdf["daily_txn_count"])

    df = spark.createDataFrame([tuple([1.0, 3.0] + [0.0] * 11)], ", ".join(f"{c} double" for c in MODEL_FEATURES))
    assert training.apply_foreign_model(df, load).first().anomaly_score == 0.75


def test_metrics(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([0.1, 0.5, 0.9, rnd.random()]), int(rnd.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "anomaly_score double, has_anomaly int")
    got = {r.metric: r.value for r in training.evaluate(df).collect()}
    tp = sum(s >= 0.5 and y for s, y in rows)
    pos, hits = sum(y for _, y in rows), sum(s >= 0.5 for s, _ in rows)
    assert got["precision"] == pytest.approx(tp / hits) and got["recall"] == pytest.approx(tp / pos)
    ups, downs = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((a > b) + (a == b) / 2 for a in ups for b in downs)
    assert got["roc_auc"] == pytest.approx(wins / len(ups) / len(downs))
    one_class = {r.metric: r.value for r in training.evaluate(df.filter("has_anomaly = 0")).collect()}
    assert "roc_auc" not in one_class and one_class["precision"] == 0
    with pytest.raises(ValueError, match="empty"):
        training.evaluate(df.limit(0))
