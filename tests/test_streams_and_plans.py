import json
import random
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from helpers import brute_windows, random_txns, window_rows
from pyspark.sql import functions as F

from tidemark.operators import decode as dec
from tidemark.operators.featureview import realtime_view
from tidemark.operators.training import TrainingConfig
from tidemark.operators.windows import session_features
from tidemark.plans import batch_features as bf
from tidemark.plans import streaming_features as stream_plan
from tidemark.plans import training as train_plan
from tidemark.schemas import WINDOW_FEATURES
from tidemark.session import rocksdb_state
from tidemark.sources import readers, sinks
from tidemark.sources.buckets import BucketTable
from tidemark.streaming import features as sf
from tidemark.streaming import ingest as ing
from tidemark.streaming.sessions import Sessions, stream_session_features
from tidemark.workload import fixtures as fx
from tidemark.workload import streams


def message(i, user, amount, at, category="a", merchant="m", device="mobile", anomaly=False):
    when = at.replace(tzinfo=timezone.utc).isoformat()
    return json.dumps(
        {
            "transaction_id": f"t{i}", "user_id": user, "amount": amount, "category": category,
            "merchant_id": merchant, "timestamp": when, "is_anomaly": anomaly, "device_type": device,
        }
    )


def write_files(path, batches):
    path.mkdir()
    for n, lines in enumerate(batches):
        f = path / f"part-{n:03d}.txt"
        f.write_text("\n".join(lines) + "\n")
        import os

        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))


T0 = datetime(2025, 1, 15, 12)


def test_velocity_across_batches(spark, tmp_path):
    seconds = (0, 60, 420, 30)
    batches = [[message(i, "u", 1.0, T0 + timedelta(seconds=s))] for i, s in enumerate(seconds)]
    batches[2].append(message(9, "w", 1.0, T0))
    write_files(tmp_path / "in", batches)
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    out = sf.stream_velocity(good)
    with rocksdb_state(spark):
        query = sinks.stream_table(out, str(tmp_path / "out"), str(tmp_path / "cp"), every=None)
    sinks.drain(query)
    rows = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).orderBy("transaction_id").collect()
    assert [r.ms_since_last_txn for r in rows] == [-1, 60000, 360000, -390000, -1]
    assert [r.is_first_txn for r in rows] == [True, False, False, True, True]


def test_ordered_velocity_splits_a_user_and_carries_over_batches(spark, tmp_path):
    rnd = random.Random(4)
    times = [[rnd.randrange(k * 36_000, (k + 2) * 36_000) for _ in range(150)] for k in range(3)]
    users = [["hot" if rnd.random() < 0.8 else f"u{rnd.randrange(3)}" for _ in part] for part in times]
    rows = [[(1000 * k + i, u, t) for i, (u, t) in enumerate(zip(*pair))] for k, pair in enumerate(zip(users, times))]
    write_files(tmp_path / "in", [[message(i, u, 1.0, T0 + timedelta(seconds=t)) for i, u, t in part] for part in rows])
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.drain(sf.ordered_velocity_table(good, str(tmp_path / "out"), str(tmp_path / "cp")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    out = spark.read.parquet(str(tmp_path / "out"))
    want, last = {}, {}
    for part in rows:
        for i, u, t in sorted(part, key=lambda r: (r[2], f"t{r[0]}")):
            want[f"t{i}"] = 1000 * (t - last[u]) if u in last else -1
            last[u] = t
    assert {r.transaction_id: r.ms_since_last_txn for r in out.collect()} == want and out.count() == 450
    # no task holds all records of the busy user in a trigger
    files = out.filter("user_id = 'hot'").select("version", F.input_file_name().alias("f")).distinct()
    assert all(r["count"] > 1 for r in files.groupBy("version").count().collect())


def test_registered_velocity_gathers_no_user(spark, monkeypatch):
    monkeypatch.setattr(sf._PreviousTime, "__init__", lambda *_: pytest.fail("keyed state of whole users"))
    assert streams.stream_velocity(spark, "/root/testdata/sf0.001").count() > 0


def test_windows_over_batches_with_late_rows(spark, tmp_path):
    rows = sorted(random_txns(300, seed=8, span=3600), key=lambda r: r[7])
    lines = [message(r[0][1:], r[1], r[2], r[7], r[3], r[4], r[5], r[6]) for r in rows]
    batches = [lines[i : i + 60] for i in range(0, 300, 60)]
    # a record hours behind, long after its windows were closed
    batches[4].append(message(999, "late", 1.0, T0 - timedelta(hours=5)))
    write_files(tmp_path / "in", batches)
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    out = sf.stream_window_features(good, "5m")
    sinks.drain(sinks.stream_table(out, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))
    table = readers.window_table(spark, str(tmp_path / "out"))
    got = window_rows(table)
    assert len(got) == table.count()
    end = max(r[7] for r in rows) - timedelta(seconds=5)
    closed = int(end.replace(tzinfo=timezone.utc).timestamp() * 1000) - 300000
    want = {k: v for k, v in brute_windows(rows, 300000, 60000).items() if k[1] <= closed}
    assert got == want


def drained(query):
    query.awaitTermination()
    return [[(o.numRowsTotal, o.customMetrics) for o in p.stateOperators] for p in query.recentProgress]


def test_window_state_is_bounded_by_distinct_values(spark, tmp_path):
    """6,000 records of one user within two minutes: two categories, three merchants, one device, 40 cells of time."""
    rnd = random.Random(6)
    lines = []
    for i in range(6000):
        ms = rnd.randrange(40) * 3000 + rnd.randrange(50)
        at = T0 + timedelta(milliseconds=ms)
        lines.append(message(i, "hot", 1.0 + i % 400, at, f"c{i % 2}", f"m{i % 3}", "d"))
    flush = [message(9000, "other", 1.0, T0 + timedelta(hours=1))]
    write_files(tmp_path / "in", [lines[:3000], lines[3000:], flush, [flush[0].replace("t9000", "t9001")]])
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    out = sf.stream_window_features(good, "5m")
    progress = drained(sinks.stream_table(out, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))
    facts, users = [max(p[k][0] for p in progress) for k in (0, 1)] if len(progress[0]) == 2 else (None, None)
    # six windows at most hold the two minutes; per window 40 cells and six values, plus those of the other user
    assert max(facts, users) <= 7 * (40 + 6) + 20
    # what closes goes through the second aggregate in the same trigger
    assert min(progress[-1][0][0], progress[-1][1][0]) == 0
    rows = [json.loads(x) for x in lines]
    got = readers.window_table(spark, str(tmp_path / "out")).filter("user_id = 'hot'").collect()
    assert len(got) == 6 and sum(r.txn_count for r in got) >= 5 * 6000 * 0.9
    whole = [r for r in got if r.txn_count == len(rows)]
    assert whole and whole[0].unique_merchants == 3 and whole[0].txn_sum == pytest.approx(sum(r["amount"] for r in rows))
    assert whole[0].min_inter_txn_ms == 0.0


def test_a_record_makes_one_state_row_a_window(spark, tmp_path):
    """Twenty records a second apart, two more in the last one's cell; null counts as a value."""
    lines = [message(i, "u", 1.0, T0 + timedelta(seconds=i), f"c{i}", f"m{i}", f"d{i}") for i in range(20)]
    lines += [message(30 + i, "u", 2.0, T0 + timedelta(seconds=19, milliseconds=7 * i), None, f"m{i}", "d0") for i in (1, 2)]
    flush = [[message(40 + k, "v", 1.0, T0 + timedelta(hours=1, seconds=k))] for k in (0, 1)]
    write_files(tmp_path / "in", [lines, *flush])
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    out = sf.stream_window_features(good, "1m", timedelta(minutes=1))
    with rocksdb_state(spark):
        progress = drained(sinks.stream_table(out, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))
    assert max(op[0] for op in progress[0]) == 20 and any("rocksdbPutCount" in op[1] for op in progress[0])
    row = readers.window_table(spark, str(tmp_path / "out")).filter("user_id = 'u'").first()
    assert (row.txn_count, row.unique_categories, row.unique_merchants, row.unique_devices) == (22, 21, 20, 20)
    assert (row.min_inter_txn_ms, row.txn_sum) == (7.0, 24.0)


def test_late_records_count_in_open_windows(spark, tmp_path):
    """The watermark stands at 605 s when a record of 500 s comes: windows that end at 600 s or before are closed."""
    first = [message(i, "u", 1.0, T0 + timedelta(seconds=20 * i)) for i in range(31)]
    later = [[message(100, "u", 1.0, T0 + timedelta(seconds=610))], [message(102, "v", 1.0, T0 + timedelta(seconds=611))],
             [message(101, "u", 50.0, T0 + timedelta(seconds=500))], [message(103, "v", 1.0, T0 + timedelta(seconds=4000))],
             [message(104, "v", 1.0, T0 + timedelta(seconds=4001))]]
    write_files(tmp_path / "in", [first, *later])
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    out = sf.stream_window_features(good, "5m")
    sinks.drain(sinks.stream_table(out, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))
    rows = readers.window_table(spark, str(tmp_path / "out")).filter("user_id = 'u'").collect()
    top = {int((r.window_end - T0).total_seconds()): r.txn_max for r in rows}
    assert len(top) == len(rows)
    assert {end for end, most in top.items() if most == 50.0} == {660, 720, 780} and top[600] == top[540] == 1.0


@pytest.mark.parametrize("gap, cell_apart", [(60.0, False), (0.05, True)])
def test_sessions_over_triggers_equal_the_batch(spark, tmp_path, gap, cell_apart):
    rnd = random.Random(17)
    times = sorted(rnd.randrange(0, 4_000_000 if not cell_apart else 20_000) for _ in range(400))
    rows = []
    for i, ms in enumerate(times):
        user = "hot" if rnd.random() < 0.5 else f"u{rnd.randrange(4)}"
        rows.append((i, user, round(rnd.uniform(1, 600), 2), T0 + timedelta(milliseconds=ms), f"c{rnd.randrange(3)}",
                     f"m{rnd.randrange(9)}", "xyz"[i % 3], i % 7 == 0, ms))
    # disorder within the lateness, across triggers; then late records that join sessions which are still open
    rows.sort(key=lambda r: r[8] + rnd.randrange(0, 4000))
    batches = [[message(*r[:8]) for r in rows[k : k + 80]] for k in range(0, 400, 80)]
    end = T0 + timedelta(milliseconds=5_000_000)
    batches += [[message(900 + k, "end", 1.0, end + timedelta(hours=k))] for k in range(3)]
    write_files(tmp_path / "in", batches)
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    span = timedelta(seconds=gap)
    with rocksdb_state(spark):
        query = sinks.stream_table(stream_session_features(good, span), str(tmp_path / "out"), str(tmp_path / "cp"), every=None)
    drained(query)
    batch, _ = dec.decode(spark.read.text(str(tmp_path / "in")))
    columns = [c for c in WINDOW_FEATURES.fieldNames() if c != "computed_at"]
    shown = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                              for r in df.filter("user_id <> 'end'").select(*columns).collect())
    assert shown(readers.window_table(spark, str(tmp_path / "out"))) == shown(session_features(batch, span))


def test_a_late_record_joins_two_open_sessions(spark, tmp_path):
    def at(i, seconds, **more):
        return message(i, "u", float(i), T0 + timedelta(seconds=seconds), **more)

    batches = [[at(1, 0, merchant="a"), at(2, 62, merchant="b")], [at(3, 64, merchant="a")], [at(4, 31, merchant="c")],
               [at(5, 1000)], [at(9, 1001)], [at(6, 90)], [at(7, 2000)], [at(8, 2001)]]
    write_files(tmp_path / "in", batches)
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    with rocksdb_state(spark):
        query = sinks.stream_table(
            stream_session_features(good, timedelta(seconds=60)), str(tmp_path / "out"), str(tmp_path / "cp"), every=None
        )
    drained(query)
    rows = readers.window_table(spark, str(tmp_path / "out")).orderBy("window_start").collect()
    # the record of 90 s comes after its session was closed and is dropped; the last session stays open
    assert [(r.txn_count, r.unique_merchants, r.txn_sum, r.min_inter_txn_ms) for r in rows] == [
        (4, 3, 10.0, 2_000.0), (2, 1, 14.0, 1_000.0),
    ]


def test_long_sessions_keep_no_times(spark, tmp_path):
    """A user who never pauses: cells older than the gap are folded into the session's numbers."""
    batches = [[message(100 * k + i, "u", 1.0, T0 + timedelta(seconds=200 * k + 2 * i)) for i in range(100)] for k in range(8)]
    write_files(tmp_path / "in", batches)
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    with rocksdb_state(spark):
        query = sinks.stream_table(
            stream_session_features(good, timedelta(seconds=30)), str(tmp_path / "out"), str(tmp_path / "cp"), every=None
        )
    rows = [p[0][0] for p in drained(query)]
    assert max(rows) < 350 and rows[-1] <= max(rows[:4]), rows


def test_topics_in_folders_and_state_are_compressed(spark, tmp_path):
    write_files(tmp_path / "in", [[message(i, f"u{i}", 1.0, T0 + timedelta(seconds=i)) for i in range(500)]])
    messages = readers.file_messages(spark, str(tmp_path / "in"))
    sinks.drain(sinks.publish(messages, str(tmp_path / "cp"), path=str(tmp_path / "out"), every=None))
    files = [f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-")]
    sizes = [sum(f.stat().st_size for f in found) for found in (files, (tmp_path / "in").iterdir())]
    assert files and all(f.suffix == ".gz" for f in files) and sizes[0] < sizes[1] / 4
    lines = [{r.value for r in spark.read.text(str(tmp_path / d)).collect()} for d in ("in", "out")]
    assert lines[0] == lines[1] and len(lines[0]) == 500
    names = ("rocksdb.compression", "rocksdb.allowFAllocate", "providerClass")
    held = lambda: [spark.conf.get(f"spark.sql.streaming.stateStore.{n}", None) for n in names]
    before = held()
    with rocksdb_state(spark):
        assert held()[:2] == ["zstd", "false"]
    assert held() == before


def test_calls_of_the_state_store_do_not_grow_with_the_records():
    calls, kept = [], {}

    class Handle:
        def getValueState(self, name, schema):
            return self

        def get(self):
            calls.append("get")
            return kept.get("v")

        def update(self, value):
            calls.append("update")
            kept["v"] = value

        def clear(self):
            calls.append("clear")
            kept.clear()

        def registerTimer(self, at):
            calls.append("register")

        def deleteTimer(self, at):
            calls.append("delete")

    class Timer:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    def rows(first):
        us = [1_000_000 * (first + i) for i in range(300)]
        return pd.DataFrame({"event_us": us, "amount": 1.0, "is_anomaly": False, "category": "c", "device_type": None,
                             "merchant_id": [f"m{first + i}" for i in range(300)]})

    sessions = Sessions(60_000_000, 300.0)
    sessions.init(Handle())
    for first in (0, 250, 2000):
        list(sessions.handleInputRows(("u",), iter([rows(first)]), Timer(0)))
    assert len(calls) <= 3 * 4, calls
    ended = pd.concat(sessions.handleExpiredTimer(("u",), Timer(10_000_000), None))
    assert ended["txn_count"].tolist() == [600, 300] and ended["unique_merchants"].tolist() == [550, 300]
    assert ended["min_gap"].tolist() == [0, 1000] and not kept and len(calls) <= 4 * 4


def test_bucket_table_costs_the_same_after_many_triggers(spark, tmp_path):
    table = BucketTable(str(tmp_path / "state"), "user_id string, event_ms long", "user_id", 4)
    want, most = {}, 0
    for n in range(50):
        users = [f"u{(7 * n + k) % 40}" for k in range(3)]
        ends = spark.createDataFrame([(u, n) for u in users], table.schema)
        touched = [r[0] for r in ends.select(table.bucket()).distinct().collect()]
        for attempt in range(2 if n % 10 == 3 else 1):  # a repeated trigger starts from the same state
            last = table.before(spark, n, touched)
            if last is None:
                table.replace(ends, n)
                continue
            held = {r.user_id: r.event_ms for r in last.collect()}
            inside = {r.user_id for r in spark.createDataFrame([(u, 0) for u in want], table.schema)
                      .filter(table.bucket().isin(touched)).collect()} if want else set()
            assert held == {u: want[u] for u in inside}
            table.replace(ends.unionByName(last.join(ends, "user_id", "left_anti")), n)
        want |= {u: n for u in users}
        most = max(most, len(table.folders(spark)))
    assert most <= 2 * 4
    whole = table.before(spark, 50, list(range(4)))
    assert {r.user_id: r.event_ms for r in whole.collect()} == want


def test_streaming_job(spark, tmp_path):
    lines = [message(i, f"u{i % 3}", 10.0 * i, T0 + timedelta(seconds=40 * i)) for i in range(60)] + ["broken"]
    write_files(tmp_path / "in", [lines])
    root = str(tmp_path / "out")
    started = stream_plan.run(readers.file_messages(spark, str(tmp_path / "in")), root, every=None)
    sinks.drain(*started.values())
    assert set(started) == {"features-5m", "features-15m", "features-1h", "enriched-transactions", "quarantine"}
    first = json.loads(spark.read.text(f"{root}/enriched-transactions").orderBy("value").first().value)
    assert set(first) == {"transaction", "ms_since_last_txn", "is_first_txn"}
    assert spark.read.text(f"{root}/enriched-transactions").count() == 60
    wire = json.loads(spark.read.text(f"{root}/features-5m").first().value)
    assert list(wire) == WINDOW_FEATURES.fieldNames() and isinstance(wire["window_start"], int)
    assert spark.read.parquet(f"{root}/quarantine").first().reason == "bad json"
    again = readers.file_messages(spark, f"{root}/enriched-transactions")
    sinks.drain(stream_plan.enriched_table(again, f"{root}/files", f"{root}/files-cp", every=None))
    assert spark.read.parquet(f"{root}/files").select("transaction.user_id").distinct().count() == 3
    # the published windows become a typed table, also when there are none
    back = readers.feature_stream(spark.read.text(f"{root}/features-5m"))
    assert sinks.export_windows(back, f"{root}/exports/features_5m") == back.count() > 0
    assert sinks.export_windows(back.limit(0), f"{root}/exports/none") == 0
    assert spark.read.parquet(f"{root}/exports/none").schema == WINDOW_FEATURES


def test_landing_and_raw_lake(spark, tmp_path):
    write_files(tmp_path / "in", [[message(1, "u", 1.0, T0)], [message(2, "u", 2.0, T0 + timedelta(days=1)), "{{"]])
    path = str(tmp_path / "lake")
    stream = readers.file_messages(spark, str(tmp_path / "in"), 1)
    sinks.drain(stream_plan.land(stream, path, str(tmp_path / "cp"), every=None))
    assert readers.raw_lake(spark, path).count() == 2
    days = spark.read.parquet(path).select("event_date").distinct().count()
    assert days == 2
    # a filter on the day reaches the listing of files
    one = readers.raw_lake(spark, path).filter("event_date = date'2025-01-16'")
    assert [r.transaction_id for r in one.collect()] == ["t2"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_lake_days_are_compacted_and_show_new_columns(spark, tmp_path):
    path, target = str(tmp_path / "lake"), str(tmp_path / "days")
    batches = [[message(100 * k + i, f"u{i}", 1.0 + i, T0 + timedelta(days=i % 3)) for i in range(60)] for k in range(5)]
    write_files(tmp_path / "in", batches)
    stream = readers.file_messages(spark, str(tmp_path / "in"), 1)
    sinks.drain(stream_plan.land(stream, path, str(tmp_path / "cp"), every=None))
    lake = readers.raw_lake(spark, path)
    first, second = T0.date(), T0.date() + timedelta(days=1)
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert 5 <= files(lake.filter(F.col("event_date") == first)) <= 5 * 8
    sinks.compact_days(lake, target, [first, second])
    compact = readers.raw_lake(spark, target)
    assert files(compact) == 2 and compact.count() == 200
    sinks.compact_days(lake, target, [second], file_bytes=4000)
    again = readers.raw_lake(spark, target)
    assert files(again.filter(F.col("event_date") == first)) == 1 and files(again.filter(F.col("event_date") == second)) > 3
    assert again.exceptAll(lake).count() == 0 and again.count() == 200
    # a column that came later
    late = again.filter(F.col("event_date") == second).withColumn("channel", F.lit("app"))
    late.drop("event_date").write.parquet(f"{target}/event_date=2025-02-01")
    merged = readers.raw_lake(spark, target, merge=True)
    assert {r.channel: r["count"] for r in merged.groupBy("channel").count().collect()} == {None: 200, "app": 100}
    assert readers.raw_lake(spark, target).columns == lake.columns


def test_files_roll_by_size_and_empty_triggers_leave_none(spark, tmp_path):
    rows = [[message(1000 * k + i, "u", 1.0, T0, "x" * 200) for i in range(n)] for k, n in enumerate((400, 4, 400))]
    write_files(tmp_path / "in", rows)
    good, _ = dec.decode(readers.file_messages(spark, str(tmp_path / "in"), 1))
    out = str(tmp_path / "out")
    sinks.drain(sinks.roll_table(good, out, str(tmp_path / "cp"), every=None, file_bytes=40_000))
    table = spark.read.parquet(out)
    assert table.count() == 804
    per_file = table.groupBy("version", F.input_file_name().alias("f")).count().collect()
    assert len([r for r in per_file if r.version == 1]) == 1
    assert all(r["count"] <= 150 for r in per_file) and len(per_file) >= 7
    # a stream that has nothing to say writes nothing
    none = good.filter("amount < 0")
    sinks.drain(sinks.roll_table(none, str(tmp_path / "none"), str(tmp_path / "cp2"), every=None))
    assert not sinks.exists(spark, str(tmp_path / "none"))


def test_ingest_and_compaction(spark, tmp_path):
    rows = [("u", 1, 5.0), ("w", 1, 1.0), ("u", 3, 7.0), ("u", 2, 6.0)]
    columns = [f for f in WINDOW_FEATURES.fieldNames()]
    lines = []
    for user, minute, total in rows:
        rec = dict.fromkeys(columns)
        rec.update(user_id=user, window_end=minute * 60000, txn_sum=total, window_label="5m")
        lines.append([json.dumps(rec)])
    write_files(tmp_path / "in", lines)
    empty = spark.createDataFrame([], WINDOW_FEATURES)
    view = realtime_view(empty)
    stream = readers.feature_stream(readers.file_messages(spark, str(tmp_path / "in"), 1))
    store, other = str(tmp_path / "store"), str(tmp_path / "store2")
    sinks.drain(ing.ingest(stream, view, store, str(tmp_path / "cp")))
    want = {"u": 7.0, "w": 1.0}
    assert {r.user_id: r.txn_sum for r in ing.current(spark, view, store, WINDOW_FEATURES).collect()} == want
    ing.compact(spark, view, store, WINDOW_FEATURES, other)
    assert {r.user_id: r.txn_sum for r in ing.current(spark, view, other, WINDOW_FEATURES).collect()} == want
    assert sinks.newest_version(spark, other) == sinks.newest_version(spark, store)
    assert sinks.newest_version(spark, str(tmp_path / "nowhere")) is None


SF = "/root/testdata/sf0.001"


def seconds(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def test_batch_train_and_score(spark, tmp_path):
    raw = fx.transactions(spark, SF).drop("event_ts")
    layout, mirror = bf.Layout(str(tmp_path / "a")), bf.Layout(str(tmp_path / "b"))
    types = [*fx.EVENT_TYPES, "purchase"]
    with pytest.raises(AssertionError, match="accepted_values"):
        bf.run(spark, raw, layout, seconds("2024-01-10"), categories=fx.EVENT_TYPES)
    assert not sinks.exists(spark, layout.export("user_daily_features"))
    counts = bf.run(spark, raw, layout, seconds("2024-01-10"), mirror, categories=types)
    assert counts["user_daily_features"] == counts["user_rolling_features"] > 0
    exported = spark.read.parquet(mirror.export("user_daily_features"))
    assert dict(exported.dtypes)["event_date"] == "timestamp" and exported.count() == counts["user_daily_features"]

    bf.run(spark, raw, layout, seconds("2024-01-31"), categories=types)
    daily, rolling = bf.register_views(spark, layout)
    live = bf.online_table(spark, daily, layout)
    newest = daily.df.groupBy("user_id").agg(F.max("event_date").alias("_ts"))
    assert live.select("user_id", "_ts").exceptAll(newest).count() == 0 and live.count() == newest.count()

    config = TrainingConfig(boosted_trees=False, reg_params=(0.01,))
    model, metrics = train_plan.train(spark, layout, config)
    assert {"test_accuracy", "val_loss", "train_pos_weight", "model"} <= set(metrics)
    assert spark.read.parquet(layout.table("run_features")).count() == 13

    requests = spark.createDataFrame(
        [(live.first().user_id, "r1", 20.0, datetime(2024, 1, 31)), ("user_unknown", "r2", 1.0, None)],
        "user_id string, transaction_id string, amount double, event_timestamp timestamp_ntz",
    )
    predictions, rejects = train_plan.score_requests(spark, requests, layout, version="7")
    p = predictions.first()
    assert predictions.count() == 1 and p.transaction_id == "r1" and 0 <= p.anomaly_score <= 1
    assert p.is_anomaly == (p.anomaly_score >= 0.5) and p.model_version == "7"
    assert rejects.first().transaction_id == "r2" and "daily_txn_count" in rejects.first().error
    assert train_plan.publish_predictions(predictions, layout) == 1
    assert train_plan.model_info(layout, spark, 0.3).first().anomaly_threshold == 0.3
