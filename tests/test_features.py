from datetime import date, timedelta
from decimal import Decimal

import pytest
from helpers import brute_windows, epoch_ms, frame, random_txns, ts, txn, window_rows
from pyspark.sql import functions as F

from tidemark.operators import decode as dec
from tidemark.operators.daily import daily_features, rolling_features
from tidemark.operators.skew import hot_groups, with_pieces
from tidemark.operators.staging import staging
from tidemark.operators.velocity import text_form, velocity
from tidemark.operators.windows import session_features, window_features

MIN = timedelta(minutes=1)


def one(spark, rows):
    out = window_features(frame(spark, rows), 10 * MIN).collect()
    assert len(out) == 1
    return out[0]


def test_single(spark):
    r = one(spark, [txn(1, "u", 100.0, 0)])
    assert (r.txn_count, r.txn_sum, r.txn_max, r.txn_min, r.txn_avg) == (1, 100, 100, 100, 100)
    assert (r.unique_categories, r.unique_merchants, r.anomaly_count, r.high_amount_count) == (1, 1, 0, 0)
    assert (r.avg_inter_txn_ms, r.min_inter_txn_ms) == (0, 0)


def test_three(spark):
    r = one(spark, [
        txn(1, "u", 50.0, 0, "a", "m1"), txn(2, "u", 150.0, 1, "b", "m2", anomaly=True), txn(3, "u", 75.0, 2, "a", "m1"),
    ])
    assert (r.txn_sum, r.txn_max, r.txn_min) == (275, 150, 50)
    assert r.txn_avg == pytest.approx(91.667, abs=0.001)
    assert (r.unique_categories, r.unique_merchants, r.anomaly_count, r.high_amount_count) == (2, 2, 1, 0)


def test_high_amounts(spark):
    r = one(spark, [txn(1, "u", 100.0, 0), txn(2, "u", 500.0, 1, anomaly=True), txn(3, "u", 1000.0, 2, anomaly=True)])
    assert (r.high_amount_count, r.anomaly_count) == (2, 2)


@pytest.mark.parametrize("times, avg, low", [((0, 60, 120), 60000, 60000), ((0, 10, 60), 30000, 10000)])
def test_gaps(spark, times, avg, low):
    r = one(spark, [txn(i, "u", 1.0, t) for i, t in enumerate(times)])
    assert (r.avg_inter_txn_ms, r.min_inter_txn_ms) == (avg, low)


def test_ratio(spark):
    assert one(spark, [txn(i, "u", a, i) for i, a in enumerate((10.0, 10.0, 100.0))]).max_amount_ratio == 2.5


def test_merge_of_partials(spark):
    r = one(spark, [
        txn(1, "u", 50.0, 0, "a", "m1"), txn(2, "u", 100.0, 65, "b", "m2", anomaly=True), txn(3, "u", 200.0, 130, "c", "m3"),
    ])
    assert (r.txn_count, r.txn_sum, r.txn_max, r.txn_min) == (3, 350, 200, 50)
    assert (r.unique_categories, r.unique_merchants, r.anomaly_count) == (3, 3, 1)


def test_empty(spark):
    assert window_features(frame(spark, []), 10 * MIN).count() == 0


def test_zero_amounts_and_missing_values(spark):
    r = one(spark, [(f"t{i}", "u", None, None, None, None, None, ts(i)) for i in range(2)])
    assert (r.txn_sum, r.txn_avg, r.max_amount_ratio) == (0, 0, 0)
    assert (r.unique_categories, r.unique_merchants, r.unique_devices, r.anomaly_count) == (1, 1, 1, 0)


@pytest.mark.parametrize("size, slide", [(5, 1), (15, 5), (60, 15), (10, 10), (7, 3), (2, 5), (31, 1), (32, 1), (60, 1), (97, 13), (1440, 60)])
@pytest.mark.parametrize("parts", [1, 17])
def test_windows_equal_brute_force(spark, size, slide, parts):
    rows = random_txns(400, seed=size * 100 + slide)
    got = window_features(frame(spark, rows, parts), size * MIN, slide * MIN)
    assert window_rows(got) == brute_windows(rows, size * 60000, slide * 60000)


def test_any_number_of_panes(spark):
    rows = random_txns(120, seed=5, span=300)
    got = window_features(frame(spark, rows), timedelta(seconds=1200), timedelta(seconds=7))
    assert window_rows(got) == brute_windows(rows, 1_200_000, 7_000)
    day = window_features(frame(spark, rows[:40]), timedelta(days=1), MIN)
    assert window_rows(day) == brute_windows(rows[:40], 86_400_000, 60_000)
    with pytest.raises(ValueError):
        window_features(frame(spark, []), timedelta(days=1), timedelta(0))


def test_panes_of_a_busy_user_are_looked_up_in_buckets(spark):
    """Records of 600 minutes, with values that come back after a window, one short of it, and across a bucket's border."""
    rows = [txn(i, "hot" if i % 3 else None, 1.0 + i % 700, 20.0 * i, f"c{i % 7}", f"m{i % 181}", f"d{i // 900}") for i in range(1800)]
    got = window_features(frame(spark, rows), 40 * MIN, 3 * MIN)
    assert window_rows(got) == brute_windows(rows, 2_400_000, 180_000)


def test_windows_before_1970(spark):
    rows = [(*r[:7], r[7] - timedelta(days=365 * 60)) for r in random_txns(60, 3, span=900)]
    assert window_rows(window_features(frame(spark, rows), 5 * MIN, MIN)) == brute_windows(rows, 300000, 60000)


def test_sessions(spark):
    rows = [txn(i, "u", 1.0, t) for i, t in enumerate((0, 30, 100, 1000, 1010))]
    out = session_features(frame(spark, rows), timedelta(minutes=5)).orderBy("window_start").collect()
    assert [(r.txn_count, r.min_inter_txn_ms) for r in out] == [(3, 30000), (2, 10000)]


@pytest.mark.parametrize("bucket", [timedelta(seconds=20), timedelta(hours=1)])
def test_sessions_equal_brute_force(spark, bucket):
    rows, gap = random_txns(300, seed=6), 45_000
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: r[7]):
        ms = epoch_ms(r[7])
        seen = last.get(r[1])
        start = seen[0] if seen and ms - seen[1] <= gap else ms
        last[r[1]] = (start, ms)
        s = want.setdefault((r[1], start), [0, set(), None])
        s[0] += 1
        s[1].add(r[3])
        if start != ms or s[0] > 1:
            s[2] = min(x for x in (s[2], ms - seen[1]) if x is not None)
    out = session_features(frame(spark, rows), timedelta(milliseconds=gap), bucket=bucket)
    got = {
        (r.user_id, epoch_ms(r.window_start)): [r.txn_count, r.unique_categories, r.min_inter_txn_ms]
        for r in out.collect()
    }
    assert got == {k: [n, len(c), float(g or 0)] for k, (n, c, g) in want.items()}


def brute_velocity(rows):
    out, last = {}, {}
    for r in sorted(rows, key=lambda r: (r[7], r[0])):
        ms = epoch_ms(r[7])
        out[r[0]] = ms - last[r[1]] if r[1] in last else -1
        last[r[1]] = ms
    return out


@pytest.mark.parametrize("bucket", [timedelta(seconds=7), timedelta(minutes=10), timedelta(days=3)])
def test_velocity_equals_brute_force(spark, bucket):
    rows = random_txns(500, seed=5)
    got = {r.transaction_id: r.ms_since_last_txn for r in velocity(frame(spark, rows), bucket=bucket).collect()}
    assert got == brute_velocity(rows)


def test_rows_without_a_user_follow_each_other_across_buckets(spark):
    for user in ("u", None, ""):
        rows = [txn(i, user, 1.0, t) for i, t in enumerate((0, 18000, 18000 + 2400, 90000))] + [txn(9, "w", 1.0, 5)]
        for bucket in (timedelta(minutes=1), timedelta(hours=1), timedelta(days=2)):
            got = velocity(frame(spark, rows), bucket=bucket).orderBy("transaction_id").collect()
            assert [r.ms_since_last_txn for r in got] == [-1, 18000000, 2400000, 69600000, -1]
            out = session_features(frame(spark, rows), timedelta(hours=2), bucket=bucket)
            assert sorted(r.txn_count for r in out.collect()) == [1, 1, 1, 2]


def test_velocity_in_arrival_order(spark):
    df = frame(spark, [txn(i, "u", 1.0, t) for i, t in enumerate((0, 60, 420, 30))])
    df = df.withColumn("offset", F.expr("cast(substring(transaction_id, 2) as bigint)"))
    for bucket in (1, 2, 100):
        got = velocity(df, ("offset",), bucket=bucket).orderBy("offset").collect()
        assert [r.ms_since_last_txn for r in got] == [-1, 60000, 360000, -390000]
        assert [r.is_first_txn for r in got] == [True, False, False, True]
    strict = velocity(df, ("offset",), strict_first=True, bucket=2).orderBy("offset").collect()
    assert [r.is_first_txn for r in strict] == [True, False, False, False]


@pytest.mark.parametrize("rows_per_group", [40, 400])
def test_a_busy_hour_is_cut_into_pieces(spark, rows_per_group):
    """One user has most records of one hour; every piece is sorted alone and results stay."""
    rows = random_txns(900, seed=12, span=1800, hot=0.8)
    txns = frame(spark, rows)
    shown = lambda df: sorted(map(repr, df.collect()))
    assert shown(velocity(txns, rows_per_group=rows_per_group)) == shown(velocity(txns))
    cut = session_features(txns, timedelta(seconds=20), rows_per_group=rows_per_group).drop("computed_at")
    assert shown(cut) == shown(session_features(txns, timedelta(seconds=20)).drop("computed_at"))
    us = txns.withColumn("us", F.unix_micros("event_ts"))
    pieces = with_pieces(us, ["user_id"], "us", rows_per_group=rows_per_group)
    groups = pieces.groupBy("user_id", "_piece").agg(F.count("*").alias("n"), F.min("us").alias("lo"), F.max("us").alias("hi"))
    found = sorted((r.user_id, r["_piece"], r.lo, r.hi, r.n) for r in groups.collect())
    assert max(r[4] for r in found) <= 2 * rows_per_group
    hot = [r for r in found if r[0] == "hot"]
    assert len(hot) > 1 and all(a[3] < b[2] for a, b in zip(hot, hot[1:]))


def test_pieces_of_nulls_and_ties(spark):
    rows = [(None, 5)] * 50 + [("a", None)] * 30 + [("a", 1)] * 30 + [("a", 2)] * 3 + [("b", 1)]
    df = spark.createDataFrame(rows, "k string, t long")
    got = with_pieces(df, ["k"], "t", rows_per_group=10)
    assert got.count() == len(rows)
    by = {(r.k, r.t): r["_piece"] for r in got.distinct().collect()}
    assert by["b", 1] == 0 and by["a", None] == 0 and by["a", 1] <= by["a", 2]
    assert hot_groups(df, ["k"], 1000) is None and hot_groups(df.limit(0), ["k"], 1) is None


def test_text_form(spark):
    line = text_form(velocity(frame(spark, [txn(1, "u", 2.5, 0)]))).first().value
    assert line == "EnrichedTransaction{userId='u', amount=2.5, msSinceLast=-1, first=true}"


GOOD = (
    '{"transaction_id":"t1","user_id":"u1","amount":149.99,"currency":"USD","category":"books","merchant_id":"m",'
    '"timestamp":"2025-01-15T12:00:00Z","is_anomaly":true,"session_id":"s","device_type":"mobile","location_country":"US"}'
)


def decoded(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    good, bad = dec.decode(df)
    return good.collect(), {r.reason for r in bad.collect()}


def test_decode_golden(spark):
    (r,), bad = decoded(spark, GOOD)
    assert not bad and r.event_ms == 1736942400000 and r.amount == 149.99 and r.is_anomaly is True


@pytest.mark.parametrize(
    "old, new, amount, anomaly",
    [
        ('"currency"', '"extra":{"a":1},"other":[1],"currency"', 149.99, True),
        ("149.99", '"149.99"', 149.99, True),
        ('"amount":149.99,', "", 0.0, True),
        ('"is_anomaly":true,', "", 149.99, False),
        ('"is_anomaly":true', '"is_anomaly":"false"', 149.99, False),
        ("12:00:00Z", "14:00:00+02:00", 149.99, True),
    ],
)
def test_decode_tolerance(spark, old, new, amount, anomaly):
    (r,), bad = decoded(spark, GOOD.replace(old, new))
    assert not bad and (r.amount, r.is_anomaly, r.event_ms) == (amount, anomaly, 1736942400000)


@pytest.mark.parametrize(
    "value, reason",
    [
        ("not valid json", "bad json"),
        ("", "bad json"),
        ("[1, 2]", "bad json"),
        (None, "empty"),
        (GOOD.replace("149.99", '"lots"'), "bad value"),
        (GOOD.replace("2025-01-15T12:00:00Z", "yesterday"), "bad timestamp"),
        (GOOD.replace('"user_id":"u1",', ""), "no key"),
    ],
)
def test_decode_quarantine(spark, value, reason):
    good, bad = decoded(spark, value)
    assert not good and bad == {reason}


def test_decode_bytes(spark):
    df = spark.createDataFrame([(GOOD.encode(),), (b"\xff\xfe" + GOOD.encode(),)], "value binary")
    good, bad = dec.decode(df)
    assert good.count() == 1 and bad.first().reason == "bad encoding"


def test_landing_keeps_nulls(spark):
    df = spark.createDataFrame([('{"user_id":"u"}',), ("x",)], "value string")
    (r,) = dec.land_fields(df).collect()
    assert r.user_id == "u" and r.amount is None and r.is_anomaly is None


RAW = (
    "transaction_id string, user_id string, amount double, currency string, category string, merchant_id string, "
    "timestamp string, is_anomaly boolean, session_id string, device_type string, location_country string"
)


def raw(i, user, amount, at, category="a", anomaly=False):
    return (f"t{i}", user, amount, "USD", category, "m", at, anomaly, "s", "mobile", "US")


def test_staging(spark):
    rows = [
        raw(1, "u", 10.0, "2025-01-15T23:30:00-01:00"),
        raw(1, "u", 99.0, "2025-01-15T23:30:01-01:00"),
        raw(2, "u", 10.239, "2025-01-12T08:00:00Z"),
    ]
    out = {r.transaction_id: r for r in staging(spark.createDataFrame(rows, RAW)).collect()}
    assert len(out) == 2 and out["t1"].amount == Decimal("10.00")
    assert (out["t1"].event_date, out["t1"].event_hour) == (date(2025, 1, 16), 0)
    assert out["t2"].event_dow == 0 and out["t2"].amount == Decimal("10.24")


def test_staging_needs_its_columns(spark):
    with pytest.raises(ValueError, match="amount"):
        staging(spark.createDataFrame([("t",)], "transaction_id string"))


def test_daily_and_rolling(spark):
    rows = [raw(i, "u", 10.0 * (i + 1), f"2025-01-{d:02d}T0{i % 5}:00:00Z", anomaly=i == 3)
            for i, d in enumerate((1, 1, 2, 9, 10))]
    daily = daily_features(staging(spark.createDataFrame(rows, RAW)))
    first = daily.orderBy("event_date").first()
    assert (first.daily_txn_count, float(first.daily_txn_sum), first.daily_txn_avg) == (2, 30.0, 15.0)
    assert (first.first_txn_hour, first.last_txn_hour, first.has_anomaly) == (0, 1, 0)
    by_rows = [r.rolling_7d_txn_count for r in rolling_features(daily).orderBy("event_date").collect()]
    by_date = rolling_features(daily, frame="calendar").orderBy("event_date").collect()
    assert by_rows == [2, 3, 4, 5]
    assert [r.rolling_7d_txn_count for r in by_date] == [2, 3, 1, 2]
    assert by_date[2].rolling_30d_avg_amount == pytest.approx((15 + 30 + 40) / 3)
    with pytest.raises(ValueError):
        rolling_features(daily, frame="weeks")


def test_tasks_that_copy_panes_grow_with_the_rows(spark, monkeypatch):
    from tidemark.operators import windows

    monkeypatch.setattr(windows, "COPIES_PER_TASK", 600)
    few, many = random_txns(40, seed=3), random_txns(400, seed=3)
    plans = [window_features(frame(spark, r), 60 * MIN, MIN)._jdf.queryExecution().logical().toString() for r in (few, many)]
    cores = spark.sparkContext.defaultParallelism
    assert "RepartitionByExpression" in plans[1] and f", {max(cores, 4)}" in plans[0] and ", 40" in plans[1]
    out = window_features(frame(spark, many), 60 * MIN, MIN)
    assert window_rows(out) == brute_windows(many, 3_600_000, 60_000)


def test_copies_of_panes_are_summed_up_where_they_are_made(spark):
    rows = [txn(i, f"u{i % 3}", 1.0 + i, 1800.0 * i, merchant=f"m{i % 7}") for i in range(60)]
    out = window_features(frame(spark, rows), 60 * MIN, MIN)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # read from the result down: the copies are made before the first exchange is met
    assert plan.index("Generate explode") < plan.index("Exchange")
    assert window_rows(out) == brute_windows(rows, 3_600_000, 60_000)
