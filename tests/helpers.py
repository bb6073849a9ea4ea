"""Small inputs and brute-force twins."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

T0 = datetime(2025, 1, 15, 12, 0, 0)
TXN = (
    "transaction_id string, user_id string, amount double, category string, merchant_id string, device_type string, "
    "is_anomaly boolean, event_ts timestamp_ntz"
)


def ts(seconds=0.0):
    return T0 + timedelta(seconds=seconds)


def txn(i, user, amount, seconds, category="a", merchant="m", device="mobile", anomaly=False):
    return (f"t{i}", user, amount, category, merchant, device, anomaly, ts(seconds))


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, TXN).repartition(parts)
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def random_txns(n, seed, span=7200, users=6, hot=0.4):
    """Some users, one of them with a large share; times repeat, some values are null."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rnd.random() < hot else f"u{rnd.randrange(users)}"
        at = rnd.randrange(span * 4) / 4 if rnd.random() < 0.9 else rnd.randrange(20) * 60.0
        rows.append(
            txn(
                i, user, round(rnd.uniform(1, 600), 2), at,
                rnd.choice(["a", "b", None]), f"m{rnd.randrange(5)}", rnd.choice(["x", "y"]), rnd.random() < 0.1,
            )
        )
    return rows


def epoch_ms(t):
    return int(t.replace(tzinfo=timezone.utc).timestamp() * 1000)


def brute_windows(rows, size_ms, slide_ms, high=300.0):
    groups = {}
    for r in rows:
        ms = epoch_ms(r[7])
        start = ms // slide_ms * slide_ms
        while start > ms - size_ms:
            groups.setdefault((r[1], start), []).append((ms, r))
            start -= slide_ms
    out = {}
    for key, items in groups.items():
        times = sorted(m for m, _ in items)
        amounts = [r[2] for _, r in items]
        gaps = [b - a for a, b in zip(times, times[1:])]
        avg = sum(amounts) / len(amounts)
        out[key] = (
            len(items), round(sum(amounts), 4), max(amounts), min(amounts),
            len({r[3] for _, r in items}), len({r[4] for _, r in items}), len({r[5] for _, r in items}),
            round(sum(gaps) / len(gaps), 4) if gaps else 0.0, float(min(gaps)) if gaps else 0.0,
            sum(r[6] for _, r in items), round(max(amounts) / avg, 6), sum(a > high for a in amounts),
        )
    return out


def window_rows(df):
    rows = df.select("*", F.unix_millis(F.col("window_start")).alias("ws")).collect()
    return {
        (r.user_id, r.ws): (
            r.txn_count, round(r.txn_sum, 4), r.txn_max, r.txn_min, r.unique_categories, r.unique_merchants,
            r.unique_devices, round(r.avg_inter_txn_ms, 4), r.min_inter_txn_ms, r.anomaly_count,
            round(r.max_amount_ratio, 6), r.high_amount_count,
        )
        for r in rows
    }
