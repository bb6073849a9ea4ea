"""Sliding and tumbling window features over a batch of transactions."""

from __future__ import annotations

from datetime import timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import floor_div, micros, millis, ratio
from tidemark.operators.skew import ROWS_PER_GROUP
from tidemark.operators.velocity import USER, with_previous
from tidemark.schemas import HIGH_AMOUNT, WINDOW_SIZES

_BITS = 63
# rows that one task makes from panes
COPIES_PER_TASK = 1 << 20
# grouping_id() of the four grouping sets below
_BY_TIME, _BY_CATEGORY, _BY_MERCHANT, _BY_DEVICE = 0b0111, 0b1011, 0b1101, 0b1110
_DIMENSIONS = ("ms", "category", "merchant_id", "device_type")


def finish(agg: DataFrame, label: str, computed_at: Column | None = None) -> DataFrame:
    """Derived columns shared by the batch and the streaming form.

    Needs window_start, window_end, txn_count, txn_sum, txn_max, txn_min, first_ms,
    last_ms, min_gap, the distinct counts and the risk counts.
    """
    n = F.col("txn_count")
    avg = ratio(F.col("txn_sum"), n)
    gap = F.when(n > 1, (F.col("last_ms") - F.col("first_ms")) / (n - 1)).otherwise(F.lit(0.0))
    stamp = F.current_timestamp() if computed_at is None else computed_at
    return agg.select(
        "user_id",
        "window_start",
        "window_end",
        F.lit(label).alias("window_label"),
        "txn_count",
        "txn_sum",
        avg.alias("txn_avg"),
        "txn_max",
        "txn_min",
        F.col("unique_categories").cast("bigint").alias("unique_categories"),
        F.col("unique_merchants").cast("bigint").alias("unique_merchants"),
        F.col("unique_devices").cast("bigint").alias("unique_devices"),
        gap.alias("avg_inter_txn_ms"),
        F.coalesce(F.col("min_gap").cast("double"), F.lit(0.0)).alias("min_inter_txn_ms"),
        "anomaly_count",
        ratio(F.col("txn_max"), avg).alias("max_amount_ratio"),
        "high_amount_count",
        stamp.alias("computed_at"),
    )


def window_features(
    txns: DataFrame,
    size: timedelta,
    slide: timedelta | None = None,
    label: str | None = None,
    high_amount: float = HIGH_AMOUNT,
    ts_col: str = "event_ts",
    computed_at: Column | None = None,
) -> DataFrame:
    """Features per user and window; ``slide=None`` gives tumbling windows.

    Copying each row into every window it falls in would multiply the input by
    size/slide (and by four for the distinct counts). Instead time is cut into panes
    (the common divisor of size and slide) and runs of panes into chunks; a few
    panes at the start of a chunk are also handed to the chunk before, so that each
    window lies within one chunk.

    1. One grouping-sets aggregate reduces a chunk to one row per user and distinct
       millisecond (sums, counts) and one per distinct category, merchant and device;
       the panes in which a value occurs are a bit mask. All buffers are fixed-width
       and combine before the shuffle, so a busy user is reduced on the map side and
       spread over the cluster by value.
    2. The reduced rows meet per (user, chunk), where gaps between neighbours are
       taken and each row is expanded to the windows its mask hits. A group holds at
       most one row per millisecond of the chunk plus its distinct values.

    Windows of more than half a mask of panes are made by ``_from_panes`` instead, which has no bound on their number.
    """
    slide = size if slide is None else slide
    size_ms, slide_ms = millis(size), millis(slide)
    if size_ms <= 0 or slide_ms <= 0:
        raise ValueError("window size and slide must be positive")
    pane_ms = gcd(size_ms, slide_ms)
    k, step = size_ms // pane_ms, slide_ms // pane_ms
    rows = txns.select(
        "user_id",
        F.coalesce(F.col("amount"), F.lit(0.0)).cast("double").alias("amount"),
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        "category",
        "merchant_id",
        "device_type",
        F.unix_millis(F.col(ts_col).cast("timestamp")).alias("ms"),
    ).filter(F.col("ms").isNotNull())
    rows = rows.withColumn("pane", floor_div(F.col("ms"), pane_ms))
    by_masks = k <= _BITS // 2 and (_BITS - max(k - step, 0)) // step > 0
    agg = (_from_masks if by_masks else _from_panes)(rows, k, step, pane_ms, high_amount)
    agg = agg.withColumn("window_start", F.timestamp_millis("start_ms"))
    agg = agg.withColumn("window_end", F.timestamp_millis(F.col("start_ms") + size_ms))
    return finish(agg, f"{size_ms // 60000}m" if label is None else label, computed_at)


def _facts(rows: DataFrame, keys: list[str], high_amount: float, *more: Column) -> DataFrame:
    """One row per key and distinct millisecond, category, merchant and device."""
    sets = [[*keys, c] for c in _DIMENSIONS]
    return rows.groupingSets(sets, *keys, *_DIMENSIONS).agg(
        F.grouping_id().alias("gid"),
        F.count("*").alias("n"),
        F.sum("amount").alias("total"),
        F.max("amount").alias("top"),
        F.min("amount").alias("low"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(F.col("amount") > high_amount).alias("highs"),
        *more,
    )


def _from_masks(rows: DataFrame, k: int, step: int, pane_ms: int, high_amount: float) -> DataFrame:
    halo = max(k - step, 0)
    chunk_panes = (_BITS - halo) // step * step
    rows = rows.withColumn("bit", F.pmod("pane", F.lit(chunk_panes)).cast("int"))
    rows = rows.withColumn("chunk", floor_div(F.col("pane"), chunk_panes))
    if halo:
        own = F.struct(F.col("chunk"), F.col("bit"))
        before = F.struct((F.col("chunk") - 1).alias("chunk"), (F.col("bit") + chunk_panes).alias("bit"))
        slots = F.when(F.col("bit") < halo, F.array(own, before)).otherwise(F.array(own))
        keep = [c for c in rows.columns if c not in ("pane", "chunk", "bit")]
        rows = rows.select(*keep, F.inline(slots))

    keys = ["user_id", "chunk"]
    facts = _facts(
        rows, keys, high_amount,
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"), F.min("bit").alias("first_bit"), F.max("bit").alias("last_bit"),
    )

    # rows of the time set sort first: their grouping id is the smallest
    by_chunk = Window.partitionBy(*keys).orderBy("gid", "ms")
    facts = facts.withColumn("prev_ms", F.lag("ms").over(by_chunk))
    lowest = F.greatest(F.col("first_bit") - (k - 1), F.lit(0))
    first = F.floor((lowest + step - 1) / step).cast("int") * step
    last = F.floor(F.least(F.col("last_bit"), F.lit(chunk_panes - step)) / step).cast("int") * step
    hits = F.when(first <= last, F.sequence(first, last, F.lit(step)))
    spread = facts.select("*", F.explode(hits).alias("at")).filter(
        F.expr(f"(shiftright(mask, at) & {(1 << k) - 1}L) != 0")
    )
    start_ms = (F.col("chunk") * chunk_panes + F.col("at")) * pane_ms
    is_time = F.col("gid") == _BY_TIME
    gap = F.when(F.col("n") > 1, F.lit(0)).when(F.col("prev_ms") >= start_ms, F.col("ms") - F.col("prev_ms"))

    def timed(c: str | Column) -> Column:
        return F.when(is_time, F.col(c) if isinstance(c, str) else c)

    agg = spread.groupBy(*keys, "at").agg(
        F.sum(timed("n")).alias("txn_count"),
        F.sum(timed("total")).alias("txn_sum"),
        F.max(timed("top")).alias("txn_max"),
        F.min(timed("low")).alias("txn_min"),
        F.count_if(F.col("gid") == _BY_CATEGORY).alias("unique_categories"),
        F.count_if(F.col("gid") == _BY_MERCHANT).alias("unique_merchants"),
        F.count_if(F.col("gid") == _BY_DEVICE).alias("unique_devices"),
        F.min(timed("ms")).alias("first_ms"),
        F.max(timed("ms")).alias("last_ms"),
        F.min(timed(gap)).alias("min_gap"),
        F.sum(timed("anomalies")).alias("anomaly_count"),
        F.sum(timed("highs")).alias("high_amount_count"),
    )
    return agg.withColumn("start_ms", start_ms)


def _parts(rows: DataFrame, copies: int) -> int:
    """Partitions of which each makes about ``COPIES_PER_TASK`` rows, if every row is copied so often."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() * copies // COPIES_PER_TASK))


def _from_panes(rows: DataFrame, k: int, step: int, pane_ms: int, high_amount: float) -> DataFrame:
    """Windows of any number of panes.

    A pane is summed up to one row before it is copied to the windows that cover it. A distinct value is counted by its
    first occurrence in a window: a pane that holds it counts for the windows that start after the value's previous pane,
    so each value reaches a window once; values of a pane that count for the same windows become one number. In the same
    way the gap between the first record of a pane and the record before it counts for windows that cover both. A window
    belongs to the bucket of panes it starts in, so the first ``k - 1`` panes of a bucket are also handed to the one before.
    Rows meet per (user, bucket) before they are copied, and the copies are summed up where they are made: no copy is
    shuffled. The tasks that copy are as many as the copies need, by a count of the rows ahead.
    """
    parts = _parts(rows, -(-k // step))
    facts = _facts(rows, ["user_id", "pane"], high_amount)
    bucket_panes = max(4 * k, 256)
    bucket, place = floor_div(F.col("pane"), bucket_panes), F.pmod("pane", F.lit(bucket_panes))
    keys = ["user_id", "bucket"]

    def in_buckets(df: DataFrame) -> DataFrame:
        own, before = F.struct(bucket.alias("bucket")), F.struct((bucket - 1).alias("bucket"))
        return df.select(*df.columns, F.inline(F.when(place < k - 1, F.array(own, before)).otherwise(F.array(own))))

    def previous(value: str, *same: str) -> Column:
        return F.lag(value).over(Window.partitionBy(*same).orderBy("pane"))

    # the earliest and the latest start, in panes, of the windows of a bucket that cover a pane; greatest skips null
    lowest = F.greatest(F.col("pane") - (k - 1), F.col("bucket") * bucket_panes)
    highest = F.least(F.col("pane"), (F.col("bucket") + 1) * bucket_panes - 1)
    values = in_buckets(facts.filter(F.col("gid") != _BY_TIME).select("user_id", "pane", "gid", *_DIMENSIONS[1:]))
    same = (*keys, "gid", *_DIMENSIONS[1:])
    values = values.repartition(parts, *same).withColumn("lowest", F.greatest(lowest, previous("pane", *same) + 1))
    values = values.filter(F.col("lowest") <= highest).groupBy(*keys, "gid", "pane", "lowest").agg(F.count("*").alias("n"))

    inside = Window.partitionBy("user_id", "pane").orderBy("ms")
    times = facts.filter(F.col("gid") == _BY_TIME).withColumn("near", F.col("ms") - F.lag("ms").over(inside))
    panes = times.groupBy("user_id", "pane").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.max("top").alias("top"),
        F.min("low").alias("low"),
        F.sum("anomalies").alias("anomalies"),
        F.sum("highs").alias("highs"),
        F.min("ms").alias("first_ms"),
        F.max("ms").alias("last_ms"),
        F.min(F.when(F.col("n") > 1, F.lit(0)).otherwise(F.col("near"))).alias("near"),
    )
    panes = in_buckets(panes).withColumns({"gid": F.lit(_BY_TIME).cast(facts.schema["gid"].dataType), "lowest": lowest})
    both = panes.unionByName(values, allowMissingColumns=True).repartition(parts, *keys)
    both = both.withColumn("prev", previous("last_ms", *keys, "gid"))
    first = floor_div(F.col("lowest") + (step - 1), step) * step
    last = floor_div(highest, step) * step
    starts = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("bigint")))
    both = both.select("*", F.explode(starts).alias("start"))
    to_previous = F.when(F.col("prev") >= F.col("start") * pane_ms, F.col("first_ms") - F.col("prev"))

    def distinct(gid: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("gid") == gid, F.col("n"))), F.lit(0))

    agg = both.groupBy(*keys, "start").agg(
        F.sum(F.when(F.col("gid") == _BY_TIME, F.col("n"))).alias("txn_count"),
        F.sum("total").alias("txn_sum"),
        F.max("top").alias("txn_max"),
        F.min("low").alias("txn_min"),
        distinct(_BY_CATEGORY).alias("unique_categories"),
        distinct(_BY_MERCHANT).alias("unique_merchants"),
        distinct(_BY_DEVICE).alias("unique_devices"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
        F.min(F.least("near", to_previous)).alias("min_gap"),
        F.sum("anomalies").alias("anomaly_count"),
        F.sum("highs").alias("high_amount_count"),
    )
    return agg.withColumn("start_ms", F.col("start") * pane_ms)


def standard_window_features(txns: DataFrame, label: str, **options) -> DataFrame:
    """One of the three window sizes of the stream job."""
    for name, size, slide in WINDOW_SIZES:
        if name == label:
            return window_features(txns, timedelta(minutes=size), timedelta(minutes=slide), name, **options)
    raise ValueError(f"unknown window label: {label}")


def session_features(
    txns: DataFrame,
    gap: timedelta,
    label: str = "session",
    high_amount: float = HIGH_AMOUNT,
    ts_col: str = "event_ts",
    computed_at: Column | None = None,
    bucket: timedelta = timedelta(hours=1),
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """The same features per session: a user's records without a pause longer than ``gap``.

    A busy user may never pause, so a session is not gathered anywhere. Its start is
    carried through time buckets like the previous record, gaps are taken between
    neighbours, and the rest is an aggregate per (user, start) that combines before
    its shuffle.
    """
    rows = txns.select(
        "user_id",
        F.coalesce(F.col("amount"), F.lit(0.0)).cast("double").alias("amount"),
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        *[F.struct(c).alias(c) for c in ("category", "merchant_id", "device_type")],
        F.unix_micros(F.col(ts_col).cast("timestamp")).alias("us"),
    ).filter(F.col("us").isNotNull())
    rows = with_previous(rows, "us", ("us",), floor_div(F.col("us"), micros(bucket)), rows_per_group)
    opens = F.col("_prev").isNull() | (F.col("us") - F.col("_prev") > micros(gap))
    rows = rows.withColumn("opened", F.when(opens, F.col("us")))

    by_user = Window.partitionBy(*USER).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*USER, "_bucket").agg(F.max("opened").alias("_open"))
    starts = starts.select(*USER, "_bucket", F.max("_open").over(by_user).alias("_carried"))
    inside = Window.partitionBy(*USER, "_bucket").orderBy("us").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_open", F.max("opened").over(inside)).join(starts, [*USER, "_bucket"], "left")
    ms = floor_div(F.col("us"), 1000)
    near = F.when(F.col("opened").isNull(), ms - floor_div(F.col("_prev"), 1000))
    agg = rows.groupBy("user_id", F.coalesce("_open", "_carried").alias("start")).agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("txn_sum"),
        F.max("amount").alias("txn_max"),
        F.min("amount").alias("txn_min"),
        F.count_distinct("category").alias("unique_categories"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.count_distinct("device_type").alias("unique_devices"),
        F.min(ms).alias("first_ms"),
        F.max(ms).alias("last_ms"),
        F.max("us").alias("last_us"),
        F.min(near).alias("min_gap"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.count_if(F.col("amount") > high_amount).alias("high_amount_count"),
    )
    agg = agg.withColumn("window_start", F.timestamp_micros("start"))
    agg = agg.withColumn("window_end", F.timestamp_micros(F.col("last_us") + micros(gap)))
    return finish(agg, label, computed_at)
