"""Streaming twins of the window and velocity features."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions.scalar import floor_div, interval, micros
from tidemark.operators.velocity import velocity_columns, with_previous
from tidemark.operators.windows import finish
from tidemark.schemas import HIGH_AMOUNT, WINDOW_SIZES
from tidemark.sources import sinks
from tidemark.sources.buckets import BucketTable

# How late a record may arrive.
LATENESS = timedelta(seconds=5)


# A cell of time holds the milliseconds in which records fell as the bits of one number.
CELL_MS = 60


def _in_cells(txns: DataFrame) -> DataFrame:
    """A record's cell of time, its millisecond there, its numbers and the values to be counted."""
    ms = F.unix_millis("event_ts")
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in ("category", "merchant_id", "device_type")])
    return txns.select(
        "user_id",
        "event_ts",
        floor_div(ms, CELL_MS).alias("cell"),
        F.pmod(ms, F.lit(CELL_MS)).cast("int").alias("bit"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        values.alias("record"),
    )


def _cell_aggregates(high_amount: float) -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum("amount").alias("total"),
        F.max("amount").alias("top"),
        F.min("amount").alias("low"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(F.col("amount") > high_amount).alias("highs"),
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"),
        F.collect_set("record").alias("records"),
    ]


def _with_cell_times(cells: DataFrame) -> DataFrame:
    """First and last millisecond of a cell and its least gap between neighbours, from its mask."""
    mask, at = F.col("mask"), F.col("cell") * CELL_MS
    first = at + F.bit_count(mask.bitwiseAND(-mask) - 1)
    last = at + F.length(F.bin(mask)) - 1
    apart = F.expr(f"array_min(filter(sequence(1, {CELL_MS - 1}), d -> (mask & shiftright(mask, d)) != 0))")
    near = F.when(F.col("n") > F.bit_count(mask), F.lit(0)).when(F.bit_count(mask) > 1, apart)
    return cells.withColumns({"first": first, "last": last, "near": near})


def _per_user(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells summed up to the features of a user; null counts as a value."""
    agg = cells.groupBy("user_id", *keys).agg(
        F.sum("n").alias("txn_count"),
        F.sum("total").alias("txn_sum"),
        F.max("top").alias("txn_max"),
        F.min("low").alias("txn_min"),
        F.min("first").alias("first_ms"),
        F.max("last").alias("last_ms"),
        F.min("near").alias("near"),
        F.collect_list(F.struct("first", "last")).alias("cells"),
        F.flatten(F.collect_list("records")).alias("records"),
        F.sum("anomalies").alias("anomaly_count"),
        F.sum("highs").alias("high_amount_count"),
    )
    counted = {"unique_categories": "category", "unique_merchants": "merchant_id", "unique_devices": "device_type"}
    return agg.withColumns({name: F.size(F.array_distinct(F.col("records")[c])) for name, c in counted.items()})


def _min_gap() -> Column:
    """The least gap within a cell or between neighbouring cells."""
    cells, others = F.array_sort("cells"), F.size("cells") - 1
    between = F.zip_with(F.slice(cells, 2, others), F.slice(cells, 1, others), lambda after, before: after["first"] - before["last"])
    return F.when(others > 0, F.least(F.col("near"), F.array_min(between))).otherwise(F.col("near"))


def with_lateness(txns: DataFrame, lateness: timedelta = LATENESS) -> DataFrame:
    return txns.withWatermark("event_ts", interval(lateness))


def stream_window_features(
    txns: DataFrame,
    label: str,
    size: timedelta | None = None,
    slide: timedelta | None = None,
    lateness: timedelta = LATENESS,
    high_amount: float = HIGH_AMOUNT,
    computed_at: Column | None = None,
) -> DataFrame:
    """Window features of a transaction stream, one row per closed window (append mode).

    Two event-time aggregates follow each other. The state of the first is one row per user, window and cell of time, with
    its numbers and the distinct values of its records, so a record makes one state row a window, a busy user is spread over
    the cluster and no state row outgrows what falls in 60 ms. When the watermark closes a window its rows go on to the
    second aggregate, which sums them up per user and closes the window in the same trigger; it holds at most one pair of
    times and the values of each cell of the window. A late record counts in all windows that are still open. (Panes
    shared by all sizes would close before the windows that cover them and lose such records.) Where the state outgrows
    the heap, start the query under ``rocksdb_state``.
    """
    if size is None:
        minutes = {name: (s, g) for name, s, g in WINDOW_SIZES}[label]
        size, slide = (timedelta(minutes=m) for m in minutes)
    span = F.window("event_ts", interval(size), interval(slide or size))
    cells = _in_cells(with_lateness(txns, lateness))
    cells = cells.groupBy("user_id", span.alias("w"), "cell").agg(*_cell_aggregates(high_amount))
    agg = _per_user(_with_cell_times(cells), "w").withColumn("min_gap", _min_gap())
    return finish(agg.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}), label, computed_at)


class _PreviousTime(StatefulProcessor):
    """Keeps the time of a user's previous record."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last_ms", T.StructType([T.StructField("ms", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.state.get()[0] if self.state.exists() else None
        for chunk in rows:
            if chunk.empty:
                continue
            ms = chunk["event_ms"].astype("Int64")
            before = ms.shift(1)
            if last is not None:
                before.iloc[0] = last
            last = int(ms.iloc[-1])
            yield chunk.assign(_delta=ms - before)
        if last is not None:
            self.state.update((last,))

    def close(self) -> None:
        pass


def _with_event_ms(txns: DataFrame) -> DataFrame:
    return txns if "event_ms" in txns.columns else txns.withColumn("event_ms", F.unix_millis("event_ts"))


def stream_velocity(txns: DataFrame, strict_first: bool = False) -> DataFrame:
    """Add the gap to the user's previous record, kept as keyed state.

    Records are taken as they arrive, chunk by chunk, so a user's records are never
    gathered; a late record yields a negative gap. Where several tasks read the source,
    only the records of each of them are sure to keep their order: ``ordered_velocity_table``
    takes event or offset order instead. Reads ``event_ms`` as ``decode``
    gives it. Needs the RocksDB state store.
    """
    rows = _with_event_ms(txns)
    schema = T.StructType([*rows.schema.fields, T.StructField("_delta", T.LongType())])
    keyed = rows.groupBy("user_id").transformWithStateInPandas(
        _PreviousTime(), outputStructType=schema, outputMode="Append", timeMode="None"
    )
    return keyed.withColumns(velocity_columns(F.col("_delta"), strict_first)).drop("_delta")


def ordered_velocity(
    rows: DataFrame, last: DataFrame | None, order: tuple[str, ...], strict_first: bool, bucket: timedelta | int
) -> tuple[DataFrame, DataFrame]:
    """The records of one trigger with their gaps, and the last ``event_ms`` of each user in it.

    ``last`` has that of earlier triggers. It joins in as one row per user ahead of all others.
    """
    seeded = rows.withColumn("_seed", F.lit(False))
    if last is not None:
        seeds = last.select("user_id", "event_ms", F.lit(True).alias("_seed"))
        seeded = seeded.unionByName(seeds, allowMissingColumns=True)
    first = F.unix_micros("event_ts") if order[0] == "event_ts" else F.col(order[0]).cast("bigint")
    seeded = seeded.withColumns({"_real": ~F.col("_seed"), "_at": first})
    cut = floor_div(F.col("_at"), micros(bucket) if isinstance(bucket, timedelta) else bucket)
    linked = with_previous(seeded, "event_ms", ("_at", "_real", *order[1:]), cut).filter("_real")
    linked = linked.withColumns(velocity_columns(F.col("event_ms") - F.col("_prev"), strict_first))
    ends = rows.groupBy("user_id").agg(F.max_by("event_ms", F.struct(*order)).alias("event_ms"))
    return linked.select(*rows.columns, "ms_since_last_txn", "is_first_txn"), ends


def ordered_velocity_table(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    order: tuple[str, ...] = ("event_ts", "transaction_id"),
    strict_first: bool = False,
    bucket: timedelta | int = timedelta(hours=1),
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream with its gaps to a Parquet table, the records of each trigger in ``order``.

    The first order column is event time (then ``bucket`` is a duration) or an arrival number
    such as an offset (then ``bucket`` is a count); the rest break ties. Spark sorts a trigger
    split by user and bucket, so no task holds all records of a user and no rate limit is
    needed. A record that comes a trigger late has its gap, a negative one, to the last record
    of the triggers before. Each trigger is one version of the table; repeating it replaces its own.
    The last times of users lie beside the checkpoint in hash buckets, of which a trigger reads and
    replaces those of its own users.
    """
    rows = _with_event_ms(txns)
    state = BucketTable(f"{checkpoint.rstrip('/')}-last", "user_id string, event_ms long", "user_id")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            touched = [r[0] for r in batch.select(state.bucket()).distinct().collect()]
            last = state.before(batch.sparkSession, batch_id, touched)
            linked, ends = ordered_velocity(batch, last, order, strict_first, bucket)
            sinks.write_version(linked, path, batch_id)
            if last is not None:
                ends = ends.unionByName(last.join(ends, last["user_id"].eqNullSafe(ends["user_id"]), "left_anti"))
            if touched:
                state.replace(ends, batch_id)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
