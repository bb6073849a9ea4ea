"""Feature streams into the latest-value store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.featureview import FeatureView
from tidemark.sources import sinks

_VERSION = T.StructField("version", T.LongType())


def latest_rows(rows: DataFrame, keys: tuple[str, ...], ts_col: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c != ts_col]
    newest = rows.groupBy(*keys).agg(F.max(F.struct(ts_col, *rest)).alias("_row"))
    return newest.select(*keys, "_row.*")


def ingest(features: DataFrame, view: FeatureView, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the latest row per key of each trigger as one version of the store.

    A trigger writes only the keys it saw, so its cost follows the stream and not the
    size of the store. Readers take the latest row over all versions; ``compact``
    folds them into one now and then. Repeating a trigger replaces its own version.
    """
    wanted = [*view.keys, view.ts_col, *view.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_version(latest_rows(batch.select(*wanted), view.keys, view.ts_col), path, batch_id)

    writer = features.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def current(spark: SparkSession, view: FeatureView, path: str, schema: T.StructType) -> DataFrame:
    """Latest row per key over all versions, in the layout of a snapshot (``_ts``)."""
    wanted = T.StructType([f for f in schema.fields if f.name in (*view.keys, view.ts_col, *view.fields)])
    rows = spark.read.schema(wanted).parquet(path)
    return latest_rows(rows, view.keys, view.ts_col).withColumnRenamed(view.ts_col, "_ts")


def compact(spark: SparkSession, view: FeatureView, path: str, schema: T.StructType, target: str) -> None:
    """Fold all versions into a new store; the old one can be dropped once readers have moved."""
    newest = sinks.newest_version(spark, path)
    if newest is not None:
        rows = current(spark, view, path, schema).withColumnRenamed("_ts", view.ts_col)
        sinks.write_version(rows, target, newest)
