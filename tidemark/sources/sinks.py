"""Writers for batches and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalar import parse_iso
from tidemark.operators.decode import encode, to_wire
from tidemark.operators.velocity import nested
from tidemark.schemas import PREDICTION_COLUMNS, RAW_TRANSACTION, WINDOW_FEATURES

# Triggers of the stream job and of lake landing; files roll at 5 minutes, after 2 idle minutes or at 128 MB.
CHECKPOINT_EVERY = "30 seconds"
LAND_EVERY = "15 seconds"
ROLL_EVERY = "5 minutes"
IDLE_EVERY = "2 minutes"
ROLL_BYTES = 128 << 20


# -- streams


def _start(df: DataFrame, checkpoint: str, every: str | None, mode: str = "append"):
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def publish(
    values: DataFrame, checkpoint: str, *, topic: str | None = None, servers: str | None = None,
    path: str | None = None, every: str | None = CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Send a ``value`` stream to a topic, or as text lines to a folder, which hold the same names over and over: gzipped."""
    writer = _start(values, checkpoint, every)
    if path is not None:
        return writer.format("text").option("compression", "gzip").start(path)
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).start()


def publish_features(features: DataFrame, checkpoint: str, **target) -> StreamingQuery:
    return publish(encode(to_wire(features)), checkpoint, **target)


def publish_enriched(enriched: DataFrame, checkpoint: str, **target) -> StreamingQuery:
    fields = [f.name for f in RAW_TRANSACTION.fields]
    return publish(encode(nested(enriched, fields)), checkpoint, **target)


def stream_table(df: DataFrame, path: str, checkpoint: str, every: str | None = ROLL_EVERY) -> StreamingQuery:
    """Append a stream to a Parquet table, one set of files per trigger; exactly once."""
    return _start(df, checkpoint, every).format("parquet").start(path)


def sized(batch: DataFrame, file_bytes: int) -> DataFrame:
    """The rows dealt over as many partitions as files of about ``file_bytes`` need, by their size as JSON."""
    fields = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    total = batch.agg(F.sum(F.octet_length(F.to_json(fields)).cast("long"))).first()[0] or 0
    return batch.repartition(max(1, -(-total // file_bytes)))


def roll_table(
    df: DataFrame, path: str, checkpoint: str, every: str | None = IDLE_EVERY, file_bytes: int = ROLL_BYTES
) -> StreamingQuery:
    """Append a stream to a Parquet table in files of about ``file_bytes``, one version of the table per trigger.

    Nothing stays open between triggers: what came in is a finished file after ``every``, so a quiet stream is flushed
    as soon as a busy one, and a trigger without rows leaves no file. Repeating a trigger replaces its own version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                write_version(sized(batch, file_bytes), path, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def with_landing_date(records: DataFrame) -> DataFrame:
    return records.withColumn("event_date", F.to_date(parse_iso(F.col("timestamp"))))


def land(
    records: DataFrame, path: str, checkpoint: str, every: str | None = LAND_EVERY, pieces: int = 8
) -> StreamingQuery:
    """Append raw records to the lake, partitioned by event date: at most ``pieces`` files per date and trigger."""
    piece = F.pmod(F.xxhash64("transaction_id", "timestamp"), F.lit(pieces))
    clustered = with_landing_date(records).repartition(F.col("event_date"), piece)
    return _start(clustered, checkpoint, every).partitionBy("event_date").format("parquet").start(path)


def compact_days(lake: DataFrame, target: str, days: list[date], file_bytes: int = ROLL_BYTES) -> None:
    """Rewrites whole days of a lake into files of about ``file_bytes`` at ``target``.

    Only the given days are read, and only theirs are replaced there; a day that got late records is compacted again.
    """
    rows = lake.filter(F.col("event_date").isin(days))
    fields = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    sizes = rows.groupBy("event_date").agg(F.sum(F.octet_length(F.to_json(fields)).cast("long")).alias("n")).collect()
    files = {r["event_date"]: max(1, -(-r["n"] // file_bytes)) for r in sizes}
    if files:
        number = F.create_map(*[F.lit(x) for pair in files.items() for x in pair])[F.col("event_date")]
        piece = F.pmod(F.xxhash64(*rows.columns), number)
        rows = rows.repartition(sum(files.values()), F.col("event_date"), piece)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("event_date").parquet(target)


def drain(*queries: StreamingQuery) -> None:
    """Wait for bounded streams; a failed one raises."""
    for q in queries:
        q.awaitTermination()


# -- batches


def write_table(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> None:
    """Full refresh of a table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def counted_write(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write and return the number of rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return seen.get["n"]


def write_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def dated(df: DataFrame) -> DataFrame:
    """``event_date`` as a UTC timestamp, as feature exports carry it."""
    return df.withColumn("event_date", F.col("event_date").cast("timestamp"))


def export_features(df: DataFrame, *paths: str) -> list[int]:
    """Export a feature table to every target; the later ones copy the first."""
    counts = [counted_write(dated(df), paths[0])]
    written = df.sparkSession.read.parquet(paths[0]) if paths[1:] else None
    return counts + [counted_write(written, p) for p in paths[1:]]


def export_windows(df: DataFrame, path: str) -> int:
    """Window features under their declared types; without rows one typed empty file is left."""
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WINDOW_FEATURES.fields])
    return counted_write(typed, path)


def export_entity_rows(df: DataFrame, path: str) -> int:
    return counted_write(df, path)


def write_index(vectors: DataFrame, path: str) -> int:
    """Full refresh of a vector index."""
    return counted_write(vectors, path)


def write_predictions(predictions: DataFrame, path: str, mode: str = "append") -> int:
    return counted_write(predictions.select(*PREDICTION_COLUMNS), path, mode)


def publish_batch(values: DataFrame, *, topic: str | None = None, servers: str | None = None, path: str | None = None):
    if path is not None:
        values.select("value").write.mode("append").text(path)
    else:
        writer = values.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", topic).save()


# -- versions of a snapshot, so that a table is never overwritten while it is read


def write_version(df: DataFrame, path: str, version: int) -> None:
    """One folder per version; writing a version again replaces it, which makes retries safe."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _fs(spark, path)
    return fs.exists(jvm_path)


def newest_version(spark: SparkSession, path: str) -> int | None:
    """Largest complete version, by listing folder names."""
    if not exists(spark, path):
        return None
    fs, jvm_path = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    marks = [int(n.partition("=")[2]) for n in names if n.startswith("version=")]
    return max((m for m in marks if exists(spark, f"{path}/version={m}/_SUCCESS")), default=None)
