"""Readers: message topics, the raw lake, feature tables, entity rows, text and vectors.

Connector formats are parameters. Topics need the Kafka connector on the class path;
``file_messages`` gives the same ``value`` contract over files of JSON lines.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import interval
from tidemark.operators.decode import from_wire
from tidemark.operators.featureview import FeatureView
from tidemark.schemas import LABEL, RAW_TRANSACTION, WINDOW_FEATURES, WINDOW_FEATURES_WIRE, require_columns


# Topics of the stream job.
RAW_TOPIC = "raw-transactions"
ENRICHED_TOPIC = "enriched-transactions"
FEATURE_TOPICS = {"5m": "features-5m", "15m": "features-15m", "1h": "features-1h"}


def topic_stream(
    spark: SparkSession, servers: str, topic: str = RAW_TOPIC, starting: str = "latest", group: str | None = None,
    max_per_trigger: int | None = None, **options: str,
) -> DataFrame:
    """Unbounded read of a topic: value, partition and offset."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting).options(**options)
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select("value", "partition", "offset")


def topic_batch(spark: SparkSession, servers: str, topic: str, starting="earliest", ending="latest") -> DataFrame:
    """Bounded read of a topic: everything between two offsets, which drains it without an idle timer."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return (
        reader.option("startingOffsets", starting).option("endingOffsets", ending).load()
        .select("value", "partition", "offset")
    )


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines of a folder as a stream of messages."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def raw_lake(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Landed transactions with ``event_date``, by which the files are partitioned and a filter prunes them.

    Files written before a column existed give null for it. ``merge`` also shows columns that only some files have, beyond
    those declared.
    """
    declared = T.StructType([*RAW_TRANSACTION.fields, T.StructField("event_date", T.DateType())])
    if not merge:
        return spark.read.schema(declared).parquet(path)
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    more = [f for f in found.fields if f.name not in declared.fieldNames()]
    return spark.read.schema(T.StructType([*RAW_TRANSACTION.fields, *more, declared["event_date"]])).parquet(path)


def feature_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def window_table(spark: SparkSession, path: str) -> DataFrame:
    return feature_table(spark, path, WINDOW_FEATURES)


def file_view(spark: SparkSession, path: str, like: FeatureView) -> FeatureView:
    """A view over an exported table."""
    return FeatureView(like.name, like.keys, like.ts_col, like.ttl, like.fields, feature_table(spark, path))


def feature_stream(messages: DataFrame, delay: timedelta = timedelta(minutes=5)) -> DataFrame:
    """Window features from their topic, with a watermark on the window end."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), WINDOW_FEATURES_WIRE).alias("v")).select("v.*")
    rows = from_wire(parsed.filter(F.col("user_id").isNotNull() & F.col("window_end").isNotNull()))
    return rows.withWatermark("window_end", interval(delay)) if rows.isStreaming else rows


def entity_rows(spark: SparkSession, path: str) -> DataFrame:
    """Labelled entity rows from CSV or Parquet; ``event_date`` stands in for a missing event time."""
    rows = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    if "event_timestamp" not in rows.columns:
        if "event_date" not in rows.columns:
            raise ValueError("entity rows need a time: event_timestamp, or event_date in its place")
        rows = rows.withColumn("event_timestamp", F.col("event_date"))
    require_columns(rows.columns, ("user_id", "event_timestamp", LABEL), "entity rows")
    return rows.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        F.col(LABEL).cast("int").alias(LABEL),
    )


def text_documents(spark: SparkSession, root: str, relative_paths: list[str]) -> DataFrame:
    """``(path, text)`` of the listed files; those that do not exist are skipped."""
    root = root.rstrip("/")
    pattern = "{" + ",".join(relative_paths) + "}" if len(relative_paths) > 1 else relative_paths[0]
    try:
        files = spark.read.text(f"{root}/{pattern}", wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, text string")
    path = F.regexp_replace(F.col("_metadata.file_path"), rf"^.*\Q{root}/\E", "")
    return files.select(path.alias("path"), F.col("value").alias("text"))


def vector_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def peek(messages: DataFrame, count: int = 5, value_col: str = "value") -> DataFrame:
    """First messages of a topic; what is no JSON object is shown as its first 200 characters."""
    text = F.col(value_col).cast("string")
    parsed = F.try_parse_json(text)
    shown = F.when(parsed.isNotNull(), F.to_json(parsed)).otherwise(F.substring(text, 1, 200))
    keep = [c for c in ("partition", "offset") if c in messages.columns]
    return messages.limit(count).select(*keep, shown.alias("message"), parsed.isNotNull().alias("is_json"))
