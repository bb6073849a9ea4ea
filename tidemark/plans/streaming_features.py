"""The streaming feature job and lake landing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.decode import decode, land_fields
from tidemark.schemas import RAW_TRANSACTION, WINDOW_SIZES
from tidemark.session import rocksdb_state
from tidemark.sources import readers, sinks
from tidemark.streaming.features import stream_velocity, stream_window_features


def run(
    messages: DataFrame, root: str, *, servers: str | None = None, every: str | None = sinks.CHECKPOINT_EVERY
) -> dict[str, StreamingQuery]:
    """Start one query per output: three window streams, enriched records and the quarantine.

    With ``servers`` the streams go to their topics, otherwise to folders below
    ``root``. ``every=None`` drains what is there and stops.
    """
    good, bad = decode(messages)

    def check(name: str) -> str:
        return f"{root}/checkpoints/{name}"

    def target(name: str) -> dict:
        return {"servers": servers, "topic": name} if servers else {"path": f"{root}/{name}"}

    started = {}
    with rocksdb_state(messages.sparkSession):
        for label, _, _ in WINDOW_SIZES:
            topic = readers.FEATURE_TOPICS[label]
            feats = stream_window_features(good, label)
            started[topic] = sinks.publish_features(feats, check(topic), every=every, **target(topic))
        enriched = stream_velocity(good)
        topic = readers.ENRICHED_TOPIC
        started[topic] = sinks.publish_enriched(enriched, check(topic), every=every, **target(topic))
    started["quarantine"] = sinks.stream_table(bad, f"{root}/quarantine", check("quarantine"), every)
    return started


def enriched_table(
    published: DataFrame, path: str, checkpoint: str, every: str | None = sinks.IDLE_EVERY, file_bytes: int = sinks.ROLL_BYTES
):
    """Write the published enriched records to files of bounded size, so that their state is kept only once."""
    record = T.StructType(
        [
            T.StructField("transaction", RAW_TRANSACTION),
            T.StructField("ms_since_last_txn", T.LongType()),
            T.StructField("is_first_txn", T.BooleanType()),
        ]
    )
    rows = published.select(F.from_json(F.col("value").cast("string"), record).alias("v")).select("v.*")
    return sinks.roll_table(rows, path, checkpoint, every, file_bytes)


def land(messages: DataFrame, path: str, checkpoint: str, every: str | None = sinks.LAND_EVERY) -> StreamingQuery:
    """Raw messages to the lake."""
    return sinks.land(land_fields(messages), path, checkpoint, every)
