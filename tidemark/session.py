"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What a cluster session should carry; sizes of partitions are left to AQE.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # chained lookups share one exchange; still split a hot key when one shows up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore"
# State is compressed well, and a small store reserves no space ahead.
ROCKSDB_CONF = {
    STATE_STORE_CONF: ROCKSDB_PROVIDER,
    f"{_STORE}.rocksdb.compression": "zstd",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    f"{_STORE}.compression.codec": "zstd",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Keyed processors need this state store when their query starts; the session gets its own settings back afterwards."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB_CONF}
    for name, value in ROCKSDB_CONF.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session.

    The folder comes from ``spark.checkpoint.dir``. Only a local master may go
    without it: a cluster needs a folder that every executor can reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the shared scratch area and read it back, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
