"""A small keyed table beside a stream: hash buckets, of which a trigger replaces those it touched."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sinks import _fs

BUCKETS = 64


@dataclass(frozen=True)
class BucketTable:
    """Rows of ``schema`` in folders ``version=N/bucket=B``, the newest version of a bucket below a trigger is its state.

    A trigger reads and writes only the buckets of its own keys. What it supersedes is kept for one more version, so that a
    trigger that is repeated finds the state it started from; older folders are deleted. There are never more than about
    two folders a bucket, so the cost of a trigger depends on its keys and on the size of their buckets, not on how many
    triggers came before.
    """

    path: str
    schema: str
    key: str
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def folders(self, spark: SparkSession) -> list[tuple[int, int]]:
        """Version and bucket of every complete folder."""
        fs, root = _fs(spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for v in fs.listStatus(root):
            name = v.getPath().getName()
            names = [b.getPath().getName() for b in fs.listStatus(v.getPath())] if name.startswith("version=") else []
            if "_SUCCESS" in names:
                version = int(name.partition("=")[2])
                found += [(version, int(n.partition("=")[2])) for n in names if n.startswith("bucket=")]
        return found

    def before(self, spark: SparkSession, version: int, touched: list[int]) -> DataFrame | None:
        """The state of some buckets as it was before ``version``."""
        newest: dict[int, int] = {}
        for v, b in self.folders(spark):
            if v < version and b in touched:
                newest[b] = max(newest.get(b, v), v)
        if not newest:
            return None
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/version={v}/bucket={b}" for b, v in newest.items()])

    def replace(self, rows: DataFrame, version: int) -> None:
        """Writes whole buckets as ``version``; a repeated version replaces itself."""
        spark = rows.sparkSession
        shaped = rows.withColumn("bucket", self.bucket()).repartition("bucket")
        shaped.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/version={version}")
        kept: dict[int, list[int]] = {}
        for v, b in sorted(self.folders(spark)):
            kept.setdefault(b, []).append(v)
        live = set()
        for b, versions in kept.items():
            older = [v for v in versions if v < version]
            stale = older[:-1]
            live.update(v for v in versions if v not in stale)
            for v in stale:
                self._delete(spark, f"version={v}/bucket={b}")
        for v in {v for versions in kept.values() for v in versions} - live:
            self._delete(spark, f"version={v}")

    def _delete(self, spark: SparkSession, name: str) -> None:
        fs, path = _fs(spark, f"{self.path}/{name}")
        fs.delete(path, True)
