"""Shards by weighted rendezvous hashing.

For every shard a record draws a number from the hash of its key and the shard's name; the smallest of -ln(u)/weight
wins. A record's shard depends on its key and the shards alone, shares follow the weights, and one more shard takes
records only into itself. Only DataFrame functions are used.

Slots number the records of a shard without gaps: records go to ``buckets`` by a digest of key, size and checksum,
bucket sizes are summed up per shard, and each record adds its rank inside its bucket. So no task holds a shard, and what
moves is a narrow row per record, never the text. A hot key is spread over the buckets by its texts; equal records are
counted before the shuffle and take a run of slots, so a record that repeats without end is one row until the last step,
where its run is cut into pieces for many tasks.

Edge cases: a null key is a key of its own and shares one shard. Records with equal keys meet in one shard. Columns other
than key and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import materialise

# hexadecimal digits of a digest in a draw: 48 bits are exact in a double
DIGITS = 12
BUCKETS = 4096
RUN = 1 << 16


def key_text(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))


def draw(key: Column, shard: Column) -> Column:
    """A number inside (0, 1) for a key and a shard."""
    digest = F.md5(F.concat_ws("/", key_text(key), shard.cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return (number + 0.5) / float(16**DIGITS)


def place(key: Column, weights: list[float]) -> Column:
    """Struct of the winning ``shard`` and its ``cost``."""
    if not weights or any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("weights have to be positive numbers")
    shards = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(w)).alias("w")) for k, w in enumerate(weights)])
    return F.array_min(
        F.transform(shards, lambda s: F.struct((-F.log(draw(key, s["k"])) / s["w"]).alias("cost"), s["k"].alias("shard")))
    )


def bucket(key: Column, size: Column, checksum: Column, buckets: int = BUCKETS) -> Column:
    named = F.concat_ws("/", F.lit("bucket"), key_text(key), size.cast("string"), checksum.cast("string"))
    digest = F.md5(named.cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets).cast("int")


def assign(documents: DataFrame, weights: list[float], overhead: int = 8, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` (with one more shard of weight 1)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    new = len(weights)
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place(F.col("doc_id"), weights).alias("p"),
        (-F.log(draw(F.col("doc_id"), F.lit(new)))).alias("extra"),
    )
    rows = rows.select(
        "doc_id", "size", "text_crc32", F.col("p.shard").alias("shard"),
        F.when(F.col("extra") < F.col("p.cost"), new).otherwise(F.col("p.shard")).alias("grown_shard"),
    )
    # equal records combine on the map side
    record = ["doc_id", "size", "text_crc32", "shard", "grown_shard"]
    equal = rows.groupBy(*record).agg(F.count("*").alias("n"))
    equal = equal.withColumn("bucket", bucket(F.col("doc_id"), F.col("size"), F.col("text_crc32"), buckets))
    equal = materialise(equal, "records")
    # at most shards * buckets rows
    sizes = equal.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    ranked = equal.withColumn("rank", F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
    placed = ranked.join(base, ["shard", "bucket"]).withColumn("first", F.col("base") + F.col("rank"))
    # runs are cut into bounded pieces, and the pieces of a long run are dealt out
    ends = placed.withColumn("last", F.col("first") + F.col("n") - 1)
    starts = F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(RUN)))
    pieces = ends.filter(F.col("n") > RUN).select(*record, starts.alias("first"), "last").repartition("shard", "first")
    pieces = pieces.withColumn("last", F.least(F.col("last"), F.col("first") + (RUN - 1)))
    runs = ends.filter(F.col("n") <= RUN).select(*record, "first", "last").unionByName(pieces)
    slots = F.explode(F.sequence("first", "last"))
    return runs.select("doc_id", "size", "text_crc32", "shard", slots.alias("slot"), "grown_shard")
