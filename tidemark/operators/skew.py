"""Groups too large for one task: found by counting ahead, and split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one group that a task may get. Groups beyond it are split; at most MOST of them, the largest. Any further group
# has less than one in MOST of all rows.
ROWS_PER_GROUP = 1 << 20
MOST = 10_000
# borders inside a split group
CUTS = 255


def hot_groups(rows: DataFrame, keys: list[str], rows_per_group: int = ROWS_PER_GROUP) -> DataFrame | None:
    """Keys and row count ``_n`` of the groups beyond ``rows_per_group``, at most ``MOST`` rows; None if there are none.

    One pass over the keys, combined before its shuffle. What comes to the driver is bounded by ``MOST``.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_group)
    found = counts.orderBy(F.desc("_n")).limit(MOST).collect()
    return rows.sparkSession.createDataFrame(found, counts.schema) if found else None


def null_safe(left: str, right: str, keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return same


def with_hot(rows: DataFrame, hot: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """``columns`` of the (small) table of hot groups beside every row of theirs, null elsewhere."""
    joined = rows.alias("r").join(F.broadcast(hot).alias("h"), null_safe("r", "h", keys), "left")
    return joined.select("r.*", *[F.col(f"h.{c}").alias(c) for c in columns])


def with_salt(rows: DataFrame, hot: DataFrame, keys: list[str], name: str, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Deals the rows of a hot group round over pieces of about ``rows_per_group``; other rows have salt 0."""
    rows = with_hot(rows, hot, keys, "_n")
    pieces = F.coalesce(F.ceil(F.col("_n") / rows_per_group), F.lit(1))
    return rows.withColumn(name, F.pmod(F.monotonically_increasing_id(), pieces).cast("int")).drop("_n")


def with_every_salt(rows: DataFrame, hot: DataFrame, keys: list[str], name: str, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """The other side: a row of a hot group once for each of its pieces."""
    rows = with_hot(rows, hot, keys, "_n")
    last = F.coalesce(F.ceil(F.col("_n") / rows_per_group), F.lit(1)).cast("int") - 1
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), last))).drop("_n")


def with_pieces(
    rows: DataFrame, keys: list[str], order: str, name: str = "_piece", rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Numbers the pieces of hot groups in the order of the column ``order``, cut at its quantiles; other rows have 0.

    Rows equal in ``order`` stay together.
    """
    hot = hot_groups(rows, keys, rows_per_group)
    if hot is None:
        return rows.withColumn(name, F.lit(0))
    inside = rows.alias("r").join(F.broadcast(hot).alias("h"), null_safe("r", "h", keys)).select("r.*", "h._n")
    shares = F.array(*[F.lit(i / (CUTS + 1)) for i in range(1, CUTS + 1)])
    found = inside.groupBy(*keys).agg(F.percentile_approx(order, shares, F.lit(20_000)).alias("_cuts"), F.max("_n").alias("_n"))
    # no more pieces than needed: every s-th border
    step = F.greatest(F.floor((CUTS + 1) / F.ceil(F.col("_n") / rows_per_group)), F.lit(1)).cast("int")
    cuts = F.filter("_cuts", lambda c, i: (i + 1) % step == 0)
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("_cuts", T.ArrayType(rows.schema[order].dataType))])
    borders = rows.sparkSession.createDataFrame(found.select(*keys, F.array_distinct(cuts).alias("_cuts")).collect(), schema)
    rows = with_hot(rows, borders, keys, "_cuts")
    before = F.size(F.filter(F.col("_cuts"), lambda c: c < F.col(order)))
    return rows.withColumn(name, F.when(F.col("_cuts").isNotNull() & F.col(order).isNotNull(), before).otherwise(0)).drop("_cuts")
