"""JSON records to typed transactions, with a quarantine for what cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import parse_iso
from tidemark.schemas import RAW_TRANSACTION

_CORRUPT = "_corrupt_record"
# amount and is_anomaly are read as text first, so that "149.99" counts as a number
_LENIENT = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name in ("amount", "is_anomaly") else f.dataType)
        for f in RAW_TRANSACTION.fields
    ]
    + [T.StructField(_CORRUPT, T.StringType())]
)


def _primitive(text: Column, kind: str, empty: Column) -> Column:
    return F.when(text.isNull() | (F.trim(text) == ""), empty).otherwise(text.try_cast(kind))


def _parsed(df: DataFrame, value_col: str) -> DataFrame:
    raw = F.col(value_col)
    text = raw.cast("string")
    rec = F.from_json(text, _LENIENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # exploding a single element keeps each record from being parsed once per field
    out = df.withColumn("_text", text).select("*", F.explode(F.array(rec)).alias("_rec"))
    amount = _primitive(F.col("_rec.amount"), "double", F.lit(0.0))
    anomaly = _primitive(F.col("_rec.is_anomaly"), "boolean", F.lit(False))
    out = out.withColumn("_amount", amount).withColumn("_anomaly", anomaly)
    out = out.withColumn("_ts", parse_iso(F.col("_rec.timestamp")))
    reason = (
        F.when(F.col("_text").isNull(), "empty")
        .when(~F.is_valid_utf8(F.col("_text")), "bad encoding")
        .when(F.col("_rec").isNull() | F.col(f"_rec.{_CORRUPT}").isNotNull(), "bad json")
        .when(F.col("_amount").isNull() | F.col("_anomaly").isNull(), "bad value")
        .when(F.col("_rec.user_id").isNull(), "no key")
        .when(F.col("_ts").isNull(), "bad timestamp")
    )
    return out.withColumn("reason", reason)


def decode(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Split a frame of JSON values into (transactions, quarantine).

    Unknown keys are ignored, missing ones become null; a missing amount is 0 and a
    missing anomaly flag false. Good rows carry the raw fields plus ``event_ts`` and
    ``event_ms``. Nothing fails on a bad record: it goes to the quarantine with a
    ``reason``. ``keep`` names further input columns (offsets) to carry along.
    """
    parsed = _parsed(df, value_col)
    fields = {f.name: F.col(f"_rec.{f.name}") for f in RAW_TRANSACTION.fields}
    fields["amount"], fields["is_anomaly"] = F.col("_amount"), F.col("_anomaly")
    good = parsed.filter(F.col("reason").isNull()).select(
        *keep,
        *[c.alias(name) for name, c in fields.items()],
        F.col("_ts").alias("event_ts"),
        F.unix_millis("_ts").alias("event_ms"),
    )
    bad = parsed.filter(F.col("reason").isNotNull()).select(
        *keep, F.col(value_col).cast("binary").alias("value"), "reason"
    )
    return good, bad


def land_fields(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Fixed-schema projection for the lake: missing keys become null, bad JSON is dropped."""
    parsed = _parsed(df, value_col)
    readable = parsed.filter(F.col("reason").isNull() | ~F.col("reason").isin("empty", "bad encoding", "bad json"))
    typed = {
        "amount": F.col("_rec.amount").try_cast("double"),
        "is_anomaly": F.col("_rec.is_anomaly").try_cast("boolean"),
    }
    return readable.select(
        *[typed.get(f.name, F.col(f"_rec.{f.name}")).alias(f.name) for f in RAW_TRANSACTION.fields]
    )


def encode(df: DataFrame, *, key: str | None = None) -> DataFrame:
    """Rows to a JSON ``value`` column; null fields are kept, as a consumer expects every key."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def to_wire(features: DataFrame) -> DataFrame:
    """Window features with their times as epoch milliseconds."""
    times = {c: F.unix_millis(c) for c in ("window_start", "window_end", "computed_at") if c in features.columns}
    return features.withColumns(times)


def from_wire(features: DataFrame) -> DataFrame:
    times = {c: F.timestamp_millis(c) for c in ("window_start", "window_end", "computed_at") if c in features.columns}
    return features.withColumns(times)
