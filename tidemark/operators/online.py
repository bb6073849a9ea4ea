"""Latest-value snapshots and request-time lookups."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import clip_lower, flag, interval
from tidemark.operators.featureview import FeatureView
from tidemark.schemas import (
    DAILY_VIEW,
    MODEL_FEATURES,
    MODEL_REFS,
    REQUEST,
    RISK_FEATURES,
    RISK_VIEW,
    ROLLING_VIEW,
    require_columns,
)


def as_time(value: datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def _latest(rows: DataFrame, keys: tuple[str, ...], fields: list[str]) -> DataFrame:
    # a plain max over (time, values): combines on the map side, ties take the larger values
    newest = rows.groupBy(*keys).agg(F.max(F.struct("_ts", *fields)).alias("_row"))
    return newest.select(*keys, "_row.*")


def snapshot(
    view: FeatureView,
    as_of: datetime | str | Column,
    previous: DataFrame | None = None,
    since: datetime | str | Column | None = None,
) -> DataFrame:
    """Latest row per key at or before ``as_of``: keys, ``_ts`` and the view's fields.

    With ``previous`` and its mark ``since`` only rows in (since, as_of] are read and
    merged into the previous snapshot.
    """
    fields = list(view.fields)
    rows = view.frame().filter(F.col("_ts") <= as_time(as_of))
    if since is not None:
        rows = rows.filter(F.col("_ts") > as_time(since))
    if previous is not None:
        rows = rows.unionByName(previous.select(*view.keys, "_ts", *fields))
    return _latest(rows, view.keys, fields)


def request_rows(requests: DataFrame, now: Column | None = None, strict: bool = True) -> DataFrame:
    """Add the request-time columns: amount, hour (of now when no time is given), gap (-1 when unknown)."""
    known = [f.name for f in REQUEST.fields]
    if strict and set(requests.columns) - set(known):
        raise ValueError(f"unexpected request columns: {', '.join(sorted(set(requests.columns) - set(known)))}")
    require_columns(requests.columns, ["user_id", "transaction_id", "amount"], "requests")
    at = F.coalesce(
        F.col("event_timestamp") if "event_timestamp" in requests.columns else F.lit(None).cast("timestamp"),
        F.current_timestamp() if now is None else now,
    )
    gap = F.col("ms_since_last_txn") if "ms_since_last_txn" in requests.columns else F.lit(None)
    return requests.withColumns(
        {
            "request_amount": F.col("amount").cast("float"),
            "request_hour": F.hour(at).cast("bigint"),
            "request_ms_since_last_txn": F.coalesce(gap.cast("bigint"), F.lit(-1)),
        }
    )


def wide_snapshot(snapshots: Mapping[FeatureView, DataFrame] | list[tuple[FeatureView, DataFrame]]) -> DataFrame:
    """All snapshots side by side, one row per user, columns ``view__feature`` and ``view__ts``.

    They are stacked and folded by key in one exchange; a chain of full outer joins
    would shuffle its growing result again for every view.
    """
    items = list(snapshots.items() if isinstance(snapshots, Mapping) else snapshots)
    keys = list(items[0][0].keys)
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [snap.select(*keys, F.struct("_ts", *v.fields).alias(v.name)) for v, snap in items],
    )
    folded = stacked.groupBy(*keys).agg(*[F.max(v.name).alias(v.name) for v, _ in items])
    times = [F.col(f"{v.name}._ts").alias(f"{v.name}__ts") for v, _ in items]
    return folded.select(
        *keys, *times, *[F.col(f"{v.name}.{c}").alias(f"{v.name}__{c}") for v, _ in items for c in v.fields]
    )


def online_lookup(
    requests: DataFrame,
    snapshots: list[tuple[FeatureView, DataFrame]],
    now: Column | None = None,
    enforce_ttl: bool = False,
) -> DataFrame:
    """Left join of requests and the latest features, columns ``view__feature``.

    The snapshots have one row per user and are lined up first, so the requests are
    shuffled once and a user with most of the requests can be split freely.
    """
    wide = wide_snapshot(snapshots)
    keys = list(snapshots[0][0].keys)
    out = requests.join(wide, keys, "left")
    at = F.coalesce("event_timestamp", F.current_timestamp() if now is None else now)
    drop = []
    for view, _ in snapshots:
        ts = f"{view.name}__ts"
        drop.append(ts)
        if enforce_ttl:
            alive = F.col(ts) >= at - F.expr(f"interval {interval(view.ttl)}")
            out = out.withColumns({f"{view.name}__{c}": F.when(alive, F.col(f"{view.name}__{c}")) for c in view.fields})
    return out.drop(*drop)


def risk_context(looked_up: DataFrame) -> DataFrame:
    """Request-time features: amount against the usual amounts, unusual hour, rapid repeat."""
    amount = F.col("request_amount").cast("double")

    def over(usual: str) -> Column:
        return (amount / clip_lower(F.col(usual).cast("double"), 1.0)).cast("float")

    hour = F.col("request_hour")
    # each comparison with an unknown value is false on its own
    before = flag(hour < F.col(f"{DAILY_VIEW}__first_txn_hour"))
    after = flag(hour > F.col(f"{DAILY_VIEW}__last_txn_hour"))
    gap = F.col("request_ms_since_last_txn")
    made = (
        over(f"{DAILY_VIEW}__daily_txn_avg"),
        over(f"{ROLLING_VIEW}__rolling_30d_avg_amount"),
        F.greatest(before, after),
        flag((gap >= 0) & (gap < 60_000)),
    )
    return looked_up.withColumns({f"{RISK_VIEW}__{n}": c for n, c in zip(RISK_FEATURES, made, strict=True)})


def reference_names(df: DataFrame, keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Columns ``view__feature`` renamed to ``view:feature``; the entity key is dropped."""
    return df.drop(*keys).withColumnsRenamed({c: c.replace("__", ":") for c in df.columns if "__" in c})


def model_input(looked_up: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Split into (rows with every model feature as double, rejects with the missing names)."""
    columns = {feature: ref.replace(":", "__") for feature, ref in zip(MODEL_FEATURES, MODEL_REFS, strict=True)}
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f)) for f, c in columns.items()]))
    marked = looked_up.withColumn("_missing", missing)
    good = marked.filter(F.size("_missing") == 0).select(
        *carry, *[F.col(c).cast("double").alias(f) for f, c in columns.items()]
    )
    text = F.concat(F.lit("Missing online features required for inference: "), F.array_join("_missing", ", "))
    rejects = marked.filter(F.size("_missing") > 0).select(*carry, text.alias("error"))
    return good, rejects
