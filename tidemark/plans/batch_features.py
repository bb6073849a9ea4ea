"""Batch feature run: models, data tests, exports and the latest-value store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.daily import daily_features, rolling_features
from tidemark.operators.entity import entity_rows
from tidemark.operators.featureview import FeatureView, daily_view, realtime_view, rolling_view
from tidemark.operators.online import snapshot
from tidemark.operators.staging import staging
from tidemark.schemas import CATEGORIES
from tidemark.sources import readers, sinks


@dataclass(frozen=True)
class Layout:
    """Folders of a feature store below one root."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def export(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/exports/{name}"

    def online(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/online/{name}"


def build_models(spark: SparkSession, raw: DataFrame, layout: Layout) -> dict[str, DataFrame]:
    """Staging as a view, daily and rolling features as tables; rolling reads the written daily table."""
    sinks.write_view(staging(raw), "stg_transactions")
    daily = daily_features(spark.table("stg_transactions"))
    sinks.write_table(daily, layout.table("user_daily_features"))
    daily = readers.feature_table(spark, layout.table("user_daily_features"), daily.schema)
    rolling = rolling_features(daily)
    sinks.write_table(rolling, layout.table("user_rolling_features"))
    rolling = readers.feature_table(spark, layout.table("user_rolling_features"), rolling.schema)
    return {"raw_transactions": raw, "user_daily_features": daily, "user_rolling_features": rolling}


def export_models(tables: dict[str, DataFrame], layout: Layout, mirror: Layout | None = None) -> dict[str, int]:
    """Export both feature tables to one or two targets; returns their row counts."""
    counts = {}
    for name in ("user_daily_features", "user_rolling_features"):
        targets = [t.export(name) for t in (layout, mirror) if t is not None]
        counts[name] = sinks.export_features(tables[name], *targets)[0]
    return counts


def register_views(spark: SparkSession, layout: Layout) -> list[FeatureView]:
    """Feature views over the exported tables; window features only once they exist."""
    views = [
        daily_view(readers.feature_table(spark, layout.export("user_daily_features"))),
        rolling_view(readers.feature_table(spark, layout.export("user_rolling_features"))),
    ]
    if sinks.exists(spark, layout.export("features_5m")):
        views.append(realtime_view(readers.window_table(spark, layout.export("features_5m"))))
    return views


def materialise_view(spark: SparkSession, view: FeatureView, layout: Layout, until: int) -> None:
    """Bring the latest-value table of a view forward to ``until`` (epoch seconds).

    Only rows after the previous mark are read; the result is a new version beside the
    old one, so a failed run leaves the store as it was.
    """
    path = layout.online(view.name)
    mark = sinks.newest_version(spark, path)
    if mark is not None and mark >= until:
        return
    previous = since = None
    if mark is not None:
        previous = spark.read.parquet(f"{path}/version={mark}")
        since = _at(mark)
    sinks.write_version(snapshot(view, _at(until), previous, since), path, until)


def _at(seconds: int) -> Column:
    return F.timestamp_seconds(F.lit(seconds))


def online_table(spark: SparkSession, view: FeatureView, layout: Layout) -> DataFrame:
    mark = sinks.newest_version(spark, layout.online(view.name))
    if mark is None:
        raise ValueError(f"{view.name} has not been materialised")
    return spark.read.parquet(f"{layout.online(view.name)}/version={mark}")


def run(
    spark: SparkSession, raw: DataFrame, layout: Layout, until: int, mirror: Layout | None = None,
    categories=CATEGORIES,
) -> dict[str, int]:
    """The whole batch run. A failed data test stops it before anything is exported."""
    tables = build_models(spark, raw, layout)
    tests = quality.model_tests(tables["user_daily_features"], categories)
    quality.assert_passed(quality.run_tests(tables, tests))
    counts = export_models(tables, layout, mirror)
    for view in register_views(spark, layout):
        materialise_view(spark, view, layout, until)
    return counts


def write_entity_rows(spark: SparkSession, layout: Layout) -> int:
    daily = readers.feature_table(spark, layout.table("user_daily_features"))
    return sinks.export_entity_rows(entity_rows(daily), layout.export("entity_rows"))
