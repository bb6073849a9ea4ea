"""Point-in-time lookup of feature views."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import floor_div, micros
from tidemark.operators.featureview import FeatureView, output_names, resolve_refs
from tidemark.operators.skew import ROWS_PER_GROUP, hot_groups, with_every_salt, with_salt


def default_bucket(ttl: timedelta) -> timedelta:
    return timedelta(days=8) if ttl >= timedelta(days=1) else ttl / 16


def _validity(view: FeatureView, columns: list[str], bucket_us: int) -> DataFrame:
    """Feature rows with the time span in which each is the newest, one copy per bucket touched.

    The end of a span is the start of the next row: the next one in the same bucket, or
    the first of the key's next bucket with rows, so that the history of one key is
    never sorted in one task. Spans of one key do not overlap, so the copies are bounded
    by the feature rows plus one per key and bucket of the lifetime. Of rows with the
    same key and time the largest wins; the others get an empty span.
    """
    f = view.frame(columns).filter(F.col("_ts").isNotNull()).withColumn("_from", F.unix_micros("_ts"))
    f = f.withColumn("_cut", floor_div(F.col("_from"), bucket_us))
    firsts = f.groupBy(*view.keys, "_cut").agg(F.min("_from").alias("_first"))
    by_key = Window.partitionBy(*view.keys).orderBy("_cut")
    following = firsts.select(*view.keys, "_cut", F.lead("_first").over(by_key).alias("_later"))
    inside = Window.partitionBy(*view.keys, "_cut").orderBy("_from", *columns)
    f = f.withColumn("_next", F.lead("_from").over(inside)).join(following, [*view.keys, "_cut"], "left")
    end = F.least(F.coalesce("_next", "_later") - 1, F.col("_from") + micros(view.ttl))
    f = f.select(*view.keys, *columns, "_from", end.alias("_to")).filter("_from <= _to")
    buckets = F.sequence(floor_div(F.col("_from"), bucket_us), floor_div(F.col("_to"), bucket_us))
    return f.withColumn("_bucket", F.explode(buckets))


def asof_join(
    spine: DataFrame,
    views: list[FeatureView],
    refs,
    ts_col: str = "event_timestamp",
    full_names: bool = False,
    bucket: timedelta | None = None,
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """For each spine row and view the newest feature row at or before ``ts_col``.

    Rows older than the view's lifetime count as absent; every spine row comes out
    exactly once, duplicates included. The lookup is an equi-join on (key, time
    bucket), so a user with a long history is spread over many tasks, and views with the
    same bucket length share the exchange of the spine. A (key, bucket) of more than
    ``rows_per_group`` spine rows is found by counting ahead: its rows are dealt over pieces and
    its feature rows, one per grid step of the bucket, are copied to each. Keys that are null meet
    nothing and are dealt out alike.
    """
    chosen = resolve_refs(refs, views)
    names = output_names(chosen, full_names)
    out = spine.withColumn("_at", F.unix_micros(F.col(ts_col).cast("timestamp")))
    extra, hot = ["_at"], {}
    for view in sorted((v for v in views if v.name in chosen), key=lambda v: bucket or default_bucket(v.ttl)):
        columns = chosen[view.name]
        width = micros(bucket or default_bucket(view.ttl))
        renamed = {c: names[view.name, c] for c in columns}
        f = _validity(view, columns, width).withColumnsRenamed(renamed)
        on = [*view.keys, f"_b{width}"]
        f = f.withColumnRenamed("_bucket", f"_b{width}")
        if f"_b{width}" not in extra:
            out = out.withColumn(f"_b{width}", floor_div(F.col("_at"), width))
            extra.append(f"_b{width}")
        group = tuple(on)
        if group not in hot:
            keyed = spine.withColumn(f"_b{width}", floor_div(F.unix_micros(F.col(ts_col).cast("timestamp")), width))
            hot[group] = hot_groups(keyed, on, rows_per_group)
            if hot[group] is not None:
                out = with_salt(out, hot[group], on, f"_salt{len(hot)}", rows_per_group)
        if hot[group] is not None:
            salt = f"_salt{list(hot).index(group) + 1}"
            f = with_every_salt(f, hot[group], on, salt, rows_per_group)
            on.append(salt)
        left, right = out.alias("s"), f.alias("f")
        same = [F.col(f"s.{c}") == F.col(f"f.{c}") for c in on]
        valid = F.col("s._at").between(F.col("f._from"), F.col("f._to"))
        kept = [F.col(f"s.{c}") for c in out.columns]
        out = left.join(right, [*same, valid], "left").select(*kept, *[F.col(f"f.{n}") for n in renamed.values()])
    ordered = [names[v, c] for v, cols in chosen.items() for c in cols]
    return out.select(*spine.columns, *ordered)
