"""Aggregates over time buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.names import check_ident, parse_duration
from deq.functions.text import sorted_entries
from deq.operators.quantiles import exact_median
from deq.sources.points import flat_points

GRAINS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year", "all")


def bucket(ts: Column, interval: str, origin: str = "0s") -> Column:
    """The tumbling bucket ``{start, end}`` of a stamp, counted from 1970-01-01 plus ``origin``."""
    seconds = f"{parse_duration(interval)} seconds"
    return F.window(ts, seconds, seconds, f"{parse_duration(origin)} seconds")


def time_range(df: DataFrame, column: str, start=None, stop=None) -> DataFrame:
    """Rows with ``start <= column < stop``; a missing bound is open."""
    c = F.col(check_ident(column))
    if start is not None:
        df = df.filter(c >= F.lit(start))
    if stop is not None:
        df = df.filter(c < F.lit(stop))
    return df


def _aggregates(value: str = "value", ts: str = "ts") -> dict:
    v = F.col(value)
    at = F.when(v.isNotNull(), F.struct(F.col(ts), v))
    return {
        "mean": F.avg(v),
        "sum": F.sum(v),
        "min": F.min(v),
        "max": F.max(v),
        "count": F.count(v).cast("double"),
        "first": F.min_by(v, at),
        "last": F.max_by(v, at),
    }


def downsample(points: DataFrame, source: str, target: str, interval: str, aggregation: str = "mean") -> DataFrame:
    """``measurement, tags, field, ts, value``: one value per series and bucket.

    A series is a set of tags and a field. Empty buckets give no row; ``ts`` is the bucket's end.
    All aggregates but the median are combined inside each task first; the median of a bucket is
    found by range-partitioned ranks, so no bucket has to fit in one task.
    """
    aggregation = aggregation or "mean"
    series = (
        points.filter(F.col("measurement") == source)
        .select(sorted_entries(F.col("tags")).alias("series"), "ts", F.explode("fields").alias("field", "value"))
        .withColumn("at", bucket(F.col("ts"), interval)["end"])
    )
    keys = ["series", "field", "at"]
    if aggregation == "median":
        found = exact_median(series, keys, "value")
    else:
        known = _aggregates()
        if aggregation not in known:
            raise ValueError(f"unknown aggregation {aggregation!r}")
        found = series.groupBy(*keys).agg(known[aggregation].alias("value"))
    return found.select(
        F.lit(target).alias("measurement"), F.map_from_entries("series").alias("tags"), "field", F.col("at").alias("ts"), "value"
    )


def downsample_wide(
    df: DataFrame,
    source: str,
    target: str,
    interval: str,
    tags: list[str],
    fields: list[str],
    aggregation: str = "mean",
    measurement: str = "measurement",
    ts: str = "ts",
) -> DataFrame:
    """:func:`downsample` for a table with one column per tag and field, in the same long form.

    The fields are aggregated side by side and only the results are turned into rows, so no map
    is built per point.
    """
    aggregation = aggregation or "mean"
    for c in [*tags, *fields]:
        check_ident(c)
    rows = df.filter(F.col(measurement) == source)
    if aggregation == "median":
        points = flat_points(rows, list(tags), list(fields), measurement=measurement, ts=ts)
        return downsample(points, source, target, interval, "median")
    numbers = rows.select(*tags, F.col(ts).alias("_ts"), *[F.col(f).cast("double").alias(f) for f in fields])
    if aggregation not in _aggregates():
        raise ValueError(f"unknown aggregation {aggregation!r}")
    found = numbers.groupBy(*tags, bucket(F.col("_ts"), interval).alias("_w")).agg(
        *[F.when(F.count(f) > 0, _aggregates(f, "_ts")[aggregation]).alias(f"_value_{i}") for i, f in enumerate(fields)]
    )
    cells = [F.struct(F.lit(f).alias("field"), F.col(f"_value_{i}").alias("value")) for i, f in enumerate(fields)]
    pairs = [x for t in tags for x in (F.lit(t), F.col(t).cast("string"))]
    series = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return (
        found.select(F.lit(target).alias("measurement"), series.alias("tags"), F.col("_w.end").alias("ts"), F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .select("measurement", "tags", "field", "ts", "value")
    )


def time_bucket(
    df: DataFrame,
    column: str,
    interval: str,
    keys: list[str],
    aggregates: list[Column],
    origin: str = "0s",
) -> DataFrame:
    """Group by keys and bucket; column ``bucket`` is the bucket's start."""
    start = bucket(F.col(check_ident(column)), interval, origin)
    return df.groupBy(*keys, start.alias("w")).agg(*aggregates).withColumn("bucket", F.col("w.start")).drop("w")


def granularity_series(df: DataFrame, column: str, grain: str, aggregates: list[Column]) -> DataFrame:
    """One row per calendar unit, or one row for ``all``; column ``bucket`` is the unit's start."""
    if grain not in GRAINS:
        raise ValueError(f"unknown granularity {grain!r}")
    if grain == "all":
        return df.agg(F.min(column).alias("bucket"), *aggregates)
    start = F.date_trunc(grain, F.col(check_ident(column))).cast(df.select(column).schema.fields[0].dataType)
    return df.groupBy(start.alias("bucket")).agg(*aggregates)


def group_average(df: DataFrame, time_column: str, keys: list[str], value: str, as_of, last: str) -> DataFrame:
    """Mean per group over the stretch of time before ``as_of``."""
    from datetime import timedelta

    recent = time_range(df, time_column, as_of - timedelta(seconds=parse_duration(last)), as_of)
    return recent.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
