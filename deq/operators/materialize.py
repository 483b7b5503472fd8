"""Materialised aggregates kept as partitioned tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.functions.names import check_ident, parse_duration
from deq.operators.windows import time_range
from deq.session import materialize
from deq.sources.layouts import empty_partition, write_partitioned

_DAY = timedelta(days=1)


_EPOCH = datetime(1970, 1, 1)


def _floor(stamp: datetime, step: timedelta) -> datetime:
    return _EPOCH + (stamp - _EPOCH) // step * step


def refresh_continuous(
    path: str,
    source: DataFrame,
    time_column: str,
    query: Callable[[DataFrame], DataFrame],
    start: datetime | None = None,
    stop: datetime | None = None,
    width: str = "1d",
    stamp: str = "start",
) -> None:
    """Recompute the buckets of a continuous aggregate that lie in ``[start, stop)``.

    ``query`` turns source rows into rows with a ``bucket`` column, the ``start`` or ``end`` of a
    bucket of ``width`` counted from 1970. The width has to divide a day or be whole days; shorter
    buckets that divide it are fine too. Both bounds are moved back to whole days and whole buckets,
    so a bucket still open stays as it was. With no bounds everything is recomputed. A bucket that
    falls outside the bounds raises, as the width cannot be that of the query then.
    """
    span = timedelta(seconds=parse_duration(width))
    if span <= timedelta(0) or (span % _DAY and _DAY % span):
        raise ValueError(f"buckets of {width} do not line up with days")
    if stamp not in ("start", "end"):
        raise ValueError(f"unknown stamp {stamp!r} (valid: start, end)")
    step = max(span, _DAY)
    start = _floor(start, step) if start else None
    stop = _floor(stop, step) if stop else None
    begins = F.col("bucket") - F.lit(span) if stamp == "end" else F.col("bucket")
    fresh = query(time_range(source, time_column, start, stop)).withColumn("bucket_day", F.to_date(begins))
    if start is None and stop is None:
        write_partitioned(fresh, path, ["bucket_day"], mode="overwrite")
        return
    staged = materialize(fresh)
    ends = staged.agg(F.min("bucket_day").alias("first"), F.max("bucket_day").alias("last")).first()
    if ends["first"] and ((start and ends["first"] < start.date()) or (stop and ends["last"] >= stop.date())):
        raise ValueError(f"the query has buckets that are not of {width}, or not stamped with their {stamp}")
    before = _stored_days(staged.sparkSession, path, start, stop)
    write_partitioned(staged, path, ["bucket_day"], mode="overwrite", keep_others=True)
    # A day whose source rows are all gone has to lose its buckets too; there is one row per day.
    if before is not None:
        lost = before.join(staged.select("bucket_day"), "bucket_day", "left_anti").collect()
        for row in lost:
            empty_partition(staged, path, "bucket_day", row["bucket_day"])


def _stored_days(spark: SparkSession, path: str, start: datetime | None, stop: datetime | None) -> DataFrame | None:
    """The days of the window that hold buckets, fixed before they are replaced."""
    try:
        days = spark.read.parquet(path).select("bucket_day").distinct()
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if start:
        days = days.filter(F.col("bucket_day") >= F.lit(start.date()))
    if stop:
        days = days.filter(F.col("bucket_day") < F.lit(stop.date()))
    return materialize(days)


def scheduled_refresh(
    path,
    source,
    time_column,
    query,
    now: datetime,
    start_offset: str = "",
    end_offset: str = "",
    width: str = "1d",
    stamp: str = "start",
) -> None:
    """Refresh ``[now - start_offset, now - end_offset)``; an empty offset leaves that side open."""
    start = now - timedelta(seconds=parse_duration(start_offset)) if start_offset else None
    stop = now - timedelta(seconds=parse_duration(end_offset)) if end_offset else None
    refresh_continuous(path, source, time_column, query, start, stop, width, stamp)


def _unit(time_column: str, width: str):
    """The day a stamp's bucket starts on; buckets shorter than a day share its folder."""
    step = F.lit(int(max(timedelta(seconds=parse_duration(width)), _DAY) / timedelta(microseconds=1))).cast("bigint")
    micros = F.unix_micros(F.col(check_ident(time_column)).cast("timestamp"))
    return F.to_date(F.timestamp_micros(micros - F.pmod(micros, step)))


def _entries(spark: SparkSession, log: str) -> DataFrame | None:
    try:
        spark.read.parquet(log)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return spark.read.schema("bucket_day date, entry bigint").parquet(log)


def _enter(days: DataFrame, log: str, entry: int) -> None:
    """One small file per entry, so an entry is there as a whole or not at all."""
    days.withColumn("entry", F.lit(entry).cast("bigint")).coalesce(1).write.mode("append").parquet(log)


def _last_entry(spark: SparkSession, log: str) -> int:
    known = _entries(spark, log)
    return (known.agg(F.max("entry")).first()[0] or 0) if known is not None else 0


def invalidate(changes: DataFrame, log: str, time_column: str, width: str = "1d") -> None:
    """Note in a log which buckets of a continuous aggregate some changed source rows fall in.

    Changed rows are those added, removed or altered, in their old and their new form. Rows without
    a time fall in no bucket. ``width`` is that of the aggregate's buckets.
    """
    spark = changes.sparkSession
    days = changes.select(_unit(time_column, width).alias("bucket_day")).filter("bucket_day IS NOT NULL").distinct()
    _enter(days, log, _last_entry(spark, log) + 1)


def refresh_invalidated(
    path: str,
    source: DataFrame,
    log: str,
    time_column: str,
    query: Callable[[DataFrame], DataFrame],
    stop: datetime | None = None,
    width: str = "1d",
    stamp: str = "start",
) -> int:
    """Recompute the buckets that :func:`invalidate` noted since the last time, and no others.

    Buckets from ``stop`` on, those still open, wait for a later call. Folders of other days keep
    their files. A call that fails is tried again as a whole: entries count as done only after the
    buckets were replaced. Returns the number of folders recomputed.
    """
    spark = source.sparkSession
    known, done = _entries(spark, log), f"{log.rstrip('/')}.done"
    if known is None:
        return 0
    finished, last = _last_entry(spark, done), _last_entry(spark, log)
    span = timedelta(seconds=parse_duration(width))
    limit = F.lit(_floor(stop, max(span, _DAY)).date()) if stop else None
    unread = known.filter((F.col("entry") > finished) & (F.col("entry") <= last)).select("bucket_day").distinct()
    # One row per day that changed.
    days = sorted(r["bucket_day"] for r in (unread.filter(F.col("bucket_day") < limit) if stop else unread).collect())
    if days:
        first, after = days[0], datetime.combine(days[-1], datetime.min.time()) + max(span, _DAY)
        near = time_range(source, time_column, datetime.combine(first, datetime.min.time()), after)
        begins = F.col("bucket") - F.lit(span) if stamp == "end" else F.col("bucket")
        staged = materialize(
            query(near.filter(_unit(time_column, width).isin(days))).withColumn("bucket_day", F.to_date(begins))
        )
        kept = {r["bucket_day"] for r in staged.select("bucket_day").distinct().collect()}
        if kept - set(days):
            raise ValueError(f"the query has buckets that are not of {width}, or not stamped with their {stamp}")
        write_partitioned(staged, path, ["bucket_day"], mode="overwrite", keep_others=True)
        for day in set(days) - kept:
            empty_partition(staged, path, "bucket_day", day)
    if stop:
        waiting = unread.filter(F.col("bucket_day") >= limit)
        if not waiting.isEmpty():
            _enter(materialize(waiting), log, last + 1)
    _enter(spark.createDataFrame([], "bucket_day date") if last == finished else unread.limit(1), done, last)
    return len(days)


def read_continuous(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path).drop("bucket_day")


def materialized_view(df: DataFrame, path: str, order_by: list[str], partition_by: list[str] = ()) -> None:
    """Write a query result in folders by ``partition_by``, each file sorted by ``order_by``."""
    for c in [*order_by, *partition_by]:
        check_ident(c)
    if partition_by:
        write_partitioned(df, path, list(partition_by), mode="overwrite", order=order_by)
    else:
        df.sortWithinPartitions(*order_by).write.mode("overwrite").parquet(path)


def stored_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``path, length`` of the data files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )


def view_status(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``rows, files, bytes, active``."""
    files = stored_files(spark, path).agg(F.struct(F.count("path").alias("files"), F.sum("length").alias("bytes"))).scalar()
    return (
        spark.read.parquet(path)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("rows", files["files"].alias("files"), files["bytes"].alias("bytes"), F.lit(True).alias("active"))
    )
