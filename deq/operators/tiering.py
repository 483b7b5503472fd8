"""Retention, cold archive and tier status."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deq.functions.names import check_ident, parse_duration
from deq.functions.text import sorted_json
from deq.operators.materialize import stored_files
from deq.session import materialize

ARCHIVE_FIELDS = "timestamp bigint, measurement string, tags string, fields string"


def cutoff(as_of: datetime, older_than: str) -> datetime:
    """The one instant that parts hot rows from old ones."""
    return as_of - timedelta(seconds=parse_duration(older_than))


def retention(df: DataFrame, time_column: str, duration: str, as_of: datetime) -> DataFrame:
    """Rows that have not expired."""
    return df.filter(F.col(check_ident(time_column)) >= F.lit(cutoff(as_of, duration)))


def archive_rows(
    df: DataFrame,
    limit: datetime,
    time_column: str = "ts",
    measurement: str = "measurement",
    tags: str = "tags",
) -> DataFrame:
    """Rows before ``limit`` in the four-column cold form.

    Every other column goes into the ``fields`` object. The stamp is nanoseconds since 1970.
    """
    old = df.filter(F.col(time_column) < F.lit(limit))
    rest = [c for c in df.columns if c not in (time_column, measurement, tags)]
    tag_text = F.coalesce(sorted_json(F.col(tags)), F.lit("null")) if tags in df.columns else F.lit("null")
    return old.select(
        (F.unix_micros(F.col(time_column).cast("timestamp")) * 1000).alias("timestamp"),
        F.coalesce(F.col(measurement), F.lit("")).alias("measurement"),
        tag_text.alias("tags"),
        F.to_json(F.struct(*sorted(rest)), {"ignoreNullFields": "false"}).alias("fields"),
    )


def write_archive(cold: DataFrame, dest: str, form: str = "parquet", mode: str = "append") -> None:
    """Write cold rows to a folder as Parquet or CSV."""
    if form == "csv":
        cold.write.mode(mode).options(header=True, quoteAll=True, escape='"').csv(dest)
    else:
        cold.write.mode(mode).parquet(dest)


def read_archive(spark: SparkSession, dest: str, form: str = "parquet") -> DataFrame:
    reader = spark.read.schema(ARCHIVE_FIELDS)
    if form == "csv":
        return reader.options(header=True, quote='"', escape='"', multiLine=True).csv(dest).drop("until")
    return reader.parquet(dest).drop("until")


@dataclass
class Archived:
    """What an archive run did: old rows that the cold folder now holds, those added by this run, the hot rest."""

    rows_archived: int
    destination: str
    deleted_from_hot: bool
    hot: DataFrame
    rows_added: int = 0


def _archived_since(spark: SparkSession, dest: str, form: str, first: int) -> DataFrame | None:
    """Cold rows from a stamp on; None if there is no cold folder yet."""
    try:
        spark.read.format(form).load(dest)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return read_archive(spark, dest, form).filter(F.col("timestamp") >= first)


def archive(
    df: DataFrame,
    older_than: str,
    dest: str,
    as_of: datetime,
    form: str = "parquet",
    delete_after: bool = False,
    **columns,
) -> Archived:
    """Add old rows to a cold folder and, if asked, take them out of the hot side.

    Only rows that the cold side does not hold yet are added, a row that occurs several times as often
    as it is missing; nothing there is ever replaced. So a run may be tried again before or after the
    removal, late rows of an old time are added, and runs without removal do not copy a row twice. A
    late row that equals a cold row in all columns is taken for that row.

    Copy and removal use one cutoff. The hot side is only cut after every old row was found on the
    cold side; with no old row nothing is removed. Cold rows before the first old hot row are not read.
    """
    spark, limit = df.sparkSession, cutoff(as_of, older_than)
    time_column = columns.get("time_column", "ts")
    old = materialize(archive_rows(df, limit, **columns))
    seen = old.agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first")).first()
    if not seen["n"]:
        return Archived(0, dest, False, df)
    present = _archived_since(spark, dest, form, seen["first"])
    missing = old if present is None else materialize(old.exceptAll(present))
    added = Observation()
    counted = missing.observe(added, F.count(F.lit(1)).alias("n"))
    write_archive(counted, f"{dest}/until={limit:%Y%m%dT%H%M%S%f}", form)
    if not old.exceptAll(_archived_since(spark, dest, form, seen["first"])).isEmpty():
        raise RuntimeError(f"rows older than {limit} are missing in {dest}")
    hot = df.filter(~F.coalesce(F.col(time_column) < F.lit(limit), F.lit(False))) if delete_after else df
    return Archived(seen["n"], dest, delete_after, hot, added.get["n"])


def hot_status(df: DataFrame, measurement: Column | None = None, time_column: str = "ts") -> DataFrame:
    """``measurement, hot_rows, hot_oldest`` per measurement."""
    key = (measurement if measurement is not None else F.col("measurement")).alias("measurement")
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("hot_rows"), F.min(time_column).alias("hot_oldest"))


def cold_status(spark: SparkSession, dest: str, pattern: str = "*.parquet") -> DataFrame:
    """One row: ``cold_files, cold_rows, cold_oldest, total_bytes``."""
    files = stored_files(spark, dest, pattern).agg(F.struct(F.count("path").alias("n"), F.sum("length").alias("b"))).scalar()
    form = "csv" if pattern.endswith("csv") else "parquet"
    return (
        read_archive(spark, dest, form)
        .agg(F.count(F.lit(1)).alias("cold_rows"), F.min("timestamp").alias("oldest"))
        .select(
            files["n"].alias("cold_files"),
            "cold_rows",
            F.timestamp_micros(F.floor(F.col("oldest") / 1000)).cast("timestamp_ntz").alias("cold_oldest"),
            files["b"].alias("total_bytes"),
        )
    )
