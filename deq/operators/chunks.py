"""A table in time chunks with a catalogue of them, which tells what a chunk holds without opening it.

The rows lie below one folder per chunk. The catalogue beside the table is a log: one row per chunk
and change of the chunk, the latest of which counts. Each change of the table is one small file of
the log, so it is there as a whole or not at all.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.functions.names import check_ident
from deq.session import materialize
from deq.sources.layouts import chunk_start, write_partitioned

ENTRY = "chunk string, first timestamp_ntz, last timestamp_ntz, rows bigint, files bigint, bytes bigint, version bigint"

_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _log_path(path: str) -> str:
    return f"{path.rstrip('/')}.chunks"


def _log(spark: SparkSession, path: str) -> DataFrame:
    try:
        spark.read.parquet(_log_path(path))
    except AnalysisException as problem:
        if problem.getCondition() not in _MISSING:
            raise
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(_log_path(path))


def chunk_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """``chunk, first, last, rows, files, bytes`` of each chunk that holds rows.

    Rows without a time share the chunk NULL, whose first and last time are NULL.
    """
    entry = F.struct("first", "last", "rows", "files", "bytes")
    latest = _log(spark, path).groupBy("chunk").agg(F.max_by(entry, "version").alias("entry"))
    return latest.select("chunk", "entry.*").filter("rows > 0")


def _record(spark: SparkSession, path: str, entries: DataFrame) -> None:
    version = (_log(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    rows = entries.withColumn("version", F.lit(version).cast("bigint"))
    rows.coalesce(1).write.mode("append").parquet(_log_path(path))


def _in(chunks: Iterable[str | None]):
    named = [c for c in chunks if c is not None]
    found = F.col("chunk").isin(named) if named else F.lit(False)
    return found | F.col("chunk").isNull() if None in chunks else found


def _measured(spark: SparkSession, path: str, time_column: str, chunks: list[str | None]) -> DataFrame:
    """Catalogue entries of some chunks out of their files; only the time column is read."""
    stamp = F.col(time_column).cast("timestamp_ntz")
    by_file = (
        _table(spark, path)
        .filter(_in(chunks))
        .groupBy("chunk", F.col("_metadata.file_path").alias("file"))
        .agg(
            F.min(stamp).alias("first"),
            F.max(stamp).alias("last"),
            F.count(F.lit(1)).alias("rows"),
            F.first("_metadata.file_size").alias("size"),
        )
    )
    return by_file.groupBy("chunk").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("rows").alias("rows"),
        F.count("file").alias("files"),
        F.sum("size").alias("bytes"),
    )


def _table(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows.withColumn("chunk", F.col("chunk").cast("string"))


def append_chunks(df: DataFrame, path: str, time_column: str, interval: str = "1d") -> None:
    """Add rows to the chunks their time falls in and enter those chunks in the catalogue.

    The labels of the chunks that get rows come to the driver, one per interval of time.
    """
    spark = df.sparkSession
    start = chunk_start(F.col(check_ident(time_column, strict=True)), interval)
    rows = materialize(df.withColumn("chunk", F.date_format(start, "yyyy-MM-dd'T'HH-mm-ss")))
    touched = [r["chunk"] for r in rows.select("chunk").distinct().collect()]
    if not touched:
        return
    write_partitioned(rows, path, ["chunk"])
    _record(spark, path, materialize(_measured(spark, path, time_column, touched)))


def read_chunk_range(spark: SparkSession, path: str, time_column: str, start: datetime, stop: datetime) -> DataFrame:
    """Rows with ``start <= time < stop``; only chunks that hold such a time by the catalogue are opened."""
    within = (F.col("last") >= F.lit(start)) & (F.col("first") < F.lit(stop))
    ends = chunk_catalogue(spark, path).filter(within).agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).first()
    rows, time = _table(spark, path), F.col(time_column)
    if ends["low"] is None:
        return rows.limit(0)
    # Labels sort by time, so the range of labels prunes folders.
    labels = F.col("chunk").between(ends["low"], ends["high"])
    return rows.filter(labels & (time >= F.lit(start)) & (time < F.lit(stop)))


def _delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_chunks(spark: SparkSession, path: str, time_column: str, limit: datetime) -> dict:
    """Let all rows before ``limit`` expire: whole chunks by their folder, without reading a row.

    Only chunks with times on both sides of the limit are read and rewritten; all others keep their
    files. Rows without a time have no age and stay. Returns the numbers of chunks dropped and
    rewritten, the rows removed and the bytes that dropped chunks had. Tried again after a
    failure it goes on where it stopped; the catalogue follows the files.
    """
    old = materialize(chunk_catalogue(spark, path).filter(F.col("first") < F.lit(limit)))
    # One row per chunk; a chunk covers an interval of time.
    found = old.withColumn("whole", F.col("last") < F.lit(limit)).collect()
    whole = [r for r in found if r["whole"]]
    border = [r["chunk"] for r in found if not r["whole"]]
    removed = sum(r["rows"] for r in whole)
    if border:
        rows = _table(spark, path).filter(_in(border) & (F.col(time_column) >= F.lit(limit)))
        write_partitioned(materialize(rows), path, ["chunk"], mode="overwrite", keep_others=True)
        left = materialize(_measured(spark, path, time_column, border))
        removed += sum(r["rows"] for r in found if not r["whole"]) - (left.agg(F.sum("rows")).first()[0] or 0)
        _record(spark, path, left)
    for row in whole:
        _delete_folder(spark, f"{path.rstrip('/')}/chunk={row['chunk']}")
    if whole:
        gone = {"rows": 0, "files": 0, "bytes": 0}
        emptied = old.filter(F.col("last") < F.lit(limit)).withColumns({c: F.lit(n).cast("bigint") for c, n in gone.items()})
        _record(spark, path, emptied)
    return {"dropped": len(whole), "rewritten": len(border), "rows_removed": removed, "bytes_freed": sum(r["bytes"] for r in whole)}
