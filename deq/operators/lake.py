"""Versioned tables: append, overwrite, upsert, compact, as-of reads, expiry.

A table is a DataFrame or a folder of Parquet files; a history is a change log with a version
column. Nothing is edited in place.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from deq.functions.names import check_ident, declared_type, spark_type, text_width
from deq.operators.materialize import stored_files
from deq.session import literal_rows, materialize
from deq.sources.layouts import empty_partition, write_partitioned

DELETE = "DELETE"


def schema_of(fields: list[dict]) -> T.StructType:
    """Spark schema of ``{name, type, required, doc}`` fields; ids are given by position unless set.

    The width of text is kept as metadata, as Spark drops it.
    """
    out = T.StructType()
    for i, f in enumerate(fields):
        meta = {"id": f.get("id", i + 1)}
        if text_width(f["type"]) is not None:
            meta["sql_type"] = f["type"]
        if f.get("doc"):
            meta["comment"] = f["doc"]
        out.add(check_ident(f["name"], strict=True), spark_type(f["type"]), not f.get("required", False), meta)
    return out


def create_table(spark: SparkSession, path: str, fields: list[dict], partition_by: list[str] = ()) -> bool:
    """Make an empty table at a folder; False when one is there already."""
    schema = schema_of(fields)
    try:
        spark.read.parquet(path)
        return False
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    spark.createDataFrame([], schema).write.partitionBy(*partition_by).parquet(path)
    return True


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Target plus new rows; columns missing on one side are NULL there."""
    return target.unionByName(rows, allowMissingColumns=True)


def write(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] = ()) -> None:
    """Append, or overwrite everything, or with partitions overwrite those that get new rows."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def latest_per_key(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last change of each key.

    An aggregate rather than a ranking window: each task keeps one row per key before the
    shuffle, so a key that fills a third of the log costs no more than any other.
    """
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return changes.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*").select(*changes.columns)


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """Target with the last change of each key applied; a last change DELETE removes the key.

    A NULL ``op`` is no DELETE. A row whose key is NULL names no row, so it is added each time.
    """
    # The keys alone are read for the anti join; a small change set is broadcast, the target stays put.
    kept = target.join(changes.select(*keys).distinct(), keys, "left_anti")
    alive = latest_per_key(changes, keys, order).filter(~F.col(op).eqNullSafe(DELETE))
    return kept.unionByName(alive.select(*[c for c in target.columns if c in alive.columns]), allowMissingColumns=True)


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The storage bucket of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write a keyed table in one folder per bucket, for :func:`upsert_table`.

    The number of buckets is kept beside the table.
    """
    write_partitioned(df.withColumn("bucket", bucket_of(keys, buckets)), path, ["bucket"], mode="overwrite")
    literal_rows(df.sparkSession, [(buckets,)], "buckets int").write.mode("overwrite").parquet(_buckets_path(path))


def _buckets_path(path: str) -> str:
    return f"{path.rstrip('/')}.buckets"


def upsert_table(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: list[str],
    order: list[str],
    buckets: int,
    op: str = "op",
) -> int:
    """Apply changes to a table that :func:`write_bucketed` made; returns the buckets rewritten.

    Only buckets with a change are read and replaced. The new content is stored beside the table
    first, so nothing is read from the folders that are being overwritten and a second try gives
    the same result. A bucket that loses its last row keeps an empty file. Folders are replaced one
    after the other, so a reader may meet old and new ones until the call returns.
    """
    kept = spark.read.schema("buckets int").parquet(_buckets_path(path)).first()["buckets"]
    if kept != buckets:
        raise ValueError(f"the table {path} has {kept} buckets, not {buckets}")
    placed = changes.withColumn("bucket", bucket_of(keys, buckets))
    # At most one row per bucket comes to the driver; the literal list prunes the folders.
    touched = [r["bucket"] for r in placed.select("bucket").distinct().collect()]
    if not touched:
        return 0
    target = spark.read.option("mergeSchema", "true").parquet(path).filter(F.col("bucket").isin(touched))
    merged = materialize(upsert(target, placed, keys, order, op).withColumn("bucket", bucket_of(keys, buckets)))
    emptied = set(touched) - {r["bucket"] for r in merged.select("bucket").distinct().collect()}
    write_partitioned(merged, path, ["bucket"], mode="overwrite", keep_others=True)
    for bucket in emptied:
        empty_partition(merged, path, "bucket", bucket)
    return len(touched)


def snapshots(log: DataFrame, version: str = "version") -> DataFrame:
    """``version, committed_at, inserts, updates, deletes, rows`` per version."""
    return log.groupBy(version).agg(
        F.min("ts").alias("committed_at"),
        *[F.count_if(F.col("op") == o).alias(n) for n, o in {"inserts": "INSERT", "updates": "UPDATE", "deletes": DELETE}.items()],
        F.count(F.lit(1)).alias("rows"),
    )


def as_of(log: DataFrame, keys: list[str], order: list[str], version=None, time=None) -> DataFrame:
    """Table content at a version or an instant (both inclusive)."""
    if version is None and time is None:
        raise ValueError("a version or a time is required")
    if version is not None:
        log = log.filter(F.col("version") <= F.lit(version))
    if time is not None:
        log = log.filter(F.col("ts") <= F.lit(time))
    return latest_per_key(log, keys, order).filter(~F.col("op").eqNullSafe(DELETE))


def expire(log: DataFrame, keys: list[str], order: list[str], older_than) -> DataFrame:
    """Drop superseded rows older than the instant.

    The newest old row of each key stays, so every version from the instant on reads as before.
    Newer rows pass through without a shuffle, and so do rows without a time, whose age is unknown.
    """
    recent = log.filter((F.col("ts") >= F.lit(older_than)) | F.col("ts").isNull())
    return recent.unionByName(latest_per_key(log.filter(F.col("ts") < F.lit(older_than)), keys, order))


def compact(
    spark: SparkSession,
    source: str,
    dest: str,
    target_bytes: int = 536_870_912,
    partition_by: list[str] = (),
) -> dict:
    """Rewrite a folder's small files into files of about ``target_bytes`` in a new folder.

    Tasks are merged without a shuffle, so rows move only to the task that writes them. Files of
    different columns are read with all of them; the copy is compared with its source.
    """
    if target_bytes <= 0:
        raise ValueError("target size must be positive")
    before = stored_files(spark, source).agg(F.count("path").alias("files"), F.sum("length").alias("bytes")).first()
    wanted = max(1, math.ceil((before["bytes"] or 0) / target_bytes))
    every = spark.read.option("mergeSchema", "true").parquet(source)
    rows = every.coalesce(wanted)
    (rows.write.partitionBy(*partition_by) if partition_by else rows.write).parquet(dest)
    copy = spark.read.schema(every.schema).parquet(dest)
    if copy.count() != every.count():
        raise RuntimeError(f"the compacted folder {dest} does not hold the rows of {source}")
    after = stored_files(spark, dest).count()
    return {"files_before": before["files"], "files_after": after, "bytes_before": before["bytes"]}


def describe(df: DataFrame, log: DataFrame | None = None, location: str = "") -> DataFrame:
    """``position, column, type, required, doc, location, snapshots`` of a table."""
    rows = [
        (f.metadata.get("id", i + 1), f.name, declared_type(f), not f.nullable, f.metadata.get("comment"), location)
        for i, f in enumerate(df.schema.fields)
    ]
    out = literal_rows(
        df.sparkSession, rows, "position int, column string, type string, required boolean, doc string, location string"
    )
    if log is None:
        return out.withColumn("snapshots", F.lit(0).cast("bigint"))
    versions = log.select("version").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return out.withColumn("snapshots", versions)


def _next_id(df: DataFrame) -> int:
    """An id no column has; a column without one has its position."""
    return max((f.metadata.get("id", i + 1) for i, f in enumerate(df.schema.fields)), default=0) + 1


def added_column(df: DataFrame, name: str, type_name: str, default: Column | None = None, doc: str | None = None, **meta) -> DataFrame:
    """The rows with a new column that keeps its declared width and comment as metadata."""
    if text_width(type_name) is not None:
        meta["sql_type"] = type_name
    if doc:
        meta["comment"] = doc
    # An added column may be NULL, whatever its default.
    value = F.lit(None) if default is None else F.when(F.lit(name).isNotNull(), default)
    return df.withColumn(check_ident(name, strict=True), value.cast(spark_type(type_name))).withMetadata(name, meta)


def retyped_column(df: DataFrame, name: str, type_name: str) -> DataFrame:
    """The rows with a column cast; its id and comment stay, its declared width is the new one."""
    meta = {k: v for k, v in df.schema[name].metadata.items() if k != "sql_type"}
    if text_width(type_name) is not None:
        meta["sql_type"] = type_name
    return df.withColumn(name, F.col(f"`{name}`").cast(spark_type(type_name))).withMetadata(name, meta)


def evolve_schema(df: DataFrame, changes: list[dict]) -> DataFrame:
    """Apply column updates in order: add-column, rename-column, update-column-type, delete-column.

    A new column is NULL in old rows, or its ``default``; it keeps its ``doc``, its declared width and an
    id of its own. Updates of other kinds carry no column change and leave the rows as they are.
    """
    changes = [c for c in changes if c.get("action")]
    if not changes:
        raise ValueError("at least one change is required")
    for c in changes:
        name = c.get("name", "")
        if c["action"] == "add-column":
            default = F.lit(c["default"]) if c.get("default") is not None else None
            df = added_column(df, name, c["type"], default, c.get("doc"), id=_next_id(df))
        elif c["action"] == "rename-column":
            df = df.withColumnRenamed(_existing(df, name), check_ident(c["to"], strict=True))
        elif c["action"] == "update-column-type":
            df = retyped_column(df, _existing(df, name), c["type"])
        elif c["action"] == "delete-column":
            df = df.drop(_existing(df, name))
    return df


def _existing(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        raise ValueError(f"column {name!r} is not in the table")
    return name
