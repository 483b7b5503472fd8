"""Row layouts and partitioned writes of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from deq.functions.names import check_ident, parse_duration, strip_identifier
from deq.functions.text import number_text, sorted_json


def _field_texts() -> Column:
    return F.map_concat(F.transform_values("fields", lambda k, v: number_text(v)), F.col("texts"))


def to_kv_arrays(points: DataFrame) -> DataFrame:
    """``measurement, ts, tag_keys, tag_values, field_keys, field_values``, keys in order."""
    texts = points.withColumn("_all", _field_texts())
    tag_keys, field_keys = F.sort_array(F.map_keys("tags")), F.sort_array(F.map_keys("_all"))
    return texts.select(
        "measurement",
        "ts",
        tag_keys.alias("tag_keys"),
        F.transform(tag_keys, lambda k: F.col("tags")[k]).alias("tag_values"),
        field_keys.alias("field_keys"),
        F.transform(field_keys, lambda k: F.col("_all")[k]).alias("field_values"),
    )


def to_wide(points: DataFrame, tags: list[str], fields: list[str], texts: list[str] = ()) -> DataFrame:
    """One column per tag and field, time cut to seconds; a field hides a tag of the same name."""
    columns = [F.col("fields")[n].alias(n) for n in fields] + [F.col("texts")[n].alias(n) for n in texts]
    columns += [F.col("tags")[n].alias(n) for n in tags if n not in fields and n not in texts]
    return points.select("measurement", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("time"), *columns)


def to_json_layout(points: DataFrame) -> DataFrame:
    """``measurement, time, tags, fields`` with JSON objects, keys in order."""
    numbers, texts = sorted_json(F.col("fields")), sorted_json(F.col("texts"))
    both = (
        F.when(F.size("texts") == 0, F.col("_n"))
        .when(F.size("fields") == 0, F.col("_t"))
        .otherwise(F.concat(F.expr("left(_n, length(_n) - 1)"), F.lit(","), F.expr("substring(_t, 2)")))
    )
    return points.withColumn("_n", numbers).withColumn("_t", texts).select(
        "measurement", F.col("ts").alias("time"), sorted_json(F.col("tags")).alias("tags"), both.alias("fields")
    )


def to_typed_columns(df: DataFrame, keep: list[str] = ("measurement", "ts")) -> DataFrame:
    """Keep the named columns and those that hold floats, integers, text or booleans."""
    simple = (T.DoubleType, T.FloatType, T.IntegralType, T.StringType, T.BooleanType)
    return df.select(*[f.name for f in df.schema.fields if f.name in keep or isinstance(f.dataType, simple)])


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: list[str],
    mode: str = "append",
    order: list[str] = (),
    keep_others: bool = False,
) -> None:
    """Write one folder per value of ``columns``.

    The rebalance hint lets a partition value that holds most of the rows spread over several
    tasks, and small ones share a task, so neither one huge nor many tiny files come out. An
    overwrite replaces the whole table, or with ``keep_others`` only the folders that get rows.
    """
    spread = df.hint("rebalance", *columns)
    if order:
        spread = spread.sortWithinPartitions(*columns, *order)
    replace = "dynamic" if keep_others else "static"
    spread.write.mode(mode).option("partitionOverwriteMode", replace).partitionBy(*columns).parquet(path)


def empty_partition(df: DataFrame, path: str, column: str, value) -> None:
    """Replace the content of one folder by an empty file."""
    df.drop(column).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def write_by_measurement(points: DataFrame, path: str) -> None:
    """One folder per measurement, named like the table that would hold it."""
    rows = points.withColumn("target", strip_identifier(F.col("measurement")))
    write_partitioned(rows, path, ["target"])


def chunk_start(ts: Column, interval: str = "1d") -> Column:
    """Start of the storage chunk a stamp falls in, counted from 1970; NULL without a stamp."""
    step = F.lit(int(parse_duration(interval) * 1_000_000)).cast("bigint")
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, step))


def chunked_table(df: DataFrame, path: str, time_column: str, interval: str = "1d") -> None:
    """Write a table split by time; readers that filter on ``chunk`` open only those folders."""
    start = chunk_start(F.col(check_ident(time_column, strict=True)), interval)
    label = F.date_format(start, "yyyy-MM-dd'T'HH-mm-ss")
    write_partitioned(df.withColumn("chunk", label), path, ["chunk"], mode="overwrite")


def chunk_label(stamp, interval: str = "1d") -> str:
    """Folder name of the chunk that holds a Python datetime."""
    from datetime import datetime, timedelta

    seconds = parse_duration(interval)
    since = int((stamp - datetime(1970, 1, 1)).total_seconds())
    start = datetime(1970, 1, 1) + timedelta(seconds=since - since % seconds)
    return start.strftime("%Y-%m-%dT%H-%M-%S")


def read_chunks(df: DataFrame, time_column: str, start, stop, interval: str = "1d") -> DataFrame:
    """Rows with ``start <= time < stop``; the filter on ``chunk`` prunes folders."""
    c = F.col(time_column)
    chunk = F.col("chunk").between(chunk_label(start, interval), chunk_label(stop, interval))
    return df.filter(chunk & (c >= F.lit(start)) & (c < F.lit(stop)))
