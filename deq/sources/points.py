"""Time-series points: ``measurement, tags, fields, texts, ts``.

``tags`` maps names to text, ``fields`` names to numbers, ``texts`` names to other field values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.text import json_value

# What counts as an RFC 3339 instant.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"

def _is_number(value: Column) -> Column:
    return F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|DECIMAL)")


def _text(value: Column) -> Column:
    return F.variant_get(value, "$", "string")


def _instant(stamp: Column, now: Column) -> Column:
    text = F.try_variant_get(stamp, "$", "string")
    nanos = F.try_variant_get(stamp, "$", "decimal(38,0)")
    return F.coalesce(
        F.when(
            F.schema_of_variant(stamp) == "STRING",
            F.when(text.rlike(RFC3339), F.try_to_timestamp(text)),
        ).when(_is_number(stamp), F.timestamp_micros(F.floor(nanos / 1000).cast("bigint"))),
        now.cast("timestamp"),
    )


def normalize_points(df: DataFrame, payload: str, now=None, need_fields: bool = False) -> DataFrame:
    """Points out of JSON objects, with a column ``error`` that is NULL where the point is good.

    Tags that are no text are dropped. A stamp is RFC 3339 text or nanoseconds since 1970;
    anything else becomes ``now``.
    """
    now = F.lit(now) if now is not None else F.current_timestamp()
    body = json_value(F.col(payload) if isinstance(payload, str) else payload)
    read = df.withColumn("_b", body).select(
        *df.columns,
        F.try_variant_get("_b", "$.measurement", "variant").alias("_m"),
        F.try_variant_get("_b", "$.tags", "map<string,variant>").alias("_t"),
        F.try_variant_get("_b", "$.fields", "map<string,variant>").alias("_f"),
        F.try_variant_get("_b", "$.timestamp", "variant").alias("_s"),
        (F.col("_b").isNotNull() & F.ltrim(payload).startswith("{")).alias("_ok"),
    )
    none = F.create_map().cast("map<string,variant>")
    name = F.when(F.schema_of_variant("_m") == "STRING", _text(F.col("_m")))
    tags = F.map_filter(F.coalesce("_t", none), lambda k, v: F.schema_of_variant(v) == "STRING")
    fields = F.coalesce("_f", none)
    error = (
        F.when(~F.col("_ok"), "point must be an object")
        .when(F.coalesce(name, F.lit("")) == "", "measurement is required")
        .when(F.lit(need_fields) & (F.size(fields) == 0), "fields is required")
    )
    return read.select(
        *[c for c in df.columns if c != payload],
        F.coalesce(name, F.lit("")).alias("measurement"),
        F.transform_values(tags, lambda k, v: _text(v)).alias("tags"),
        F.transform_values(
            F.map_filter(fields, lambda k, v: _is_number(v)), lambda k, v: F.variant_get(v, "$", "double")
        ).alias("fields"),
        F.transform_values(
            F.map_filter(fields, lambda k, v: ~_is_number(v)), lambda k, v: F.try_variant_get(v, "$", "string")
        ).alias("texts"),
        _instant(F.col("_s"), now).cast("timestamp_ntz").alias("ts"),
        error.alias("error"),
    )


def flat_points(
    df: DataFrame,
    tags: list[str],
    fields: list[str],
    texts: list[str] = (),
    measurement: str = "measurement",
    ts: str = "ts",
) -> DataFrame:
    """Points out of one column per tag and field; NULL cells are left out of the maps."""

    def packed(names, kind):
        if not names:
            return F.create_map().cast(f"map<string,{kind}>")
        pairs = [x for n in names for x in (F.lit(n), F.col(n).cast(kind))]
        return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())

    return df.select(
        F.col(measurement).alias("measurement"),
        packed(tags, "string").alias("tags"),
        packed(fields, "double").alias("fields"),
        packed(texts, "string").alias("texts"),
        F.col(ts).alias("ts"),
    )
