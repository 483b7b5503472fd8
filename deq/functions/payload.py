"""Validation of JSON payloads against the names a schema asks for."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.text import json_value


def _load(schema: str):
    try:
        return json.loads(schema)
    except ValueError:
        return None


def _verdict(df: DataFrame, error: Column) -> DataFrame:
    return df.withColumn("error", error).withColumn("valid", F.col("error").isNull())


def _missing(payload: Column, names: list[str]) -> Column:
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return F.array_except(wanted, F.json_object_keys(payload))


def _names_error(payload: Column, names: list[str] | None, what: str) -> Column:
    text = F.when(json_value(payload).isNull(), "invalid JSON payload")
    if names is None:
        return text
    keys = F.json_object_keys(payload)
    lost = _missing(payload, names)
    return text.when(keys.isNull(), "expected JSON object").when(
        F.size(lost) > 0, F.concat(F.lit(f"missing {what}: "), F.array_join(lost, " "))
    )


def validate_json(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """Add ``valid, error``: well-formed JSON that holds the top-level ``required`` names.

    A schema that cannot be read, or that names nothing, asks for well-formed JSON only.
    """
    read = _load(schema)
    required = read.get("required") if isinstance(read, dict) else None
    names = [n if isinstance(n, str) else "" for n in required] if isinstance(required, list) else None
    return _verdict(df, _names_error(F.col(payload), names, "required fields"))


def validate_avro_fields(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """Add ``valid, error``: a JSON object that holds every field the record schema names."""
    read = _load(schema)
    fields = read.get("fields") if isinstance(read, dict) else None
    names = [f.get("name", "") for f in fields or [] if isinstance(f, dict)]
    return _verdict(df, _names_error(F.col(payload), names, "Avro fields"))


def validate_syntax(df: DataFrame, payload: str) -> DataFrame:
    """Add ``valid, error``: well-formed JSON."""
    return _verdict(df, _names_error(F.col(payload), None, ""))
