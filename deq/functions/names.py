"""Identifiers, durations and type names."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# Identifier and expression grammars.
DOTTED_IDENT = r"^[a-zA-Z_][a-zA-Z0-9_.]*$"
STRICT_IDENT = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
TYPE_NAME = r"^[a-zA-Z][a-zA-Z0-9_ ]*(\(\d+(,\s*\d+)?\))?(\[\])?$"

# Nanoseconds per duration unit.
UNIT_NANOS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}

# Short SQL type names and their canonical forms.
TYPE_ALIASES = {
    "varchar": "character varying",
    "int": "integer",
    "int2": "smallint",
    "int4": "integer",
    "int8": "bigint",
    "float4": "real",
    "float8": "double precision",
    "float": "double precision",
    "bool": "boolean",
    "timestamptz": "timestamp with time zone",
}

# Widening order of the numeric types.
NUMERIC_RANK = {
    "smallint": 1,
    "int2": 1,
    "int": 2,
    "integer": 2,
    "int4": 2,
    "bigint": 3,
    "int8": 3,
    "real": 4,
    "float4": 4,
    "float": 5,
    "double precision": 5,
    "float8": 5,
    "numeric": 6,
    "decimal": 6,
}

_NUMBER = r"(?:\d+\.?\d*|\.\d+)"
_UNIT = "(?:ns|us|µs|μs|ms|s|m|h)"
_DURATION = rf"^[-+]?(?:{_NUMBER}{_UNIT})+$"
_DAYS = r"^[-+]?\d+d$"


def check_ident(name: str, strict: bool = False) -> str:
    """Return ``name`` if it is a safe identifier, else raise."""
    if not name:
        raise ValueError("identifier must not be empty")
    if not re.match(STRICT_IDENT if strict else DOTTED_IDENT, name) or name.endswith("\n"):
        raise ValueError(f"identifier {name!r} is invalid")
    return name


def check_type_name(name: str) -> str:
    """Return ``name`` if it reads like a column type, else raise."""
    if not name or not re.match(TYPE_NAME, name):
        raise ValueError(f"column type {name!r} is invalid")
    return name


def parse_duration(text: str) -> int:
    """Whole seconds of ``1h30m``-style text or of whole days ``30d``."""
    sign = -1 if text.startswith("-") else 1
    body = text.lstrip("+-")
    if text in ("0", "+0", "-0"):
        return 0
    if re.match(_DURATION, text):
        parts = re.findall(rf"({_NUMBER})({_UNIT})", body)
        nanos = sum(Decimal(number) * UNIT_NANOS[unit] for number, unit in parts)
        return sign * int(nanos // 1_000_000_000)
    if re.match(_DAYS, text):
        return sign * int(body[:-1]) * 86_400
    raise ValueError(f"cannot parse duration {text!r}")


def duration_seconds(text: Column) -> Column:
    """Column form of :func:`parse_duration`; NULL where the text is no duration."""
    units = F.create_map(*[x for u, n in UNIT_NANOS.items() for x in (F.lit(u), F.lit(n).cast("decimal(20,0)"))])
    parts = F.regexp_extract_all(text, F.lit(f"({_NUMBER}{_UNIT})"), F.lit(1))
    nanos = F.aggregate(
        parts,
        F.lit(0).cast("decimal(38,6)"),
        lambda total, part: (
            total
            + F.regexp_extract(part, f"({_NUMBER})", 1).cast("decimal(18,6)")
            * units[F.regexp_extract(part, f"({_UNIT})$", 1)]
        ).cast("decimal(38,6)"),
    )
    sign = F.when(text.startswith("-"), -1).otherwise(1)
    days = F.regexp_extract(text, r"^[-+]?(\d+)d$", 1)
    return (
        F.when(text.rlike(_DURATION), sign * F.floor(nanos / F.lit(1_000_000_000)).cast("bigint"))
        .when(text.rlike(_DAYS), sign * F.when(days != "", days).cast("bigint") * 86_400)
        .when(text.rlike(r"^[-+]?0$"), F.lit(0))
        .cast("bigint")
    )


def _lookup(table: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def normalize_type(name: Column) -> Column:
    """Lower-case, trimmed type name with short names spelled out; a width hides no short name."""
    base = F.lower(F.trim(name))
    bare = F.trim(F.regexp_replace(base, r"\(.*\)$", ""))
    return F.coalesce(_lookup(TYPE_ALIASES, bare), base)


def _text_width(base: Column) -> Column:
    digits = F.regexp_extract(base, r"^(?:varchar|character varying)\(\s*(\d+)[^)]*\)$", 1)
    return F.when(digits != "", digits).cast("bigint")


def is_narrowing(from_type: Column, to_type: Column) -> Column:
    """True where the type change can lose data; unknown pairs count as narrowing."""
    before, after = F.lower(F.trim(from_type)), F.lower(F.trim(to_type))
    w0, w1 = _text_width(before), _text_width(after)
    r0, r1 = _lookup(NUMERIC_RANK, before), _lookup(NUMERIC_RANK, after)
    return F.coalesce(w1 < w0, r1 < r0, F.lit(True))


def strip_identifier(name: Column) -> Column:
    """Drop every character that is no ASCII letter, digit or underscore."""
    return F.regexp_replace(name, "[^a-zA-Z0-9_]", "")


def replace_identifier(name: Column) -> Column:
    """Put an underscore for every character that is no ASCII letter, digit or underscore."""
    return F.regexp_replace(name, "[^a-zA-Z0-9_]", "_")


def truncate_precision(ts: Column, precision: str) -> Column:
    """Cut a timestamp to ``s``, ``ms`` or finer; Spark keeps microseconds, so ``ns`` changes nothing."""
    unit = {"s": "second", "ms": "millisecond", "us": "microsecond"}.get(precision)
    return F.date_trunc(unit, ts) if unit else ts


def sql_type_name(data_type: T.DataType) -> str:
    """SQL name of a Spark type, as a schema catalog would show it."""
    if isinstance(data_type, T.DecimalType):
        return f"numeric({data_type.precision},{data_type.scale})"
    if isinstance(data_type, T.VarcharType):
        return f"character varying({data_type.length})"
    names = {
        T.ByteType: "smallint",
        T.ShortType: "smallint",
        T.IntegerType: "integer",
        T.LongType: "bigint",
        T.FloatType: "real",
        T.DoubleType: "double precision",
        T.StringType: "character varying",
        T.BooleanType: "boolean",
        T.TimestampType: "timestamp with time zone",
        T.TimestampNTZType: "timestamp without time zone",
        T.DateType: "date",
    }
    return names.get(type(data_type), data_type.simpleString())


def declared_type(field: T.StructField) -> str:
    """The type name a field was declared with, else the SQL name of its type."""
    return (field.metadata or {}).get("sql_type") or sql_type_name(field.dataType)


def text_width(name: str) -> int | None:
    """Width of a ``varchar(n)`` type name."""
    width = re.match(r"^\s*(?:varchar|character varying)\((\d+)\)\s*$", name.lower())
    return int(width.group(1)) if width else None


def spark_type(name: str) -> T.DataType:
    """Spark type for a SQL type name; text has no width in Spark's plans."""
    base = check_type_name(name).lower().strip()
    if base.endswith("[]"):
        return T.ArrayType(spark_type(base[:-2]))
    if text_width(base) is not None:
        return T.StringType()
    decimal = re.match(r"^(?:numeric|decimal)\((\d+)(?:,\s*(\d+))?\)$", base)
    if decimal:
        return T.DecimalType(int(decimal.group(1)), int(decimal.group(2) or 0))
    canonical = TYPE_ALIASES.get(base, base)
    simple = {
        "smallint": T.ShortType(),
        "integer": T.IntegerType(),
        "bigint": T.LongType(),
        "long": T.LongType(),
        "real": T.FloatType(),
        "double precision": T.DoubleType(),
        "double": T.DoubleType(),
        "numeric": T.DecimalType(38, 18),
        "decimal": T.DecimalType(38, 18),
        "character varying": T.StringType(),
        "text": T.StringType(),
        "string": T.StringType(),
        "boolean": T.BooleanType(),
        "timestamp with time zone": T.TimestampType(),
        "timestamp": T.TimestampNTZType(),
        "date": T.DateType(),
        "binary": T.BinaryType(),
    }
    if canonical not in simple:
        raise ValueError(f"column type {name!r} is unknown")
    return simple[canonical]
