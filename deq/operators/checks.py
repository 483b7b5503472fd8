"""Quality checks on a table.

All checks that need nothing but a scan are answered by one aggregate. ``unique`` columns of all
checks share one shuffle. Every operator returns rows ``check, column, passed, value, message``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from deq.functions.names import check_ident, parse_duration
from deq.functions.text import group_text

# Message texts of the checks.
NULLS_FOUND, NO_NULLS = 'column "{}" has %d null(s)', "all columns have no nulls"
DUPLICATES_FOUND, ALL_UNIQUE = 'column "{}" has %d duplicate value(s)', "all columns are unique"
NO_ROWS, LAST_UPDATE = "table is empty (no rows found)", "last update was %ds ago (max allowed: {}s)"
ROWS_BELOW, ROWS_ABOVE, ROWS = "row count %d is below minimum {}", "row count %d exceeds maximum {}", "row count: %d"
ORPHANS_FOUND, NO_ORPHANS = "%d orphan row(s) in {}.{} not found in {}.{}", "no orphan rows found"
QUERY_RESULT = "query returned %d (threshold: {})"

RESULT_COLUMNS = ["check", "column", "passed", "value", "message"]


@dataclass
class Check:
    """One assertion: its type and the parameters of that type."""

    type: str
    config: dict = field(default_factory=dict)

    @classmethod
    def parse(cls, raw: Check | dict) -> Check:
        """Accept parameters under ``config`` or beside ``type``."""
        if isinstance(raw, Check):
            return raw
        nested = raw.get("config")
        config = nested if isinstance(nested, dict) else {k: v for k, v in raw.items() if k != "type"}
        return cls(raw.get("type", ""), dict(config))

    def need(self, name: str):
        value = self.config.get(name)
        if value in (None, "", []):
            raise ValueError(f"{self.type}: {name} is required")
        return value

    def columns(self) -> list[str]:
        return [check_ident(c) for c in self.need("columns")]


def _result(name: str, column: str, passed: Column, value: Column, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(column).alias("column"),
        passed.cast("boolean").alias("passed"),
        value.cast("bigint").alias("value"),
        message.cast("string").alias("message"),
    )


def _per_column_verdict(name: str, counts: dict[str, Column], complaint: str, praise: str) -> Column:
    notes = [
        F.when(n > 0, F.format_string(complaint.format(c), n)) for c, n in counts.items()
    ]
    total = reduce(lambda a, b: a + b, counts.values())
    message = F.when(total > 0, F.concat_ws("; ", *notes)).otherwise(praise)
    return _result(name, ",".join(counts), total == 0, total, message)


def _row_count_verdict(check: Check, count: Column) -> Column:
    lowest, highest = int(check.config.get("min", -1)), int(check.config.get("max", -1))
    below = (count < lowest) if lowest >= 0 else F.lit(False)
    above = (count > highest) if highest >= 0 else F.lit(False)
    complaints = F.concat_ws(
        "; ",
        F.when(below, F.format_string(ROWS_BELOW.format(lowest), count)),
        F.when(above, F.format_string(ROWS_ABOVE.format(highest), count)),
    )
    message = F.when(below | above, complaints).otherwise(F.format_string(ROWS, count))
    return _result("row_count", "", ~(below | above), count, message)


def _freshness_verdict(check: Check, newest: Column, as_of: Column) -> Column:
    allowed = parse_duration(check.need("maxAge"))
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))
    age = F.floor(micros / 1_000_000).cast("bigint")
    message = F.when(newest.isNull(), NO_ROWS).otherwise(F.format_string(LAST_UPDATE.format(allowed), age))
    return _result("freshness", check.need("column"), F.coalesce(micros <= allowed * 1_000_000, F.lit(False)), age, message)


def _rows(one_row: DataFrame, verdicts: list[tuple[int, Column]]) -> DataFrame:
    """One output row per numbered verdict over a one-row aggregate."""
    tagged = [F.struct(F.lit(i).alias("seq"), *[v[c].alias(c) for c in RESULT_COLUMNS]) for i, v in verdicts]
    return one_row.select(F.inline(F.array(*tagged)))


def duplicate_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``name, duplicates``: distinct values seen more than once, for all columns in one shuffle.

    NULL counts as one value. A hot value is summed up inside each task before the shuffle.
    """
    return (
        value_counts(df, columns)
        .groupBy("name")
        .agg(F.count_if(F.col("n") > 1).alias("duplicates"))
    )


def _slots(column: Column, data_type: T.DataType) -> dict[str, Column]:
    """The typed cells a value is counted by; numbers stay numbers, all else is text."""
    if isinstance(data_type, T.IntegralType):
        return {"whole": column.cast("bigint")}
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return {"real": column.cast("double")}
    if isinstance(data_type, T.DecimalType):
        return {"real": column.cast("double"), "text": column.cast("string")}
    return {"text": group_text(column, data_type)}


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``name, present, number, n``: occurrences of each value of each column.

    One row per value, NULL (not ``present``) included; ``number`` is NULL for text. All columns
    go through one scan and one shuffle.
    """
    kinds = {"whole": "bigint", "real": "double", "text": "string"}
    slots = {c: _slots(F.col(c), type_of(df, c)) for c in columns}
    used = [k for k in kinds if any(k in s for s in slots.values())]
    cells = [
        F.struct(F.lit(i).alias("i"), *[slots[c].get(k, F.lit(None).cast(kinds[k])).alias(k) for k in used])
        for i, c in enumerate(columns)
    ]
    counted = df.select(F.inline(F.array(*cells))).groupBy("i", *used).agg(F.count(F.lit(1)).alias("n"))
    numbers = [F.col(k).cast("double") for k in used if k != "text"] or [F.lit(None).cast("double")]
    present = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in used])
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(
        F.element_at(names, F.col("i") + 1).alias("name"), present.alias("present"), F.coalesce(*numbers).alias("number"), "n"
    )


def type_of(df: DataFrame, column: str) -> T.DataType:
    """Type of a column or, with dots, of a field inside one."""
    return df.select(F.col(column)).schema.fields[0].dataType


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(type_of(df, column), T.NumericType)


def _named(kind: str, column: str) -> str:
    """Name of an aggregate; the dots of a field's path would be read as a path again."""
    return f"{kind}_" + column.replace("_", "_u").replace(".", "_d")


def orphan_count(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """One row ``orphans``: rows whose key is missing in ``ref``; a NULL key is an orphan.

    Keys are counted before the join, so a key that fills a third of the table is one row in it.
    """
    keys = df.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = ref.select(F.col(ref_column).alias("key")).filter(F.col("key").isNotNull()).distinct()
    lost = keys.join(known, "key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def quality_check(
    df: DataFrame,
    checks: list[Check | dict],
    table: str = "table",
    lookup: Callable[[str], DataFrame] | None = None,
    as_of=None,
) -> DataFrame:
    """Run a list of checks; one row each, in the order given (column ``seq``)."""
    spark: SparkSession = df.sparkSession
    lookup = lookup or spark.table
    now = F.lit(as_of) if as_of is not None else F.current_timestamp()
    parsed = [Check.parse(c) for c in checks]
    if not parsed:
        raise ValueError("checks is required")
    aggregates: dict[str, Column] = {}
    scanned: list[tuple[int, Column]] = []
    unique: list[tuple[int, list[str]]] = []
    others: list[DataFrame] = []

    for i, check in enumerate(parsed):
        if check.type == "not_null":
            names = check.columns()
            for c in names:
                aggregates[_named("nulls", c)] = F.count_if(F.col(c).isNull())
            counts = {c: F.col(_named("nulls", c)) for c in names}
            scanned.append((i, _per_column_verdict("not_null", counts, NULLS_FOUND, NO_NULLS)))
        elif check.type == "row_count":
            aggregates["rows"] = F.count(F.lit(1))
            scanned.append((i, _row_count_verdict(check, F.col("rows"))))
        elif check.type == "freshness":
            c = check_ident(check.need("column"))
            aggregates[_named("newest", c)] = F.max(c)
            scanned.append((i, _freshness_verdict(check, F.col(_named("newest", c)), now)))
        elif check.type == "unique":
            unique.append((i, check.columns()))
        elif check.type == "referential":
            c, other, ref = (check_ident(check.need(k)) for k in ("column", "refTable", "refColumn"))
            lost = F.format_string(ORPHANS_FOUND.format(table, c, other, ref), F.col("orphans"))
            message = F.when(F.col("orphans") == 0, NO_ORPHANS).otherwise(lost)
            verdict = _result("referential", c, F.col("orphans") == 0, F.col("orphans"), message)
            others.append(_rows(orphan_count(df, c, lookup(other), ref), [(i, verdict)]))
        elif check.type == "custom_sql":
            others.append(_rows(*_custom_sql(spark, check, i)))
        else:
            raise ValueError(f"unknown check type {check.type!r}")

    if scanned:
        one_row = df.agg(*[a.alias(n) for n, a in aggregates.items()])
        others.insert(0, _rows(one_row, scanned))
    if unique:
        columns = sorted({c for _, names in unique for c in names})
        dups = duplicate_counts(df, columns).agg(
            *[F.coalesce(F.sum(F.when(F.col("name") == c, F.col("duplicates"))), F.lit(0)).alias(_named("dup", c)) for c in columns]
        )
        verdicts = [
            (i, _per_column_verdict("unique", {c: F.col(_named("dup", c)) for c in names}, DUPLICATES_FOUND, ALL_UNIQUE))
            for i, names in unique
        ]
        others.append(_rows(dups, verdicts))
    return reduce(DataFrame.unionByName, others)


def _custom_sql(spark: SparkSession, check: Check, seq: int):
    threshold = int(check.config.get("threshold", 0))
    query = spark.sql(check.need("query"))
    value = F.col(query.columns[0]).cast("bigint")
    # Only the first row of the query counts, as with any single-value check.
    # No row and NULL are no answer, and no answer does not pass.
    one_row = query.limit(1).select(value.alias("found")).agg(F.first("found").alias("found"))
    message = F.coalesce(F.format_string(QUERY_RESULT.format(threshold), F.col("found")), F.lit("query gave no value"))
    message = F.when(F.col("found").isNull(), "query gave no value").otherwise(message)
    good = F.coalesce(F.col("found") <= threshold, F.lit(False))
    return one_row, [(seq, _result("custom_sql", "", good, F.col("found"), message))]


def passed(results: DataFrame) -> DataFrame:
    """One row: whether every check passed."""
    return results.agg(F.coalesce(F.every(F.coalesce("passed", F.lit(False))), F.lit(True)).alias("passed"))
