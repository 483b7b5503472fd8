"""Schema diffs and safe changes.

Schemas are metadata tables ``dataset, column, type`` and indexes ``dataset, name, columns,
unique`` (``columns`` is an array), so one job compares any number of tables.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.functions.names import check_ident, check_type_name, is_narrowing, spark_type, text_width
from deq.operators.lake import added_column, retyped_column
from deq.operators.skew import join_skewed
from deq.session import literal_rows, scratch_path

DIFF_COLUMNS = ["dataset", "name", "change", "from_type", "to_type", "breaking"]

# Characters and keywords a transform may and may not hold.
TRANSFORM_CHARS = r"""^[a-zA-Z0-9_.(),:'"\s+\-*/|]+$"""
UNSAFE_KEYWORDS = r"(?i)\b(DELETE|DROP|INSERT|UPDATE|CREATE|ALTER|TRUNCATE|EXECUTE|GRANT|REVOKE)\b"


# Literals and calls a column default may be.
DEFAULT_VALUE = r"^(\d+(\.\d+)?|'[^']*'|[a-zA-Z_][a-zA-Z0-9_]*\(\)|true|false|NULL)$"

COLUMN_FIELDS = (
    "dataset string, position int, column string, type string, nullable boolean, primary_key boolean, "
    "unique boolean, default string"
)


class BreakingChange(ValueError):
    """A plan holds a breaking change and the policy is to block."""


def _change(df: DataFrame, change: str, name, breaking: bool, from_type=None, to_type=None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        "dataset",
        name.alias("name"),
        F.lit(change).alias("change"),
        (from_type if from_type is not None else none).alias("from_type"),
        (to_type if to_type is not None else none).alias("to_type"),
        F.lit(breaking).alias("breaking"),
    )


def declared_schema(spark: SparkSession, definitions: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Column and index tables out of ``{table, columns, indexes}`` definitions."""
    columns, indexes = [], []
    for d in definitions:
        table = check_ident(d["table"], strict=True)
        for i, c in enumerate(d.get("columns") or []):
            default = c.get("default") or ""
            if default and not re.match(DEFAULT_VALUE, default):
                raise ValueError(f"column default {default!r} is invalid")
            name, kind = check_ident(c["name"], strict=True), check_type_name(c["type"])
            flags = [bool(c.get(k, False)) for k in ("nullable", "primaryKey", "unique")]
            columns.append((table, i, name, kind, *flags, default))
        for x in d.get("indexes") or []:
            names = ",".join(check_ident(c, strict=True) for c in x["columns"])
            indexes.append((table, x.get("name") or "", names, bool(x.get("unique", False))))
    index_rows = literal_rows(spark, indexes, "dataset string, name string, columns string, unique boolean")
    return literal_rows(spark, columns, COLUMN_FIELDS), index_rows.withColumn("columns", F.split("columns", ","))


def _tables(first: DataFrame, second: DataFrame) -> DataFrame:
    """``dataset, in_first, in_second`` for every table one of the sides knows."""
    a = first.select("dataset").distinct().withColumn("in_first", F.lit(True))
    b = second.select("dataset").distinct().withColumn("in_second", F.lit(True))
    return a.join(b, "dataset", "full_outer").na.fill(False)


def schema_diff(
    desired: DataFrame,
    live: DataFrame,
    desired_indexes: DataFrame | None = None,
    live_indexes: DataFrame | None = None,
) -> DataFrame:
    """``dataset, name, change, from_type, to_type, breaking`` from live to desired.

    Tables that are only live are left alone. A new table is one change; its columns are not listed.
    """
    tables = _tables(desired, live)
    parts = [_change(tables.filter("in_first AND NOT in_second"), "add_table", F.col("dataset"), False)]

    new = desired.select("dataset", "column", F.col("type").alias("to_type"))
    old = live.select("dataset", "column", F.col("type").alias("from_type"))
    change = (
        F.when(F.col("from_type").isNull(), "add_column")
        .when(F.col("to_type").isNull(), "drop_column")
        .when(F.lower("from_type") == F.lower("to_type"), F.lit(None))
        .when(is_narrowing(F.col("from_type"), F.col("to_type")), "narrow_type")
        .otherwise("widen_type")
    )
    changed = new.join(old, ["dataset", "column"], "full_outer").withColumn("change", change).filter("change IS NOT NULL")
    # Only the changes meet the list of tables, not every column.
    parts.append(
        join_skewed(changed, tables.filter("in_first AND in_second"), ["dataset"], "left_semi").select(
            "dataset",
            F.col("column").alias("name"),
            "change",
            "from_type",
            "to_type",
            F.col("change").isin("drop_column", "narrow_type").alias("breaking"),
        )
    )
    if desired_indexes is not None and live_indexes is not None:
        label = F.coalesce(
            F.nullif(F.col("name"), F.lit("")), F.concat(F.lit("idx_"), "dataset", F.lit("_"), F.array_join("columns", "_"))
        )
        key = ["dataset", "columns", "unique"]
        added = desired_indexes.join(live_indexes.select(*key), key, "left_anti")
        gone = live_indexes.join(desired_indexes.select(*key), key, "left_anti")
        dropped = join_skewed(gone, desired.select("dataset").distinct(), ["dataset"], "left_semi")
        parts += [_change(added, "add_index", label, False), _change(dropped, "drop_index", label, True)]
    return reduce(DataFrame.unionByName, parts)


def plan_safety(diff: DataFrame) -> DataFrame:
    """``dataset, changes, breaking_changes, safe`` per table."""
    return diff.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if("breaking").alias("breaking_changes"),
        (F.count_if("breaking") == 0).alias("safe"),
    )


def plan_of(diff: DataFrame, dataset: str, desired: DataFrame | None = None) -> list[dict]:
    """The changes of one table in the order :func:`apply_plan` takes them.

    With ``desired``, the columns of :func:`declared_schema`, new columns have their ``default``.

    New and changed columns come first, then dropped ones, then indexes. A table has few columns,
    so its plan may come to the driver.
    """
    steps = ["add_table", "add_column", "widen_type", "narrow_type", "drop_column", "add_index", "drop_index"]
    rank = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col("change"))
    rows = diff.filter(F.col("dataset") == dataset).orderBy(rank, "name").collect()
    plan = [r.asDict() for r in rows]
    if desired is not None:
        own = desired.filter((F.col("dataset") == dataset) & (F.col("default") != "")).collect()
        defaults = {r["column"]: r["default"] for r in own}
        plan = [c | {"default": defaults[c["name"]]} if c["change"] == "add_column" and c["name"] in defaults else c for c in plan]
    return plan


def _default(text: str | None) -> Column | None:
    """The value of a declared default; only literals and the calls of the fixed list are taken."""
    if not text:
        return None
    if not re.match(DEFAULT_VALUE, text):
        raise ValueError(f"column default {text!r} is invalid")
    return F.expr("uuid()" if text.lower() == "gen_random_uuid()" else text)


def layer_diff(source: DataFrame, registry: DataFrame) -> DataFrame:
    """``dataset, column, missing_in`` for fields that only one layer knows.

    As in a pairwise comparison, tables that one of the layers does not hold at all give no rows.
    """
    a = source.select("dataset", "column").distinct().withColumn("in_source", F.lit(True))
    b = registry.select("dataset", "column").distinct().withColumn("in_registry", F.lit(True))
    missing = F.when(F.col("in_registry").isNull(), "schema_registry").when(F.col("in_source").isNull(), "source_db")
    lone = a.join(b, ["dataset", "column"], "full_outer").withColumn("missing_in", missing).filter("missing_in IS NOT NULL")
    both = _tables(source, registry).filter("in_first AND in_second")
    return join_skewed(lone, both, ["dataset"], "left_semi").select("dataset", "column", "missing_in")


def layer_consistency(source: DataFrame, registry: DataFrame) -> DataFrame:
    """``dataset, diffs, consistent`` for every table any layer knows.

    A table the source does not hold is not consistent.
    """
    diffs = layer_diff(source, registry).groupBy("dataset").agg(F.count(F.lit(1)).alias("diffs"))
    found = F.coalesce("diffs", F.lit(0))
    return _tables(source, registry).join(diffs, "dataset", "left").select(
        "dataset", found.alias("diffs"), ((found == 0) & F.col("in_first")).alias("consistent")
    )


def apply_plan(df: DataFrame, changes: list[dict], policy: str = "block", mode: str = "online") -> DataFrame:
    """Apply column changes ``{change, name, to_type, breaking}`` in order.

    ``block`` refuses a plan with a breaking change before anything is done; ``warn`` goes on.
    Mode ``blue_green`` writes the new form beside the old one, compares row counts and returns
    the new table; indexes and new tables change no rows.
    """
    if mode not in ("online", "blue_green"):
        raise ValueError(f"unknown mode {mode!r} (online, blue_green)")
    if policy not in ("block", "warn"):
        raise ValueError(f"unknown policy {policy!r} (block, warn)")
    for c in changes:
        if c.get("breaking") and policy == "block":
            raise BreakingChange(f"the plan would break readers of {c['name']} ({c['change']}); allow it with the policy warn")
    out = df
    for c in changes:
        kind, name = c["change"], c["name"]
        if kind == "add_column":
            out = added_column(out, name, c["to_type"], _default(c.get("default")))
        elif kind in ("widen_type", "narrow_type"):
            out = retyped_column(out, name, c["to_type"])
        elif kind == "drop_column":
            out = out.drop(name)
    if mode == "blue_green":
        spark = df.sparkSession
        green = scratch_path(spark, "green")
        out.write.parquet(green)
        out = spark.read.parquet(green)
        if out.count() != df.count():
            raise RuntimeError("the new table does not hold the rows of the old one")
    return out


def check_transform(expression: str) -> str:
    """The transform, if it is a plain expression without statements."""
    if expression:
        if not re.match(TRANSFORM_CHARS, expression) or ";" in expression:
            raise ValueError(f"only plain expressions may transform a column, not {expression!r}")
        if re.search(UNSAFE_KEYWORDS, expression):
            raise ValueError(f"a statement may not transform a column: {expression!r}")
    return expression


def _transform(expression: str):
    """Spark expression for a transform written with ``NEW.col`` and ``x::type``."""
    text = re.sub(r"\bNEW\.", "", check_transform(expression))

    def cast(match: re.Match) -> str:
        name = match.group(2).strip()
        value = f"CAST({match.group(1)} AS {spark_type(name).simpleString()})"
        width = text_width(name)
        return f"left({value}, {width})" if width is not None else value

    operand = r"([\w.]+(?:\([^()]*\))?|\([^()]*\)|'[^']*')"
    text = re.sub(operand + r"::([a-zA-Z][a-zA-Z0-9_]*(?: precision)?(?:\(\d+(?:,\s*\d+)?\))?)", cast, text)
    return F.expr(text)


def expand(df: DataFrame, changes: list[dict]) -> DataFrame:
    """Add the new column of each change beside the old one.

    Types: add_column (NULL unless a transform is given), rename_column (the old value),
    change_type (the old value cast), drop_column (nothing yet).
    """
    for c in changes:
        kind = c.get("type")
        if kind not in ("add_column", "rename_column", "change_type", "drop_column"):
            raise ValueError(f"unknown change type {kind!r}")
        if kind != "add_column":
            check_ident(c["oldColumn"], strict=True)
        if kind == "drop_column":
            continue
        new, new_type = check_ident(c["newColumn"], strict=True), check_type_name(c["newType"])
        old = f"NEW.{c.get('oldColumn')}"
        default = {"add_column": "NULL", "rename_column": old, "change_type": f"{old}::{new_type}"}
        df = df.withColumn(new, _transform(c.get("transform") or default[kind]).cast(spark_type(new_type)))
    return df


def new_columns(changes: list[dict]) -> list[str]:
    return [c["newColumn"] for c in changes if c["type"] != "drop_column"]


def verify_expand(df: DataFrame, changes: list[dict]) -> DataFrame:
    """One row ``pending, safe``: rows where some new column is still NULL."""
    open_rows = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in new_columns(changes)], F.lit(False))
    return df.agg(F.count_if(open_rows).alias("pending")).select("pending", (F.col("pending") == 0).alias("safe"))


def contract(df: DataFrame, changes: list[dict]) -> DataFrame:
    """Drop the old columns; added columns stay."""
    return df.drop(*[c["oldColumn"] for c in changes if c["type"] != "add_column"])
