"""Data contracts: expected columns, checks, patterns and assertion queries."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.functions.names import check_ident, declared_type, normalize_type
from deq.functions.text import engine_pattern
from deq.operators.checks import RESULT_COLUMNS, Check, quality_check
from deq.session import literal_rows

# Message texts of a contract.
COLUMN_MISSING = 'column "%s" not found in %s'
COLUMN_MISTYPED = 'column "%s": expected type "%s", got "%s"'
COLUMN_NULLABLE = 'column "%s": contract requires NOT NULL but column allows NULL'
PATTERN_RESULT = "pattern check on {}: %d violation(s)"
ASSERTION_RESULT = 'quality check "{}": found %d violations'

COLUMN_FIELDS = "dataset string, position int, column string, type string, nullable boolean"
RESULT_FIELDS = "seq int, check string, column string, passed boolean, value bigint, message string"


@dataclass
class ContractColumn:
    name: str
    type: str = ""
    nullable: bool = False
    pattern: str = ""


@dataclass
class Contract:
    """Expected columns and checks of one dataset."""

    dataset: str
    owner: str = ""
    columns: list[ContractColumn] = field(default_factory=list)
    quality: list[Check] = field(default_factory=list)

    @classmethod
    def parse(cls, raw: dict | str) -> Contract:
        """From a dict, or from JSON or (where PyYAML is there) YAML text."""
        raw = _load(raw)
        if not raw.get("dataset"):
            raise ValueError("dataset is required")
        columns = (raw.get("schema") or {}).get("columns") or []
        return cls(
            raw["dataset"],
            raw.get("owner", ""),
            [ContractColumn(**c) for c in columns],
            [Check.parse(c) for c in raw.get("quality") or []],
        )


def read_contract(spark: SparkSession, path: str) -> Contract:
    """A contract file from any file system Spark reads."""
    return Contract.parse(spark.read.text(path, wholetext=True).first()["value"])


def _load(raw: dict | str) -> dict:
    if isinstance(raw, dict):
        return raw
    try:
        import yaml
    except ImportError:
        return json.loads(raw)
    return yaml.safe_load(raw)


def live_columns(df: DataFrame, dataset: str) -> DataFrame:
    """Column metadata of a DataFrame: ``dataset, position, column, type, nullable``."""
    rows = [(dataset, i, f.name, declared_type(f), f.nullable) for i, f in enumerate(df.schema.fields)]
    return literal_rows(df.sparkSession, rows, COLUMN_FIELDS)


def schema_violations(expected: DataFrame, live: DataFrame) -> DataFrame:
    """``dataset, position, column, error`` for every expected column that is missing, mistyped or nullable.

    Works on column metadata of any number of datasets at once. Types match when one normalised
    name contains the other; an empty type is not compared.
    """
    have = live.select(
        "dataset", "column", F.col("type").alias("live_type"), F.col("nullable").alias("live_nullable"), F.lit(True).alias("found")
    )
    want_type, have_type = normalize_type(F.col("type")), normalize_type(F.col("live_type"))
    mistyped = (F.col("type") != "") & ~have_type.contains(want_type) & ~want_type.contains(have_type)
    errors = F.when(
        F.col("found").isNull(),
        F.array(F.format_string(COLUMN_MISSING, "column", "dataset")),
    ).otherwise(
        F.array_compact(
            F.array(
                F.when(mistyped, F.format_string(COLUMN_MISTYPED, "column", "type", "live_type")),
                F.when(~F.col("nullable") & F.col("live_nullable"), F.format_string(COLUMN_NULLABLE, "column")),
            )
        )
    )
    return expected.join(have, ["dataset", "column"], "left").select(
        "dataset", "position", "column", F.explode(errors).alias("error")
    )


def pattern_violations(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Check rows per column: non-null values that contain no match of the pattern; one scan."""
    counts, rows = [], []
    for i, (c, pattern) in enumerate(patterns.items()):
        text = F.col(check_ident(c)).cast("string")
        counts.append(F.count_if(text.isNotNull() & ~text.rlike(engine_pattern(pattern))).alias(f"bad_{i}"))
        bad = F.col(f"bad_{i}")
        rows.append(
            F.struct(
                F.lit(i).alias("seq"),
                F.lit(f"pattern({c})").alias("check"),
                F.lit(c).alias("column"),
                (bad == 0).alias("passed"),
                bad.alias("value"),
                F.format_string(PATTERN_RESULT.format(c), bad).alias("message"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def contract_results(
    df: DataFrame, contract: Contract, lookup: Callable[[str], DataFrame] | None = None, as_of=None
) -> DataFrame:
    """Every finding of a contract: ``part, seq, check, column, passed, value, message``.

    Parts are ``schema`` (only violations), ``quality`` and ``pattern``.
    """
    spark = df.sparkSession
    parts = []
    if contract.columns:
        rows = [(contract.dataset, i, c.name, c.type, c.nullable) for i, c in enumerate(contract.columns)]
        expected = literal_rows(spark, rows, COLUMN_FIELDS)
        wrong = schema_violations(expected, live_columns(df, contract.dataset)).withColumnRenamed("position", "seq")
        parts.append(
            wrong.select(
                F.lit("schema").alias("part"),
                "seq",
                F.lit("schema").alias("check"),
                "column",
                F.lit(False).alias("passed"),
                F.lit(1).cast("bigint").alias("value"),
                F.col("error").alias("message"),
            )
        )
    if contract.quality:
        checked = quality_check(df, contract.quality, contract.dataset, lookup, as_of)
        parts.append(checked.select(F.lit("quality").alias("part"), "seq", *RESULT_COLUMNS))
    patterns = {c.name: c.pattern for c in contract.columns if c.pattern}
    if patterns:
        parts.append(pattern_violations(df, patterns).select(F.lit("pattern").alias("part"), "seq", *RESULT_COLUMNS))
    if not parts:
        return literal_rows(spark, [], f"part string, {RESULT_FIELDS}")
    return reduce(DataFrame.unionByName, parts)


def contract_verdict(results: DataFrame, contract: Contract) -> DataFrame:
    """One row: ``dataset, schema_ok, quality_ok, passed``."""
    schema_ok = F.count_if((F.col("part") == "schema") & ~F.coalesce("passed", F.lit(False))) == 0
    quality_ok = F.count_if((F.col("part") != "schema") & ~F.coalesce("passed", F.lit(False))) == 0
    return results.agg(schema_ok.alias("schema_ok"), quality_ok.alias("quality_ok")).select(
        F.lit(contract.dataset).alias("dataset"),
        "schema_ok",
        "quality_ok",
        (F.col("schema_ok") & F.col("quality_ok")).alias("passed"),
    )


def contract_assertions(spark: SparkSession, assertions: list[dict], database: bool = True) -> DataFrame:
    """``seq, name, violations, passed, error``: every query has to return no row.

    Each query is counted on its own, so one that fails, be it while it is planned or while it
    runs, is a violation and does not stop the others.
    """
    out = []
    for i, a in enumerate(assertions if database else []):
        name = a["name"]
        try:
            found = spark.sql(a["query"]).count()
        except PySparkException as problem:
            first_line = str(problem).strip().splitlines()[0]
            out.append((i, name, None, False, f'quality check "{name}": {first_line}'))
        else:
            out.append((i, name, found, found == 0, ASSERTION_RESULT.format(name) % found if found else None))
    return literal_rows(spark, out, "seq int, name string, violations bigint, passed boolean, error string")
