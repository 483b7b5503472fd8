"""Totals per run out of archived logs of quality tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.text import json_value

# Result names in structured test logs.
TEST_RESULTS = {"passed": "TestPass", "failed": "TestFail", "errors": "TestError", "skipped": "TestSkip"}

# Summary lines of a scan log.
SCAN_LINES = {
    "passed": r"(?i)(\d+)\s+checks?\s+passed",
    "failed": r"(?i)(\d+)\s+checks?\s+failed",
    "errors": r"(?i)(\d+)\s+checks?\s+(?:had )?error",
}

# The shape of an expectation run.
RUN_SHAPE = (
    "success boolean, evaluated int, successful int, failed int, "
    "run_results map<string, struct<validation_result: struct<statistics: "
    "struct<evaluated_expectations: int, successful_expectations: int, failed_expectations: int>>>>"
)


def event_log_totals(lines: DataFrame, run: str = "run_id", line: str = "line") -> DataFrame:
    """``run, passed, failed, errors, skipped`` out of newline-delimited JSON events.

    Lines that are no JSON are passed over. A run without events whose only line is a summary
    object takes its numbers from there.
    """
    body = json_value(F.trim(line))
    info = F.try_variant_get(body, "$.info", "map<string,variant>")
    name = F.when(info.isNotNull(), F.try_variant_get(body, "$.info.name", "string")).otherwise(
        F.try_variant_get(body, "$.name", "string")
    )
    read = lines.filter(F.trim(line) != "").select(
        run, name.alias("name"), *[F.try_variant_get(body, f"$.{t}", "int").alias(f"sum_{t}") for t in TEST_RESULTS]
    )
    counted = read.groupBy(run).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.count_if(F.col("name") == n).alias(t) for t, n in TEST_RESULTS.items()],
        *[F.max(f"sum_{t}").alias(f"sum_{t}") for t in TEST_RESULTS],
    )
    events = sum((F.col(t) for t in TEST_RESULTS), F.lit(0))
    summary = (events == 0) & (F.col("lines") == 1)
    return counted.select(
        run,
        *[F.when(summary, F.coalesce(f"sum_{t}", F.lit(0))).otherwise(F.col(t)).cast("bigint").alias(t) for t in TEST_RESULTS],
    )


def scan_log_totals(lines: DataFrame, run: str = "run_id", line: str = "line") -> DataFrame:
    """``run, passed, failed, errors`` summed over lines like ``3 checks passed``."""

    def number(pattern: str) -> Column:
        digits = F.regexp_extract(line, pattern, 1)
        return F.when(digits != "", digits).try_cast("bigint")

    return lines.groupBy(run).agg(
        *[F.coalesce(F.sum(number(p)), F.lit(0)).alias(t) for t, p in SCAN_LINES.items()]
    )


def expectation_totals(runs: DataFrame, run: str = "run_id", document: str = "document") -> DataFrame:
    """``run, success, evaluated, successful, failed``: flat totals plus those of all nested results."""
    read = runs.select(run, F.from_json(document, RUN_SHAPE).alias("r"))

    def total(flat: str, nested: str) -> Column:
        parts = F.coalesce(F.map_values("r.run_results"), F.array())
        return F.aggregate(
            parts,
            F.coalesce(F.col(f"r.{flat}"), F.lit(0)),
            lambda acc, x: acc + F.coalesce(x["validation_result"]["statistics"][nested], F.lit(0)),
        ).cast("bigint")

    return read.select(
        run,
        F.coalesce("r.success", F.lit(False)).alias("success"),
        total("evaluated", "evaluated_expectations").alias("evaluated"),
        total("successful", "successful_expectations").alias("successful"),
        total("failed", "failed_expectations").alias("failed"),
    )
