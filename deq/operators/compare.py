"""Drift between a baseline table and a current one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.functions.names import check_ident

# Default tolerances.
TOLERANCES = {"row_count": 0.05, "null_rate": 0.01}


def _counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)],
        ).alias("s")
    )


def compare(
    baseline: DataFrame,
    current: DataFrame,
    columns: list[str] = (),
    tolerances: dict | None = None,
) -> DataFrame:
    """``column, metric, baseline, current, within_tolerance``.

    The row-count entry is left out when the baseline is empty. Each table is scanned once.
    """
    columns = [check_ident(c) for c in columns]
    limit = {**TOLERANCES, **(tolerances or {})}
    old = _counts(baseline, columns).scalar()
    both = _counts(current, columns).select(F.col("s").alias("cur"), old.alias("base"))
    b, c = F.col("base"), F.col("cur")

    def entry(column, metric, before, after, inside):
        return F.struct(
            F.lit(column).alias("column"),
            F.lit(metric).alias("metric"),
            before.cast("double").alias("baseline"),
            after.cast("double").alias("current"),
            inside.alias("within_tolerance"),
        )

    drift = F.abs(b["rows"] - c["rows"]) / F.nullif(b["rows"], F.lit(0))
    entries = [entry("", "row_count", b["rows"], c["rows"], drift <= limit["row_count"])]
    for i, name in enumerate(columns):
        before, after = (
            F.when(side["rows"] > 0, side[f"nulls_{i}"] / F.nullif(side["rows"], F.lit(0))).otherwise(F.lit(0.0))
            for side in (b, c)
        )
        entries.append(entry(name, "null_rate", before, after, F.abs(before - after) <= limit["null_rate"]))
    return (
        both.select(F.inline(F.array(*entries)))
        .filter((F.col("metric") != "row_count") | (F.col("baseline") > 0))
    )


def compare_verdict(diffs: DataFrame) -> DataFrame:
    """One row: whether every entry is inside its tolerance."""
    return diffs.agg(F.coalesce(F.every("within_tolerance"), F.lit(True)).alias("passed"))
