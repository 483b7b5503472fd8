"""Outliers by z-score or interquartile range.

The limits of all columns are found first and reach the second scan as a scalar subquery, so no
row is joined with anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.names import check_ident
from deq.operators.checks import is_numeric
from deq.operators.profile import numeric_quantiles

# Default thresholds of the two methods.
DEFAULT_THRESHOLD = {"zscore": 3.0, "iqr": 1.5}


def _settle(method: str, threshold: float | None) -> tuple[str, float]:
    method = method if method == "iqr" else "zscore"
    return method, float(threshold) if threshold and threshold > 0 else DEFAULT_THRESHOLD[method]


def _need_numbers(df: DataFrame, columns: list[str]) -> list[str]:
    if not columns:
        raise ValueError("columns is required")
    for c in columns:
        if not is_numeric(df, check_ident(c)):
            raise ValueError(f"column {c!r} holds no numbers")
    return list(columns)


def outlier_flags(
    df: DataFrame,
    columns: list[str],
    method: str = "zscore",
    threshold: float | None = None,
) -> dict[str, Column]:
    """A condition per column that is true on its outliers and never NULL."""
    method, t = _settle(method, threshold)
    columns = _need_numbers(df, columns)
    value = {c: F.col(c).cast("double") for c in columns}
    if method == "zscore":
        stats = df.agg(
            F.struct(*[F.struct(F.avg(value[c]).alias("mean"), F.stddev_samp(value[c]).alias("sd")).alias(c) for c in columns]).alias("s")
        ).scalar()
        return {
            c: F.coalesce(F.abs((value[c] - stats[c]["mean"]) / F.nullif(stats[c]["sd"], F.lit(0.0))) > t, F.lit(False))
            for c in columns
        }
    quartiles = numeric_quantiles(df, columns, {"q1": 0.25, "q3": 0.75})
    limits = quartiles.agg(
        F.struct(
            *[
                F.struct(
                    F.max(F.when(F.col("column") == c, F.col("q1") - t * (F.col("q3") - F.col("q1")))).alias("low"),
                    F.max(F.when(F.col("column") == c, F.col("q3") + t * (F.col("q3") - F.col("q1")))).alias("high"),
                ).alias(c)
                for c in columns
            ]
        ).alias("s")
    ).scalar()
    return {
        c: F.coalesce((value[c] < limits[c]["low"]) | (value[c] > limits[c]["high"]), F.lit(False)) for c in columns
    }


def anomaly(df: DataFrame, columns: list[str], method: str = "zscore", threshold: float | None = None) -> DataFrame:
    """``column, method, threshold, sample_size, anomalies``, one row per column."""
    flags = outlier_flags(df, columns, method, threshold)
    method, t = _settle(method, threshold)
    counts = []
    for i, c in enumerate(columns):
        counts += [F.count(c).alias(f"size_{i}"), F.count_if(flags[c]).alias(f"found_{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(method).alias("method"),
            F.lit(t).alias("threshold"),
            F.col(f"size_{i}").alias("sample_size"),
            F.col(f"found_{i}").alias("anomalies"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def anomaly_rows(df: DataFrame, column: str, method: str = "zscore", threshold: float | None = None) -> DataFrame:
    """The rows whose value is an outlier."""
    return df.filter(outlier_flags(df, [column], method, threshold)[column])
