"""Column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.names import check_ident
from deq.operators.checks import is_numeric, value_counts
from deq.operators.quantiles import column_quantiles

# The percentiles of a profile.
PERCENTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}


def _per_column(df: DataFrame, columns: list[str], stats: dict) -> DataFrame:
    """One scan for all statistics of all columns, turned into one row per column."""
    aggregates, structs = [], []
    for i, c in enumerate(columns):
        fields = [F.lit(c).alias("column")]
        for name, build in stats.items():
            aggregates.append(build(c).alias(f"{name}_{i}"))
            fields.append(F.col(f"{name}_{i}").alias(name))
        structs.append(F.struct(*fields))
    return df.agg(F.count(F.lit(1)).alias("rows"), *aggregates).select("rows", F.inline(F.array(*structs)))


def _moment(df: DataFrame, fn):
    def build(c: str) -> Column:
        return fn(F.col(c).cast("double")) if is_numeric(df, c) else F.lit(None).cast("double")

    return build


def profile_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, row_count, null_count, null_rate``; the rate of an empty table is 0."""
    counted = _per_column(df, [check_ident(c) for c in columns], {"null_count": lambda c: F.count_if(F.col(c).isNull())})
    rate = F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows")).otherwise(F.lit(0.0))
    return counted.select("column", F.col("rows").alias("row_count"), "null_count", rate.alias("null_rate"))


def profile_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, min, max`` as text."""
    stats = {"min": lambda c: F.min(c).cast("string"), "max": lambda c: F.max(c).cast("string")}
    return _per_column(df, [check_ident(c) for c in columns], stats).drop("rows")


def profile_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, mean, stddev`` (sample form); NULL for columns that hold no numbers."""
    stats = {"mean": _moment(df, F.avg), "stddev": _moment(df, F.stddev_samp)}
    return _per_column(df, [check_ident(c) for c in columns], stats).drop("rows")


def profile_distinct(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """``column, distinct_count`` without NULL; exact unless ``approximate`` is asked for."""
    columns = [check_ident(c) for c in columns]
    if approximate:
        return _per_column(df, columns, {"distinct_count": lambda c: F.approx_count_distinct(c)}).drop("rows")
    return _distinct(value_counts(df, columns), columns)


def _distinct(counts: DataFrame, columns: list[str]) -> DataFrame:
    found = counts.groupBy("name").agg(F.count_if("present").alias("distinct"))
    sums = [F.coalesce(F.sum(F.when(F.col("name") == c, F.col("distinct"))), F.lit(0)).alias(f"d_{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"d_{i}").alias("distinct_count")) for i, c in enumerate(columns)]
    return found.agg(*sums).select(F.inline(F.array(*rows)))


def numeric_quantiles(df: DataFrame, columns: list[str], probabilities: dict[str, float]) -> DataFrame:
    """``column`` and one column per probability, exact, for columns of numbers."""
    return _spread(column_quantiles(df, columns, probabilities), probabilities)


def _spread(found: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    return found.groupBy("column").agg(
        *[F.max(F.when(F.col("name") == p, F.col("number"))).alias(p) for p in probabilities]
    )


def profile_percentiles(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """``column, p25 … p99``: the smallest value whose cumulative share reaches p."""
    columns = [check_ident(c) for c in columns]
    if approximate:
        stats = {n: (lambda c, p=p: F.percentile_approx(F.col(c).cast("double"), p)) for n, p in PERCENTILES.items()}
        return _per_column(df, columns, stats).drop("rows")
    return numeric_quantiles(df, columns, PERCENTILES)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with all statistics.

    One scan answers counts, extremes and moments, the counted values of all columns the distinct
    counts. Percentiles move no values but those close to a wanted rank.
    """
    columns = [check_ident(c) for c in columns]
    stats = {
        "null_count": lambda c: F.count_if(F.col(c).isNull()),
        "min": lambda c: F.min(c).cast("string"),
        "max": lambda c: F.max(c).cast("string"),
        "mean": _moment(df, F.avg),
        "stddev": _moment(df, F.stddev_samp),
    }
    out = _per_column(df, columns, stats)
    numeric = [c for c in columns if is_numeric(df, c)]
    # One row per column on every side.
    out = out.join(F.broadcast(_distinct(value_counts(df, columns), columns)), "column", "left")
    if numeric:
        out = out.join(F.broadcast(numeric_quantiles(df, numeric, PERCENTILES)), "column", "left")
    else:
        out = out.withColumns({p: F.lit(None).cast("double") for p in PERCENTILES})
    rate = F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows")).otherwise(F.lit(0.0))
    return out.select(
        "column",
        F.col("rows").alias("row_count"),
        "null_count",
        rate.alias("null_rate"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        "min",
        "max",
        "mean",
        "stddev",
        *PERCENTILES,
    )
