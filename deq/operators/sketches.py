"""Approximate profiles of any range of days out of stored, mergeable sketches.

Each day and column has one row: counts, an HLL sketch of the values and a KLL sketch of the numbers.
A profile of a range merges the rows of its days; the table itself is not read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.functions.names import check_ident
from deq.functions.text import group_text
from deq.operators.checks import is_numeric, type_of
from deq.operators.profile import PERCENTILES
from deq.session import materialize
from deq.sources.layouts import write_partitioned

#: Two to this power registers of a distinct sketch: a standard error of about 0.8 %.
REGISTERS = 14

#: Size parameter of a quantile sketch: ranks are right within about 0.3 % of the rows.
RANKS = 800


def _cell(df: DataFrame, column: str) -> Column:
    """What a sketch sees of a column: its value as text and, if it is one, as a number that is not NaN."""
    number = F.col(column).cast("double") if is_numeric(df, column) else F.lit(None).cast("double")
    return F.struct(
        F.lit(column).alias("column"),
        F.col(column).isNull().alias("empty"),
        group_text(F.col(column), type_of(df, column)).alias("value"),
        F.when(~F.isnan(number), number).alias("number"),
    )


def write_sketches(df: DataFrame, path: str, time_column: str, columns: list[str]) -> None:
    """Store the sketches of every day in ``df``, in place of what was stored for those days.

    ``df`` has to hold the whole of each of its days. Rows are summed up in each task before the
    shuffle, so a day or column with most of the rows stays small. Rows without a time go to the day
    NULL. One scan serves all columns.
    """
    check_ident(time_column)
    cells = F.inline(F.array(*[_cell(df, check_ident(c)) for c in columns]))
    rows = df.select(F.to_date(time_column).alias("day"), cells)
    sketches = rows.groupBy("day", "column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("empty").alias("nulls"),
        F.hll_sketch_agg("value", REGISTERS).alias("distinct"),
        F.kll_sketch_agg_double("number", RANKS).alias("ranks"),
        F.count("number").alias("numbers"),
        F.min("number").alias("least"),
        F.max("number").alias("greatest"),
    )
    write_partitioned(materialize(sketches), path, ["day"], mode="overwrite", keep_others=True)


def sketched_profile(spark: SparkSession, path: str, start: date | None = None, stop: date | None = None) -> DataFrame:
    """``column, row_count, null_count, distinct_count, min, max, p25 … p99`` of the days ``start <= day < stop``.

    Counts and extremes are exact, distinct counts and percentiles as good as the merged sketches. A
    column without numbers has no extremes and percentiles. Without bounds the day NULL takes part.
    """
    days = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    if start is not None:
        days = days.filter(F.col("day") >= F.lit(start))
    if stop is not None:
        days = days.filter(F.col("day") < F.lit(stop))
    merged = days.groupBy("column").agg(
        F.sum("rows").alias("row_count"),
        F.sum("nulls").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"),
        F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("ranks"))).alias("ranks"),
        F.sum("numbers").alias("numbers"),
        F.min("least").alias("min"),
        F.max("greatest").alias("max"),
    )
    quantile = {
        p: F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(x))) for p, x in PERCENTILES.items()
    }
    return merged.select(
        "column", "row_count", "null_count", "distinct_count", "min", "max", *[q.alias(p) for p, q in quantile.items()]
    )


def rank_errors(found: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, name, rank_error``: how far each percentile of a profile lies from its rank, as a share of the rows.

    ``df`` holds the rows the profile is about; a value that occurs often covers all its ranks.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in columns]
    values = df.select(F.inline(F.array(*cells))).filter("number IS NOT NULL")
    wanted = F.array(*[F.struct(F.lit(p).alias("name"), F.lit(x).alias("share"), F.col(p).alias("at")) for p, x in PERCENTILES.items()])
    points = found.select(F.col("column").alias("_column"), F.inline(wanted))
    # Five points per column.
    joined = values.join(F.broadcast(points), F.col("column") == F.col("_column"))
    ranks = joined.groupBy("column", "name", "share").agg(
        (F.count_if(F.col("number") < F.col("at")) / F.count(F.lit(1))).alias("low"),
        (F.count_if(F.col("number") <= F.col("at")) / F.count(F.lit(1))).alias("high"),
    )
    error = F.greatest(F.col("low") - F.col("share"), F.col("share") - F.col("high"), F.lit(0.0))
    return ranks.select("column", "name", error.alias("rank_error"))
