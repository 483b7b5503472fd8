"""Named tables and ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deq.functions.names import check_ident


def scan(spark: SparkSession, table: str, folder: str | None = None) -> DataFrame:
    """Read a table by name: from the catalog, or from ``<folder>/<table>.parquet``."""
    check_ident(table)
    if folder:
        return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
    return spark.table(table)


def sql_query(spark: SparkSession, text: str, params: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with ``:name`` parameters; ``{name}`` stands for a DataFrame passed by keyword."""
    return spark.sql(text, args=params or {}, **tables)
