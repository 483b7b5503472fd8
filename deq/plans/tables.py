"""Derived inputs on the given tables, used by the registered queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.sources.tables import scan

AS_OF = datetime(2024, 1, 31)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, "events", folder)


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Events with NULLs, repeated ids and unknown users."""
    i = F.col("event_id")
    return events(spark, folder).select(
        F.when(i % 250 == 1, i - 1).otherwise(i).alias("event_id"),
        "ts",
        F.when(i % 101 == 0, F.col("user_id") + 100000).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(i % 17 != 0, F.col("value")).alias("value"),
    )


DIRTY = """(SELECT CASE WHEN event_id % 250 = 1 THEN event_id - 1 ELSE event_id END AS event_id, ts,
  CASE WHEN event_id % 101 = 0 THEN user_id + 100000 ELSE user_id END AS user_id,
  event_type, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value FROM events)"""


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as a change stream."""
    kind = F.col("event_type")
    return events(spark, folder).select(
        F.col("event_id").alias("seq"),
        "ts",
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("op"),
        F.when(F.col("user_id") % 2 == 0, "public.users").otherwise("public.orders").alias("tbl"),
        F.concat(F.lit("src_"), (F.col("user_id") % 4).cast("string")).alias("source_id"),
        F.col("user_id").alias("k"),
        "value",
    )


CHANGES = """(SELECT event_id AS seq, ts,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
  CASE WHEN user_id % 2 = 0 THEN 'public.users' ELSE 'public.orders' END AS tbl,
  concat('src_', CAST(user_id % 4 AS VARCHAR)) AS source_id, user_id AS k, value FROM events)"""


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Event payloads, some of them broken."""
    i = F.col("event_id")
    return events(spark, folder).select(
        "event_id",
        F.when(i % 29 == 0, "not json")
        .when(i % 13 == 0, '{"x": 1}')
        .when(i % 31 == 0, "[1, 2]")
        .otherwise(F.col("props"))
        .alias("payload"),
    )


PAYLOADS = """(SELECT event_id, CASE WHEN event_id % 29 = 0 THEN 'not json'
  WHEN event_id % 13 = 0 THEN '{"x": 1}' WHEN event_id % 31 = 0 THEN '[1, 2]' ELSE props END AS payload FROM events)"""


def event_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events as points: ``measurement, tags, fields, texts, ts``."""
    from deq.sources.points import flat_points

    k = F.get_json_object("props", "$.k").cast("double").alias("k")
    flat = events(spark, folder).select(
        F.col("event_type").alias("measurement"), F.col("user_id").cast("string").alias("user"), "value", k, "ts"
    )
    return flat_points(flat, tags=["user"], fields=["value", "k"])


POINTS = """(SELECT event_type AS measurement, CAST(user_id AS VARCHAR) AS "user", value,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, ts, event_id FROM events)"""


def tenant_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the tenant they belong to."""
    customers = scan(spark, "customer", folder).select("c_custkey", "c_nationkey")
    orders = scan(spark, "orders", folder)
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.concat(F.lit("t"), F.col("c_nationkey").cast("string")).alias("tenant"),
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )


TENANT_ORDERS = """(SELECT concat('t', CAST(c_nationkey AS VARCHAR)) AS tenant, o_orderkey, o_custkey, o_totalprice,
  o_orderdate, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey)"""


TYPE_LADDER = ["smallint", "integer", "bigint", "real", "double precision", "numeric", "varchar(10)", "varchar(50)", "boolean"]


def declared_columns(spark: SparkSession, folder: str, status: str, shift: int) -> DataFrame:
    """Column metadata read out of line items: a supplier is a table, a part a column of it."""
    parts = F.array(*[F.lit(t) for t in TYPE_LADDER])
    pick = (F.col("l_partkey") + F.col("most") * shift) % len(TYPE_LADDER)
    return (
        scan(spark, "lineitem", folder)
        .filter(F.col("l_linestatus") == status)
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.max("l_linenumber").alias("most"))
        .select(
            F.format_string("s%d", "l_suppkey").alias("dataset"),
            F.col("l_partkey").cast("int").alias("position"),
            F.format_string("c%d", "l_partkey").alias("column"),
            F.element_at(parts, (pick + 1).cast("int")).alias("type"),
            (F.col("most") > 4).alias("nullable"),
        )
    )


def declared_sql(status: str, shift: int) -> str:
    ladder = ", ".join(f"'{t}'" for t in TYPE_LADDER)
    return f"""(SELECT concat('s', CAST(l_suppkey AS VARCHAR)) AS dataset, CAST(l_partkey AS INTEGER) AS position,
  concat('c', CAST(l_partkey AS VARCHAR)) AS "column",
  ([{ladder}])[CAST((l_partkey + most * {shift}) % {len(TYPE_LADDER)} + 1 AS INTEGER)] AS type, most > 4 AS nullable
  FROM (SELECT l_suppkey, l_partkey, max(l_linenumber) AS most FROM lineitem WHERE l_linestatus = '{status}' GROUP BY ALL))"""
