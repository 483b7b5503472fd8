"""Change-data, versioned-table and tenancy queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from deq.operators import lake, tenancy
from deq.operators.change_data import (
    cdc_filter,
    ddl_history,
    lag_status,
    monitor,
    schema_history,
    snapshot_events,
    source_lag,
    table_stats,
)
from deq.plans.tables import AS_OF, CHANGES, TENANT_ORDERS, changes, events, tenant_orders
from deq.session import scratch_path
from deq.sources.tables import scan

KEY, ORDER = ["k"], ["ts", "seq"]
CUT = datetime(2024, 1, 16)


def cdc_filter_rows(spark, folder):
    # The table name sits in "source" for some events, as connectors differ.
    odd = F.col("seq") % 2 == 1
    rows = changes(spark, folder).withColumns(
        {"table": F.when(odd, "").otherwise(F.col("tbl")), "source": F.when(odd, F.col("tbl")).otherwise("elsewhere")}
    )
    return cdc_filter(rows, ["public.users"], ["INSERT", "DELETE"]).select("seq", "op", "tbl", "k")


def cdc_snapshot(spark, folder):
    return snapshot_events({t: scan(spark, t, folder) for t in ("region", "nation", "customer", "supplier")})


def _ddl(spark, folder):
    """Every signup read as a DDL statement on the user's table."""
    who = F.col("user_id").cast("string")
    return events(spark, folder).filter(F.col("event_type") == "signup").select(
        F.concat(F.lit("t"), who).alias("tbl"),
        F.col("event_id").alias("version"),
        F.concat(F.lit("ALTER TABLE t"), who, F.lit(" ADD COLUMN c"), F.col("event_id").cast("string")).alias("ddl"),
        F.col("ts").alias("applied_at"),
    )


def cdc_table_stats(spark, folder):
    ddl = _ddl(spark, folder).select(F.lit("DDL").alias("op"), F.col("tbl"))
    own = changes(spark, folder).select("op", F.concat(F.lit("t"), F.col("k").cast("string")).alias("tbl"))
    stats = table_stats(own.unionByName(ddl))
    return stats.join(ddl_history(stats), "tbl", "left")


def _lag(spark, folder):
    rows = changes(spark, folder).withColumn("payload", F.concat(F.col("tbl"), F.col("k").cast("string")))
    return source_lag(rows, AS_OF, acknowledged=500)


def cdc_backpressure(spark, folder):
    per_user = (
        events(spark, folder)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), (F.lit(2678400) - F.unix_seconds(F.max("ts").cast("timestamp")) + F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))).alias("age"))
    )
    status = lag_status(F.col("n") * 1_000_000, F.col("age"), max_bytes=70_000_000, max_seconds=100_000)
    return per_user.select("user_id", "n", "age", status.alias("status"), lag_status(F.col("n"), F.col("age"), 0, 0).alias("off"))


def _target(spark, folder):
    """State before the second half of January."""
    old = changes(spark, folder).filter(F.col("ts") < F.lit(CUT))
    return lake.latest_per_key(old, KEY, ORDER).filter("op <> 'DELETE'").drop("op")


def lake_upsert(spark, folder):
    recent = changes(spark, folder).filter(F.col("ts") >= F.lit(CUT))
    return lake.upsert(_target(spark, folder), recent, KEY, ORDER)


def lake_upsert_table(spark, folder):
    path = scratch_path(spark, "keyed")
    lake.write_bucketed(_target(spark, folder), path, KEY, 16)
    recent = changes(spark, folder).filter(F.col("ts") >= F.lit(CUT))
    lake.upsert_table(spark, path, recent, KEY, ORDER, 16)
    return spark.read.parquet(path).drop("bucket")


def _log(spark, folder):
    return changes(spark, folder).withColumn("version", F.dayofmonth("ts"))


def lake_create_table(spark, folder):
    path = scratch_path(spark, "table")
    fields = [
        {"name": "event_id", "type": "long", "required": True, "doc": "event number"},
        {"name": "event_type", "type": "varchar(20)"},
        {"name": "amount", "type": "numeric(12,2)"},
        {"name": "at", "type": "timestamp"},
    ]
    made = lake.create_table(spark, path, fields)
    again = lake.create_table(spark, path, fields)
    rows = events(spark, folder).select(
        "event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("amount"), F.col("ts").alias("at")
    )
    lake.write(rows, path, "append")
    stored = spark.read.schema(lake.schema_of(fields)).parquet(path)
    return stored.groupBy("event_type").agg(
        F.count("event_id").alias("n"), F.sum("amount").cast("double").alias("total"), F.max("at").alias("newest")
    ).withColumns({"created": F.lit(made), "created_again": F.lit(again)})


def lake_append(spark, folder):
    rows = events(spark, folder)
    middle = F.lit(CUT)
    first = rows.filter(F.col("ts") < middle).select("event_id", "event_type")
    second = rows.filter(F.col("ts") >= middle).select("event_id", "event_type", "value")
    return lake.append(first, second)


def lake_overwrite(spark, folder):
    path = scratch_path(spark, "days")
    rows = events(spark, folder).select("event_id", "value", F.dayofmonth("ts").alias("day"))
    lake.write(rows, path, "append", ["day"])
    lake.write(rows.filter("day > 20").withColumn("value", F.col("value") * 2), path, "overwrite", ["day"])
    return spark.read.parquet(path).groupBy("day").agg(F.count("event_id").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def lake_compact(spark, folder):
    small, big = scratch_path(spark, "small"), scratch_path(spark, "big")
    events(spark, folder).repartition(16, "event_id").write.parquet(small)
    report = lake.compact(spark, small, big, target_bytes=64_000_000)
    return spark.read.parquet(big).select("event_id", "value", "ts").withColumn(
        "fewer_files", F.lit(report["files_after"] < report["files_before"])
    )


def lake_describe(spark, folder):
    rows = events(spark, folder)
    return lake.describe(rows, _log(spark, folder), "events").withColumn(
        "rows", rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    )


def lake_evolve(spark, folder):
    return lake.evolve_schema(
        scan(spark, "orders", folder),
        [
            {"action": "add-column", "name": "phone", "type": "string", "doc": "phone number"},
            {"action": "rename-column", "name": "o_orderstatus", "to": "status"},
            {"action": "update-column-type", "name": "o_custkey", "type": "double"},
            {"action": "delete-column", "name": "o_orderpriority"},
            {"action": "set-properties"},
        ],
    )


LIMIT = {"rowCount": 600, "queryRate": 100, "storageBytes": 10_737_418_240}


def _metrics(spark, folder):
    return tenancy.tenant_metrics(tenant_orders(spark, folder), "tenant", "o_orderdate")


def tenant_metrics(spark, folder):
    found = _metrics(spark, folder)
    rate = F.round("queryRate", 9)
    return found.select("tenant", "rowCount", rate.alias("queryRate"), (F.col("storageBytes") > F.col("rowCount")).alias("has_bytes"))


def tenant_promotion(spark, folder):
    big = F.substring("tenant", 2, 9).cast("int") % 3
    tiers = F.element_at(F.array(*[F.lit(t) for t in tenancy.TIERS]), big + 1)
    rated = tenancy.evaluate_promotion(_metrics(spark, folder).withColumn("current_tier", tiers), LIMIT)
    return rated.select("tenant", "current_tier", "should_promote", "recommended_tier", "reason")


def _big_tenants(spark, folder):
    return tenancy.tenant_counts(tenant_orders(spark, folder), "tenant").filter(F.col("rows") > 600).select("tenant")


def tenant_promote(spark, folder):
    rows, big = tenant_orders(spark, folder), _big_tenants(spark, folder)
    path = scratch_path(spark, "tenants")
    moved = tenancy.promote(rows, big, "tenant", path).withColumn("side", F.lit("dedicated"))
    left = tenancy.tenant_counts(tenancy.without_tenants(rows, big, "tenant"), "tenant").withColumn("side", F.lit("shared"))
    return moved.unionByName(left)


def tenant_demote(spark, folder):
    rows, big = tenant_orders(spark, folder), _big_tenants(spark, folder)
    path = scratch_path(spark, "tenants")
    tenancy.promote(rows, big, "tenant", path)
    back = tenancy.demote(tenancy.without_tenants(rows, big, "tenant"), tenancy.read_promoted(spark, path, rows.schema), "tenant")
    return back.select("tenant", "o_orderkey", "o_totalprice", "o_orderdate")


def tenant_deprovision(spark, folder):
    rows = {"tenant_orders": tenant_orders(spark, folder)}
    path = scratch_path(spark, "archive")
    tenancy.deprovision(rows, "tenant", "t3", "archive", path)
    left = tenancy.deprovision(rows, "tenant", "t3", "delete")["tenant_orders"]
    kept = spark.read.parquet(f"{path}/t3_archived/tenant_orders")
    return left.select("o_orderkey", F.lit("shared").alias("side")).unionByName(kept.select("o_orderkey", F.lit("archive").alias("side")))


def tenant_resolve(spark, folder):
    strategy = F.element_at(F.array(*[F.lit(t) for t in tenancy.TIERS]), (F.col("c_custkey") % 3 + 1).cast("int"))
    tenant = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    return scan(spark, "customer", folder).select(
        "c_custkey", tenancy.resolve_table(strategy, tenant, F.lit("orders"), "t_").alias("resolved")
    )


QUERIES = {
    "cdc_filter": cdc_filter_rows,
    "cdc_snapshot": cdc_snapshot,
    "cdc_schema_history": lambda s, f: schema_history(_ddl(s, f), "t7"),
    "cdc_table_stats": cdc_table_stats,
    "cdc_lag": _lag,
    "cdc_backpressure": cdc_backpressure,
    "cdc_monitor": lambda s, f: monitor(_lag(s, f), max_seconds=1000, max_bytes=10_000_000),
    "lake_create_table": lake_create_table,
    "lake_append": lake_append,
    "lake_overwrite": lake_overwrite,
    "lake_upsert": lake_upsert,
    "lake_upsert_table": lake_upsert_table,
    "lake_compact": lake_compact,
    "lake_snapshots": lambda s, f: lake.snapshots(_log(s, f)),
    "lake_as_of": lambda s, f: lake.as_of(_log(s, f), KEY, ORDER, version=9),
    "lake_as_of_time": lambda s, f: lake.as_of(_log(s, f), KEY, ORDER, time=CUT),
    "lake_expire": lambda s, f: lake.expire(_log(s, f), KEY, ORDER, CUT),
    "lake_describe": lake_describe,
    "lake_evolve": lake_evolve,
    "tenant_filter": lambda s, f: tenancy.tenant_filter(tenant_orders(s, f), "tenant", "t7"),
    "tenant_metrics": tenant_metrics,
    "tenant_promotion": tenant_promotion,
    "tenant_promote": tenant_promote,
    "tenant_demote": tenant_demote,
    "tenant_deprovision": tenant_deprovision,
    "tenant_resolve": tenant_resolve,
}

_SQL_LAG = f"""SELECT source_id, max(ts) AS last_event,
  CAST(coalesce(sum(length(concat(tbl, CAST(k AS VARCHAR)))) FILTER (seq > 500), 0) AS BIGINT) AS lag_bytes,
  greatest(CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts))) AS BIGINT), 0) AS lag_seconds FROM {CHANGES} GROUP BY source_id"""


def _latest(where: str, extra: str = "") -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *{extra}, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn
      FROM {CHANGES} WHERE {where}) WHERE rn = 1)"""


_VERSION = ", CAST(day(ts) AS INTEGER) AS version"


def _sql_snapshot() -> str:
    parts = []
    for t, columns in {
        "region": ["r_regionkey", "r_name"],
        "nation": ["n_nationkey", "n_name", "n_regionkey"],
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    }.items():
        cells = ", ',', ".join(
            f"""'"{c}":"', {c}, '"'""" if c.endswith(("name", "segment")) else f"""'"{c}":', CAST({c} AS VARCHAR)""" for c in columns
        )
        parts.append(f"SELECT 'READ' AS op, '{t}' AS tbl, concat('{{', {cells}, '}}') AS payload FROM {t}")
    return " UNION ALL ".join(parts)


_BIG = f"(SELECT tenant FROM {TENANT_ORDERS} GROUP BY tenant HAVING count(*) > 600)"
_TIERS = "(['row_level', 'schema_per_tenant', 'db_per_tenant'])"
_HOURS = "greatest((epoch(max(o_orderdate)) - epoch(min(o_orderdate))) / 3600, 1.0)"

_SQL_UPSERT = f"""WITH old AS (SELECT * EXCLUDE (op) FROM {_latest("ts < TIMESTAMP '2024-01-16'")} WHERE op <> 'DELETE'),
  new AS (SELECT * FROM {_latest("ts >= TIMESTAMP '2024-01-16'")})
  SELECT * FROM old WHERE k NOT IN (SELECT k FROM new) UNION ALL SELECT * EXCLUDE (op) FROM new WHERE op <> 'DELETE'"""

ORACLES = {
    "cdc_filter": f"SELECT seq, op, tbl, k FROM {CHANGES} WHERE tbl = 'public.users' AND op IN ('INSERT', 'DELETE')",
    "cdc_snapshot": _sql_snapshot(),
    "cdc_schema_history": """SELECT 't7' AS tbl, event_id AS version, concat('ALTER TABLE t7 ADD COLUMN c', CAST(event_id AS VARCHAR)) AS ddl,
        ts AS applied_at
        FROM events WHERE event_type = 'signup' AND user_id = 7""",
    "cdc_table_stats": f"""SELECT *, CASE WHEN ddls > 0 THEN
        concat('DDL changes: ', ddls, ' (inserts:', inserts, ' updates:', updates, ' deletes:', deletes, ')') END AS ddl
        FROM (SELECT concat('t', CAST(k AS VARCHAR)) AS tbl, count(*) FILTER (op = 'INSERT') AS inserts, count(*) FILTER (op = 'UPDATE') AS updates,
          count(*) FILTER (op = 'DELETE') AS deletes, count(*) FILTER (op = 'INSERT') AS ddls FROM {CHANGES} GROUP BY k)""",
    "cdc_lag": _SQL_LAG,
    "cdc_backpressure": """SELECT user_id, n, age, CASE WHEN n * 1000000 >= 70000000 OR age >= 100000 THEN 'critical'
        WHEN n * 1000000 >= 56000000 OR age >= 80000 THEN 'warning' ELSE 'healthy' END AS status, 'healthy' AS off
        FROM (SELECT user_id, count(*) AS n, CAST(2678400 - floor(epoch(max(ts))) + epoch(TIMESTAMP '2024-01-01') AS BIGINT) AS age
          FROM events GROUP BY user_id)""",
    "cdc_monitor": f"""SELECT *, CAST(CASE WHEN status = 'healthy' THEN 0 ELSE 1 END AS INTEGER) AS alerts, status = 'critical' AS throttle
        FROM (SELECT *, CASE WHEN lag_seconds >= 1000 OR lag_bytes >= 10000000 THEN 'critical'
          WHEN lag_seconds >= 800 OR lag_bytes >= 8000000 THEN 'warning' ELSE 'healthy' END AS status FROM ({_SQL_LAG}))""",
    "lake_create_table": """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total, max(ts) AS newest,
        true AS created, false AS created_again FROM events GROUP BY event_type""",
    "lake_append": """SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS value FROM events""",
    "lake_overwrite": """SELECT CAST(day(ts) AS INTEGER) AS day, count(*) AS n,
        round(sum(CASE WHEN day(ts) > 20 THEN value * 2 ELSE value END), 4) AS total FROM events GROUP BY 1""",
    "lake_upsert": _SQL_UPSERT,
    "lake_upsert_table": _SQL_UPSERT,
    "lake_compact": "SELECT event_id, value, ts, true AS fewer_files FROM events",
    "lake_snapshots": f"""SELECT CAST(day(ts) AS INTEGER) AS version, min(ts) AS committed_at, count(*) FILTER (op = 'INSERT') AS inserts,
        count(*) FILTER (op = 'UPDATE') AS updates, count(*) FILTER (op = 'DELETE') AS deletes, count(*) AS rows FROM {CHANGES} GROUP BY 1""",
    "lake_as_of": f"SELECT * FROM {_latest('day(ts) <= 9', _VERSION)} WHERE op <> 'DELETE'",
    "lake_as_of_time": f"""SELECT * FROM {_latest("ts <= TIMESTAMP '2024-01-16'", _VERSION)} WHERE op <> 'DELETE'""",
    "lake_expire": f"""SELECT *{_VERSION} FROM {CHANGES} WHERE ts >= TIMESTAMP '2024-01-16'
        UNION ALL SELECT * FROM {_latest("ts < TIMESTAMP '2024-01-16'", _VERSION)}""",
    "lake_describe": """SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name AS "column",
        CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double precision' WHEN 'TIMESTAMP' THEN 'timestamp without time zone'
          ELSE 'character varying' END AS type, false AS required, CAST(NULL AS VARCHAR) AS doc, 'events' AS location,
        (SELECT count(DISTINCT day(ts)) FROM events) AS snapshots, (SELECT count(*) FROM events) AS rows FROM (DESCRIBE events)""",
    "lake_evolve": """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus AS status, o_totalprice, o_orderdate,
        CAST(NULL AS VARCHAR) AS phone FROM orders""",
    "tenant_filter": f"SELECT * FROM {TENANT_ORDERS} WHERE tenant = 't7'",
    "tenant_metrics": f"""SELECT tenant, CAST(count(*) AS DOUBLE) AS "rowCount", round(count(*) / {_HOURS}, 9) AS "queryRate", true AS has_bytes
        FROM {TENANT_ORDERS} GROUP BY tenant""",
    "tenant_promotion": f"""SELECT tenant, current_tier, n > 600 AS should_promote,
        CASE WHEN n <= 600 THEN current_tier WHEN current_tier = 'row_level' THEN 'schema_per_tenant' ELSE 'db_per_tenant' END AS recommended_tier,
        CASE WHEN n > 600 THEN concat('rowCount (', n, ') exceeds threshold (600)') ELSE '' END AS reason
        FROM (SELECT tenant, {_TIERS}[CAST(substr(tenant, 2) AS INTEGER) % 3 + 1] AS current_tier, count(*) AS n
          FROM {TENANT_ORDERS} GROUP BY tenant)""",
    "tenant_promote": f"""SELECT tenant, count(*) AS rows, CASE WHEN count(*) > 600 THEN 'dedicated' ELSE 'shared' END AS side
        FROM {TENANT_ORDERS} GROUP BY tenant""",
    "tenant_demote": f"SELECT tenant, o_orderkey, o_totalprice, o_orderdate FROM {TENANT_ORDERS}",
    "tenant_deprovision": f"SELECT o_orderkey, CASE WHEN tenant = 't3' THEN 'archive' ELSE 'shared' END AS side FROM {TENANT_ORDERS}",
    "tenant_resolve": f"""SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN concat('t_c', c_custkey, '.orders') ELSE 'orders' END AS resolved FROM customer""",
}
