"""Time-series queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from deq.functions.names import (
    duration_seconds,
    is_narrowing,
    normalize_type,
    replace_identifier,
    strip_identifier,
    truncate_precision,
)
from deq.operators.chunks import append_chunks, chunk_catalogue, drop_chunks, read_chunk_range
from deq.operators.materialize import (
    invalidate,
    materialized_view,
    read_continuous,
    refresh_continuous,
    refresh_invalidated,
    scheduled_refresh,
    view_status,
)
from deq.operators.tiering import (
    archive,
    archive_rows,
    cold_status,
    cutoff,
    hot_status,
    read_archive,
    retention,
    write_archive,
)
from deq.operators.windows import downsample, downsample_wide, granularity_series, group_average, time_bucket, time_range
from deq.plans.tables import AS_OF, POINTS, TYPE_LADDER, event_points, events
from deq.session import scratch_path
from deq.sources.layouts import (
    chunked_table,
    read_chunks,
    to_json_layout,
    to_kv_arrays,
    to_typed_columns,
    to_wide,
    write_by_measurement,
)
from deq.sources.points import normalize_points
from deq.sources.tables import scan, sql_query

MIDDLE = datetime(2024, 1, 16)

#: An instant within a chunk.
LIMIT = datetime(2024, 1, 20, 9, 30)


def points_normalize(spark, folder):
    i = F.col("event_id")
    stamp = F.when(i % 7 == 0, F.lit(None)).when(
        i % 2 == 0, F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"'))
    ).otherwise(F.concat((F.unix_micros(F.col("ts").cast("timestamp")) * 1000).cast("string")))
    body = F.concat(
        F.lit("{"),
        F.when(i % 29 == 0, "").otherwise(F.concat(F.lit('"measurement": "'), F.col("event_type"), F.lit('", '))),
        F.format_string('"tags": {"user": "%d", "shard": %d}, ', F.col("user_id"), i % 7),
        F.concat(F.lit('"fields": {"value": '), F.col("value").cast("string"), F.lit(', "note": "n", "ok": true}')),
        F.coalesce(F.concat(F.lit(', "timestamp": '), stamp), F.lit("")),
        F.lit("}"),
    )
    raw = events(spark, folder).select(i, F.when(i % 31 == 0, "no object").otherwise(body).alias("point"))
    points = normalize_points(raw, "point", now=AS_OF, need_fields=True)
    return points.select(
        "event_id",
        "measurement",
        F.col("tags")["user"].alias("user"),
        F.size("tags").alias("tag_count"),
        F.col("fields")["value"].alias("value"),
        F.col("texts")["note"].alias("note"),
        F.size("fields").alias("number_count"),
        F.size("texts").alias("text_count"),
        "ts",
        "error",
    )


def points_kv_layout(spark, folder):
    rows = to_kv_arrays(event_points(spark, folder))
    arrays = ["tag_keys", "tag_values", "field_keys", "field_values"]
    return rows.select("measurement", "ts", *[F.array_join(a, "|").alias(a) for a in arrays])


def points_by_measurement(spark, folder):
    path = scratch_path(spark, "points")
    write_by_measurement(event_points(spark, folder), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("target").agg(
        F.count(F.lit(1)).alias("points"), F.sum(F.col("fields")["k"]).alias("sum_k"), F.max("ts").alias("newest")
    )


def ts_chunks(spark, folder):
    path = scratch_path(spark, "chunks")
    chunked_table(events(spark, folder), path, "ts", "1d")
    kept = read_chunks(spark.read.parquet(path), "ts", datetime(2024, 1, 5), datetime(2024, 1, 12, 12))
    return kept.groupBy(F.col("chunk").cast("string").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def _archived(form):
    def run(spark, folder):
        path = scratch_path(spark, "cold")
        flat = event_points(spark, folder).select(
            "measurement", "tags", "ts", F.col("fields")["value"].alias("value"), F.col("fields")["k"].alias("k")
        )
        write_archive(archive_rows(flat, cutoff(AS_OF, "15d")), path, form)
        return read_archive(spark, path, form)

    return run


def ts_query_sql(spark, folder):
    text = """SELECT event_type, count(*) AS n, max(value) AS top FROM {points}
              WHERE value > :floor AND ts >= CAST(:start AS timestamp_ntz) GROUP BY event_type"""
    return sql_query(spark, text, {"floor": 20.0, "start": "2024-01-10 00:00:00"}, points=events(spark, folder))


def _downsampled(aggregation):
    def run(spark, folder):
        found = downsample(event_points(spark, folder), "click", "click_6h", "6h", aggregation)
        return found.select("measurement", F.col("tags")["user"].alias("user"), "field", "ts", F.round("value", 6).alias("value"))

    return run


def ts_downsample_wide(spark, folder):
    wide = events(spark, folder).select(
        "event_type", "user_id", "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k")
    )
    found = downsample_wide(wide, "click", "click_6h", "6h", ["user_id"], ["value", "k"], "mean", measurement="event_type")
    return found.select("measurement", F.col("tags")["user_id"].alias("user"), "field", "ts", F.round("value", 6).alias("value"))


def ts_bucket_avg(spark, folder):
    rows = time_bucket(events(spark, folder), "ts", "1h", ["event_type"], [F.round(F.avg("value"), 6).alias("mean")])
    return rows.select("event_type", "bucket", "mean")


def ts_hourly_count(spark, folder):
    return granularity_series(events(spark, folder), "ts", "hour", [F.count(F.lit(1)).alias("n")])


def _hourly(rows):
    return time_bucket(rows, "ts", "1h", ["event_type"], [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")])


def ts_cagg_refresh(spark, folder):
    path = scratch_path(spark, "hourly")
    source = events(spark, folder)
    refresh_continuous(path, source, "ts", _hourly, None, datetime(2024, 1, 20, 7))
    scheduled_refresh(path, source, "ts", _hourly, AS_OF, start_offset="20d")
    return read_continuous(spark, path).select("event_type", "bucket", "n", "total")


def ts_cagg_invalidate(spark, folder):
    """Late rows in old buckets: only their days are recomputed, in two rounds."""
    path, log, source = scratch_path(spark, "hourly"), scratch_path(spark, "log"), events(spark, folder)
    late = (F.col("event_id") % 97 == 0) & (F.dayofmonth("ts") % 5 == 0)
    refresh_continuous(path, source.filter(~late), "ts", _hourly)
    invalidate(source.filter(late), log, "ts")
    refresh_invalidated(path, source, log, "ts", _hourly, datetime(2024, 1, 20, 7))
    refresh_invalidated(path, source, log, "ts", _hourly)
    return read_continuous(spark, path).select("event_type", "bucket", "n", "total")


def _weekly(rows):
    return time_bucket(rows, "ts", "7d", ["event_type"], [F.count(F.lit(1)).alias("n")])


def ts_cagg_week(spark, folder):
    """Buckets longer than a day: first up to a day inside of one, then from a day inside of one on."""
    path = scratch_path(spark, "weekly")
    source = events(spark, folder)
    refresh_continuous(path, source, "ts", _weekly, None, datetime(2024, 1, 20, 7), width="7d")
    refresh_continuous(path, source, "ts", _weekly, datetime(2024, 1, 20, 7), None, width="7d")
    return read_continuous(spark, path).select("event_type", "bucket", "n")


def _view(spark, folder):
    path = scratch_path(spark, "view")
    daily = events(spark, folder).groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )
    materialized_view(daily, path, ["day"], ["event_type"])
    return path


def ts_matview(spark, folder):
    return spark.read.parquet(_view(spark, folder)).select(F.col("event_type").cast("string").alias("event_type"), "day", "n", "top")


def ts_matview_status(spark, folder):
    return view_status(spark, _view(spark, folder)).select(
        "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"), "active"
    )


def ts_granularity(spark, folder):
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("value"), 4).alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    ]
    source = events(spark, folder)
    parts = [granularity_series(source, "ts", g, measures).withColumn("grain", F.lit(g)) for g in ("hour", "day", "all")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ts_recent_mean(spark, folder):
    recent = time_range(events(spark, folder), "ts", datetime(2024, 1, 24), AS_OF)
    return recent.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("mean"))


def ts_group_avg(spark, folder):
    found = group_average(events(spark, folder), "ts", ["event_type"], "value", AS_OF, "48h")
    return found.withColumn("mean", F.round("mean", 6))


def ts_archive_split(spark, folder):
    """Two runs without removal, one with late rows and removal, and the same again after it."""
    flat = event_points(spark, folder).select("measurement", "tags", "ts", F.col("fields")["value"].alias("value"))
    path, late = scratch_path(spark, "cold"), F.xxhash64("ts", "value") % 5 == 0
    archive(flat.filter(~late), "17d", path, AS_OF)
    archive(flat.filter(~late), "15d", path, AS_OF)
    done = archive(flat, "15d", path, AS_OF, delete_after=True)
    again = archive(done.hot, "15d", path, AS_OF, delete_after=True)
    cold = read_archive(spark, path).select(F.lit("cold").alias("tier"), "measurement", F.col("timestamp").alias("nanos"))
    hot = again.hot.select(
        F.lit("hot").alias("tier"), "measurement", (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("nanos")
    )
    return hot.unionByName(cold)


def _expired(spark, folder):
    """The events in daily chunks, written in two parts, after those before the limit expired."""
    path, rows = scratch_path(spark, "chunks"), events(spark, folder)
    append_chunks(rows.filter("event_id % 3 > 0"), path, "ts")
    append_chunks(rows.filter("event_id % 3 = 0"), path, "ts")
    drop_chunks(spark, path, "ts", LIMIT)
    return path


def ts_drop_chunks(spark, folder):
    return read_chunk_range(spark, _expired(spark, folder), "ts", LIMIT, AS_OF).select("event_id", "ts")


def ts_chunk_catalogue(spark, folder):
    found = chunk_catalogue(spark, _expired(spark, folder))
    return found.select("chunk", "first", "last", "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


def ts_cold_status(spark, folder):
    path = scratch_path(spark, "cold")
    write_archive(archive_rows(event_points(spark, folder), MIDDLE), path)
    return cold_status(spark, path).select(
        (F.col("cold_files") > 0).alias("has_files"), "cold_rows", "cold_oldest", (F.col("total_bytes") > 0).alias("has_bytes")
    )


def fn_duration(spark, folder):
    q, n = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    text = (
        F.when(n == 1, F.concat(q, F.lit("d")))
        .when(n == 2, F.concat(q, F.lit("h")))
        .when(n == 3, F.concat(q, F.lit("h30m")))
        .when(n == 4, F.concat(q, F.lit(".5s")))
        .when(n == 5, F.concat(q, F.lit("00ms")))
        .when(n == 6, F.concat(F.lit("-"), q, F.lit("m")))
        .otherwise(F.concat(q, F.lit(" days")))
    )
    rows = scan(spark, "lineitem", folder).select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))
    return rows.withColumn("seconds", duration_seconds(F.col("text"))).groupBy("text", "seconds").agg(F.count(F.lit(1)).alias("n"))


def fn_precision(spark, folder):
    cut = [truncate_precision(F.col("ts"), p).cast("timestamp_ntz").alias(f"to_{p}") for p in ("s", "ms", "us", "ns")]
    return events(spark, folder).select("event_id", *cut)


def _ladder(index):
    return F.element_at(F.array(*[F.lit(t) for t in TYPE_LADDER]), (index % len(TYPE_LADDER) + 1).cast("int"))


NAMES = ["VARCHAR", " int", "int2", "INT4", "int8", "Float4", "float8", "float", "bool", "timestamptz", "varchar(20)", "numeric(10,2)", "text"]


def fn_normalize_type(spark, folder):
    pick = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("p_partkey") % len(NAMES) + 1).cast("int"))
    return scan(spark, "part", folder).select("p_partkey", normalize_type(pick).alias("type"))


def fn_narrowing(spark, folder):
    rows = scan(spark, "lineitem", folder).select(_ladder(F.col("l_partkey")).alias("a"), _ladder(F.col("l_suppkey")).alias("b"))
    return rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("narrowing", is_narrowing(F.col("a"), F.col("b")))


def fn_sanitize(spark, folder):
    url = F.col("url")
    return scan(spark, "pages", folder).select(
        "page_id", strip_identifier(url).alias("stripped"), replace_identifier(url).alias("replaced")
    )


DOWNSAMPLES = {
    "mean": "avg(v)",
    "sum": "sum(v)",
    "min": "min(v)",
    "max": "max(v)",
    "count": "CAST(count(v) AS DOUBLE)",
    "first": "first(v ORDER BY ts, v)",
    "last": "last(v ORDER BY ts, v)",
    "median": "median(v)",
}

QUERIES = {
    "points_normalize": points_normalize,
    "points_kv_layout": points_kv_layout,
    "points_wide_layout": lambda s, f: to_wide(event_points(s, f), ["user"], ["value", "k"]),
    "points_json_layout": lambda s, f: to_json_layout(event_points(s, f)),
    "points_typed_layout": lambda s, f: to_typed_columns(
        events(s, f).withColumns({"day": F.to_date("ts"), "list": F.array("value")}), ["ts"]
    ),
    "points_by_measurement": points_by_measurement,
    "ts_chunks": ts_chunks,
    "ts_archive_parquet": _archived("parquet"),
    "ts_archive_csv": _archived("csv"),
    "ts_query_sql": ts_query_sql,
    "ts_range": lambda s, f: time_range(events(s, f), "ts", datetime(2024, 1, 10), MIDDLE).select("event_id", "ts", "value"),
    **{f"ts_downsample_{a}": _downsampled(a) for a in DOWNSAMPLES},
    "ts_downsample_wide": ts_downsample_wide,
    "ts_bucket_avg": ts_bucket_avg,
    "ts_hourly_count": ts_hourly_count,
    "ts_cagg_refresh": ts_cagg_refresh,
    "ts_cagg_week": ts_cagg_week,
    "ts_cagg_invalidate": ts_cagg_invalidate,
    "ts_matview": ts_matview,
    "ts_matview_status": ts_matview_status,
    "ts_granularity": ts_granularity,
    "ts_recent_mean": ts_recent_mean,
    "ts_group_avg": ts_group_avg,
    "ts_retention": lambda s, f: retention(events(s, f), "ts", "7d", AS_OF).select("event_id", "ts"),
    "ts_archive_split": ts_archive_split,
    "ts_drop_chunks": ts_drop_chunks,
    "ts_chunk_catalogue": ts_chunk_catalogue,
    "ts_tier_status": lambda s, f: hot_status(event_points(s, f)),
    "ts_cold_status": ts_cold_status,
    "fn_duration": fn_duration,
    "fn_precision": fn_precision,
    "fn_normalize_type": fn_normalize_type,
    "fn_narrowing": fn_narrowing,
    "fn_sanitize": fn_sanitize,
}


def _sql_downsample(call: str) -> str:
    bucket = "time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours'"
    return f"""SELECT 'click_6h' AS measurement, "user", field, {bucket} AS ts, round({call}, 6) AS value
      FROM (SELECT "user", ts, 'value' AS field, value AS v FROM {POINTS} WHERE measurement = 'click'
            UNION ALL SELECT "user", ts, 'k', k FROM {POINTS} WHERE measurement = 'click') GROUP BY "user", field, {bucket}"""


_SQL_ARCHIVE = f"""SELECT epoch_us(ts) * 1000 AS timestamp, measurement, concat('{{"user":"', "user", '"}}') AS tags,
  concat('{{"k":', CAST(k AS VARCHAR), ',"value":', CAST(value AS VARCHAR), '}}') AS fields
  FROM {POINTS} WHERE ts < TIMESTAMP '2024-01-16'"""

_LIST = "([" + ", ".join(f"'{t}'" for t in TYPE_LADDER) + "])"
_NAMES = "([" + ", ".join(f"'{n}'" for n in NAMES) + "])"
_RANK = "CASE $x WHEN 'smallint' THEN 1 WHEN 'integer' THEN 2 WHEN 'bigint' THEN 3 WHEN 'real' THEN 4 WHEN 'double precision' THEN 5 WHEN 'numeric' THEN 6 END"
_WIDTH = "CASE $x WHEN 'varchar(10)' THEN 10 WHEN 'varchar(50)' THEN 50 END"


def _less(expr: str) -> str:
    return f"({expr.replace('$x', 'b')}) < ({expr.replace('$x', 'a')})"


_SERIES = "count(*) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high"

ORACLES = {
    "points_normalize": """SELECT event_id,
        CASE WHEN event_id % 31 = 0 OR event_id % 29 = 0 THEN '' ELSE event_type END AS measurement,
        CASE WHEN event_id % 31 <> 0 THEN CAST(user_id AS VARCHAR) END AS "user",
        CAST(CASE WHEN event_id % 31 = 0 THEN 0 ELSE 1 END AS INTEGER) AS tag_count,
        CASE WHEN event_id % 31 <> 0 THEN value END AS value, CASE WHEN event_id % 31 <> 0 THEN 'n' END AS note,
        CAST(CASE WHEN event_id % 31 = 0 THEN 0 ELSE 1 END AS INTEGER) AS number_count,
        CAST(CASE WHEN event_id % 31 = 0 THEN 0 ELSE 2 END AS INTEGER) AS text_count,
        CASE WHEN event_id % 31 = 0 OR event_id % 7 = 0 THEN TIMESTAMP '2024-01-31' ELSE ts END AS ts,
        CASE WHEN event_id % 31 = 0 THEN 'point must be an object' WHEN event_id % 29 = 0 THEN 'measurement is required' END AS error
        FROM events""",
    "points_kv_layout": f"""SELECT measurement, ts, 'user' AS tag_keys, "user" AS tag_values, 'k|value' AS field_keys,
        concat(CAST(CAST(k AS BIGINT) AS VARCHAR), '|', regexp_replace(CAST(value AS VARCHAR), '\\.0$', '')) AS field_values FROM {POINTS}""",
    "points_wide_layout": f"""SELECT measurement, date_trunc('second', ts) AS time, "user", value, k FROM {POINTS}""",
    "points_json_layout": f"""SELECT measurement, ts AS time, concat('{{"user":"', "user", '"}}') AS tags,
        concat('{{"k":', CAST(k AS VARCHAR), ',"value":', CAST(value AS VARCHAR), '}}') AS fields FROM {POINTS}""",
    "points_typed_layout": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "points_by_measurement": f"SELECT measurement AS target, count(*) AS points, sum(k) AS sum_k, max(ts) AS newest FROM {POINTS} GROUP BY measurement",
    "ts_chunks": """SELECT strftime(date_trunc('day', ts), '%Y-%m-%dT%H-%M-%S') AS chunk, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
        FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 12:00:00' GROUP BY 1""",
    "ts_archive_parquet": _SQL_ARCHIVE,
    "ts_archive_csv": _SQL_ARCHIVE,
    "ts_query_sql": """SELECT event_type, count(*) AS n, max(value) AS top FROM events
        WHERE value > 20 AND ts >= TIMESTAMP '2024-01-10' GROUP BY event_type""",
    "ts_range": "SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-16'",
    **{f"ts_downsample_{a}": _sql_downsample(call) for a, call in DOWNSAMPLES.items()},
    "ts_downsample_wide": _sql_downsample(DOWNSAMPLES["mean"]),
    "ts_bucket_avg": """SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS bucket, round(avg(value), 6) AS mean
        FROM events GROUP BY event_type, bucket""",
    "ts_hourly_count": "SELECT date_trunc('hour', ts) AS bucket, count(*) AS n FROM events GROUP BY 1",
    "ts_cagg_refresh": """SELECT event_type, date_trunc('hour', ts) AS bucket, count(*) AS n, round(sum(value), 4) AS total
        FROM events GROUP BY ALL""",
    "ts_cagg_invalidate": """SELECT event_type, date_trunc('hour', ts) AS bucket, count(*) AS n, round(sum(value), 4) AS total
        FROM events GROUP BY 1, 2""",
    "ts_cagg_week": """SELECT event_type, CAST(time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS bucket,
        count(*) AS n FROM events GROUP BY ALL""",
    "ts_matview": "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, max(value) AS top FROM events GROUP BY ALL",
    "ts_matview_status": """SELECT count(*) AS rows, true AS has_files, true AS has_bytes, true AS active
        FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events)""",
    "ts_granularity": f"""SELECT date_trunc('hour', ts) AS bucket, {_SERIES}, 'hour' AS grain FROM events GROUP BY 1
        UNION ALL SELECT CAST(date_trunc('day', ts) AS TIMESTAMP), {_SERIES}, 'day' FROM events GROUP BY 1
        UNION ALL SELECT min(ts), {_SERIES}, 'all' FROM events""",
    "ts_recent_mean": """SELECT user_id, event_type, round(avg(value), 6) AS mean FROM events
        WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31' GROUP BY ALL""",
    "ts_group_avg": """SELECT event_type, round(avg(value), 6) AS mean, count(value) AS n FROM events
        WHERE ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-31' GROUP BY event_type""",
    "ts_retention": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-24'",
    "ts_drop_chunks": """SELECT event_id, ts FROM events
        WHERE ts >= TIMESTAMP '2024-01-20 09:30:00' AND ts < TIMESTAMP '2024-01-31'""",
    "ts_chunk_catalogue": """SELECT strftime(date_trunc('day', ts), '%Y-%m-%dT%H-%M-%S') AS chunk, min(ts) AS first, max(ts) AS last,
        count(*) AS rows, true AS has_files, true AS has_bytes FROM events
        WHERE ts >= TIMESTAMP '2024-01-20 09:30:00' GROUP BY 1""",
    "ts_archive_split": """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'cold' ELSE 'hot' END AS tier, event_type AS measurement,
        epoch_us(ts) * 1000 AS nanos FROM events""",
    "ts_tier_status": "SELECT event_type AS measurement, count(*) AS hot_rows, min(ts) AS hot_oldest FROM events GROUP BY 1",
    "ts_cold_status": """SELECT true AS has_files, count(*) AS cold_rows, min(ts) AS cold_oldest, true AS has_bytes
        FROM events WHERE ts < TIMESTAMP '2024-01-16'""",
    "fn_duration": """SELECT text, seconds, count(*) AS n FROM (SELECT
        CASE l_linenumber WHEN 1 THEN concat(q, 'd') WHEN 2 THEN concat(q, 'h') WHEN 3 THEN concat(q, 'h30m') WHEN 4 THEN concat(q, '.5s')
          WHEN 5 THEN concat(q, '00ms') WHEN 6 THEN concat('-', q, 'm') ELSE concat(q, ' days') END AS text,
        CAST(CASE l_linenumber WHEN 1 THEN q * 86400 WHEN 2 THEN q * 3600 WHEN 3 THEN q * 3600 + 1800 WHEN 4 THEN q
          WHEN 5 THEN q // 10 WHEN 6 THEN -q * 60 END AS BIGINT) AS seconds
        FROM (SELECT l_linenumber, CAST(l_quantity AS INTEGER) AS q FROM lineitem)) GROUP BY ALL""",
    "fn_precision": """SELECT event_id, date_trunc('second', ts) AS to_s, date_trunc('millisecond', ts) AS to_ms,
        date_trunc('microsecond', ts) AS to_us, ts AS to_ns FROM events""",
    "fn_normalize_type": f"""SELECT p_partkey, CASE t WHEN 'varchar' THEN 'character varying' WHEN 'varchar(20)' THEN 'character varying'
        WHEN 'int' THEN 'integer' WHEN 'int2' THEN 'smallint' WHEN 'int4' THEN 'integer' WHEN 'int8' THEN 'bigint' WHEN 'float4' THEN 'real'
        WHEN 'float8' THEN 'double precision' WHEN 'float' THEN 'double precision' WHEN 'bool' THEN 'boolean'
        WHEN 'timestamptz' THEN 'timestamp with time zone' ELSE t END AS type
        FROM (SELECT p_partkey, lower(trim({_NAMES}[p_partkey % {len(NAMES)} + 1])) AS t FROM part)""",
    "fn_narrowing": f"""SELECT a, b, count(*) AS n, coalesce({_less(_WIDTH)}, {_less(_RANK)}, true) AS narrowing
        FROM (SELECT {_LIST}[l_partkey % 9 + 1] AS a, {_LIST}[l_suppkey % 9 + 1] AS b FROM lineitem) GROUP BY a, b""",
    "fn_sanitize": """SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_]', '', 'g') AS stripped,
        regexp_replace(url, '[^a-zA-Z0-9_]', '_', 'g') AS replaced FROM pages""",
}
