"""Streaming queries: each one runs a job over what is there and returns what it stored."""

from __future__ import annotations

import time
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.plans.tables import AS_OF, CHANGES, changes, events
from deq.session import scratch_path
from deq.streaming import jobs, lag

KEY, ORDER = ["k"], ["ts", "seq"]

INSTANTS = [datetime(2024, 1, 3, 5), datetime(2024, 1, 16), AS_OF]


def _event_stream(spark, folder):
    """The events, be they one file, whose path alone Spark refuses as a stream, or a folder of files."""
    table = events(spark, folder)
    if any(f.rstrip("/").endswith("/events.parquet") for f in table.inputFiles()):
        return jobs.read_files(spark, folder, table.schema, pattern="events.parquet")
    return jobs.read_files(spark, f"{folder}/events.parquet", table.schema)


def _change_stream(spark, folder, files: int = 4, per_batch: int | None = 1, **extra):
    """The change events as a folder of files, read one file per batch."""
    path = scratch_path(spark, "changes")
    rows = changes(spark, folder).withColumns(extra)
    rows.repartitionByRange(files, "seq").write.parquet(path)
    return jobs.read_files(spark, path, rows.schema, per_batch)


def stream_ingest(spark, folder):
    dest = scratch_path(spark, "ingested")
    jobs.finish(jobs.ingest(_event_stream(spark, folder), dest, scratch_path(spark, "offsets"), rows_per_file=1_000_000))
    return spark.read.parquet(dest)


def stream_cdc_filter(spark, folder):
    dest = scratch_path(spark, "matched")
    query = jobs.on_change(
        _change_stream(spark, folder), jobs.batch_writer(dest), scratch_path(spark, "offsets"), ["public.orders"], ["UPDATE"]
    )
    jobs.finish(query)
    return spark.read.parquet(dest).select("seq", "op", "tbl", "k", "value")


def stream_cdc_upsert(spark, folder):
    log, rejected = scratch_path(spark, "log"), scratch_path(spark, "rejected")
    stream = _change_stream(spark, folder, k=F.when(F.col("seq") % 53 != 0, F.col("k")))
    jobs.finish(jobs.apply_changes(stream, log, rejected, scratch_path(spark, "offsets"), ["k"]))
    state = jobs.current_state(spark, log, KEY, ORDER, AS_OF)
    refused = spark.read.parquet(rejected)
    return state.select("k", "seq", "op", "value", F.lit("state").alias("side")).unionByName(
        refused.select("k", "seq", "op", "value", F.lit("rejected").alias("side"))
    )


def stream_cdc_fold(spark, folder):
    """States at three instants, read from bases that were folded in between and the batches after them."""
    log, offsets = scratch_path(spark, "log"), scratch_path(spark, "offsets")
    jobs.finish(jobs.apply_changes(_change_stream(spark, folder, 5), log, scratch_path(spark, "rejected"), offsets, ["k"]))
    jobs.fold_changes(spark, log, KEY, ORDER, 1)
    jobs.fold_changes(spark, log, KEY, ORDER)
    states = [
        jobs.current_state(spark, log, KEY, ORDER, at).select(F.lit(at).alias("at"), "k", "seq", "op", "value") for at in INSTANTS
    ]
    return reduce(DataFrame.unionByName, states)


def stream_cagg(spark, folder):
    dest = scratch_path(spark, "hourly")
    sums = [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")]
    jobs.finish(
        jobs.continuous_aggregate(
            _event_stream(spark, folder), dest, scratch_path(spark, "offsets"), "1 hour", ["event_type"], sums, "1 hour"
        )
    )
    return spark.read.parquet(dest).select("event_type", "bucket", "n", "total")


#: What the sources have acknowledged: a share of the offsets that differs by source.
_ACKNOWLEDGED = "floor(max(seq) * (ascii(right(source_id, 1)) - 47) / 6)"


def _last_alerts(spark, alerts, query):
    number = query.lastProgress["batchId"]
    stored = spark.read.parquet(alerts).filter(F.col("batch") == number)
    return stored.select("source_id", "lag_seconds", "lag_bytes", "status", "throttle")


def _half(spark, folder, path, second):
    """Write the first or second half of the change events, in files."""
    rows = changes(spark, folder).withColumn("payload", F.col("tbl"))
    half = rows.filter((F.col("seq") % 2 == 0) == F.lit(second))
    half.repartitionByRange(2, "seq").write.mode("append").parquet(path)
    return rows.schema


def stream_monitor(spark, folder):
    """Alerts of the last of several batches, which knows all sources, also those before a restart."""
    alerts, state, offsets, path = (scratch_path(spark, n) for n in ("alerts", "state", "offsets", "changes"))
    for second in (False, True):
        schema = _half(spark, folder, path, second)
        stream = jobs.read_files(spark, path, schema, 1)
        query = jobs.finish(lag.watch_lag(stream, alerts, state, offsets, lambda: AS_OF, max_seconds=1000, max_bytes=0))
    return _last_alerts(spark, alerts, query)


def stream_monitor_acknowledged(spark, folder):
    """Bytes after what each source acknowledged between two runs."""
    alerts, state, offsets, path, acks = (scratch_path(spark, n) for n in ("alerts", "state", "offsets", "changes", "acks"))
    for second in (False, True):
        schema = _half(spark, folder, path, second)
        stream = jobs.read_files(spark, path, schema, 1)
        query = jobs.finish(
            lag.watch_lag(stream, alerts, state, offsets, lambda: AS_OF, acks, max_seconds=1000, max_bytes=0)
        )
        done = changes(spark, folder).groupBy("source_id").agg(F.expr(f"CAST({_ACKNOWLEDGED} AS bigint)").alias("acknowledged"))
        done.write.mode("overwrite").parquet(acks)
    return _last_alerts(spark, alerts, query)


def stream_silence(spark, folder):
    """Alerts that timers raise after the last event, when no source has any news."""
    alerts, state = scratch_path(spark, "alerts"), scratch_path(spark, "state")
    stream = _change_stream(spark, folder, 2, None, payload=F.col("tbl"))
    query = lag.watch_lag(
        stream, alerts, state, scratch_path(spark, "offsets"), lambda: AS_OF, every="1 second", silence=2, max_seconds=1000, max_bytes=0
    )
    try:
        # The first batch takes all events; those after it run for timers alone.
        while query.isActive and (query.lastProgress or {"batchId": 0})["batchId"] < 3:
            time.sleep(0.2)
    finally:
        jobs.throttle(query)
    if query.exception():
        raise query.exception()
    return _last_alerts(spark, alerts, query)


def stream_throttle(spark, folder):
    """Stop after the first batch, go on from the same checkpoint."""
    dest, offsets = scratch_path(spark, "throttled"), scratch_path(spark, "offsets")
    stream = _change_stream(spark, folder)
    query = jobs.ingest(stream, dest, offsets, every="1 second")
    while query.isActive and not query.recentProgress:
        time.sleep(0.1)
    jobs.throttle(query)
    jobs.finish(jobs.ingest(stream, dest, offsets))
    return spark.read.parquet(dest).groupBy("seq").agg(F.count(F.lit(1)).alias("copies"))


def stream_status(spark, folder):
    dest = scratch_path(spark, "ingested")
    query = jobs.finish(jobs.ingest(_change_stream(spark, folder), dest, scratch_path(spark, "offsets")))
    return jobs.stream_status(query, "events", spark.read.parquet(dest), "ts")


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_cdc_filter": stream_cdc_filter,
    "stream_cdc_upsert": stream_cdc_upsert,
    "stream_cdc_fold": stream_cdc_fold,
    "stream_cagg": stream_cagg,
    "stream_monitor": stream_monitor,
    "stream_monitor_acknowledged": stream_monitor_acknowledged,
    "stream_silence": stream_silence,
    "stream_throttle": stream_throttle,
    "stream_status": stream_status,
}



def _monitor_sql(size, more=""):
    return f"""SELECT *, status = 'critical' AS throttle FROM (SELECT *, CASE WHEN lag_seconds >= 1000 THEN 'critical'
          WHEN lag_seconds >= 800 THEN 'warning' ELSE 'healthy' END AS status
          FROM (SELECT source_id, greatest(CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts))) AS BIGINT), 0) AS lag_seconds,
            CAST(sum({size}) AS BIGINT) AS lag_bytes FROM {CHANGES} {more} GROUP BY source_id)) WHERE status <> 'healthy'"""


ORACLES = {
    "stream_ingest": "SELECT * FROM events",
    "stream_cdc_filter": f"SELECT seq, op, tbl, k, value FROM {CHANGES} WHERE tbl = 'public.orders' AND op = 'UPDATE'",
    "stream_cdc_upsert": f"""SELECT k, seq, op, value, 'state' AS side FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn
          FROM {CHANGES} WHERE seq % 53 <> 0 AND ts <= TIMESTAMP '2024-01-31') WHERE rn = 1 AND op <> 'DELETE'
        UNION ALL SELECT NULL, seq, op, value, 'rejected' FROM {CHANGES} WHERE seq % 53 = 0""",
    "stream_cdc_fold": " UNION ALL ".join(
        f"""SELECT TIMESTAMP '{at}' AS "at", k, seq, op, value FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn
          FROM {CHANGES} WHERE ts <= TIMESTAMP '{at}') WHERE rn = 1 AND op <> 'DELETE'"""
        for at in INSTANTS
    ),
    "stream_cagg": """SELECT event_type, date_trunc('hour', ts) AS bucket, count(*) AS n, round(sum(value), 4) AS total FROM events
        GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL '2 hours' <= (SELECT max(ts) FROM events)""",
    "stream_monitor": _monitor_sql("length(tbl)"),
    "stream_monitor_acknowledged": _monitor_sql(
        "CASE WHEN seq > acknowledged THEN length(tbl) ELSE 0 END",
        f"JOIN (SELECT source_id, CAST({_ACKNOWLEDGED} AS BIGINT) AS acknowledged FROM {CHANGES} GROUP BY source_id) USING (source_id)",
    ),
    "stream_silence": _monitor_sql("length(tbl)"),
    "stream_throttle": "SELECT event_id AS seq, CAST(1 AS BIGINT) AS copies FROM events",
    "stream_status": "SELECT 'events' AS source_id, 'stopped' AS state, CAST(4 AS BIGINT) AS batches, count(*) AS rows, max(ts) AS last_event FROM events",
}
