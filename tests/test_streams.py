import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deq.operators.lake import as_of
from deq.plans import streams
from deq.session import scratch_path
from deq.streaming import jobs, lag

START = datetime(2024, 1, 1)
FIELDS = "seq int, ts timestamp_ntz, op string, tbl string, k int, v double"


def changes(spark, n=60):
    kinds = ["INSERT", "UPDATE", "DELETE", "UPDATE"]
    rows = [
        (i, START + timedelta(minutes=7 * i), kinds[i % 4], "public.users" if i % 2 else "public.orders", None if i % 10 == 9 else i % 7, float(i))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FIELDS)


def stream(spark, df, files=5, per_batch=1):
    path = scratch_path(spark, "in")
    df.repartitionByRange(files, "seq").write.parquet(path)
    return jobs.read_files(spark, path, df.schema, per_batch)


def test_callback_sees_each_matching_event_once(spark, rows):
    df, dest = changes(spark), scratch_path(spark, "out")
    query = jobs.on_change(stream(spark, df), jobs.batch_writer(dest), scratch_path(spark, "c"), ["public.users"], ["UPDATE"])
    jobs.finish(query)
    want = df.filter("tbl = 'public.users' AND op = 'UPDATE'")
    assert rows(spark.read.parquet(dest).select(*df.columns)) == rows(want)
    assert len(query.recentProgress) >= 5


def test_stream_and_batch_upsert_agree(spark, rows):
    df = changes(spark)
    log, rejected = scratch_path(spark, "log"), scratch_path(spark, "rejected")
    jobs.finish(jobs.apply_changes(stream(spark, df), log, rejected, scratch_path(spark, "c"), ["k"]))
    # The second instant lies inside a batch, after which its keys change again.
    for end in (START + timedelta(days=9), START + timedelta(minutes=7 * 15)):
        state = jobs.current_state(spark, log, ["k"], ["ts", "seq"], end)
        assert rows(state.select(*df.columns)) == rows(as_of(df.filter("k IS NOT NULL"), ["k"], ["ts", "seq"], time=end))
    assert rows(spark.read.parquet(rejected).select("seq")) == rows(df.filter("k IS NULL").select("seq"))


def test_a_repeated_batch_replaces_itself(spark):
    dest = scratch_path(spark, "out")
    store = jobs.batch_writer(dest)
    for _ in range(2):
        store(changes(spark, 10), 3)
    assert spark.read.parquet(dest).count() == 10


def test_pause_and_resume_loses_and_repeats_nothing(spark, rows):
    df = changes(spark)
    source, dest, checkpoint = stream(spark, df), scratch_path(spark, "out"), scratch_path(spark, "c")
    query = jobs.ingest(source, dest, checkpoint, every="500 milliseconds")
    query.processAllAvailable()
    jobs.throttle(query)
    assert not query.isActive
    first = spark.read.parquet(dest).count()
    jobs.finish(jobs.ingest(source, dest, checkpoint))
    assert first <= 60
    assert rows(spark.read.parquet(dest)) == rows(df)


def test_closed_buckets_equal_the_batch_result(spark, rows):
    df, dest = changes(spark), scratch_path(spark, "out")
    sums = [F.count("*").alias("n"), F.sum("v").alias("s")]
    jobs.finish(jobs.continuous_aggregate(stream(spark, df, per_batch=None), dest, scratch_path(spark, "c"), "1 hour", ["tbl"], sums, "30 minutes"))
    newest = START + timedelta(minutes=7 * 59)
    batch = (
        df.groupBy("tbl", F.window("ts", "1 hour").alias("w")).agg(*sums).filter(F.col("w.end") <= F.lit(newest - timedelta(minutes=30)))
    )
    assert rows(spark.read.parquet(dest), "tbl", "bucket", "n", "s") == rows(batch.select("tbl", "w.start", "n", "s"))


def test_lag_alerts(spark):
    df = changes(spark).withColumns({"source_id": F.col("tbl"), "payload": F.col("op")})
    alerts = scratch_path(spark, "alerts")
    newest = START + timedelta(minutes=7 * 59)
    jobs.finish(lag.watch_lag(stream(spark, df, per_batch=None), alerts, scratch_path(spark, "s"), scratch_path(spark, "c"), lambda: newest, max_seconds=400, max_bytes=0))
    assert [(r["source_id"], r["lag_seconds"], r["status"]) for r in spark.read.parquet(alerts).collect()] == [("public.orders", 420, "critical")]


def test_status(spark):
    dest = scratch_path(spark, "o")
    query = jobs.finish(jobs.ingest(stream(spark, changes(spark)), dest, scratch_path(spark, "c")))
    row = jobs.stream_status(query, "users", spark.read.parquet(dest), "ts").first()
    assert tuple(row) == ("users", "stopped", 5, 60, START + timedelta(minutes=7 * 59))


def test_a_silent_source_is_reported_in_later_batches(spark):
    df = changes(spark).withColumns({"source_id": F.expr("if(seq < 12, 'silent', 'busy')"), "payload": F.col("op")})
    alerts, state, called = scratch_path(spark, "alerts"), scratch_path(spark, "s"), []
    clock = lambda: START + timedelta(minutes=7 * 59)
    watch = lag.watch_lag(
        stream(spark, df), alerts, state, scratch_path(spark, "c"), clock,
        on_critical=lambda rows: called.append({r["source_id"] for r in rows.collect()}), max_seconds=7200, max_bytes=0,
    )
    jobs.finish(watch)
    last = {r["source_id"]: r for r in spark.read.parquet(alerts).filter("batch = 4").collect()}
    assert set(last) == {"silent"} and last["silent"]["lag_seconds"] == 7 * 60 * 48
    assert spark.read.parquet(state).filter("batch = 4").count() == 2
    # The order of files is not fixed, but the last batch knows them all.
    # A source that stays critical is reported once.
    assert sum("silent" in c for c in called) == 1


def offsets_of(source_id, n, first=0):
    return [(source_id, START, first + i, "x" * 10) for i in range(n)]


def lag_source(spark, rows, path):
    schema = "source_id string, ts timestamp_ntz, seq bigint, payload string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return jobs.read_files(spark, path, spark.createDataFrame([], schema).schema, 1)


def test_bytes_fall_after_an_acknowledgement(spark):
    path, alerts, state, check, acks = (scratch_path(spark, n) for n in ("in", "a", "s", "c", "acks"))

    def run(rows, batch):
        jobs.finish(lag.watch_lag(lag_source(spark, rows, path), alerts, state, check, lambda: START, acks, max_bytes=1, max_seconds=0))
        found = spark.read.parquet(alerts).filter(f"batch = {batch}").collect()
        return {r["source_id"]: r["lag_bytes"] for r in found}

    assert run(offsets_of("a", 6) + offsets_of("b", 3), 0) == {"a": 60, "b": 30}
    spark.createDataFrame([("a", 3), ("a", 1), ("c", 99)], "source_id string, acknowledged bigint").write.parquet(acks)
    assert run(offsets_of("b", 1, 3), 1) == {"a": 20, "b": 40}
    spark.createDataFrame([("a", 7), ("b", 0)], "source_id string, acknowledged bigint").write.mode("append").parquet(acks)
    assert run(offsets_of("a", 3, 6), 2) == {"a": 10, "b": 30}
    # Two folders take turns and the open events alone are kept.
    kept = spark.read.parquet(state).filter("batch = 2 AND offset IS NOT NULL")
    assert {(r["source_id"], r["offset"]) for r in kept.collect()} == {("a", 8), ("b", 1), ("b", 2), ("b", 3)}
    assert spark.read.parquet(state).select("turn").distinct().count() == 2


def test_timers_report_silence_of_all_sources_over_a_restart(spark):
    path, alerts, state, check = (scratch_path(spark, n) for n in ("in", "a", "s", "c"))
    called, newest = [], START + timedelta(hours=1)

    def run(rows, first):
        query = lag.watch_lag(
            lag_source(spark, rows, path), alerts, state, check, lambda: newest, every="500 milliseconds", silence=1,
            on_critical=lambda r: called.append({x["source_id"] for x in r.collect()}), max_seconds=60, max_bytes=0,
        )
        try:
            end = time.time() + 60
            while query.isActive and (query.lastProgress or {"batchId": 0})["batchId"] < first + 3 and time.time() < end:
                time.sleep(0.2)
        finally:
            query.stop()
        assert query.exception() is None
        return query.lastProgress["batchId"]

    last = run(offsets_of("a", 4) + offsets_of("b", 2), 0)
    found = spark.read.parquet(alerts).filter(f"batch = {last}").collect()
    assert {(r["source_id"], r["lag_seconds"], r["lag_bytes"]) for r in found} == {("a", 3600, 40), ("b", 3600, 20)}
    last = run(offsets_of("a", 1, 4), last)
    found = spark.read.parquet(alerts).filter(f"batch = {last}").collect()
    assert {(r["source_id"], r["lag_bytes"]) for r in found} == {("a", 50), ("b", 20)}
    assert called == [{"a", "b"}]


def test_broken_messages_are_kept(spark):
    texts = ['{"ts":"2024-01-01T00:00:00","k":1}', '{"k":2}', "no json", '{"ts":"2024-01-01T00:00:00","k":"x"}', None]
    schema = StructType().add("ts", "timestamp_ntz").add("k", "integer")
    got = jobs.parsed_rows(spark.createDataFrame([(t,) for t in texts], "value string"), schema, "ts").collect()
    assert [(r["problem"], r["raw"]) for r in got] == [
        (None, None), ("no ts", texts[1]), ("no row of the schema", texts[2]), ("no row of the schema", texts[3]), ("no row of the schema", None),
    ]
    assert got[0]["k"] == 1


def test_events_as_a_folder_of_files(spark):
    folder = scratch_path(spark, "tables")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    assert streams.stream_ingest(spark, folder).count() == events.count()


def test_bases_answer_any_instant_and_bound_what_is_read(spark, rows):
    df = changes(spark).filter("k IS NOT NULL")
    log = scratch_path(spark, "log")
    store = jobs.batch_writer(log)
    parts = [df.filter(f"seq BETWEEN {12 * i} AND {12 * i + 11}") for i in range(5)]
    late = spark.createDataFrame([(500, START + timedelta(minutes=30), "UPDATE", "public.users", 3, 1.5), (501, None, "UPDATE", "t", 4, 2.5)], FIELDS)
    for i, part in enumerate(parts[:3]):
        store(part, i)
    assert jobs.fold_changes(spark, log, ["k"], ["ts", "seq"]) == 1
    assert jobs.fold_changes(spark, log, ["k"], ["ts", "seq"]) == 1
    store(parts[3].unionByName(late), 3)
    assert jobs.fold_changes(spark, log, ["k"], ["ts", "seq"], 3) == 3
    # A later batch brings a column.
    store(parts[4].withColumn("more", F.lit("m")), 4)
    everything = df.unionByName(late).withColumn("more", F.when(F.col("seq").between(48, 59), "m"))
    for minutes in (0, 31, 7 * 13, 7 * 24, 7 * 40, 7 * 59, 10_000):
        at = START + timedelta(minutes=minutes)
        state = jobs.current_state(spark, log, ["k"], ["ts", "seq"], at)
        assert rows(state, *everything.columns) == rows(as_of(everything, ["k"], ["ts", "seq"], time=at))
    # At the end: seven keys of the newest base and the last batch, not the sixty changes of the log.
    files = jobs._base_and_tail(spark, log, 3).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("/")[-2] for r in files} == {"upto=3", "batch=4"}
    assert jobs._base_and_tail(spark, log, 3).count() == 7 + parts[4].count()
