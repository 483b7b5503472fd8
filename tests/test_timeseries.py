from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from deq.operators import chunks
from deq.operators.chunks import append_chunks, chunk_catalogue, drop_chunks, read_chunk_range
from deq.operators.materialize import invalidate, read_continuous, refresh_continuous, refresh_invalidated, scheduled_refresh, view_status, materialized_view
from deq.operators.tiering import archive, archive_rows, cold_status, cutoff, hot_status, read_archive, retention, write_archive
from deq.operators.windows import bucket, downsample, downsample_wide, granularity_series, time_bucket, time_range
from deq.session import scratch_path
from deq.sources.layouts import (
    chunk_label,
    chunked_table,
    read_chunks,
    to_json_layout,
    to_kv_arrays,
    to_typed_columns,
    to_wide,
    write_by_measurement,
)
from deq.sources.points import flat_points, normalize_points
from deq.sources.tables import scan, sql_query

NOW = datetime(2024, 6, 1)


def normalized(spark, *payloads, **options):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    return normalize_points(df, "p", now=NOW, **options).orderBy("i").collect()


def test_points_from_json(spark):
    good, no_name, text_name, junk, array = normalized(
        spark,
        '{"measurement": "cpu", "tags": {"host": "a", "n": 3}, "fields": {"v": 1.5, "n": 2, "s": "x", "b": true}, "timestamp": "2024-01-02T03:04:05.123456789+02:00"}',
        '{"fields": {"v": 1}}',
        '{"measurement": 7}',
        "nothing",
        "[1]",
    )
    assert good["measurement"] == "cpu" and good["tags"] == {"host": "a"} and good["error"] is None
    assert good["fields"] == {"v": 1.5, "n": 2.0} and good["texts"] == {"s": "x", "b": "true"}
    assert good["ts"] == datetime(2024, 1, 2, 1, 4, 5, 123456)
    assert no_name["error"] == text_name["error"] == "measurement is required"
    assert junk["error"] == array["error"] == "point must be an object"


@pytest.mark.parametrize(
    ("stamp", "expected"),
    [
        ("1704067200123456789", datetime(2024, 1, 1, 0, 0, 0, 123456)),
        ("1.7040672e18", datetime(2024, 1, 1)),
        ('"2024-01-01T00:00:00Z"', datetime(2024, 1, 1)),
        ('"2024-01-01"', NOW),
        ('"2024-13-01T00:00:00Z"', NOW),
        ('"soon"', NOW),
        ("true", NOW),
        ("null", NOW),
    ],
)
def test_point_stamps(spark, stamp, expected):
    (row,) = normalized(spark, f'{{"measurement": "m", "timestamp": {stamp}}}')
    assert row["ts"] == expected


def test_single_points_need_fields(spark):
    row, full = normalized(spark, '{"measurement": "m"}', '{"measurement": "m", "fields": {"v": 1}}', need_fields=True)
    assert (row["error"], full["error"]) == ("fields is required", None)


def points(spark):
    flat = spark.createDataFrame(
        [
            ("cpu", "b", "eu", 1.0, 14.56, "x", datetime(2024, 1, 1, 0, 0, 1, 500000)),
            ("cpu", "a", None, 2.0, None, None, datetime(2024, 1, 1, 1)),
            ("mem use", "a", "us", 3.5, 0.00001, "y", datetime(2024, 1, 2)),
        ],
        "measurement string, host string, zone string, v double, w double, note string, ts timestamp_ntz",
    )
    return flat_points(flat, ["zone", "host"], ["v", "w"], ["note"])


def test_key_value_layout(spark):
    first = to_kv_arrays(points(spark)).orderBy("ts").collect()
    assert (first[0]["tag_keys"], first[0]["tag_values"]) == (["host", "zone"], ["b", "eu"])
    assert (first[0]["field_keys"], first[0]["field_values"]) == (["note", "v", "w"], ["x", "1", "14.56"])
    assert (first[1]["field_keys"], first[1]["field_values"]) == (["v"], ["2"])
    assert first[2]["field_values"] == ["y", "3.5", "1e-05"]


def test_json_layout(spark):
    rows = to_json_layout(points(spark)).orderBy("time").collect()
    assert rows[0]["tags"] == '{"host":"b","zone":"eu"}'
    assert rows[0]["fields"] == '{"v":1.0,"w":14.56,"note":"x"}'
    assert rows[1]["fields"] == '{"v":2.0}'


def test_wide_layout_prefers_fields(spark):
    df = points(spark).withColumn("tags", F.create_map(F.lit("v"), F.lit("tag"), F.lit("host"), F.lit("h")))
    row = to_wide(df, ["v", "host"], ["v"]).orderBy("time").first()
    assert (row["v"], row["host"], row["time"]) == (1.0, "h", datetime(2024, 1, 1, 0, 0, 1))


def test_typed_layout(spark):
    df = spark.sql("SELECT 1 AS a, 2.0D AS b, 's' AS c, true AS d, date'2024-01-01' AS e, array(1) AS f, 1.5BD AS g")
    assert to_typed_columns(df).columns == ["a", "b", "c", "d"]


def test_one_folder_per_measurement(spark):
    path = scratch_path(spark, "points")
    write_by_measurement(points(spark), path)
    assert {r["target"] for r in spark.read.parquet(path).collect()} == {"cpu", "memuse"}
    assert spark.read.parquet(path).count() == 3


def test_chunks_prune_folders(spark):
    path = scratch_path(spark, "chunks")
    df = spark.range(240).select(F.expr("timestampadd(HOUR, cast(id AS int), timestamp_ntz'2024-01-01')").alias("ts"), "id")
    chunked_table(df, path, "ts", "7d")
    stored = spark.read.parquet(path)
    kept = read_chunks(stored, "ts", datetime(2024, 1, 3), datetime(2024, 1, 5), "7d")
    assert kept.count() == 48
    assert "PartitionFilters: [isnotnull(chunk" in kept._jdf.queryExecution().toString()
    assert chunk_label(datetime(2024, 1, 3), "7d") == "2023-12-28T00-00-00"


def test_time_range_is_half_open(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 3)], "ts timestamp_ntz")
    assert time_range(df, "ts", datetime(2024, 1, 1), datetime(2024, 1, 3)).count() == 2
    assert time_range(df, "ts").count() == 3


@pytest.mark.parametrize(
    ("fn", "value"),
    [("mean", 3.0), ("", 3.0), ("sum", 12.0), ("min", 1.0), ("max", 6.0), ("count", 4.0), ("first", 2.0), ("last", 6.0), ("median", 2.5)],
)
def test_downsample(spark, fn, value):
    start = datetime(2024, 1, 1, 10, 0)
    rows = [("cpu", "a", v, start + timedelta(minutes=m)) for m, v in [(0, 2.0), (5, 1.0), (20, 3.0), (59, 6.0)]]
    rows += [("cpu", "a", 9.0, start + timedelta(hours=2)), ("mem", "a", 8.0, start)]
    df = flat_points(spark.createDataFrame(rows, "measurement string, host string, v double, ts timestamp_ntz"), ["host"], ["v"])
    found = downsample(df, "cpu", "cpu_1h", "1h", fn).orderBy("ts").collect()
    assert [(r["measurement"], r["tags"], r["field"], r["ts"]) for r in found] == [
        ("cpu_1h", {"host": "a"}, "v", datetime(2024, 1, 1, 11)),
        ("cpu_1h", {"host": "a"}, "v", datetime(2024, 1, 1, 13)),
    ]
    assert found[0]["value"] == pytest.approx(value)


@pytest.mark.parametrize("fn", ["mean", "", "sum", "min", "max", "count", "first", "last", "median"])
def test_wide_and_long_downsampling_agree(spark, rows, fn):
    start = datetime(2024, 1, 1)
    data = [
        ("cpu" if i % 5 else "mem", f"h{i % 3}" if i % 7 else None, float(i * 37 % 11) if i % 4 else None, None if i % 6 == 0 else i, start + timedelta(minutes=13 * (i // 2)))
        for i in range(300)
    ]
    wide = spark.createDataFrame(data, "measurement string, host string, v double, w int, ts timestamp_ntz")
    long = downsample(flat_points(wide, ["host"], ["v", "w"]), "cpu", "x", "2h", fn)
    flat = downsample_wide(wide, "cpu", "x", "2h", ["host"], ["v", "w"], fn)

    def shown(df):
        return rows(df.select("measurement", F.col("tags")["host"], "field", "ts", F.round("value", 9)))

    assert shown(long) == shown(flat) and long.count() > 50


def test_unknown_aggregates_and_grains(spark):
    df = points(spark)
    with pytest.raises(ValueError):
        downsample(df, "cpu", "x", "1h", "mode")
    with pytest.raises(ValueError):
        granularity_series(df, "ts", "fortnight", [])


def test_buckets_can_start_anywhere(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 3),)], "ts timestamp_ntz")
    epoch = time_bucket(df, "ts", "7d", [], [F.count("*").alias("n")]).first()["bucket"]
    monday = time_bucket(df, "ts", "7d", [], [F.count("*").alias("n")], origin="4d").first()["bucket"]
    assert (epoch, monday) == (datetime(2023, 12, 28), datetime(2024, 1, 1))


def hourly(rows):
    return time_bucket(rows, "ts", "1h", ["k"], [F.count("*").alias("n"), F.sum("v").alias("s")])


def test_incremental_refresh_equals_full_refresh(spark, rows):
    source = spark.range(5000).select(
        F.expr("timestampadd(MINUTE, cast(id * 7 AS int), timestamp_ntz'2024-01-01')").alias("ts"),
        (F.col("id") % 3).alias("k"),
        F.col("id").alias("v"),
    )
    path, full = scratch_path(spark, "inc"), scratch_path(spark, "full")
    refresh_continuous(path, source.filter("v % 2 = 0"), "ts", hourly, stop=datetime(2024, 1, 20, 5))
    assert read_continuous(spark, path).agg(F.max("bucket")).first()[0] == datetime(2024, 1, 19, 23)
    # Late rows arrived for old days: the second refresh has to reach back to the start.
    scheduled_refresh(path, source, "ts", hourly, datetime(2024, 1, 26), start_offset="30d")
    refresh_continuous(full, source, "ts", hourly)
    assert rows(read_continuous(spark, path)) == rows(read_continuous(spark, full)) == rows(hourly(source).select(*read_continuous(spark, path).columns))


def test_refresh_leaves_days_outside_alone(spark):
    path = scratch_path(spark, "inc")
    source = spark.createDataFrame([(datetime(2024, 1, d, 1), d, 1) for d in (1, 2, 3)], "ts timestamp_ntz, k int, v int")
    refresh_continuous(path, source, "ts", hourly)
    refresh_continuous(path, source.withColumn("v", F.lit(5)), "ts", hourly, datetime(2024, 1, 2, 9), datetime(2024, 1, 3, 9))
    assert {r["k"]: r["s"] for r in read_continuous(spark, path).collect()} == {1: 1, 2: 5, 3: 1}


def test_a_day_that_lost_its_rows_loses_its_buckets(spark):
    path = scratch_path(spark, "inc")
    source = spark.createDataFrame([(datetime(2024, 1, d, 1), d, 1) for d in (1, 2, 3)], "ts timestamp_ntz, k int, v int")
    refresh_continuous(path, source, "ts", hourly)
    refresh_continuous(path, source.filter("k = 3"), "ts", hourly, datetime(2024, 1, 2))
    assert sorted(r["k"] for r in read_continuous(spark, path).collect()) == [1, 3]
    refresh_continuous(path, source.filter("k = 2"), "ts", hourly)
    assert [r["k"] for r in read_continuous(spark, path).collect()] == [2]


def test_a_view_made_again_keeps_nothing_old(spark):
    path = scratch_path(spark, "view")
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    materialized_view(df, path, ["id"], ["p"])
    materialized_view(df.filter("p = 1"), path, ["id"], ["p"])
    assert spark.read.parquet(path).count() == 5


def test_view_status_and_order(spark):
    path = scratch_path(spark, "view")
    materialized_view(spark.range(100).withColumn("p", F.col("id") % 2), path, ["id"], ["p"])
    row = view_status(spark, path).first()
    assert row["rows"] == 100 and row["files"] >= 2 and row["bytes"] > 0 and row["active"]


def hot_rows(spark):
    rows = [("cpu", {"h": "a"}, NOW - timedelta(minutes=m), float(m), f'say "{m}", ok\n') for m in (10, 40, 59, 61, 500)]
    return spark.createDataFrame(rows, "measurement string, tags map<string,string>, ts timestamp_ntz, v double, note string")


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_archive_round_trip(spark, form, rows):
    path = scratch_path(spark, "cold")
    cold = archive_rows(hot_rows(spark), cutoff(NOW, "1h"))
    write_archive(cold, path, form)
    assert rows(read_archive(spark, path, form)) == rows(cold)
    assert cold.columns == ["timestamp", "measurement", "tags", "fields"]
    assert cold.orderBy("timestamp").first()["fields"] == '{"note":"say \\"500\\", ok\\n","v":500.0}'


def test_archive_splits_at_one_instant(spark):
    """Half an hour stays half an hour: nothing falls between copy and removal."""
    done = archive(hot_rows(spark), "30m", scratch_path(spark, "cold"), NOW, delete_after=True)
    assert (done.rows_archived, done.deleted_from_hot, done.hot.count()) == (4, True, 1)
    kept = archive(hot_rows(spark), "30m", scratch_path(spark, "cold"), NOW)
    assert (kept.rows_archived, kept.deleted_from_hot, kept.hot.count()) == (4, False, 5)


def test_nothing_to_archive_removes_nothing(spark):
    done = archive(hot_rows(spark), "30d", scratch_path(spark, "cold"), NOW, delete_after=True)
    assert (done.rows_archived, done.deleted_from_hot, done.hot.count()) == (0, False, 5)


def test_rows_without_a_stamp_stay_hot(spark):
    df = hot_rows(spark).withColumn("ts", F.when(F.col("v") > 20, F.col("ts")))
    done = archive(df, "30m", scratch_path(spark, "cold"), NOW, delete_after=True)
    assert (done.rows_archived, done.hot.count()) == (4, 1)


def test_tier_status(spark):
    path = scratch_path(spark, "cold")
    write_archive(archive_rows(hot_rows(spark), cutoff(NOW, "1h")), path)
    cold = cold_status(spark, path).first()
    assert (cold["cold_rows"], cold["cold_oldest"]) == (2, NOW - timedelta(minutes=500))
    assert cold["cold_files"] > 0 and cold["total_bytes"] > 0
    hot = hot_status(hot_rows(spark)).first()
    assert (hot["hot_rows"], hot["hot_oldest"]) == (5, NOW - timedelta(minutes=500))


def test_retention(spark):
    assert retention(hot_rows(spark), "ts", "1h", NOW).count() == 3


def test_scan_and_sql(spark):
    df = scan(spark, "nation", "/root/testdata/sf0.001")
    df.createOrReplaceTempView("some_nations")
    assert scan(spark, "some_nations").count() == 25
    found = sql_query(spark, "SELECT count(*) AS n FROM {t} WHERE n_regionkey = :r", {"r": 1}, t=df).first()["n"]
    assert found == df.filter("n_regionkey = 1").count()
    with pytest.raises(ValueError):
        scan(spark, "nation; DROP TABLE x")


def test_an_archive_run_that_is_tried_again_replaces_its_copy(spark):
    dest = scratch_path(spark, "cold")
    first = archive(hot_rows(spark), "30m", dest, NOW, delete_after=True)
    again = archive(hot_rows(spark), "30m", dest, NOW, delete_after=True)
    assert first.rows_archived == again.rows_archived > 0
    from deq.operators.tiering import read_archive

    assert read_archive(spark, dest).count() == first.rows_archived
    nothing = archive(first.hot, "30m", scratch_path(spark, "cold"), NOW, delete_after=True)
    assert nothing.rows_archived == 0 and not nothing.deleted_from_hot


@pytest.mark.parametrize("stamp", ["start", "end"])
def test_incremental_equals_full_for_long_and_end_stamped_buckets(spark, rows, stamp):
    source = spark.range(400).select((F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id") * 2)).cast("timestamp_ntz").alias("ts"))
    for width in ("6h", "7d"):
        def query(df, width=width):
            return df.groupBy(bucket(F.col("ts"), width)[stamp].cast("timestamp_ntz").alias("bucket")).agg(F.count("*").alias("n"))

        path = scratch_path(spark, "cagg")
        refresh_continuous(path, source, "ts", query, width=width, stamp=stamp)
        refresh_continuous(path, source, "ts", query, datetime(2024, 1, 10, 7), datetime(2024, 1, 30, 9), width, stamp)
        assert rows(read_continuous(spark, path), "bucket", "n") == rows(query(source), "bucket", "n")
    with pytest.raises(ValueError):
        refresh_continuous(path, source, "ts", query, width="5h")
    if stamp == "start":
        with pytest.raises(ValueError):
            refresh_continuous(path, source, "ts", query, datetime(2024, 1, 10, 7), None, "1d", stamp)


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_archive_keeps_what_it_archived(spark, form, rows):
    dest, df = scratch_path(spark, "cold"), hot_rows(spark)
    old = archive_rows(df, cutoff(NOW, "30m"))
    first = archive(df, "30m", dest, NOW, form, delete_after=True)
    # The same run again, now that hot has lost its old rows.
    again = archive(first.hot, "30m", dest, NOW, form, delete_after=True)
    assert (first.rows_added, again.rows_added, again.deleted_from_hot) == (4, 0, False)
    assert rows(read_archive(spark, dest, form)) == rows(old)
    # A late row under the same cutoff, twice.
    late = df.limit(1).withColumn("ts", F.lit(NOW - timedelta(days=3)))
    done = archive(first.hot.unionByName(late).unionByName(late), "30m", dest, NOW, form, delete_after=True)
    assert (done.rows_added, done.hot.count()) == (2, 1)
    assert read_archive(spark, dest, form).count() == 6


def test_archive_without_removal_copies_each_row_once(spark, rows):
    dest, df = scratch_path(spark, "cold"), hot_rows(spark)
    df = df.unionByName(df.limit(1))
    for day in range(2):
        done = archive(df, "30m", dest, NOW + timedelta(days=day))
    assert (done.rows_archived, done.deleted_from_hot) == (6, False)
    assert rows(read_archive(spark, dest)) == rows(archive_rows(df, cutoff(NOW + timedelta(days=1), "30m")))
    cut = archive(df, "30m", dest, NOW + timedelta(days=1), delete_after=True)
    assert (cut.rows_added, cut.deleted_from_hot, cut.hot.count()) == (0, True, 0)


def chunk_files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_drop_chunks_touches_only_what_expires(spark, rows):
    path = scratch_path(spark, "chunks")
    stamps = [(i, datetime(2024, 1, 1) + timedelta(hours=5 * i)) for i in range(30)]
    df = spark.createDataFrame(stamps + [(99, None)], "id int, ts timestamp_ntz")
    append_chunks(df.filter("id % 2 = 0"), path, "ts")
    append_chunks(df.filter("id % 2 = 1"), path, "ts")
    append_chunks(df.limit(0), path, "ts")
    before, limit = chunk_files(path), datetime(2024, 1, 3, 12)
    known = chunk_catalogue(spark, path)
    assert known.agg(F.sum("rows"), F.count_if(F.col("chunk").isNull())).first()[:] == (31, 1)
    done = drop_chunks(spark, path, "ts", limit)
    expired = df.filter(F.col("ts") < F.lit(limit)).count()
    assert (done["dropped"], done["rewritten"], done["rows_removed"]) == (2, 1, expired) and done["bytes_freed"] > 0
    after = chunk_files(path)
    border = "chunk=2024-01-03T00-00-00/"
    assert {f: t for f, t in after.items() if not f.startswith(border)} == {
        f: t for f, t in before.items() if not f.startswith((border, "chunk=2024-01-01", "chunk=2024-01-02"))
    }
    left = df.filter((F.col("ts") >= F.lit(limit)) | F.col("ts").isNull())
    assert rows(spark.read.parquet(path), "id", "ts") == rows(left)
    found = chunk_catalogue(spark, path).agg(F.sum("rows"), F.min("first"), F.sum("files")).first()
    assert found[:] == (31 - expired, left.agg(F.min("ts")).first()[0], len(after))
    # Again: nothing is left to do. Then everything goes but the row without a time.
    assert drop_chunks(spark, path, "ts", limit)["rows_removed"] == 0 and chunk_files(path) == after
    drop_chunks(spark, path, "ts", datetime(2025, 1, 1))
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [99]


def test_drop_chunks_goes_on_after_a_failure(spark, monkeypatch):
    path = scratch_path(spark, "chunks")
    df = spark.range(48).selectExpr("id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS int)) AS ts")
    append_chunks(df, path, "ts")
    whole = chunks._record
    monkeypatch.setattr(chunks, "_record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        drop_chunks(spark, path, "ts", datetime(2024, 1, 2))
    monkeypatch.setattr(chunks, "_record", whole)
    drop_chunks(spark, path, "ts", datetime(2024, 1, 2))
    assert spark.read.parquet(path).count() == 24
    assert chunk_catalogue(spark, path).agg(F.sum("rows")).first()[0] == 24


def test_chunk_reads_open_only_chunks_with_such_times(spark):
    path = scratch_path(spark, "chunks")
    df = spark.range(72).selectExpr("id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS int)) AS ts")
    append_chunks(df.filter("hour(ts) < 12"), path, "ts")
    found = read_chunk_range(spark, path, "ts", datetime(2024, 1, 1, 18), datetime(2024, 1, 2, 3))
    assert sorted(r["id"] for r in found.collect()) == [24, 25, 26]
    assert {f.split("chunk=")[1][:10] for f in found.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"2024-01-02"}
    assert read_chunk_range(spark, path, "ts", datetime(2024, 1, 1, 13), datetime(2024, 1, 1, 20)).count() == 0


@pytest.mark.parametrize("width,stamp", [("1h", "start"), ("1h", "end"), ("7d", "start")])
def test_invalidated_buckets_alone_are_recomputed(spark, rows, width, stamp):
    path, log, full = (scratch_path(spark, n) for n in ("cagg", "log", "full"))
    df = spark.range(240).selectExpr("id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, CAST(3 * id AS int)) AS ts")
    late = F.col("id").isin(9, 10, 200)
    gone = F.dayofmonth("ts") == 5

    def query(rows):
        out = time_bucket(rows, "ts", width, [], [F.count(F.lit(1)).alias("n")])
        return out.withColumn("bucket", F.col("bucket") + F.expr("INTERVAL 1 HOUR")) if stamp == "end" else out

    refresh_continuous(path, df.filter(~late), "ts", query, width=width, stamp=stamp)
    before = chunk_files(path)
    assert refresh_invalidated(path, df, log, "ts", query, width=width, stamp=stamp) == 0
    invalidate(df.filter(late), log, "ts", width)
    invalidate(df.filter(gone), log, "ts", width)
    now = df.filter(~gone)
    stop = datetime(2024, 1, 20)
    days = refresh_invalidated(path, now, log, "ts", query, stop, width, stamp)
    after = chunk_files(path)
    folder = lambda files: {f.split("/")[0] for f in files}
    changed = folder({*after.items() - before.items()} and {f for f, t in after.items() if before.get(f) != t})
    assert days == len(changed) == 2
    # What waited comes with the next call; after that nothing is left.
    assert refresh_invalidated(path, now, log, "ts", query, None, width, stamp) == 1
    assert refresh_invalidated(path, now, log, "ts", query, None, width, stamp) == 0
    refresh_continuous(full, now, "ts", query, width=width, stamp=stamp)
    assert rows(read_continuous(spark, path), "bucket", "n") == rows(read_continuous(spark, full), "bucket", "n")
