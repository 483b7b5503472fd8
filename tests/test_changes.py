import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from deq.operators import lake, tenancy
from deq.operators.change_data import (
    cdc_filter,
    ddl_history,
    lag_status,
    monitor,
    normalize_codes,
    schema_history,
    snapshot_events,
    source_lag,
    table_stats,
)
from deq.operators.materialize import stored_files
from deq.session import scratch_path

START = datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, "`table` string, source string, op string, action string, k int")


def test_filter_is_exact_and_falls_back(spark):
    df = events(
        spark,
        [
            ("public.users", "x", "INSERT", None, 1),
            ("", "public.users", "", "INSERT", 2),
            (None, "public.users", "UPDATE", None, 3),
            ("Public.Users", "public.users", "INSERT", None, 4),
            ("public.orders", "public.users", "insert", "INSERT", 5),
        ],
    )

    def keys(*args):
        return sorted(r["k"] for r in cdc_filter(df, *args).collect())

    assert keys(["public.users"], ["INSERT"]) == [1, 2]
    assert keys(["public.users"]) == [1, 2, 3]
    assert keys([], ["UPDATE"]) == [3]
    assert keys() == [1, 2, 3, 4, 5]


def test_short_codes(spark):
    df = spark.createDataFrame([("c",), ("d",), ("INSERT",)], "op string")
    assert [r["op"] for r in normalize_codes(df).collect()] == ["INSERT", "DELETE", "INSERT"]


def test_snapshot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    assert snapshot_events({"t": df}).collect()[0].asDict() == {"op": "READ", "tbl": "t", "payload": '{"id":1,"name":null}'}
    with pytest.raises(ValueError):
        snapshot_events({})


def test_statistics_and_history(spark):
    ops = [("a", "INSERT"), ("a", "DDL"), ("a", "DELETE"), ("b", "UPDATE")]
    stats = table_stats(spark.createDataFrame(ops, "tbl string, op string"))
    assert {r["tbl"]: (r["inserts"], r["updates"], r["deletes"], r["ddls"]) for r in stats.collect()} == {
        "a": (1, 0, 1, 1),
        "b": (0, 1, 0, 0),
    }
    assert [tuple(r) for r in ddl_history(stats).collect()] == [("a", "DDL changes: 1 (inserts:1 updates:0 deletes:1)")]
    versions = spark.createDataFrame([("a", 2, "y"), ("b", 1, "z"), ("a", 1, "x")], "tbl string, version int, ddl string")
    assert [r["ddl"] for r in schema_history(versions, "a").collect()] == ["x", "y"]


@pytest.mark.parametrize(
    ("size", "age", "limits", "status"),
    [
        (0, 0, {}, "healthy"),
        (850_000, 0, {"max_bytes": 1_000_000}, "warning"),
        (800_000, 0, {"max_bytes": 1_000_000}, "warning"),
        (799_999, 0, {"max_bytes": 1_000_000}, "healthy"),
        (1_500_000, 0, {"max_bytes": 1_000_000}, "critical"),
        (1_000_000, 0, {"max_bytes": 1_000_000}, "critical"),
        (0, 90, {"max_seconds": 60}, "critical"),
        (0, 299, {}, "warning"),
        (10**12, 10**6, {"max_bytes": 0, "max_seconds": 0}, "healthy"),
    ],
)
def test_lag_status(spark, size, age, limits, status):
    df = spark.createDataFrame([(size, age)], "b bigint, s bigint")
    assert df.select(lag_status(F.col("b"), F.col("s"), **limits)).first()[0] == status


def test_lag_counts_bytes_after_the_acknowledged_offset(spark):
    df = spark.createDataFrame(
        [("s", 1, START, "abc"), ("s", 2, START + timedelta(seconds=5), "dé"), ("t", 1, START, "x")],
        "source_id string, seq int, ts timestamp_ntz, payload string",
    )
    found = {r["source_id"]: r for r in monitor(source_lag(df, START + timedelta(seconds=400), acknowledged=1)).collect()}
    assert (found["s"]["lag_bytes"], found["s"]["lag_seconds"]) == (3, 395)
    assert (found["t"]["lag_bytes"], found["t"]["alerts"], found["t"]["throttle"]) == (0, 1, True)


def log(spark, seed=0, n=400):
    """Changes where one key holds a third of all rows and many share a time stamp."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = 0 if rng.random() < 0.33 else rng.randint(1, 20)
        op = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        rows.append((key, op, rng.choice([None, float(seq)]), START + timedelta(hours=seq // 3), seq, seq // 40))
    return rows, spark.createDataFrame(rows, "k int, op string, v double, ts timestamp_ntz, seq int, version int").repartition(5)


def replay(rows, state=None):
    state = dict(state or {})
    for r in sorted(rows, key=lambda r: (r[3], r[4])):
        if r[1] == "DELETE":
            state.pop(r[0], None)
        else:
            state[r[0]] = r
    return state


KEYS, ORDER = ["k"], ["ts", "seq"]


@pytest.mark.parametrize("seed", [0, 1])
def test_upsert_equals_replay(spark, seed):
    rows, df = log(spark, seed)
    old, new = df.filter("version < 5"), df.filter("version >= 5")
    target = lake.as_of(old, KEYS, ORDER, version=99)
    found = {r["k"]: tuple(r) for r in lake.upsert(target, new, KEYS, ORDER).collect()}
    assert found == replay(rows)


def test_upsert_twice_changes_nothing(spark, rows):
    _, df = log(spark)
    target = lake.as_of(df.filter("version < 5"), KEYS, ORDER, version=99)
    new = df.filter("version >= 5")
    once = lake.upsert(target, new, KEYS, ORDER)
    assert rows(lake.upsert(once, new, KEYS, ORDER)) == rows(once)


@pytest.mark.parametrize("buckets", [1, 8, 64])
def test_bucketed_upsert_equals_replay(spark, buckets):
    data, df = log(spark)
    path = scratch_path(spark, "keyed")
    lake.write_bucketed(lake.as_of(df.filter("version < 5"), KEYS, ORDER, version=99), path, KEYS, buckets)
    for version in range(5, 10):
        batch = df.filter(F.col("version") == version)
        assert 0 < lake.upsert_table(spark, path, batch, KEYS, ORDER, buckets) <= buckets
        found = {r["k"]: tuple(r)[:6] for r in spark.read.parquet(path).select(*df.columns).collect()}
        assert found == replay([r for r in data if r[5] <= version])
    assert lake.upsert_table(spark, path, df.limit(0), KEYS, ORDER, buckets) == 0
    with pytest.raises(ValueError, match="buckets"):
        lake.upsert_table(spark, path, df, KEYS, ORDER, buckets + 1)


def test_bucketed_upsert_can_empty_a_bucket(spark):
    path = scratch_path(spark, "keyed")
    table = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    lake.write_bucketed(table, path, KEYS, 16)
    gone = spark.createDataFrame([(1, "DELETE", None, 1)], "k int, op string, v double, seq int")
    lake.upsert_table(spark, path, gone, KEYS, ["seq"], 16)
    assert [r["k"] for r in spark.read.parquet(path).collect()] == [2]


def test_as_of_and_expiry(spark):
    data, df = log(spark)
    limit = START + timedelta(hours=60)
    short = lake.expire(df, KEYS, ORDER, limit)
    assert short.count() < df.count()
    for version in (5, 7, 9):
        want = replay([r for r in data if r[5] <= version])
        for table in (df, short):
            assert {r["k"]: tuple(r) for r in lake.as_of(table, KEYS, ORDER, version=version).collect()} == want
    assert {r["k"] for r in lake.as_of(df, KEYS, ORDER, time=limit).collect()} == set(replay([r for r in data if r[3] <= limit]))
    with pytest.raises(ValueError):
        lake.as_of(df, KEYS, ORDER)


def test_snapshots(spark):
    data, df = log(spark)
    found = {r["version"]: r["rows"] for r in lake.snapshots(df).collect()}
    assert found == {v: 40 for v in range(10)}


def test_append_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "y")], "x int, s string")
    assert sorted(tuple(r) for r in lake.append(a, b).collect()) == [(1, None), (2, "y")]


def test_overwrite_replaces_only_the_days_written(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string")
    lake.write(df, path, "append", ["d"])
    lake.write(spark.createDataFrame([(9, "b")], "v int, d string"), path, "overwrite", ["d"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 9]
    with pytest.raises(ValueError):
        lake.write(df, path, "merge")


def test_compact_keeps_rows_and_merges_files(spark, rows):
    small, big = scratch_path(spark, "small"), scratch_path(spark, "big")
    df = spark.range(1000)
    df.repartition(12).write.parquet(small)
    report = lake.compact(spark, small, big, 1 << 20)
    assert (report["files_before"], report["files_after"]) == (12, 1)
    assert rows(spark.read.parquet(big)) == rows(df.toDF("id"))
    assert stored_files(spark, big).count() == 1


def test_create_describe_evolve(spark):
    path = scratch_path(spark, "t")
    fields = [
        {"name": "id", "type": "long", "required": True},
        {"name": "name", "type": "varchar(10)", "doc": "full name"},
    ]
    assert lake.create_table(spark, path, fields) is True
    assert lake.create_table(spark, path, fields) is False
    table = spark.createDataFrame([(1, "a")], lake.schema_of(fields))
    described = [tuple(r)[:5] for r in lake.describe(table).orderBy("position").collect()]
    assert described == [(1, "id", "bigint", True, None), (2, "name", "varchar(10)", False, "full name")]
    evolved = lake.evolve_schema(table, [{"action": "add-column", "name": "phone", "type": "string", "doc": "d"}])
    assert evolved.columns == ["id", "name", "phone"] and evolved.first()["phone"] is None
    changes = [
        {"action": "add-column", "name": "code", "type": "varchar(4)", "default": "x"},
        {"action": "update-column-type", "name": "name", "type": "varchar(20)"},
        {"action": "rename-column", "name": "name", "to": "label"},
    ]
    described = [tuple(r)[:5] for r in lake.describe(lake.evolve_schema(evolved, changes)).collect()]
    assert described == [
        (1, "id", "bigint", True, None), (2, "label", "varchar(20)", False, "full name"),
        (3, "phone", "character varying", False, "d"), (4, "code", "varchar(4)", False, None),
    ]
    assert lake.evolve_schema(evolved, changes).first()["code"] == "x"
    for bad in ([], [{"action": ""}], [{"action": "delete-column", "name": "gone"}]):
        with pytest.raises(ValueError):
            lake.evolve_schema(table, bad)


def shared(spark):
    rows = [("a", i) for i in range(50)] + [("b", i) for i in range(20)] + [("c", 1), (None, 2)]
    return spark.createDataFrame(rows, "tenant_id string, v int")


def test_promote_then_demote_is_the_identity(spark, rows):
    df, path = shared(spark), scratch_path(spark, "tenants")
    big = spark.createDataFrame([("a",), ("b",)], "tenant string")
    moved = tenancy.promote(df, big, "tenant_id", path)
    assert rows(moved) == [("a", 50), ("b", 20)]
    left = tenancy.without_tenants(df, big, "tenant_id")
    assert rows(left) == [("c", 1), (None, 2)]
    dedicated = tenancy.read_promoted(spark, path, df.schema)
    assert rows(tenancy.demote(left, dedicated, "tenant_id")) == rows(df)
    # Rows that are shared already are not added again, other rows are refused.
    assert rows(tenancy.demote(df, dedicated, "tenant_id")) == rows(df)
    some = left.unionByName(spark.createDataFrame([("a", 99)], "tenant_id string, v int"))
    with pytest.raises(RuntimeError):
        tenancy.demote(some, dedicated, "tenant_id")
    with pytest.raises(RuntimeError):
        tenancy.demote(left, df.filter("tenant_id is null"), "tenant_id")


def test_promoting_several_tables_and_again_after_the_removal(spark, rows):
    df, path = shared(spark), scratch_path(spark, "tenants")
    other = spark.createDataFrame([("a", 1.5), ("c", 2.5)], "tenant_id string, x double")
    chosen = spark.createDataFrame([("a",), ("b",)], "tenant string")
    moved, left = tenancy.promote_tables({"t": df, "u": other}, chosen, "tenant_id", path, remove=True)
    assert rows(moved) == [("a", 2, 51), ("b", 1, 20)]
    assert rows(left["u"]) == [("c", 2.5)] and left["t"].count() == 2
    again, kept = tenancy.promote_tables(left, chosen, "tenant_id", path)
    assert rows(again) == [("a", 2, 51), ("b", 1, 20)] and kept == left
    with pytest.raises(ValueError):
        tenancy.promote_tables({}, chosen, "tenant_id", path)


def test_promoting_nobody(spark):
    df, path = shared(spark), scratch_path(spark, "tenants")
    nobody = spark.createDataFrame([], "tenant string")
    assert tenancy.promote(df, nobody, "tenant_id", path).count() == 0
    assert tenancy.read_promoted(spark, path, df.schema).count() == 0


def test_a_short_copy_is_noticed(spark):
    a = spark.createDataFrame([("a", 5), ("b", 1)], "tenant string, rows bigint")
    for other in ([("a", 4), ("b", 1)], [("a", 5)], [("a", 5), ("b", 1), ("c", 1)]):
        with pytest.raises(RuntimeError):
            tenancy.verify_counts(a, spark.createDataFrame(other, "tenant string, rows bigint"))


def test_deprovision(spark):
    tables = {"t": shared(spark)}
    assert tenancy.deprovision(tables, "tenant_id", "a", "delete")["t"].count() == 22
    path = scratch_path(spark, "archive")
    assert tenancy.deprovision(tables, "tenant_id", "a", "archive", path)["t"].count() == 72
    assert spark.read.parquet(f"{path}/a_archived/t").count() == 50
    with pytest.raises(ValueError):
        tenancy.deprovision(tables, "tenant_id", "a", "drop")


@pytest.mark.parametrize(
    ("tier", "rows_", "rate", "promote", "target", "reason"),
    [
        ("row_level", 1_500_000, 0, True, "schema_per_tenant", "rowCount (1500000) exceeds threshold (1000000)"),
        ("row_level", 500_000, 50, False, "row_level", ""),
        ("row_level", 1_000_000, 100, False, "row_level", ""),
        ("schema_per_tenant", 0, 101, True, "db_per_tenant", "queryRate (101) exceeds threshold (100)"),
        ("db_per_tenant", 2_000_000, 200, True, "db_per_tenant", "rowCount (2000000) exceeds threshold (1000000)"),
    ],
)
def test_promotion(spark, tier, rows_, rate, promote, target, reason):
    df = spark.createDataFrame([("x", tier, float(rows_), float(rate))], "tenant string, current_tier string, rowCount double, queryRate double")
    row = tenancy.evaluate_promotion(df).first()
    assert (row["should_promote"], row["recommended_tier"], row["reason"]) == (promote, target, reason)


def test_routing(spark):
    df = spark.createDataFrame([(s, "acme") for s in tenancy.TIERS], "s string, t string")
    found = [r[0] for r in df.select(tenancy.resolve_table(F.col("s"), F.col("t"), F.lit("orders"), "t_")).collect()]
    assert found == ["orders", "t_acme.orders", "orders"]
    assert tenancy.tenant_filter(shared(spark), "tenant_id", "b").count() == 20


def test_a_second_promotion_leaves_the_first(spark):
    from deq.operators import tenancy
    from deq.session import scratch_path

    shared = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "tenant_id string, v int")
    dest = scratch_path(spark, "tenants")
    for t in ("a", "b", "a"):
        done = tenancy.promote(shared, spark.createDataFrame([(t,)], "tenant string"), "tenant_id", dest)
        assert [r["tenant"] for r in done.collect()] == [t]
    rows = tenancy.read_promoted(spark, dest, shared.schema)
    assert sorted((r.tenant, r.v) for r in rows.collect()) == [("a", 1), ("a", 2), ("b", 3)]


def test_null_operations_and_times_stay(spark):
    from deq.operators import lake

    log = spark.createDataFrame(
        [(1, None, 1, "x", 1), (2, "DELETE", 2, "y", 1), (3, "INSERT", None, "z", 1)], "k int, op string, ts int, v string, version int"
    )
    assert {r.k for r in lake.as_of(log, ["k"], ["version"], version=1).collect()} == {1, 3}
    assert {r.k for r in lake.expire(log, ["k"], ["version"], 2).collect()} == {1, 2, 3}
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    assert [tuple(r) for r in lake.upsert(target, log.filter("k = 1"), ["k"], ["version"]).collect()] == [(1, "x")]


def test_compacting_keeps_columns_of_later_files(spark):
    from deq.operators import lake
    from deq.session import scratch_path

    source, dest = scratch_path(spark, "small"), scratch_path(spark, "large")
    spark.createDataFrame([(1,)], "a int").write.mode("append").parquet(source)
    spark.createDataFrame([(2, 3)], "a int, b int").write.mode("append").parquet(source)
    lake.compact(spark, source, dest)
    assert sorted(tuple(r) for r in spark.read.parquet(dest).select("a", "b").collect()) == [(1, None), (2, 3)]


def test_a_tenant_id_cannot_leave_its_folder(spark):
    from deq.operators import tenancy

    rows = spark.createDataFrame([("x",)], "tenant_id string")
    with pytest.raises(ValueError):
        tenancy.deprovision({"t": rows}, "tenant_id", "../../x", mode="archive", archive_path="/tmp/none")
