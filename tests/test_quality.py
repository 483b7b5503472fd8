from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from deq.functions.text import engine_pattern, portable_pattern
from deq.operators.anomaly import anomaly, anomaly_rows
from deq.operators.checks import passed, quality_check
from deq.operators.compare import compare, compare_verdict
from deq.operators.contracts import (
    Contract,
    contract_assertions,
    contract_results,
    contract_verdict,
    pattern_violations,
)
from deq.operators.profile import profile, profile_distinct, profile_percentiles
from deq.operators.sketches import rank_errors, sketched_profile, write_sketches
from deq.session import scratch_path


def one(df):
    return df.collect()[0].asDict()


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"value {kind}")


def test_not_null_counts_every_column(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "id int, email string")
    row = one(quality_check(df, [{"type": "not_null", "columns": ["id", "email"]}]))
    assert (row["passed"], row["value"]) == (False, 3)
    assert row["message"] == 'column "id" has 1 null(s); column "email" has 2 null(s)'
    clean = one(quality_check(df.na.fill({"id": 0, "email": ""}), [{"type": "not_null", "columns": ["id", "email"]}]))
    assert (clean["passed"], clean["message"]) == (True, "all columns have no nulls")


def test_unique_looks_at_columns_one_by_one_and_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "id int, name string")
    row = one(quality_check(df, [{"type": "unique", "config": {"columns": ["id", "name"]}}]))
    assert (row["passed"], row["value"]) == (False, 2)
    assert row["message"] == 'column "id" has 2 duplicate value(s)'


def test_unique_treats_both_zeros_as_one_value(spark):
    row = one(quality_check(numbers(spark, [0.0, -0.0, 1.0]), [{"type": "unique", "columns": ["value"]}]))
    assert row["value"] == 1


def test_long_text_is_counted_by_its_content(spark):
    texts = ["x" * 5000, "x" * 5000, "x" * 4999 + "y", "é" * 64, "é" * 64, "a" * 63, "a" * 63, None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert one(quality_check(df, [{"type": "unique", "columns": ["value"]}]))["value"] == 3
    assert one(profile_distinct(df, ["value"]))["distinct_count"] == 4


def test_every_kind_of_column_is_told_apart(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (9007199254740993L, 1.10BD, 0.1F, 'a', X'00', array(1), true, date'2024-01-01', timestamp_ntz'2024-01-01 00:00:00'),
           (9007199254740992L, 1.1BD, float('NaN'), 'A', X'01', array(2), true, date'2024-01-02', timestamp_ntz'2024-01-01 00:00:00.000001'),
           (9007199254740993L, 1.11BD, float('NaN'), 'a', X'00', array(1), NULL, NULL, NULL),
           (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)
           AS t(i, d, f, s, b, l, t, day, ts)"""
    )
    columns = df.columns
    found = {r["column"]: r["distinct_count"] for r in profile_distinct(df, columns).collect()}
    assert found == {"i": 2, "d": 2, "f": 2, "s": 2, "b": 2, "l": 2, "t": 1, "day": 2, "ts": 2}
    dups = one(quality_check(df, [{"type": "unique", "columns": columns}]))
    # A repeated value in i, d, f, s, b, l and t, and a repeated NULL in t, day and ts.
    assert dups["value"] == 7 + 3
    full = {r["column"]: r for r in profile(df, columns).collect()}
    assert full["i"]["distinct_count"] == 2 and full["d"]["p50"] == 1.1 and full["s"]["p50"] is None


def test_row_count_bounds_are_inclusive_and_may_be_absent(spark):
    df = spark.range(5).toDF("id")
    checks = [{"type": "row_count", **c} for c in ({"min": 5, "max": 5}, {"min": 6}, {"max": 4}, {}, {"min": -1})]
    found = quality_check(df, checks).orderBy("seq").collect()
    assert [r["passed"] for r in found] == [True, False, False, True, True]
    assert found[1]["message"] == "row count 5 is below minimum 6"
    assert found[2]["message"] == "row count 5 exceeds maximum 4"


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 0, 50),)], "ts timestamp_ntz")
    check = {"type": "freshness", "column": "ts", "maxAge": "10m"}
    assert one(quality_check(df, [check], as_of=datetime(2024, 1, 1, 1)))["passed"]
    late = one(quality_check(df, [check], as_of=datetime(2024, 1, 1, 1, 0, 0, 1)))
    assert (late["passed"], late["value"]) == (False, 600)
    empty = one(quality_check(df.limit(0), [check], as_of=datetime(2024, 1, 1, 1)))
    assert (empty["passed"], empty["value"], empty["message"]) == (False, None, "table is empty (no rows found)")


def test_referential_counts_rows_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "k int")
    ref = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    check = {"type": "referential", "column": "k", "refTable": "ref", "refColumn": "id"}
    row = one(quality_check(df, [check], "t", lambda name: ref))
    assert (row["passed"], row["value"]) == (False, 4)
    assert row["message"] == "4 orphan row(s) in t.k not found in ref.id"


def test_custom_sql_threshold(spark):
    spark.range(3).createOrReplaceTempView("three")
    checks = [{"type": "custom_sql", "query": "SELECT count(*) FROM three", "threshold": t} for t in (2, 3)]
    found = quality_check(spark.range(1), checks).orderBy("seq").collect()
    assert [r["passed"] for r in found] == [False, True]


def test_suite_keeps_the_order_and_fuses_the_verdict(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "id int, name string")
    checks = [
        {"type": "unique", "columns": ["id"]},
        {"type": "row_count", "min": 1},
        {"type": "not_null", "columns": ["name"]},
    ]
    found = quality_check(df, checks)
    assert [r["check"] for r in found.orderBy("seq").collect()] == ["unique", "row_count", "not_null"]
    assert one(passed(found)) == {"passed": False}


@pytest.mark.parametrize(
    "check",
    [
        {"type": "no_such_check"},
        {"type": "not_null", "columns": []},
        {"type": "not_null", "columns": ["a; DROP TABLE x"]},
        {"type": "freshness", "maxAge": "1h"},
        {"type": "referential", "column": "a"},
        {"type": "custom_sql"},
    ],
)
def test_bad_checks_are_errors(spark, check):
    with pytest.raises(ValueError):
        quality_check(spark.range(1), [check])


def test_no_checks_is_an_error(spark):
    with pytest.raises(ValueError):
        quality_check(spark.range(1), [])


def test_profile_of_numbers(spark):
    row = one(profile(numbers(spark, [1.0, 5.0, 10.0, None]), ["value"]))
    assert (row["row_count"], row["null_count"], row["distinct_count"]) == (4, 1, 3)
    assert row["mean"] == pytest.approx(5.333333, abs=1e-6)
    assert (row["p25"], row["p50"], row["p75"], row["p99"]) == (1.0, 5.0, 10.0, 10.0)
    assert (row["min"], row["max"], row["null_rate"]) == ("1.0", "10.0", 0.25)


def test_profile_of_text_has_no_moments(spark):
    df = spark.createDataFrame([("Alice",), ("Bob",), ("Zara",)], "name string")
    row = one(profile(df, ["name"]))
    assert (row["min"], row["max"], row["distinct_count"]) == ("Alice", "Zara", 3)
    assert row["mean"] is None and row["stddev"] is None and row["p50"] is None


@pytest.mark.parametrize("values", [[], [None, None], [7.0], [3.0] * 9])
def test_profile_edge_columns(spark, values):
    row = one(profile(numbers(spark, values), ["value"]))
    seen = [v for v in values if v is not None]
    assert (row["row_count"], row["null_count"]) == (len(values), len(values) - len(seen))
    assert row["distinct_count"] == len(set(seen))
    assert row["p50"] == (seen[0] if seen else None)
    assert row["null_rate"] == (1.0 if values and not seen else 0.0)


def test_approximate_modes_agree_on_small_data(spark):
    df = numbers(spark, [float(i) for i in range(50)])
    # The sketch promises a relative standard deviation of 5 %; three of them are 15 %.
    assert one(profile_distinct(df, ["value"], approximate=True))["distinct_count"] == pytest.approx(50, rel=0.15)
    assert one(profile_percentiles(df, ["value"], approximate=True)) == one(profile_percentiles(df, ["value"]))


@pytest.mark.parametrize(
    ("values", "method", "threshold", "expected"),
    [
        ([*range(1, 11), 100], "zscore", 2.0, 1),
        ([*range(1, 11), 100], "iqr", 1.5, 1),
        ([*range(1, 11), 1000], "zscore", None, 1),
        ([*range(1, 11), 1000], "", 0, 1),
        ([5] * 8, "zscore", None, 0),
        ([5] * 8, "iqr", None, 0),
        ([0] * 4 + [1000] * 4, "zscore", 0.1, 8),
        ([], "zscore", None, 0),
        ([42], "zscore", None, 0),
        ([42], "iqr", None, 0),
    ],
)
def test_anomalies(spark, values, method, threshold, expected):
    row = one(anomaly(numbers(spark, [float(v) for v in values]), ["value"], method, threshold))
    assert row["anomalies"] == expected
    assert row["sample_size"] == len(values)


def test_anomaly_rows_and_text_columns(spark):
    df = numbers(spark, [float(v) for v in [*range(1, 11), 1000]])
    assert [r["value"] for r in anomaly_rows(df, "value").collect()] == [1000.0]
    with pytest.raises(ValueError):
        anomaly(spark.createDataFrame([("a",)], "s string"), ["s"])


def test_compare_inside_and_outside(spark):
    base, near, far = spark.range(1000), spark.range(1030), spark.range(1200)
    assert one(compare_verdict(compare(base, near))) == {"passed": True}
    assert one(compare_verdict(compare(base, far))) == {"passed": False}
    assert one(compare_verdict(compare(base, far, tolerances={"row_count": 0.2}))) == {"passed": True}


def test_compare_leaves_the_row_count_out_for_an_empty_baseline(spark):
    df = spark.createDataFrame([(None,), (1,)], "v int")
    diffs = compare(df.limit(0), df, ["v"]).collect()
    assert [(r["metric"], r["baseline"], r["current"], r["within_tolerance"]) for r in diffs] == [("null_rate", 0.0, 0.5, False)]


USERS = """
dataset: raw.users
owner: data-team
schema:
  columns:
    - { name: id, type: bigint, nullable: true }
    - { name: email, type: "varchar(255)", nullable: true, pattern: "^[^@]+@[^@]+$" }
quality:
  - { type: row_count, min: 1 }
"""


def test_contract_from_yaml(spark):
    contract = Contract.parse(USERS)
    good = spark.createDataFrame([(1, "a@b.c")], "id bigint, email string")
    assert one(contract_verdict(contract_results(good, contract), contract)) == {
        "dataset": "raw.users",
        "schema_ok": True,
        "quality_ok": True,
        "passed": True,
    }
    bad = spark.createDataFrame([(1.5, "nobody"), (2.5, None)], "id double, email string")
    found = contract_results(bad, contract)
    assert sorted((r["part"], r["message"]) for r in found.filter("NOT passed").collect()) == [
        ("pattern", "pattern check on email: 1 violation(s)"),
        ("schema", 'column "id": expected type "bigint", got "double precision"'),
    ]
    assert one(contract_verdict(found, contract))["passed"] is False


def test_contract_demands_not_null_by_default(spark):
    contract = Contract.parse({"dataset": "orders", "schema": {"columns": [{"name": "id", "type": "int8"}, {"name": "gone"}]}})
    found = contract_results(spark.createDataFrame([(1,)], "id bigint"), contract)
    assert sorted(r["message"] for r in found.collect()) == [
        'column "gone" not found in orders',
        'column "id": contract requires NOT NULL but column allows NULL',
    ]


def test_contract_needs_a_dataset():
    with pytest.raises(ValueError):
        Contract.parse({"owner": "x"})


def test_patterns_match_anywhere_and_skip_null(spark):
    df = spark.createDataFrame([("ab1",), ("ab",), (None,)], "s string")
    assert one(pattern_violations(df, {"s": r"\d"}))["value"] == 1


@pytest.mark.parametrize("pattern", [r"(a)\1", "(?=a)", "(?<!a)b", "a++", "("])
def test_patterns_outside_the_common_dialect_are_refused(pattern):
    with pytest.raises(Exception):
        portable_pattern(pattern)


@pytest.mark.parametrize("pattern", [r"(a)\1", "(?=a)", "a++", "(", "(?U)a", "[[:nope:]]", "[:alpha:]"])
def test_engine_patterns_outside_the_dialect_are_refused(spark, pattern):
    with pytest.raises(ValueError):
        engine_pattern(pattern)


def test_engine_patterns_mean_what_the_dialect_says(spark):
    df = spark.createDataFrame([("abc",), ("abc\n",)], "s string")
    wrong = {"^[a-z]+$": 1, "^[[:alpha:]]+$": 1, r"^\pL+$": 1, "^(?P<n>[a-z]+)$": 1, "(?m)^[a-z]+$": 0, "^[[a-c]+$": 1, "^[^[:digit:]]+$": 0, "[]x]": 2}
    for pattern, n in wrong.items():
        assert one(pattern_violations(df, {"s": pattern}))["value"] == n, pattern


def test_assertions_go_on_after_a_broken_one(spark):
    spark.range(3).createOrReplaceTempView("three")
    found = contract_assertions(
        spark,
        [
            {"name": "none", "query": "SELECT * FROM three WHERE id > 5"},
            {"name": "broken", "query": "SELECT * FROM no_such_table"},
            {"name": "failing", "query": "SELECT * FROM three WHERE 1 / id > 5"},
            {"name": "two", "query": "SELECT * FROM three WHERE id > 0"},
        ],
    ).orderBy("seq").collect()
    assert [(r["name"], r["violations"], r["passed"]) for r in found] == [
        ("none", 0, True),
        ("broken", None, False),
        ("failing", None, False),
        ("two", 2, False),
    ]
    assert found[3]["error"] == 'quality check "two": found 2 violations'
    assert contract_assertions(spark, [{"name": "x", "query": "SELECT 1"}], database=False).count() == 0


def test_a_query_without_an_answer_does_not_pass(spark):
    from deq.operators.checks import passed, quality_check

    frame = spark.createDataFrame([(1,)], "a int")
    for query in ("SELECT 1 AS x WHERE false", "SELECT CAST(NULL AS INT) AS x"):
        results = quality_check(frame, [{"type": "custom_sql", "query": query, "threshold": 0}], "t")
        assert [r["passed"] for r in results.collect()] == [False]
        assert not passed(results).first()["passed"]


def test_fields_inside_a_column_are_checked_and_profiled(spark):
    at = datetime(2024, 1, 1)
    rows = [((1.0, "x", at), 1), ((1.0, None, at), 2), ((None, "y", None), 3), (None, 4)]
    df = spark.createDataFrame(rows, "a struct<b double, c string, t timestamp_ntz>, a__b int")
    checks = [
        {"type": "not_null", "columns": ["a.b", "a.c", "a__b"]},
        {"type": "unique", "columns": ["a.b", "a__b"]},
        {"type": "freshness", "column": "a.t", "maxAge": "1h"},
    ]
    found = {r["check"]: r["passed"] for r in quality_check(df, checks, as_of=at + timedelta(minutes=5)).collect()}
    assert found == {"not_null": False, "unique": False, "freshness": True}
    stats = {r["column"]: r for r in profile(df, ["a.b", "a.c", "a__b"]).collect()}
    assert (stats["a.b"]["distinct_count"], stats["a.b"]["null_count"], stats["a.b"]["mean"], stats["a.b"]["p50"]) == (1, 2, 1.0, 1.0)
    assert (stats["a.c"]["distinct_count"], stats["a.c"]["min"], stats["a__b"]["p99"]) == (2, "x", 4.0)
    assert anomaly(df, ["a.b"]).first()["sample_size"] == 2
    assert {r["method"] for r in anomaly(df, ["a.b"], "iqr").collect()} == {"iqr"}


def test_stored_sketches_answer_any_range_of_days(spark):
    df = spark.range(60_000).selectExpr(
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, CAST(id % 10 AS int)) AS ts",
        "IF(id % 3 = 0, 5.0D, CAST((id * 7919) % 60000 AS double)) AS v",
        "concat('k', id % 5000) AS k",
        "CAST(NULL AS double) AS none",
    )
    path = scratch_path(spark, "sketches")
    half = F.dayofmonth("ts") <= 5
    write_sketches(df.filter(half).limit(100), path, "ts", ["v", "k", "none"])
    # A second write replaces the days it holds and leaves the others.
    write_sketches(df.filter(half), path, "ts", ["v", "k", "none"])
    write_sketches(df.filter(~half), path, "ts", ["v", "k", "none"])
    for start, stop in ((None, None), (date(2024, 1, 3), date(2024, 1, 9)), (date(2024, 1, 2), date(2024, 1, 3))):
        part = df
        if start:
            part = df.filter((F.to_date("ts") >= F.lit(start)) & (F.to_date("ts") < F.lit(stop)))
        found = sketched_profile(spark, path, start, stop)
        exact = {r["column"]: r for r in profile(part, ["v", "k", "none"]).collect()}
        for r in found.collect():
            want = exact[r["column"]]
            assert (r["row_count"], r["null_count"]) == (want["row_count"], want["null_count"])
            assert abs(r["distinct_count"] - want["distinct_count"]) <= 0.04 * want["distinct_count"]
        assert {r["column"]: (r["min"], r["p99"] is None) for r in found.collect()} == {"v": (found.filter("column = 'v'").first()["min"], False), "k": (None, True), "none": (None, True)}
        errors = rank_errors(found, part, ["v"]).collect()
        assert len(errors) == 5 and max(e["rank_error"] for e in errors) < 0.01
