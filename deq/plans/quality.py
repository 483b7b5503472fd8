"""Quality queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deq.operators.anomaly import anomaly, anomaly_rows
from deq.operators.checks import RESULT_COLUMNS, quality_check
from deq.operators.compare import compare
from deq.operators.contracts import (
    Contract,
    contract_assertions,
    contract_results,
    pattern_violations,
    schema_violations,
)
from deq.operators.sketches import rank_errors, sketched_profile, write_sketches
from deq.operators.profile import (
    profile,
    profile_counts,
    profile_distinct,
    profile_minmax,
    profile_moments,
    profile_percentiles,
)
from deq.session import scratch_path
from deq.plans.tables import AS_OF, DIRTY, declared_columns, declared_sql, dirty, events
from deq.sources.runlogs import event_log_totals, expectation_totals, scan_log_totals
from deq.sources.tables import scan

#: Days that a sketched profile is asked for, and a border between two writes of it.
FROM, SPLIT, UNTIL = datetime(2024, 1, 5), datetime(2024, 1, 12), datetime(2024, 1, 23)

PROFILED = ["event_id", "user_id", "event_type", "value", "ts"]
NUMBERS = ["event_id", "user_id", "value"]


def _checked(spark, folder, checks) -> DataFrame:
    # Ad-hoc SQL and reference tables go by name.
    dirty(spark, folder).createOrReplaceTempView("checked_events")
    return quality_check(
        dirty(spark, folder), checks, "checked_events", lambda name: scan(spark, name, folder), as_of=AS_OF
    )


def _check(*checks):
    return lambda spark, folder: _checked(spark, folder, list(checks)).select(*RESULT_COLUMNS)


NOT_NULL = {"type": "not_null", "columns": ["event_id", "value", "user_id"]}
UNIQUE = {"type": "unique", "config": {"columns": ["event_id", "event_type"]}}
ROWS_OK = {"type": "row_count", "min": 1, "max": 1_000_000_000}
ROWS_LOW = {"type": "row_count", "min": 1_000_000_000}
FRESH = {"type": "freshness", "column": "ts", "maxAge": "24h"}
STALE = {"type": "freshness", "column": "ts", "maxAge": "1s"}
KNOWN_USER = {"type": "referential", "column": "user_id", "refTable": "customer", "refColumn": "c_custkey"}
CUSTOM = {"type": "custom_sql", "query": "SELECT count(*) FROM checked_events WHERE value > 100", "threshold": 5}


def q_suite(spark, folder):
    return _checked(spark, folder, [NOT_NULL, UNIQUE, ROWS_OK, ROWS_LOW, FRESH, KNOWN_USER, CUSTOM])


def _halves(spark, folder):
    rows, middle = dirty(spark, folder), F.lit("2024-01-16").cast("timestamp_ntz")
    return rows.filter(F.col("ts") < middle), rows.filter(F.col("ts") >= middle)


def q_compare_rows(spark, folder):
    return compare(*_halves(spark, folder))


def q_compare_nulls(spark, folder):
    return compare(*_halves(spark, folder), ["value", "user_id"]).filter(F.col("metric") == "null_rate")


def q_compare(spark, folder):
    diffs = compare(*_halves(spark, folder), ["value", "user_id", "event_type"], {"null_rate": 0.0001})
    return diffs.withColumn("passed", F.every("within_tolerance").over(Window.partitionBy(F.lit(1))))


def q_profile(spark, folder):
    return profile(dirty(spark, folder), PROFILED).select(
        "*", *[F.round(c, 6).alias(f"{c}_r") for c in ("mean", "stddev", "null_rate")]
    ).drop("mean", "stddev", "null_rate")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def q_anomaly(spark, folder):
    found = anomaly(events(spark, folder), ["value", "user_id"], "zscore")
    return found.unionByName(anomaly(events(spark, folder), ["value", "user_id"], "iqr"))


def q_anomaly_rows(spark, folder):
    rows = events(spark, folder)
    z = anomaly_rows(rows, "value", "zscore").select(F.lit("zscore").alias("method"), "event_id", "value")
    return z.unionByName(anomaly_rows(rows, "value", "iqr").select(F.lit("iqr").alias("method"), "event_id", "value"))


CONTRACT = {
    "dataset": "raw.events",
    "owner": "data-team",
    "schema": {
        "columns": [
            {"name": "event_id", "type": "bigint", "nullable": True},
            {"name": "user_id", "type": "varchar(20)", "nullable": True},
            {"name": "event_type", "type": "varchar", "nullable": True, "pattern": "^(click|view|purchase)$"},
            {"name": "value", "type": "float8", "nullable": False},
            {"name": "country", "type": "text", "nullable": True},
        ]
    },
    "quality": [ROWS_OK, NOT_NULL, {"type": "unique", "columns": ["event_id"]}, KNOWN_USER],
}


def contract_validate(spark, folder):
    contract = Contract.parse(CONTRACT)
    found = contract_results(dirty(spark, folder), contract, lambda n: scan(spark, n, folder), AS_OF)
    # One row per finding: a window over them all stays as small as the contract.
    return found.select("part", *RESULT_COLUMNS, F.every("passed").over(Window.partitionBy(F.lit(1))).alias("contract_passed"))


def contract_pattern(spark, folder):
    return pattern_violations(
        scan(spark, "documents", folder), {"text": "^[A-Z]", "lang": "^(en|de|fr|es)$", "source": r"\d"}
    ).select(*RESULT_COLUMNS)


def contract_schema(spark, folder):
    live = declared_columns(spark, folder, "F", 1)
    return schema_violations(declared_columns(spark, folder, "O", 2), live).drop("position")


def contract_assertion_rows(spark, folder):
    dirty(spark, folder).createOrReplaceTempView("checked_events")
    return contract_assertions(
        spark,
        [
            {"name": "no_null_value", "query": "SELECT * FROM checked_events WHERE value IS NULL", "type": "not_null"},
            {"name": "known_types", "query": "SELECT * FROM checked_events WHERE event_type = 'other'", "type": "custom"},
            {"name": "broken", "query": "SELECT nothing_there FROM checked_events", "type": "custom"},
            {
                "name": "unique_id",
                "query": "SELECT event_id FROM checked_events GROUP BY event_id HAVING count(*) > 1",
                "type": "unique",
            },
        ],
    ).select("name", "violations", "passed")


def _log_lines(spark, folder):
    """Structured log lines, one run per user, out of events."""
    names = {"click": "TestPass", "view": "TestPass", "purchase": "TestFail", "error": "TestError", "signup": "TestSkip"}
    name = F.create_map(*[F.lit(x) for p in names.items() for x in p])[F.col("event_type")]
    nested = F.to_json(F.struct(F.struct(name.alias("name"), F.col("event_type").alias("msg")).alias("info")))
    flat = F.to_json(F.struct(name.alias("name"), F.col("event_type").alias("msg")))
    i = F.col("event_id")
    line = F.when(i % 11 == 0, "plain text").when(i % 2 == 0, nested).otherwise(flat)
    return events(spark, folder).select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"), line.alias("line"))


def _summaries(spark, folder):
    """One summary line per event that stands alone in its run."""
    line = F.to_json(
        F.struct((F.col("event_id") % 7).alias("passed"), (F.col("event_id") % 3).alias("failed"), F.lit(1).alias("errors"))
    )
    return events(spark, folder).select(F.concat(F.lit("sum_"), F.col("event_id").cast("string")).alias("run_id"), line.alias("line"))


def runlog_dbt(spark, folder):
    return event_log_totals(_log_lines(spark, folder).unionByName(_summaries(spark, folder)))


def runlog_soda(spark, folder):
    n = (F.col("event_id") % 9).cast("string")
    word = F.create_map(
        *[F.lit(x) for p in {"click": " checks passed", "view": " Check PASSED.", "purchase": " checks failed", "error": " check had error", "signup": " checks skipped"}.items() for x in p]
    )[F.col("event_type")]
    lines = events(spark, folder).select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"), F.concat(F.lit("  "), n, word).alias("line")
    )
    return scan_log_totals(lines)


def runlog_expectations(spark, folder):
    i = F.col("event_id")
    stats = F.struct(
        (i % 10).alias("evaluated_expectations"), (i % 4).alias("successful_expectations"), (i % 3).alias("failed_expectations")
    )
    result = F.struct(F.struct(stats.alias("statistics")).alias("validation_result"))
    runs = F.when(i % 5 == 0, F.create_map(F.lit("a"), result)).otherwise(F.create_map(F.lit("a"), result, F.lit("b"), result))
    document = F.to_json(F.struct((i % 2 == 0).alias("success"), (i % 6).alias("evaluated"), runs.alias("run_results")))
    return expectation_totals(events(spark, folder).select(i.alias("run_id"), document.alias("document")))


def q_profile_sketched(spark, folder):
    """A profile of some days out of stored sketches, with its errors held against the exact rows."""
    rows, path, columns = events(spark, folder), scratch_path(spark, "sketches"), ["event_id", "user_id", "value", "event_type"]
    for early in (True, False):
        write_sketches(rows.filter((F.col("ts") < F.lit(SPLIT)) == F.lit(early)), path, "ts", columns)
    found = sketched_profile(spark, path, FROM, UNTIL)
    part = rows.filter((F.col("ts") >= F.lit(FROM)) & (F.col("ts") < F.lit(UNTIL)))
    exact = profile_distinct(part, columns).withColumnRenamed("distinct_count", "exact")
    errors = rank_errors(found, part, columns[:3]).groupBy("column").agg(F.max("rank_error").alias("rank_error"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(1), 0.04 * F.col("exact"))
    return found.join(exact, "column").join(errors, "column", "left").select(
        "column", "row_count", "null_count", "min", "max", close.alias("distinct_close"), (F.col("rank_error") < 0.01).alias("ranks_close")
    )


QUERIES = {
    "q_profile_sketched": q_profile_sketched,
    "q_row_count": _check(ROWS_OK, ROWS_LOW),
    "q_not_null": _check(NOT_NULL),
    "q_unique": _check(UNIQUE),
    "q_freshness": _check(FRESH, STALE),
    "q_referential": _check(KNOWN_USER),
    "q_custom_sql": _check(CUSTOM),
    "q_suite": q_suite,
    "q_profile_counts": lambda s, f: profile_counts(dirty(s, f), PROFILED),
    "q_profile_distinct": lambda s, f: profile_distinct(dirty(s, f), PROFILED),
    "q_profile_minmax": lambda s, f: profile_minmax(dirty(s, f), PROFILED),
    "q_profile_moments": lambda s, f: _rounded(profile_moments(dirty(s, f), NUMBERS), "mean", "stddev"),
    "q_profile_percentiles": lambda s, f: profile_percentiles(dirty(s, f), NUMBERS),
    "q_profile": q_profile,
    "q_anomaly_zscore": lambda s, f: anomaly(scan(s, "documents", f), ["n_chars"], "zscore"),
    "q_anomaly_iqr": lambda s, f: anomaly(scan(s, "documents", f), ["n_chars"], "iqr"),
    "q_anomaly": q_anomaly,
    "q_anomaly_rows": q_anomaly_rows,
    "q_compare_rows": q_compare_rows,
    "q_compare_nulls": q_compare_nulls,
    "q_compare": q_compare,
    "contract_pattern": contract_pattern,
    "contract_schema": contract_schema,
    "contract_validate": contract_validate,
    "contract_assertions": contract_assertion_rows,
    "runlog_dbt": runlog_dbt,
    "runlog_soda": runlog_soda,
    "runlog_expectations": runlog_expectations,
}

_AGE = "(epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) // 1000000"


def _sql_row_count(low: int | None, high: int | None) -> str:
    ok = " AND ".join([f"count(*) >= {low}"] * (low is not None) + [f"count(*) <= {high}"] * (high is not None))
    note = f"CASE WHEN count(*) < {low} THEN concat('row count ', count(*), ' is below minimum {low}') ELSE concat('row count: ', count(*)) END"
    return f"""SELECT 'row_count' AS "check", '' AS "column", {ok} AS passed, count(*) AS value, {note} AS message FROM {DIRTY}"""


def _sql_not_null() -> str:
    return f"""SELECT 'not_null' AS "check", 'event_id,value,user_id' AS "column", n = 0 AS passed, n AS value,
      CASE WHEN n = 0 THEN 'all columns have no nulls' ELSE concat('column "value" has ', n, ' null(s)') END AS message
      FROM (SELECT count(*) AS n FROM {DIRTY} WHERE value IS NULL)"""


def _sql_unique(columns: list[str]) -> str:
    subs = ", ".join(f"(SELECT count(*) FROM (SELECT {c} FROM {DIRTY} GROUP BY {c} HAVING count(*) > 1)) AS d_{c}" for c in columns)
    notes = ", ".join(f"""CASE WHEN d_{c} > 0 THEN concat('column "{c}" has ', d_{c}, ' duplicate value(s)') END""" for c in columns)
    total = " + ".join(f"d_{c}" for c in columns)
    return f"""SELECT 'unique' AS "check", '{",".join(columns)}' AS "column", {total} = 0 AS passed, {total} AS value,
      CASE WHEN {total} = 0 THEN 'all columns are unique' ELSE concat_ws('; ', {notes}) END AS message FROM (SELECT {subs})"""


def _sql_fresh(seconds: int) -> str:
    return f"""SELECT 'freshness' AS "check", 'ts' AS "column", age <= {seconds} AS passed, age AS value,
      concat('last update was ', age, 's ago (max allowed: {seconds}s)') AS message FROM (SELECT {_AGE} AS age FROM {DIRTY})"""


def _sql_known(table: str) -> str:
    return f"""SELECT 'referential' AS "check", 'user_id' AS "column", n = 0 AS passed, n AS value,
      CASE WHEN n = 0 THEN 'no orphan rows found' ELSE concat(n, ' orphan row(s) in {table}.user_id not found in customer.c_custkey') END AS message
      FROM (SELECT count(*) AS n FROM {DIRTY} t LEFT JOIN customer r ON t.user_id = r.c_custkey WHERE r.c_custkey IS NULL)"""


_SQL_CUSTOM = f"""SELECT 'custom_sql' AS "check", '' AS "column", n <= 5 AS passed, n AS value,
  concat('query returned ', n, ' (threshold: 5)') AS message FROM (SELECT count(*) AS n FROM {DIRTY} WHERE value > 100)"""


def _numbered(parts: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS seq, * FROM ({p})" for i, p in enumerate(parts))


def _per_column(columns: list[str], select: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", {select.replace('$c', c)} FROM {DIRTY}""" for c in columns)


_PERCENTILES = ", ".join(f"CAST(quantile_disc($c, {p}) AS DOUBLE) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9, 0.99))
_NO_NUMBERS = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("p25", "p50", "p75", "p90", "p99", "mean_r", "stddev_r"))
_COMMON = (
    "count(*) AS row_count, count(*) - count($c) AS null_count, count(DISTINCT $c) AS distinct_count, "
    "CAST(min($c) AS VARCHAR) AS min, CAST(max($c) AS VARCHAR) AS max, round((count(*) - count($c)) / count(*), 6) AS null_rate_r"
)


def _sql_profile() -> str:
    moments = "round(avg($c), 6) AS mean_r, round(stddev_samp($c), 6) AS stddev_r"
    numbers = _per_column(["event_id", "user_id", "value"], f"{_COMMON}, {_PERCENTILES}, {moments}")
    others = _per_column(["event_type", "ts"], f"{_COMMON}, {_NO_NUMBERS}")
    return f"{numbers} UNION ALL {others}"


def _sql_zscore(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", 'zscore' AS method, CAST(3.0 AS DOUBLE) AS threshold, count({column}) AS sample_size,
      count(*) FILTER (abs(({column} - m) / nullif(s, 0)) > 3.0) AS anomalies
      FROM {table}, (SELECT avg({column}) AS m, stddev_samp({column}) AS s FROM {table})"""


def _sql_iqr(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", 'iqr' AS method, CAST(1.5 AS DOUBLE) AS threshold, count({column}) AS sample_size,
      count(*) FILTER ({column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)) AS anomalies
      FROM {table}, (SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {table})"""


_HALVES = f"""(SELECT count(*) FILTER (old) AS b, count(*) FILTER (NOT old) AS c,
  $counts FROM (SELECT *, ts < TIMESTAMP '2024-01-16' AS old FROM {DIRTY}))"""


def _sql_compare(columns: list[str], tolerance: float, rows: bool = True) -> str:
    counts = ", ".join(
        f"count(*) FILTER (old AND {c} IS NULL) AS b_{c}, count(*) FILTER (NOT old AND {c} IS NULL) AS c_{c}" for c in columns
    )
    source = _HALVES.replace("$counts", counts or "1 AS one")
    parts = []
    if rows:
        parts.append(
            f"""SELECT '' AS "column", 'row_count' AS metric, CAST(b AS DOUBLE) AS baseline, CAST(c AS DOUBLE) AS current,
            abs(b - c) / b <= 0.05 AS within_tolerance FROM {source}"""
        )
    for c in columns:
        parts.append(
            f"""SELECT '{c}' AS "column", 'null_rate' AS metric, b_{c} / b AS baseline, c_{c} / c AS current,
            abs(b_{c} / b - c_{c} / c) <= {tolerance} AS within_tolerance FROM {source}"""
        )
    return " UNION ALL ".join(parts)


def _sql_pattern(column: str, pattern: str) -> str:
    return f"""SELECT 'pattern({column})' AS "check", '{column}' AS "column", n = 0 AS passed, n AS value,
      concat('pattern check on {column}: ', n, ' violation(s)') AS message
      FROM (SELECT count(*) AS n FROM documents WHERE {column} IS NOT NULL AND NOT regexp_matches({column}, '{pattern}'))"""


_TYPE_NAME = """CASE lower(trim(regexp_replace(lower(trim($t)), '\\(.*\\)$', ''))) WHEN 'varchar' THEN 'character varying'
  WHEN 'int' THEN 'integer' ELSE lower(trim($t)) END"""


def _sql_contract_schema() -> str:
    want, have = _TYPE_NAME.replace("$t", "d.type"), _TYPE_NAME.replace("$t", "l.type")
    return f"""WITH d AS (SELECT * FROM {declared_sql('O', 2)}), l AS (SELECT * FROM {declared_sql('F', 1)}),
      j AS (SELECT d.dataset, d."column", d.type AS want, l.type AS have, {want} AS w, {have} AS h, d.nullable AS dn,
        l.nullable AS ln, l.dataset IS NOT NULL AS found
        FROM d LEFT JOIN l ON d.dataset = l.dataset AND d."column" = l."column")
      SELECT dataset, "column", concat('column "', "column", '" not found in ', dataset) AS error FROM j WHERE NOT found
      UNION ALL SELECT dataset, "column", concat('column "', "column", '": expected type "', want, '", got "', have, '"') FROM j
        WHERE found AND NOT contains(h, w) AND NOT contains(w, h)
      UNION ALL SELECT dataset, "column", concat('column "', "column", '": contract requires NOT NULL but column allows NULL') FROM j
        WHERE found AND NOT dn AND ln"""


def _sql_contract() -> str:
    fields = '"check", "column", passed, value, message'
    schema = " UNION ALL ".join(
        f"""SELECT 'schema' AS part, 'schema' AS "check", '{c}' AS "column", false AS passed, 1 AS value, '{m}' AS message"""
        for c, m in [
            ("user_id", 'column "user_id": expected type "varchar(20)", got "bigint"'),
            ("value", 'column "value": contract requires NOT NULL but column allows NULL'),
            ("country", 'column "country" not found in raw.events'),
        ]
    )
    checks = [_sql_row_count(1, 1_000_000_000), _sql_not_null(), _sql_unique(["event_id"]), _sql_known("raw.events")]
    quality = " UNION ALL ".join(f"SELECT 'quality' AS part, {fields} FROM ({c})" for c in checks)
    pattern = _sql_pattern("event_type", "^(click|view|purchase)$").replace("FROM documents", f"FROM {DIRTY}")
    return f"""WITH r AS ({schema} UNION ALL {quality} UNION ALL SELECT 'pattern' AS part, {fields} FROM ({pattern}))
      SELECT *, (SELECT bool_and(passed) FROM r) AS contract_passed FROM r"""


ORACLES = {
    "q_profile_sketched": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) - count({c}) AS null_count, {number.replace('?', 'min')} AS "min",
            {number.replace('?', 'max')} AS "max", true AS distinct_close, {close} AS ranks_close
            FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-23'"""
        for c, number, close in [
            ("event_id", "CAST(?(event_id) AS DOUBLE)", "true"), ("user_id", "CAST(?(user_id) AS DOUBLE)", "true"),
            ("value", "?(value)", "true"), ("event_type", "CAST(NULL AS DOUBLE)", "CAST(NULL AS BOOLEAN)"),
        ]
    ),
    "q_row_count": f"{_sql_row_count(1, 1_000_000_000)} UNION ALL {_sql_row_count(1_000_000_000, None)}",
    "q_not_null": _sql_not_null(),
    "q_unique": _sql_unique(["event_id", "event_type"]),
    "q_freshness": f"{_sql_fresh(86400)} UNION ALL {_sql_fresh(1)}",
    "q_referential": _sql_known("checked_events"),
    "q_custom_sql": _SQL_CUSTOM,
    "q_suite": _numbered(
        [
            _sql_not_null(),
            _sql_unique(["event_id", "event_type"]),
            _sql_row_count(1, 1_000_000_000),
            _sql_row_count(1_000_000_000, None),
            _sql_fresh(86400),
            _sql_known("checked_events"),
            _SQL_CUSTOM,
        ]
    ),
    "q_profile_counts": _per_column(
        PROFILED, "count(*) AS row_count, count(*) - count($c) AS null_count, (count(*) - count($c)) / count(*) AS null_rate"
    ),
    "q_profile_distinct": _per_column(PROFILED, "count(DISTINCT $c) AS distinct_count"),
    "q_profile_minmax": _per_column(PROFILED, "CAST(min($c) AS VARCHAR) AS min, CAST(max($c) AS VARCHAR) AS max"),
    "q_profile_moments": _per_column(NUMBERS, "round(avg($c), 6) AS mean, round(stddev_samp($c), 6) AS stddev"),
    "q_profile_percentiles": _per_column(NUMBERS, _PERCENTILES),
    "q_profile": _sql_profile(),
    "q_anomaly_zscore": _sql_zscore("documents", "n_chars"),
    "q_anomaly_iqr": _sql_iqr("documents", "n_chars"),
    "q_anomaly": " UNION ALL ".join(f("events", c) for f in (_sql_zscore, _sql_iqr) for c in ("value", "user_id")),
    "q_anomaly_rows": """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d, quantile_disc(value, 0.25) AS q1,
      quantile_disc(value, 0.75) AS q3 FROM events)
      SELECT 'zscore' AS method, event_id, value FROM events, s WHERE abs((value - m) / d) > 3
      UNION ALL SELECT 'iqr', event_id, value FROM events, s WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
    "q_compare_rows": _sql_compare([], 0.01),
    "q_compare_nulls": _sql_compare(["value", "user_id"], 0.01, rows=False),
    "q_compare": f"""WITH d AS ({_sql_compare(["value", "user_id", "event_type"], 0.0001)})
      SELECT *, (SELECT bool_and(within_tolerance) FROM d) AS passed FROM d""",
    "contract_pattern": " UNION ALL ".join(
        [_sql_pattern("text", "^[A-Z]"), _sql_pattern("lang", "^(en|de|fr|es)$"), _sql_pattern("source", "\\d")]
    ),
    "contract_schema": _sql_contract_schema(),
    "contract_validate": _sql_contract(),
    "contract_assertions": f"""SELECT 'no_null_value' AS name, count(*) AS violations, count(*) = 0 AS passed FROM {DIRTY} WHERE value IS NULL
      UNION ALL SELECT 'known_types', count(*), count(*) = 0 FROM {DIRTY} WHERE event_type = 'other'
      UNION ALL SELECT 'broken', NULL, false
      UNION ALL SELECT 'unique_id', count(*), count(*) = 0 FROM (SELECT event_id FROM {DIRTY} GROUP BY event_id HAVING count(*) > 1)""",
    "runlog_dbt": """SELECT concat('run_', user_id) AS run_id,
        count(*) FILTER (event_id % 11 <> 0 AND event_type IN ('click', 'view')) AS passed,
        count(*) FILTER (event_id % 11 <> 0 AND event_type = 'purchase') AS failed,
        count(*) FILTER (event_id % 11 <> 0 AND event_type = 'error') AS errors,
        count(*) FILTER (event_id % 11 <> 0 AND event_type = 'signup') AS skipped FROM events GROUP BY user_id
      UNION ALL SELECT concat('sum_', event_id), event_id % 7, event_id % 3, 1, 0 FROM events""",
    "runlog_soda": """SELECT concat('run_', user_id) AS run_id,
        CAST(coalesce(sum(event_id % 9) FILTER (event_type IN ('click', 'view')), 0) AS BIGINT) AS passed,
        CAST(coalesce(sum(event_id % 9) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS failed,
        CAST(coalesce(sum(event_id % 9) FILTER (event_type = 'error'), 0) AS BIGINT) AS errors FROM events GROUP BY user_id""",
    "runlog_expectations": """SELECT event_id AS run_id, event_id % 2 = 0 AS success, event_id % 6 + k * (event_id % 10) AS evaluated,
      k * (event_id % 4) AS successful, k * (event_id % 3) AS failed
      FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 2 END AS k FROM events)""",
}
