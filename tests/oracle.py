"""Run registered queries beside their SQL on DuckDB and compare sorted rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, dict):
        if set(v) == {"key", "value"} and isinstance(v["key"], list):
            v = dict(zip(v["key"], v["value"]))
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r.asDict(recursive=True)[c] for c in df.columns) for r in df.collect()])


def duck_rows(con, sql):
    res = con.execute(sql)
    return rows_of([d[0] for d in res.description], res.fetchall())


def spark_types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duck_types(con, sql):
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


SAME_TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
    "date": {"DATE"},
}


def differences(spark, folder, name, run, sql, con) -> list[str]:
    df = run(spark, folder)
    out = []
    have, want = spark_types(df), duck_types(con, sql)
    for c in sorted(set(have) | set(want)):
        expected = SAME_TYPES.get(have.get(c))
        if c not in have or c not in want:
            out.append(f"column {c}: spark {have.get(c)}, sql {want.get(c)}")
        elif expected and want[c] not in expected:
            out.append(f"type of {c}: spark {have[c]}, sql {want[c]}")
    a, b = spark_rows(df), duck_rows(con, sql)
    if a != b:
        first = next(((x, y) for x, y in zip(a[1], b[1]) if x != y), (a[1][-1:], b[1][-1:]))
        out.append(f"rows {len(a[1])} / {len(b[1])}, first difference {first}")
    elif not a[1]:
        out.append("no rows")
    return out


def main(folder: str, wanted: list[str]) -> int:
    from pyspark.sql import SparkSession

    from deq.plans.registry import oracles, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracles(), 0
    for name, run in queries().items():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                found = differences(spark, folder, name, run, sqls[name], con)
            else:
                found = [] if spark_rows(run(spark, folder))[1] else ["no rows"]
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:28} {time.time() - start:6.2f}s {'' if name in sqls else '(rows only)'}", *found, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
