"""Change events: filter, snapshot, statistics, lag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default lag thresholds (1 GiB, 300 s) and the share of them that warns.
LAG_BYTES = 1_073_741_824
LAG_SECONDS = 300
WARNING_SHARE = 0.8

# Short operation codes some connectors use; only applied on request.
SHORT_CODES = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "READ"}


def _named(df: DataFrame, first: str, second: str) -> Column:
    have = [F.nullif(F.col(c), F.lit("")) for c in (first, second) if c in df.columns]
    if not have:
        raise ValueError(f"change events need a column {first!r} or {second!r}")
    return F.coalesce(*have)


def normalize_codes(df: DataFrame, column: str = "op") -> DataFrame:
    """Spell out one-letter operation codes."""
    return df.replace(SHORT_CODES, subset=[column])


def cdc_filter(
    events: DataFrame,
    tables: list[str] = (),
    actions: list[str] = (),
    table: str = "table",
    op: str = "op",
) -> DataFrame:
    """Events of the given tables and operations, matched exactly; an empty list lets all pass.

    Where the table or operation is empty, ``source`` or ``action`` stands in.
    """
    if tables:
        events = events.filter(_named(events, table, "source").isin(list(tables)))
    if actions:
        events = events.filter(_named(events, op, "action").isin(list(actions)))
    return events


def snapshot_events(tables: dict[str, DataFrame]) -> DataFrame:
    """``op, tbl, payload``: every row of every table as a READ event."""
    if not tables:
        raise ValueError("tables is required")
    reads = [
        df.select(
            F.lit("READ").alias("op"),
            F.lit(name).alias("tbl"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, reads)


def schema_history(versions: DataFrame, table: str) -> DataFrame:
    """DDL versions of one table, oldest first."""
    return versions.filter(F.col("tbl") == table).orderBy("version")


def table_stats(events: DataFrame) -> DataFrame:
    """``tbl, inserts, updates, deletes, ddls`` per table."""
    counted = {"inserts": "INSERT", "updates": "UPDATE", "deletes": "DELETE", "ddls": "DDL"}
    return events.groupBy("tbl").agg(*[F.count_if(F.col("op") == op).alias(n) for n, op in counted.items()])


def ddl_history(stats: DataFrame) -> DataFrame:
    """``tbl, ddl``: a line for each table whose structure changed."""
    line = F.format_string("DDL changes: %d (inserts:%d updates:%d deletes:%d)", "ddls", "inserts", "updates", "deletes")
    return stats.filter(F.col("ddls") > 0).select("tbl", line.alias("ddl"))


def lag_seconds(as_of) -> Column:
    """Seconds from ``last_event`` to the instant, none below zero."""
    now = F.unix_seconds(F.lit(as_of).cast("timestamp"))
    return F.greatest(now - F.unix_seconds(F.col("last_event").cast("timestamp")), F.lit(0))


def source_lag(events: DataFrame, as_of, acknowledged: Column | int = -1, payload: str = "payload") -> DataFrame:
    """``source_id, last_event, lag_seconds, lag_bytes`` per source.

    Bytes are those of the payloads after the acknowledged offset.
    """
    ahead = F.col("seq") > acknowledged
    return (
        events.groupBy("source_id")
        .agg(
            F.max("ts").alias("last_event"),
            F.coalesce(F.sum(F.when(ahead, F.octet_length(payload))), F.lit(0)).alias("lag_bytes"),
        )
        .withColumn("lag_seconds", lag_seconds(as_of))
    )


def lag_status(
    lag_bytes: Column,
    lag_seconds: Column,
    max_bytes: int = LAG_BYTES,
    max_seconds: int = LAG_SECONDS,
    share: float = WARNING_SHARE,
) -> Column:
    """``critical``, ``warning`` or ``healthy``; a threshold of 0 is off."""
    share = share if share > 0 else WARNING_SHARE

    def over(part: float) -> Column:
        hit = F.lit(False)
        if max_bytes > 0:
            hit = hit | (lag_bytes >= F.lit(max_bytes * part))
        if max_seconds > 0:
            hit = hit | (lag_seconds >= F.lit(max_seconds * part))
        return hit

    return F.when(over(1.0), "critical").when(over(share), "warning").otherwise("healthy")


def monitor(lag: DataFrame, **thresholds) -> DataFrame:
    """Lag rows with ``status``, ``alerts`` (1 unless healthy) and ``throttle`` (when critical)."""
    status = lag_status(F.col("lag_bytes"), F.col("lag_seconds"), **thresholds)
    return lag.withColumn("status", status).select(
        "*",
        F.when(F.col("status") == "healthy", 0).otherwise(1).alias("alerts"),
        (F.col("status") == "critical").alias("throttle"),
    )
