"""Tenants: routing, metrics, promotion, moves."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deq.functions.names import check_ident
from deq.operators.skew import join_skewed
from deq.session import materialize
from deq.sources.layouts import write_partitioned

# Isolation tiers, lowest first.
TIERS = ["row_level", "schema_per_tenant", "db_per_tenant"]

# Promotion thresholds, in the order a reason is looked for.
THRESHOLDS = {"rowCount": 1_000_000, "queryRate": 100, "storageBytes": 10_737_418_240}


def resolve_table(strategy: Column, tenant: Column, table: Column, prefix: str = "") -> Column:
    """Where a tenant's table lives: its own schema, or the plain name for the other strategies."""
    own_schema = F.concat(F.lit(prefix), tenant, F.lit("."), table)
    return F.when(strategy == "schema_per_tenant", own_schema).otherwise(table)


def tenant_filter(df: DataFrame, column: str, tenant) -> DataFrame:
    """The rows of one tenant."""
    return df.filter(F.col(check_ident(column)) == F.lit(tenant))


def tenant_metrics(df: DataFrame, column: str, time_column: str) -> DataFrame:
    """``tenant, rowCount, queryRate, storageBytes`` per tenant.

    The rate is rows per hour between the tenant's first and last row; bytes are those of the
    rows as JSON.
    """
    seconds = F.unix_seconds(F.max(time_column).cast("timestamp")) - F.unix_seconds(F.min(time_column).cast("timestamp"))
    return df.groupBy(F.col(check_ident(column)).alias("tenant")).agg(
        F.count(F.lit(1)).cast("double").alias("rowCount"),
        (F.count(F.lit(1)) / F.greatest(seconds / 3600, F.lit(1.0))).alias("queryRate"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).cast("double").alias("storageBytes"),
    )


def next_tier(tier: Column) -> Column:
    """The next higher tier; the top one stays."""
    steps = F.create_map(*[F.lit(x) for pair in zip(TIERS, TIERS[1:]) for x in pair])
    return F.coalesce(steps[tier], tier)


def evaluate_promotion(metrics: DataFrame, thresholds: dict | None = None, tier: str = "current_tier") -> DataFrame:
    """Add ``should_promote, recommended_tier, reason``; a metric counts when strictly above its limit."""
    limits = {**THRESHOLDS, **(thresholds or {})}
    used = [(m, limit) for m, limit in limits.items() if m in metrics.columns]
    reason = F.coalesce(
        *[
            F.when(
                F.col(m) > F.lit(float(limit)),
                F.format_string(f"{m} (%.0f) exceeds threshold (%.0f)", F.col(m).cast("double"), F.lit(float(limit))),
            )
            for m, limit in used
        ],
        F.lit(None).cast("string"),
    )
    promote = F.col("reason").isNotNull()
    return metrics.withColumn("reason", reason).select(
        *metrics.columns,
        promote.alias("should_promote"),
        F.when(promote, next_tier(F.col(tier))).otherwise(F.col(tier)).alias("recommended_tier"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def tenant_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("tenant")).agg(F.count(F.lit(1)).alias("rows"))


def _only(df: DataFrame, tenants: DataFrame, column: str, how: str) -> DataFrame:
    chosen = tenants.select(F.col("tenant").alias(column)).distinct()
    return join_skewed(df, chosen, [column], how)


def promote(df: DataFrame, tenants: DataFrame, column: str, dest: str) -> DataFrame:
    """Copy the rows of the listed tenants to one folder each, in one write.

    Folders of other tenants stay; a named tenant's own folder is replaced. Returns ``tenant, rows``
    as migrated; raises when a copy does not hold the rows of its source. A tenant without rows at
    the source was moved before and keeps its copy, so a run may be tried again after the removal.
    """
    spark = df.sparkSession
    moving = _only(df, tenants, column, "left_semi")
    write_partitioned(moving.withColumn("tenant", F.col(column).cast("string")), dest, ["tenant"], mode="overwrite", keep_others=True)
    named = tenants.select(F.col("tenant").cast("string").alias("tenant"))
    copied = tenant_counts(read_promoted(spark, dest, df.schema), "tenant").join(named, "tenant", "left_semi")
    # Counted per tenant before the list is applied: one row per tenant meets the list.
    source = materialize(tenant_counts(df, column).join(tenants.select("tenant"), "tenant", "left_semi"))
    verify_counts(source, copied.join(source.select(F.col("tenant").cast("string").alias("tenant")), "tenant", "left_semi"))
    return copied


def promote_tables(
    tables: dict[str, DataFrame], tenants: DataFrame, column: str, dest: str, remove: bool = False
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Promote the tenants' rows of several tables, each below ``<dest>/<name>``.

    Returns ``tenant, tables, rows``, summed over the tables, and the tables; with ``remove`` those
    lack the moved rows, which is decided only after every copy has been verified.
    """
    if not tables:
        raise ValueError("tables are required")
    moved = [promote(df, tenants, column, f"{dest}/{check_ident(name)}") for name, df in tables.items()]
    total = reduce(DataFrame.unionByName, moved).groupBy("tenant")
    left = {name: without_tenants(df, tenants, column) if remove else df for name, df in tables.items()}
    return total.agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows")), left


def read_promoted(spark: SparkSession, dest: str, schema: StructType) -> DataFrame:
    """All promoted rows; a filter on ``tenant`` opens that tenant's folder only.

    ``schema`` is that of the shared table, so that a run that moved nobody reads as no rows.
    """
    rest = [f for f in schema.fields if f.name != "tenant"]
    return spark.read.schema(StructType(rest).add("tenant", "string")).parquet(dest)


def verify_counts(source: DataFrame, copy: DataFrame) -> None:
    """Raise unless both ``tenant, rows`` tables agree."""
    a = source.select(F.col("tenant").cast("string").alias("tenant"), F.col("rows").alias("want"))
    b = copy.select(F.col("tenant").cast("string").alias("tenant"), F.col("rows").alias("have"))
    wrong = a.join(b, "tenant", "full_outer").filter(~F.col("want").eqNullSafe(F.col("have")))
    worst = wrong.first()
    if worst is not None:
        raise RuntimeError(f"tenant {worst['tenant']} has {worst['want']} rows at the source and {worst['have']} in the copy")


def without_tenants(df: DataFrame, tenants: DataFrame, column: str) -> DataFrame:
    """The shared rows that are left once the tenants moved away."""
    return _only(df, tenants, column, "left_anti")


def _content(df: DataFrame, column: str, rows: str, digest: str) -> DataFrame:
    """Per tenant the number of rows and a digest of all of them, whatever their order."""
    each = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("decimal(20,0)")
    return df.groupBy(F.col(column).alias("tenant")).agg(F.count(F.lit(1)).alias(rows), F.sum(each).alias(digest))


def demote(shared: DataFrame, dedicated: DataFrame, column: str) -> DataFrame:
    """Put dedicated rows back beside the shared ones.

    A tenant whose dedicated rows are shared already, as after an earlier run, is not added again;
    one that has other shared rows, or rows without a tenant, raise before anything is added.
    """
    dedicated = dedicated.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in shared.schema.fields])
    back = materialize(_content(dedicated, column, "rows", "digest"))
    there = _content(_only(shared, back, column, "left_semi"), column, "shared_rows", "shared_digest")
    state = materialize(back.join(there, "tenant", "left"))
    same = "rows = shared_rows and digest <=> shared_digest"
    wrong = state.filter(f"tenant is null or (shared_rows is not null and not ({same}))").first()
    if wrong is not None:
        raise RuntimeError(f"tenant {wrong['tenant']} has {wrong['rows']} dedicated rows and other shared ones: {wrong['shared_rows']}")
    done = state.filter("shared_rows is not null")
    return shared.unionByName(without_tenants(dedicated, done, column))


def deprovision(
    tables: dict[str, DataFrame],
    column: str,
    tenant,
    mode: str = "delete",
    archive_path: str | None = None,
) -> dict[str, DataFrame]:
    """The tables without the tenant's rows (``delete``), or unchanged (``archive``).

    With a path, archiving first copies the rows below ``<path>/<tenant>_archived/<table>``.
    """
    if mode == "delete":
        return {n: df.filter(~F.col(column).eqNullSafe(F.lit(tenant))) for n, df in tables.items()}
    if mode != "archive":
        raise ValueError(f"unknown deprovision mode {mode!r} (valid: archive, delete)")
    if archive_path:
        # The id becomes a folder name.
        if not re.fullmatch(r"[A-Za-z0-9_-][A-Za-z0-9_.-]*", str(tenant)):
            raise ValueError(f"tenant id {tenant!r} cannot name a folder")
        for n, df in tables.items():
            tenant_filter(df, column, tenant).write.parquet(f"{archive_path}/{tenant}_archived/{n}")
    return tables
