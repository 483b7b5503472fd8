"""Joins in which a hot key does not end up in one task.

Spark splits a skewed side at run time only where both sides come straight out of a shuffle. A
side that was grouped by the join key first keeps its partitioning, and then nothing is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

# A side of at most this many rows and bytes is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32_000_000

# A key is hot when it holds more than one row in HOT_SHARE, so there are fewer hot keys than that.
HOT_SHARE = 10_000
SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_hash`` of each key that holds more than its share; fewer than HOT_SHARE rows."""
    counts = df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.filter(F.col("n") * HOT_SHARE > total).select("_hash")


def is_small(df: DataFrame) -> bool:
    """Whether a side has been counted and found small enough to broadcast."""
    size = F.octet_length(F.to_json(F.struct("*")))
    seen = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    return seen["rows"] <= BROADCAST_ROWS and (seen["bytes"] or 0) <= BROADCAST_BYTES


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def join_skewed(big: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big``, where a key may be hot, with ``unique``, where every key occurs once.

    ``how`` is inner, left, left_semi or left_anti. A unique side that is counted and found small
    is broadcast, and ``big`` is not shuffled at all. Else the rows of a hot key are spread over
    SALTS tasks, and its one row on the other side is repeated for each. The salt depends on the
    row's content alone, so a task that runs again sends every row to the same place.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unknown join type {how!r}")
    keys = list(keys)
    if how in ("left_semi", "left_anti"):
        unique = unique.select(*keys)
    if is_small(unique):
        return big.join(F.broadcast(unique), keys, how)
    hot = F.broadcast(hot_keys(big, keys).withColumn("_hot", F.lit(True)))
    content = [f.name for f in big.schema.fields if _hashable(f.dataType)]
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*content), F.lit(SALTS)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left")

    left = marked(big).withColumn("_salt", salt).drop("_hash", "_hot")
    right = marked(unique).withColumn("_salt", F.explode(copies)).drop("_hash", "_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
