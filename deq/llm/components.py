"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``u`` and its component's least node ``m``, for every node of the links (u, v) that is not least.

    Alternates two steps until nothing changes: each node links its larger neighbours to the least
    node around it, then its smaller ones. A node's neighbours are only ever reduced to a minimum, so
    a hub costs no more than its rows. Every step is stored in the shared folder.
    """
    edges = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = materialize(large)
        least = _least(large)
        kept = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(kept.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select("u", F.col("v").alias("m"))
        before = state
