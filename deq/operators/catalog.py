"""Dataset records, search and lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.names import declared_type
from deq.operators.skew import join_skewed
from deq.session import literal_rows, materialize


def dataset_record(
    df: DataFrame,
    dataset: str,
    owner: str = "",
    tags: list[str] = (),
    props: dict | None = None,
    count_rows: bool = False,
) -> DataFrame:
    """One row per field: ``dataset, position, field, type, nullable, owner, tags, props``.

    With ``count_rows`` the properties also hold the number of rows.
    """
    rows = [
        (dataset, i, f.name, declared_type(f), f.nullable, owner)
        for i, f in enumerate(df.schema.fields)
    ]
    record = literal_rows(
        df.sparkSession,
        rows,
        "dataset string, position int, field string, type string, nullable boolean, owner string",
    )
    pairs = [F.lit(x) for pair in (props or {}).items() for x in pair]
    record = record.withColumns(
        {
            "tags": F.array(*[F.lit(t) for t in tags]).cast("array<string>"),
            "props": F.create_map(*pairs).cast("map<string,string>"),
        }
    )
    if count_rows:
        n = df.agg(F.count(F.lit(1)).cast("string").alias("n")).scalar()
        record = record.withColumn("props", F.map_concat("props", F.create_map(F.lit("rows"), n)))
    return record


def dataset_search(datasets: DataFrame, text: str, limit: int = 10) -> DataFrame:
    """``name, platform, owner, total``: the first matches by name, and how many there are in all."""
    if not text:
        raise ValueError("query is required")
    hits = datasets.filter(F.lower("name").contains(text.lower()))
    total = hits.agg(F.count(F.lit(1)).alias("total")).scalar()
    top = hits.orderBy("name", "platform", "owner").limit(limit if limit > 0 else 10)
    return top.select("name", "platform", "owner", total.alias("total"))


def dataset_urn(platform: Column, name: Column) -> Column:
    """Catalog name of a dataset; the platform is ``unknown`` when empty."""
    # Fixed value: the form of the name.
    known = F.coalesce(F.nullif(platform, F.lit("")), F.lit("unknown"))
    return F.format_string("urn:li:dataset:(urn:li:dataPlatform:%s,%s,PROD)", known, name)


def record_lineage(upstream: DataFrame, downstream: DataFrame) -> DataFrame:
    """Lineage edges ``src, dst, pipeline, kind`` out of ``pipeline, dataset`` lists.

    A pipeline that reads m and writes n datasets stands between them as a node of its own: m + n
    edges in place of m times n. The kind, ``reads`` or ``writes``, tells which end is the
    pipeline, so a dataset may have a pipeline's name.
    """
    reads = upstream.filter(F.coalesce("dataset", F.lit("")) != "").select(
        F.col("dataset").alias("src"), F.col("pipeline").alias("dst"), "pipeline", F.lit("reads").alias("kind")
    )
    writes = downstream.filter(F.coalesce("dataset", F.lit("")) != "").select(
        F.col("pipeline").alias("src"), F.col("dataset").alias("dst"), "pipeline", F.lit("writes").alias("kind")
    )
    return reads.unionByName(writes).distinct()


def _walk(edges: DataFrame, start: DataFrame, depth: int, forward: bool) -> DataFrame:
    """Datasets reached from ``start``; a step passes one pipeline.

    Each level is fixed before the next one, so the work stays linear in the depth; an empty level
    ends the walk.
    """
    near, far = ("src", "dst") if forward else ("dst", "src")
    hops = {k: edges.filter(F.col("kind") == k).select(F.col(near).alias("node"), F.col(far).alias("next")) for k in ("reads", "writes")}
    into, out_of = (hops["reads"], hops["writes"]) if forward else (hops["writes"], hops["reads"])
    frontier, seen = start, start
    reached = []
    for level in range(1, depth + 1):
        pipelines = join_skewed(into, frontier, ["node"], "left_semi").select(F.col("next").alias("node")).distinct()
        reach = join_skewed(out_of, pipelines, ["node"], "left_semi").select(F.col("next").alias("node")).distinct()
        frontier = reach.join(seen, "node", "left_anti")
        if level < depth:
            frontier = materialize(frontier)
        reached.append(frontier.withColumn("depth", F.lit(level)))
        if level < depth and frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return reduce(DataFrame.unionByName, reached)


def query_lineage(edges: DataFrame, dataset: str, direction: str = "both", depth: int = 1) -> DataFrame:
    """``dataset, direction, depth``: datasets up to ``depth`` pipelines away, each once per direction."""
    if direction not in ("", "both", "upstream", "downstream"):
        raise ValueError(f"unknown direction {direction!r}")
    depth = depth if depth > 0 else 1
    start = literal_rows(edges.sparkSession, [(dataset,)], "node string")
    walks = []
    for name, forward in (("upstream", False), ("downstream", True)):
        if direction in ("", "both", name):
            walks.append(_walk(edges, start, depth, forward).withColumn("direction", F.lit(name)))
    found = reduce(DataFrame.unionByName, walks)
    return found.select(F.col("node").alias("dataset"), "direction", "depth")


def lineage_edges(edges: DataFrame, found: DataFrame, dataset: str) -> DataFrame:
    """The recorded edges that touch the dataset or a dataset found by :func:`query_lineage`."""
    start = literal_rows(edges.sparkSession, [(dataset,)], "node string")
    nodes = found.select(F.col("dataset").alias("node")).unionByName(start).distinct()
    reads, writes = edges.filter(F.col("kind") == "reads"), edges.filter(F.col("kind") == "writes")
    read = join_skewed(reads, nodes.withColumnRenamed("node", "src"), ["src"], "left_semi")
    written = join_skewed(writes, nodes.withColumnRenamed("node", "dst"), ["dst"], "left_semi")
    return read.select(*edges.columns).unionByName(written.select(*edges.columns)).distinct()
