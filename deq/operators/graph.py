"""Property graphs as two tables.

Nodes are ``label, key, props``, edges ``src_label, src, dst_label, dst, type, props``; ``props``
maps names to text. A node is named by its label and key, an edge by its ends and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.names import check_ident
from deq.operators.skew import join_skewed
from deq.session import literal_rows

NODE = ["label", "key"]
EDGE = ["src_label", "src", "dst_label", "dst", "type"]


def map_properties(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """Rename source columns to properties ``{property: source}``.

    Sources that do not exist are skipped; an empty mapping passes every column.
    """
    if not mapping:
        return df
    return df.select(*[F.col(s).alias(check_ident(p, strict=True)) for p, s in mapping.items() if s in df.columns])


def as_nodes(df: DataFrame, label: str, key: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Nodes out of table rows: the key column names the node, the mapped columns describe it."""
    label = check_ident(label, strict=True)
    props = map_properties(df, mapping).columns if mapping else df.columns
    sources = {p: (mapping or {}).get(p, p) for p in props}
    pairs = [x for p, s in sources.items() for x in (F.lit(p), F.col(s).cast("string"))]
    filled = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return df.select(F.lit(label).alias("label"), F.col(key).cast("string").alias("key"), filled.alias("props"))


def _merge(existing: DataFrame, incoming: DataFrame, ids: list[str], order: str | None) -> DataFrame:
    """Set the incoming properties on the rows they name; the others pass through untouched.

    Properties are merged one by one, so a row that is named very often is shrunk inside each
    task before the shuffle. A NULL value removes its property.
    """
    named = incoming.select(*ids).distinct()
    place = F.col(order) if order else F.lit(0)

    def spread(df: DataFrame, at: Column) -> DataFrame:
        return df.select(*ids, at.cast("bigint").alias("at"), F.explode_outer("props").alias("prop", "value"))

    touched = spread(existing.join(named, ids, "left_semi"), F.lit(-1)).unionByName(spread(incoming, place))
    newest = touched.groupBy(*ids, "prop").agg(F.max_by(F.struct("value"), F.struct("at", "value")).alias("v"))
    pair = F.when(F.col("prop").isNotNull() & F.col("v.value").isNotNull(), F.struct("prop", "v.value"))
    merged = newest.groupBy(*ids).agg(F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("props"))
    return existing.join(named, ids, "left_anti").select(*ids, "props").unionByName(merged)


def upsert_nodes(nodes: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Merge nodes by label and key; entries without a label are skipped, later entries win."""
    good = incoming.filter((F.coalesce("label", F.lit("")) != "") & F.col("key").isNotNull())
    return _merge(nodes, good, NODE, order)


def upsert_edges(edges: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Merge edges by ends and type; entries without an end or a type are skipped."""
    whole = [F.coalesce(F.col(c), F.lit("")) != "" for c in EDGE]
    good = incoming
    for condition in whole:
        good = good.filter(condition)
    return _merge(edges, good, EDGE, order)


def graph_import(
    nodes: DataFrame,
    source: DataFrame,
    label: str,
    key: str,
    mapping: dict[str, str] | None = None,
) -> DataFrame:
    """Merge table rows into the nodes of one label."""
    if not label:
        raise ValueError("nodeLabel is required")
    return upsert_nodes(nodes, as_nodes(source, label, key, mapping))


def link_by_key(
    nodes: DataFrame,
    label: str,
    prop: str,
    to_label: str,
    type: str,
    props: dict | None = None,
    from_key: str | None = None,
    to_key: str | None = None,
) -> DataFrame:
    """Edges from the nodes whose property holds the key of a node of the other label.

    A key names one node, so every node gives at most one edge. ``from_key`` and ``to_key``
    restrict the ends to one node each.
    """
    for name in (label, to_label, type):
        check_ident(name, strict=True)
    a = nodes.filter(F.col("label") == label).select(F.col("key").alias("src"), F.col("props")[prop].alias("dst"))
    b = nodes.filter(F.col("label") == to_label).select(F.col("key").alias("dst"))
    if from_key is not None:
        a = a.filter(F.col("src") == from_key)
    if to_key is not None:
        a, b = a.filter(F.col("dst") == to_key), b.filter(F.col("dst") == to_key)
    pairs = [x for k, v in (props or {}).items() for x in (F.lit(check_ident(k, strict=True)), F.lit(str(v)))]
    packed = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return a.join(b, "dst", "left_semi").select(
        F.lit(label).alias("src_label"), "src", F.lit(to_label).alias("dst_label"), "dst", F.lit(type).alias("type"), packed.alias("props")
    )


def link_labels(nodes: DataFrame, links: list[tuple[str, str, str]]) -> DataFrame:
    """``src_label, dst_label, type, linked`` for links between whole labels.

    The relation holds between every pair, so it is kept as one row with the number of pairs;
    the pairs are not written out.
    """
    sizes = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    wanted = literal_rows(nodes.sparkSession, links, "src_label string, dst_label string, type string")
    a = sizes.select(F.col("label").alias("src_label"), F.col("n").alias("a"))
    b = sizes.select(F.col("label").alias("dst_label"), F.col("n").alias("b"))
    return wanted.join(a, "src_label").join(b, "dst_label").select(
        "src_label", "dst_label", "type", (F.col("a") * F.col("b")).alias("linked")
    )


def match_one_hop(nodes: DataFrame, edges: DataFrame, from_label: str, type: str, to_label: str) -> DataFrame:
    """``src, src_props, dst, dst_props`` for ``(a:from)-[:type]->(b:to)``."""
    a = nodes.filter(F.col("label") == from_label).select(F.col("key").alias("src"), F.col("props").alias("src_props"))
    b = nodes.filter(F.col("label") == to_label).select(F.col("key").alias("dst"), F.col("props").alias("dst_props"))
    return _of(edges, from_label, type, to_label).join(a, "src").join(b, "dst").select("src", "src_props", "dst", "dst_props")


def _of(edges: DataFrame, from_label: str, type: str, to_label: str) -> DataFrame:
    return edges.filter(
        (F.col("src_label") == from_label) & (F.col("type") == type) & (F.col("dst_label") == to_label)
    ).select("src", "dst")


def match_two_hops(edges: DataFrame, first: tuple[str, str, str], second: tuple[str, str, str]) -> DataFrame:
    """``src, paths``: how many paths ``(a)-[]->(b)-[]->(c)`` start at each node.

    The second hop is counted per middle node before the join, so a middle node with many edges
    on both sides is never multiplied out.
    """
    fan = _of(edges, *second).groupBy(F.col("src").alias("dst")).agg(F.count(F.lit(1)).alias("n"))
    return join_skewed(_of(edges, *first), fan, ["dst"]).groupBy("src").agg(F.sum("n").alias("paths"))
