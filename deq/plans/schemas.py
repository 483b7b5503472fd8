"""Schema-change, payload, catalog, lineage, graph and entity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from deq.functions.entities import BUILT_IN_TYPES, extract_entities, fallback_entities
from deq.functions.payload import validate_avro_fields, validate_json, validate_syntax
from deq.operators import catalog, graph
from deq.operators.schema_change import (
    apply_plan,
    contract,
    expand,
    layer_consistency,
    layer_diff,
    plan_safety,
    schema_diff,
    verify_expand,
)
from deq.plans.tables import DIRTY, PAYLOADS, declared_columns, declared_sql, dirty, payloads
from deq.session import materialize
from deq.sources.tables import scan


def _indexes(spark, folder, status):
    """One index per supplier and shipping flag pair seen in the line items."""
    return (
        scan(spark, "lineitem", folder)
        .filter(F.col("l_linestatus") == status)
        .groupBy("l_suppkey", "l_returnflag", "l_linenumber")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.format_string("s%d", "l_suppkey").alias("dataset"),
            F.when(F.col("l_linenumber") == 1, F.format_string("ix_%d_%s", "l_suppkey", "l_returnflag")).alias("name"),
            F.array(F.lower("l_returnflag"), F.format_string("c%d", "l_linenumber")).alias("columns"),
            (F.col("n") % 2 == 0).alias("unique"),
        )
    )


def _columns(spark, folder, status, shift):
    """Column metadata as a stored table, as a catalog would hold it."""
    return materialize(declared_columns(spark, folder, status, shift))


def schema_diff_rows(spark, folder):
    return schema_diff(
        _columns(spark, folder, "O", 2),
        _columns(spark, folder, "F", 1),
        materialize(_indexes(spark, folder, "O")),
        materialize(_indexes(spark, folder, "F")),
    )


PLAN = [
    {"change": "add_column", "name": "phone", "to_type": "varchar(20)", "breaking": False},
    {"change": "widen_type", "name": "o_custkey", "to_type": "double precision", "breaking": False},
    {"change": "drop_column", "name": "o_orderstatus", "breaking": True},
    {"change": "add_index", "name": "idx_orders_o_custkey", "breaking": False},
]

EXPAND = [
    {"type": "rename_column", "oldColumn": "user_id", "newColumn": "account", "newType": "bigint"},
    {"type": "change_type", "oldColumn": "value", "newColumn": "amount", "newType": "numeric(12,2)"},
    {"type": "add_column", "newColumn": "label", "newType": "text", "transform": "LOWER(NEW.event_type) || '-' || NEW.event_id::text"},
    {"type": "drop_column", "oldColumn": "ts"},
]

SCHEMA = '{"type": "object", "required": ["k"]}'
RECORD = '{"type": "record", "name": "r", "fields": [{"name": "x", "type": "int"}]}'


def _datasets(spark, folder):
    return scan(spark, "part", folder).select(
        F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("."), F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_brand").alias("platform"),
        F.col("p_type").alias("owner"),
    )


REGISTERED = ["region", "nation", "customer", "orders", "lineitem", "events"]


def catalog_register(spark, folder):
    records = [
        catalog.dataset_record(scan(spark, t, folder), t, "data-team", ["raw"], {"zone": "bronze"}, count_rows=True)
        for t in REGISTERED
    ]
    out = records[0]
    for r in records[1:]:
        out = out.unionByName(r)
    return out.select("dataset", "position", "field", "type", "nullable", "owner", F.col("props")["rows"].alias("rows"))


def _lineage(spark, folder):
    nation, customer = scan(spark, "nation", folder), scan(spark, "customer", folder)
    load_nation = F.format_string("load:nation:%d", "n_regionkey").alias("pipeline")
    load_customer = F.format_string("load:customer:%d", "c_nationkey").alias("pipeline")
    reads = nation.select(load_nation, F.format_string("region:%d", "n_regionkey").alias("dataset")).unionByName(
        customer.select(load_customer, F.format_string("nation:%d", "c_nationkey").alias("dataset"))
    )
    writes = nation.select(load_nation, F.format_string("nation:%d", "n_nationkey").alias("dataset")).unionByName(
        customer.select(load_customer, F.format_string("customer:%d", "c_custkey").alias("dataset"))
    )
    return catalog.record_lineage(reads, writes)


def _stored_lineage(spark, folder):
    return materialize(_lineage(spark, folder))


def lineage_query(spark, folder):
    edges = _stored_lineage(spark, folder)
    down = catalog.query_lineage(edges, "region:1", "downstream", 2)
    both = catalog.query_lineage(edges, "nation:5", "both", 1)
    return down.withColumn("asked", F.lit("region:1")).unionByName(both.withColumn("asked", F.lit("nation:5")))


def lineage_edges(spark, folder):
    edges = _stored_lineage(spark, folder)
    return catalog.lineage_edges(edges, catalog.query_lineage(edges, "region:2", "downstream", 1), "region:2")


def _nodes(spark, folder):
    customer = graph.as_nodes(
        scan(spark, "customer", folder), "Customer", "c_custkey", {"name": "c_name", "nation": "c_nationkey", "phone": "c_phone"}
    )
    nation = graph.as_nodes(scan(spark, "nation", folder), "Nation", "n_nationkey", {"name": "n_name", "region": "n_regionkey"})
    region = graph.as_nodes(scan(spark, "region", folder), "Region", "r_regionkey", {"name": "r_name"})
    return customer.unionByName(nation).unionByName(region)


def _edges(spark, folder):
    nodes = _nodes(spark, folder)
    lives = graph.link_by_key(nodes, "Customer", "nation", "Nation", "LIVES_IN", {"since": 1990})
    lies = graph.link_by_key(nodes, "Nation", "region", "Region", "LIES_IN")
    return lives.unionByName(lies)


def graph_upsert_nodes(spark, folder):
    orders = scan(spark, "orders", folder)
    incoming = orders.select(
        F.when(F.col("o_orderkey") % 97 != 0, "Customer").alias("label"),
        F.col("o_custkey").cast("string").alias("key"),
        F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("name"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))).alias("props"),
        F.col("o_orderkey").alias("at"),
    )
    merged = graph.upsert_nodes(_nodes(spark, folder), incoming, "at")
    p = F.col("props")
    return merged.select("label", "key", p["name"].alias("name"), p["status"].alias("status"), p["nation"].alias("nation"))


def graph_import_rows(spark, folder):
    mapping = {"title": "s_name", "nation": "s_nationkey", "fax": "s_fax"}
    rows = graph.graph_import(_nodes(spark, folder), scan(spark, "supplier", folder), "Supplier", "s_suppkey", mapping)
    p = F.col("props")
    return rows.select("label", "key", p["title"].alias("title"), p["nation"].alias("nation"), F.size("props").alias("props"))


def graph_write_rels(spark, folder):
    orders = scan(spark, "orders", folder).join(scan(spark, "customer", folder), F.col("o_custkey") == F.col("c_custkey"))
    incoming = orders.select(
        F.lit("Customer").alias("src_label"),
        F.col("o_custkey").cast("string").alias("src"),
        F.when(F.col("o_orderkey") % 89 != 0, "Nation").alias("dst_label"),
        F.col("c_nationkey").cast("string").alias("dst"),
        F.lit("LIVES_IN").alias("type"),
        F.create_map(F.lit("last_order"), F.col("o_orderkey").cast("string")).alias("props"),
        F.col("o_orderkey").alias("at"),
    )
    p = F.col("props")
    return graph.upsert_edges(_edges(spark, folder), incoming, "at").select(
        "src_label", "src", "dst_label", "dst", "type", p["since"].alias("since"), p["last_order"].alias("last_order")
    )


def graph_link_key(spark, folder):
    p = F.col("props")
    return _edges(spark, folder).select("src_label", "src", "dst_label", "dst", "type", p["since"].alias("since"))


def graph_match_1hop(spark, folder):
    rows = graph.match_one_hop(_nodes(spark, folder), _edges(spark, folder), "Customer", "LIVES_IN", "Nation")
    return rows.select("src", F.col("src_props")["name"].alias("src_name"), "dst", F.col("dst_props")["name"].alias("dst_name"))


def graph_match_2hop(spark, folder):
    edges = _edges(spark, folder)
    orders = scan(spark, "orders", folder).select(
        F.lit("Order").alias("src_label"),
        F.col("o_orderkey").cast("string").alias("src"),
        F.lit("Customer").alias("dst_label"),
        F.col("o_custkey").cast("string").alias("dst"),
        F.lit("PLACED_BY").alias("type"),
        F.create_map().cast("map<string,string>").alias("props"),
    )
    back = orders.select(
        F.col("dst_label").alias("src_label"), F.col("dst").alias("src"), F.col("src_label").alias("dst_label"), F.col("src").alias("dst"), F.lit("PLACED").alias("type"), "props"
    )
    every = edges.unionByName(orders).unionByName(back)
    along = graph.match_two_hops(every, ("Order", "PLACED_BY", "Customer"), ("Customer", "LIVES_IN", "Nation"))
    beside = graph.match_two_hops(every, ("Order", "PLACED_BY", "Customer"), ("Customer", "PLACED", "Order"))
    return along.withColumn("pattern", F.lit("nation")).unionByName(beside.withColumn("pattern", F.lit("siblings")))


def _documents(spark, folder):
    return scan(spark, "documents", folder).select("doc_id", "text")


CUSTOM_PATTERNS = [{"type": "number", "pattern": r"#\d+"}, {"type": "bad", "pattern": "(["}, {"type": "year", "pattern": r"\b(19|20)\d{2}\b"}]


def _count_of(kind):
    return lambda s, f: extract_entities(_documents(s, f), "text", [kind]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def entities_by_type(spark, folder):
    """Each built-in type as if it were alone, in one pass over the texts."""
    found = extract_entities(_documents(spark, folder), "text", overlapping=True)
    return found.groupBy("type", "value").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "schema_diff": schema_diff_rows,
    "schema_plan_safety": lambda s, f: plan_safety(schema_diff_rows(s, f)),
    "schema_layer_diff": lambda s, f: layer_diff(_columns(s, f, "O", 2), _columns(s, f, "F", 1)),
    "schema_layer_consistent": lambda s, f: layer_consistency(_columns(s, f, "F", 1), _columns(s, f, "O", 1)),
    "schema_apply": lambda s, f: apply_plan(scan(s, "orders", f), PLAN, policy="warn", mode="blue_green"),
    "migrate_expand": lambda s, f: expand(dirty(s, f), EXPAND).withColumn("amount", F.col("amount").cast("double")),
    "migrate_verify": lambda s, f: verify_expand(expand(dirty(s, f), EXPAND), EXPAND),
    "migrate_contract": lambda s, f: contract(expand(dirty(s, f), EXPAND), EXPAND).withColumn("amount", F.col("amount").cast("double")),
    "json_schema_validate": lambda s, f: validate_json(payloads(s, f), "payload", SCHEMA),
    "avro_fields_validate": lambda s, f: validate_avro_fields(payloads(s, f), "payload", RECORD),
    "json_syntax_validate": lambda s, f: validate_syntax(payloads(s, f), "payload"),
    "catalog_search": lambda s, f: catalog.dataset_search(_datasets(s, f), "RING"),
    "catalog_register": catalog_register,
    "lineage_urn": lambda s, f: scan(s, "part", f).select(
        "p_partkey", catalog.dataset_urn(F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")), F.col("p_name")).alias("urn")
    ),
    "lineage_record": _lineage,
    "lineage_query": lineage_query,
    "lineage_edges": lineage_edges,
    "graph_upsert_nodes": graph_upsert_nodes,
    "graph_import": graph_import_rows,
    "graph_write_rels": graph_write_rels,
    "graph_link_key": graph_link_key,
    "graph_link_all": lambda s, f: graph.link_labels(
        _nodes(s, f), [("Customer", "Nation", "KNOWS"), ("Nation", "Region", "NEAR"), ("Customer", "Nowhere", "KNOWS")]
    ),
    "graph_match_1hop": graph_match_1hop,
    "graph_match_2hop": graph_match_2hop,
    "entities_extract": lambda s, f: extract_entities(_documents(s, f), "text"),
    "entities_custom": lambda s, f: extract_entities(_documents(s, f), "text", ["email"], CUSTOM_PATTERNS),
    "entities_fallback": lambda s, f: fallback_entities(_documents(s, f), "text"),
    "entities_email_count": _count_of("email"),
    "entities_org_count": _count_of("org"),
    "entities_by_type": entities_by_type,
}

_RANK = "CASE lower($x) WHEN 'smallint' THEN 1 WHEN 'integer' THEN 2 WHEN 'bigint' THEN 3 WHEN 'real' THEN 4 WHEN 'double precision' THEN 5 WHEN 'numeric' THEN 6 END"
_WIDTH = "CASE $x WHEN 'varchar(10)' THEN 10 WHEN 'varchar(50)' THEN 50 END"


def _less(expr: str) -> str:
    return f"({expr.replace('$x', 'd.type')}) < ({expr.replace('$x', 'l.type')})"


def _sql_indexes(status: str) -> str:
    return f"""(SELECT concat('s', l_suppkey) AS dataset, CASE WHEN l_linenumber = 1 THEN concat('ix_', l_suppkey, '_', l_returnflag) END AS name,
      lower(l_returnflag) AS a, concat('c', l_linenumber) AS b, count(*) % 2 = 0 AS uniq
      FROM lineitem WHERE l_linestatus = '{status}' GROUP BY l_suppkey, l_returnflag, l_linenumber)"""


def _sql_diff() -> str:
    label = "coalesce(name, concat('idx_', dataset, '_', a, '_', b))"
    none = "CAST(NULL AS VARCHAR)"
    return f"""WITH d AS (SELECT * FROM {declared_sql('O', 2)}), l AS (SELECT * FROM {declared_sql('F', 1)}),
      di AS (SELECT * FROM {_sql_indexes('O')}), li AS (SELECT * FROM {_sql_indexes('F')}),
      both_sides AS (SELECT dataset FROM d INTERSECT SELECT dataset FROM l)
      SELECT DISTINCT dataset, dataset AS name, 'add_table' AS change, {none} AS from_type, {none} AS to_type, false AS breaking
        FROM d WHERE dataset NOT IN (SELECT dataset FROM l)
      UNION ALL SELECT d.dataset, d."column", 'add_column', NULL, d.type, false FROM d
        WHERE dataset IN (FROM both_sides) AND NOT EXISTS (FROM l WHERE l.dataset = d.dataset AND l."column" = d."column")
      UNION ALL SELECT l.dataset, l."column", 'drop_column', l.type, NULL, true FROM l
        WHERE dataset IN (FROM both_sides) AND NOT EXISTS (FROM d WHERE l.dataset = d.dataset AND l."column" = d."column")
      UNION ALL SELECT dataset, name, CASE WHEN narrow THEN 'narrow_type' ELSE 'widen_type' END, a, b, narrow FROM
        (SELECT d.dataset, d."column" AS name, l.type AS a, d.type AS b, coalesce({_less(_WIDTH)}, {_less(_RANK)}, true) AS narrow
         FROM d JOIN l ON l.dataset = d.dataset AND l."column" = d."column" WHERE l.type <> d.type)
      UNION ALL SELECT dataset, {label}, 'add_index', NULL, NULL, false FROM di
        WHERE NOT EXISTS (FROM li WHERE li.dataset = di.dataset AND li.a = di.a AND li.b = di.b AND li.uniq = di.uniq)
      UNION ALL SELECT dataset, {label}, 'drop_index', NULL, NULL, true FROM li
        WHERE dataset IN (SELECT dataset FROM d)
        AND NOT EXISTS (FROM di WHERE li.dataset = di.dataset AND li.a = di.a AND li.b = di.b AND li.uniq = di.uniq)"""


def _sql_layers(source: tuple, registry: tuple) -> str:
    return f"""(WITH a AS (SELECT dataset, "column" FROM {declared_sql(*source)}), b AS (SELECT dataset, "column" FROM {declared_sql(*registry)})
      SELECT dataset, "column", 'schema_registry' AS missing_in FROM a WHERE dataset IN (SELECT dataset FROM b)
        AND NOT EXISTS (FROM b WHERE a.dataset = b.dataset AND a."column" = b."column")
      UNION ALL SELECT dataset, "column", 'source_db' FROM b WHERE dataset IN (SELECT dataset FROM a)
        AND NOT EXISTS (FROM a WHERE a.dataset = b.dataset AND a."column" = b."column"))"""


_EXPANDED = """event_id, ts, user_id, event_type, value, user_id AS account,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount, concat(lower(event_type), '-', CAST(event_id AS VARCHAR)) AS label"""

_SQL_LINEAGE = """SELECT DISTINCT concat('region:', n_regionkey) AS src, concat('load:nation:', n_regionkey) AS dst, concat('load:nation:', n_regionkey) AS pipeline, 'reads' AS kind FROM nation
  UNION SELECT concat('load:nation:', n_regionkey), concat('nation:', n_nationkey), concat('load:nation:', n_regionkey), 'writes' FROM nation
  UNION SELECT concat('nation:', c_nationkey), concat('load:customer:', c_nationkey), concat('load:customer:', c_nationkey), 'reads' FROM customer
  UNION SELECT concat('load:customer:', c_nationkey), concat('customer:', c_custkey), concat('load:customer:', c_nationkey), 'writes' FROM customer"""

_LIVES = "SELECT 'Customer' AS src_label, CAST(c_custkey AS VARCHAR) AS src, 'Nation' AS dst_label, CAST(c_nationkey AS VARCHAR) AS dst, 'LIVES_IN' AS type, '1990' AS since FROM customer"

# The built-in entity types as one pattern each.
_PATTERNS = {
    "email": r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
    "date": r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4}|\d{1,2}\s+(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\s+\d{4})",
    "org": r"(?:[A-Z][a-zA-Z&\s]*\s+(?:Inc|LLC|Corp|Ltd|Co|Group|Holdings|Technologies|Solutions|Services|International|Enterprises)\.?|[A-Z]{2,}(?:\s+[A-Z]{2,})*)",
    "location": "(?:New York|Los Angeles|San Francisco|Chicago|London|Paris|Berlin|Tokyo|Beijing|Sydney|Toronto|Mumbai|Dubai|Singapore|Boston|Seattle|Austin|Denver|Atlanta|Miami|Phoenix|Dallas|Houston|Washington|Philadelphia|Portland|Minneapolis)",
    "person": r"(?:[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})",
}


def _matches(kind: str) -> str:
    return f"SELECT doc_id, '{kind}' AS type, unnest(regexp_extract_all(text, '{_PATTERNS[kind]}')) AS value FROM documents"


def _sql_count(kind: str) -> str:
    return f"SELECT doc_id, count(*) AS n FROM ({_matches(kind)}) GROUP BY doc_id"


def _sql_spans(patterns: dict[str, str]) -> str:
    """``doc_id, type, value, start, end`` in bytes; a span that overlaps one of an earlier type is left out.

    The place of a match is the length of all that precedes it: the pieces between matches and the
    matches before it.
    """
    found = " UNION ALL ".join(
        f"""SELECT doc_id, '{k}' AS type, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM documents"""
        for k, p in patterns.items()
    )
    steps, kept = [], ""
    for n, kind in enumerate(patterns):
        free = " AND ".join(
            f"NOT EXISTS (FROM a{i} WHERE a{i}.doc_id = e.doc_id AND a{i}.start < e.stop AND e.start < a{i}.stop)" for i in range(n)
        )
        steps.append(f"a{n} AS (SELECT * FROM e WHERE type = '{kind}' {'AND ' + free if free else ''})")
        kept += f"{' UNION ALL ' if kept else ''}FROM a{n}"
    return f"""(WITH s AS ({found}), u AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM s),
      b AS (SELECT doc_id, type, m[i] AS value,
        list_sum([strlen(x) for x in g[1:i]]) + coalesce(list_sum([strlen(x) for x in m[1:i - 1]]), 0) AS start FROM u),
      e AS (SELECT *, start + strlen(value) AS stop FROM b), {", ".join(steps)}
      SELECT doc_id, type, value, CAST(start AS INTEGER) AS start, CAST(stop AS INTEGER) AS "end" FROM ({kept}))"""


def _sql_payload(field: str | None, what: str) -> str:
    lost = f"WHEN json_type(payload) <> 'OBJECT' THEN 'expected JSON object' WHEN NOT json_exists(payload, '$.{field}') THEN 'missing {what}: {field}'"
    return f"""SELECT *, error IS NULL AS valid FROM (SELECT event_id, payload,
      CASE WHEN NOT json_valid(payload) THEN 'invalid JSON payload' {lost if field else ''} END AS error FROM {PAYLOADS})"""


_SQL_TYPE = "CASE column_type WHEN 'INTEGER' THEN 'integer' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double precision' WHEN 'TIMESTAMP' THEN 'timestamp without time zone' WHEN 'VARCHAR' THEN 'character varying' END"


def _sql_register(table: str) -> str:
    return f"""SELECT '{table}' AS dataset, CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS field, {_SQL_TYPE} AS type,
      true AS nullable, 'data-team' AS owner, (SELECT CAST(count(*) AS VARCHAR) FROM {table}) AS rows FROM (DESCRIBE {table})"""


ORACLES = {
    "schema_diff": _sql_diff(),
    "schema_plan_safety": f"""SELECT dataset, count(*) AS changes, count(*) FILTER (breaking) AS breaking_changes,
        count(*) FILTER (breaking) = 0 AS safe FROM ({_sql_diff()}) GROUP BY dataset""",
    "schema_layer_diff": _sql_layers(("O", 2), ("F", 1)),
    "schema_layer_consistent": f"""SELECT dataset, coalesce(n, 0) AS diffs, coalesce(n, 0) = 0 AND src AS consistent FROM
        (SELECT coalesce(a.dataset, b.dataset) AS dataset, a.dataset IS NOT NULL AS src
         FROM (SELECT DISTINCT dataset FROM {declared_sql('F', 1)}) a FULL JOIN (SELECT DISTINCT dataset FROM {declared_sql('O', 1)}) b USING (dataset))
        LEFT JOIN (SELECT dataset, count(*) AS n FROM {_sql_layers(('F', 1), ('O', 1))} GROUP BY dataset) USING (dataset)""",
    "schema_apply": """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_totalprice, o_orderdate, o_orderpriority,
        CAST(NULL AS VARCHAR) AS phone FROM orders""",
    "migrate_expand": f"SELECT {_EXPANDED} FROM {DIRTY}",
    "migrate_verify": f"SELECT count(*) FILTER (value IS NULL) AS pending, count(*) FILTER (value IS NULL) = 0 AS safe FROM {DIRTY}",
    "migrate_contract": f"SELECT event_id, event_type, account, amount, label FROM (SELECT {_EXPANDED} FROM {DIRTY})",
    "json_schema_validate": _sql_payload("k", "required fields"),
    "avro_fields_validate": _sql_payload("x", "Avro fields"),
    "json_syntax_validate": _sql_payload(None, ""),
    "catalog_search": """WITH d AS (SELECT concat(replace(p_name, ' ', '_'), '.', p_partkey) AS name, p_brand AS platform, p_type AS owner FROM part
          WHERE contains(lower(p_name), 'ring'))
        SELECT *, (SELECT count(*) FROM d) AS total FROM d ORDER BY name, platform, owner LIMIT 10""",
    "catalog_register": " UNION ALL ".join(_sql_register(t) for t in REGISTERED),
    "lineage_urn": """SELECT p_partkey, concat('urn:li:dataset:(urn:li:dataPlatform:', CASE WHEN p_partkey % 5 <> 0 THEN p_brand ELSE 'unknown' END,
        ',', p_name, ',PROD)') AS urn FROM part""",
    "lineage_record": _SQL_LINEAGE,
    "lineage_query": """SELECT concat('nation:', n_nationkey) AS dataset, 'downstream' AS direction, 1 AS depth, 'region:1' AS asked FROM nation WHERE n_regionkey = 1
        UNION ALL SELECT concat('customer:', c_custkey), 'downstream', 2, 'region:1' FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1
        UNION ALL SELECT concat('customer:', c_custkey), 'downstream', 1, 'nation:5' FROM customer WHERE c_nationkey = 5
        UNION ALL SELECT concat('region:', n_regionkey), 'upstream', 1, 'nation:5' FROM nation WHERE n_nationkey = 5""",
    "lineage_edges": f"""WITH e AS ({_SQL_LINEAGE}), n AS (SELECT 'region:2' AS node UNION ALL SELECT concat('nation:', n_nationkey) FROM nation WHERE n_regionkey = 2)
        SELECT * FROM e WHERE src IN (FROM n) OR dst IN (FROM n)""",
    "graph_upsert_nodes": """WITH o AS (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS status, max(o_orderkey) AS last FROM orders
          WHERE o_orderkey % 97 <> 0 GROUP BY o_custkey)
        SELECT 'Customer' AS label, CAST(coalesce(c_custkey, o_custkey) AS VARCHAR) AS key,
          CASE WHEN o.last IS NOT NULL THEN concat('order ', o.last) ELSE c_name END AS name, status, CAST(c_nationkey AS VARCHAR) AS nation
          FROM customer FULL JOIN o ON c_custkey = o_custkey
        UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR), n_name, NULL, NULL FROM nation
        UNION ALL SELECT 'Region', CAST(r_regionkey AS VARCHAR), r_name, NULL, NULL FROM region""",
    "graph_import": """SELECT 'Supplier' AS label, CAST(s_suppkey AS VARCHAR) AS key, s_name AS title, CAST(s_nationkey AS VARCHAR) AS nation, 2 AS props FROM supplier
        UNION ALL SELECT 'Customer', CAST(c_custkey AS VARCHAR), NULL, CAST(c_nationkey AS VARCHAR), 2 FROM customer
        UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR), NULL, NULL, 2 FROM nation
        UNION ALL SELECT 'Region', CAST(r_regionkey AS VARCHAR), NULL, NULL, 1 FROM region""",
    "graph_write_rels": f"""SELECT e.*, CAST(last AS VARCHAR) AS last_order FROM ({_LIVES}) e LEFT JOIN
          (SELECT CAST(o_custkey AS VARCHAR) AS src, max(o_orderkey) AS last FROM orders WHERE o_orderkey % 89 <> 0 GROUP BY o_custkey) o ON e.src = o.src
        UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR), 'Region', CAST(n_regionkey AS VARCHAR), 'LIES_IN', NULL, NULL FROM nation""",
    "graph_link_key": f"""{_LIVES} UNION ALL
        SELECT 'Nation', CAST(n_nationkey AS VARCHAR), 'Region', CAST(n_regionkey AS VARCHAR), 'LIES_IN', NULL FROM nation""",
    "graph_link_all": """SELECT 'Customer' AS src_label, 'Nation' AS dst_label, 'KNOWS' AS type,
          (SELECT count(*) FROM customer) * (SELECT count(*) FROM nation) AS linked
        UNION ALL SELECT 'Nation', 'Region', 'NEAR', (SELECT count(*) FROM nation) * (SELECT count(*) FROM region)""",
    "graph_match_1hop": """SELECT CAST(c_custkey AS VARCHAR) AS src, c_name AS src_name, CAST(n_nationkey AS VARCHAR) AS dst, n_name AS dst_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "graph_match_2hop": """SELECT CAST(o_orderkey AS VARCHAR) AS src, CAST(1 AS BIGINT) AS paths, 'nation' AS pattern FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), count(*) OVER (PARTITION BY o_custkey), 'siblings' FROM orders""",
    "entities_extract": f"SELECT * FROM {_sql_spans(_PATTERNS)}",
    "entities_custom": "SELECT * FROM "
    + _sql_spans({"email": _PATTERNS["email"], "number": r"#\d+", "year": r"\b(?:19|20)\d{2}\b"}),
    "entities_fallback": "SELECT doc_id, type, value, '' AS context, CAST(0.5 AS DOUBLE) AS confidence FROM "
    + _sql_spans({k: _PATTERNS[k] for k in ("org", "location", "person")}),
    "entities_email_count": _sql_count("email"),
    "entities_org_count": _sql_count("org"),
    "entities_by_type": "SELECT type, value, count(*) AS n FROM ("
    + " UNION ALL ".join(_matches(k) for k in BUILT_IN_TYPES)
    + ") GROUP BY ALL",
}
