import pytest
from pyspark.sql import functions as F

from deq.functions.names import declared_type
from deq.operators import catalog, graph
from deq.operators.schema_change import (
    BreakingChange,
    apply_plan,
    check_transform,
    contract,
    declared_schema,
    expand,
    layer_consistency,
    layer_diff,
    plan_of,
    plan_safety,
    schema_diff,
    verify_expand,
)
from deq.sources.runlogs import event_log_totals, expectation_totals, scan_log_totals


def table(name, *columns, indexes=()):
    return {"table": name, "columns": [{"name": n, "type": t} for n, t in columns], "indexes": list(indexes)}


def diff(spark, desired, live):
    (a, ai), (b, bi) = declared_schema(spark, desired), declared_schema(spark, live)
    found = schema_diff(a, b, ai, bi)
    return sorted((r["change"], r["dataset"], r["name"], r["breaking"]) for r in found.collect()), found


BASE = table("users", ("id", "bigint"), ("name", "varchar(100)"))


@pytest.mark.parametrize(
    ("desired", "live", "expected"),
    [
        ([BASE], [], [("add_table", "users", "users", False)]),
        ([BASE], [BASE], []),
        ([BASE], [table("users", ("id", "BIGINT"), ("name", "varchar(100)")), table("other", ("x", "int"))], []),
        ([table("users", ("id", "bigint"), ("name", "varchar(100)"), ("email", "text"))], [BASE], [("add_column", "users", "email", False)]),
        ([table("users", ("id", "bigint"))], [BASE], [("drop_column", "users", "name", True)]),
        ([table("users", ("id", "bigint"), ("name", "varchar(255)"))], [BASE], [("widen_type", "users", "name", False)]),
        ([table("users", ("id", "int"), ("name", "varchar(50)"))], [BASE], [("narrow_type", "users", "id", True), ("narrow_type", "users", "name", True)]),
        (
            [{**BASE, "indexes": [{"columns": ["id", "name"], "unique": True}]}],
            [{**BASE, "indexes": [{"columns": ["id", "name"]}, {"name": "by_name", "columns": ["name"]}]}],
            [
                ("add_index", "users", "idx_users_id_name", False),
                ("drop_index", "users", "by_name", True),
                ("drop_index", "users", "idx_users_id_name", True),
            ],
        ),
        (
            [{**BASE, "indexes": [{"columns": ["id"]}]}],
            [],
            [("add_index", "users", "idx_users_id", False), ("add_table", "users", "users", False)],
        ),
    ],
)
def test_schema_diff(spark, desired, live, expected):
    changes, found = diff(spark, desired, live)
    assert changes == expected
    safe = {r["dataset"]: r["safe"] for r in plan_safety(found).collect()}
    assert safe == ({"users": not any(c[3] for c in expected)} if expected else {})


@pytest.mark.parametrize(
    "bad",
    [
        {"table": "a b", "columns": []},
        {"table": "t", "columns": [{"name": "x;", "type": "int"}]},
        {"table": "t", "columns": [{"name": "x", "type": "int)"}]},
        {"table": "t", "columns": [{"name": "x", "type": "int", "default": "drop table x"}]},
    ],
)
def test_bad_definitions(spark, bad):
    with pytest.raises(ValueError):
        declared_schema(spark, [bad])


def test_layers(spark):
    (source, _), (registry, _) = (
        declared_schema(spark, [table("t", ("a", "int"), ("b", "int")), table("only_source", ("x", "int")), table("same", ("x", "int"))]),
        declared_schema(spark, [table("t", ("b", "int"), ("c", "int")), table("only_registry", ("x", "int")), table("same", ("x", "int"))]),
    )
    assert sorted(tuple(r) for r in layer_diff(source, registry).collect()) == [("t", "a", "schema_registry"), ("t", "c", "source_db")]
    assert {r["dataset"]: r["consistent"] for r in layer_consistency(source, registry).collect()} == {
        "t": False,
        "only_source": True,
        "only_registry": False,
        "same": True,
    }


PLAN = [
    {"change": "add_column", "name": "c", "to_type": "text", "breaking": False},
    {"change": "drop_column", "name": "a", "breaking": True},
]


def test_plans(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(BreakingChange):
        apply_plan(df, PLAN)
    for mode in ("online", "blue_green"):
        assert [r.asDict() for r in apply_plan(df, PLAN, "warn", mode).collect()] == [{"b": "x", "c": None}]
    assert apply_plan(df, PLAN[:1]).columns == ["a", "b", "c"]
    with pytest.raises(ValueError):
        apply_plan(df, PLAN, "warn", "purple")


def test_a_diff_leads_to_its_plan(spark):
    wanted = table("users", ("id", "bigint"), ("email", "text"))
    _, found = diff(spark, [wanted], [table("users", ("id", "int"), ("name", "text"))])
    plan = plan_of(found, "users")
    assert [(c["change"], c["name"]) for c in plan] == [("add_column", "email"), ("widen_type", "id"), ("drop_column", "name")]
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    assert apply_plan(df, plan, "warn").schema.simpleString() == "struct<id:bigint,email:string>"
    assert plan_of(found, "nobody") == []


def test_expand_verify_contract(spark):
    df = spark.createDataFrame([(1, "Ann", "12", "x"), (2, "Bob", None, "y")], "id int, name string, age string, old string")
    changes = [
        {"type": "rename_column", "oldColumn": "name", "newColumn": "full_name", "newType": "varchar(50)"},
        {"type": "change_type", "oldColumn": "age", "newColumn": "age_n", "newType": "bigint"},
        {"type": "add_column", "newColumn": "tag", "newType": "text", "transform": "LOWER(NEW.name) || NEW.id::text || NEW.name::varchar(1)"},
        {"type": "add_column", "newColumn": "twice", "newType": "int", "transform": "(NEW.id + 1)::int * 2"},
        {"type": "drop_column", "oldColumn": "old"},
    ]
    wide = expand(df, changes)
    first = wide.orderBy("id").first()
    assert (first["full_name"], first["age_n"], first["tag"], first["twice"]) == ("Ann", 12, "ann1A", 4)
    assert tuple(verify_expand(wide, changes).first()) == (1, False)
    assert contract(wide, changes).columns == ["id", "full_name", "age_n", "tag", "twice"]
    empty = expand(df, [{"type": "add_column", "newColumn": "n", "newType": "int"}])
    assert verify_expand(empty, [{"type": "add_column", "newColumn": "n"}]).first()["pending"] == 2
    with pytest.raises(ValueError):
        expand(df, [{"type": "split_column"}])


@pytest.mark.parametrize("text", ["a; b", "DROP TABLE x", "(SELECT 1) -- delete", "a` b", "x = 'y'"])
def test_unsafe_transforms(text):
    with pytest.raises(ValueError):
        check_transform(text)


def nodes(spark, *rows):
    return spark.createDataFrame(list(rows), "label string, key string, props map<string,string>")


def test_nodes_merge_property_by_property(spark):
    have = nodes(spark, ("P", "1", {"a": "x", "b": "y"}), ("P", "2", {"a": "z"}), ("Q", "1", {}))
    new = spark.createDataFrame(
        [
            ("P", "1", {"b": "new", "c": "n"}, 1),
            ("P", "1", {"b": "newer"}, 2),
            ("P", "3", {}, 1),
            ("", "9", {"a": "skipped"}, 1),
            (None, "9", {"a": "skipped"}, 1),
            ("P", "2", {"a": None}, 1),
        ],
        "label string, key string, props map<string,string>, at int",
    )
    found = {(r["label"], r["key"]): r["props"] for r in graph.upsert_nodes(have, new, "at").collect()}
    assert found == {("P", "1"): {"a": "x", "b": "newer", "c": "n"}, ("P", "2"): {}, ("P", "3"): {}, ("Q", "1"): {}}


def test_a_node_named_by_a_third_of_all_rows(spark):
    new = spark.range(3000).select(
        F.lit("P").alias("label"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.create_map(F.lit("last"), F.col("id").cast("string")).alias("props"),
        "id",
    )
    merged = graph.upsert_nodes(nodes(spark, ("P", "hot", {"old": "1"})), new, "id")
    assert merged.filter("key = 'hot'").first()["props"] == {"old": "1", "last": "2997"}
    assert merged.count() == 2001


def test_import_maps_properties(spark):
    source = spark.createDataFrame([(1, "Ann"), (2, None)], "id int, name string")
    found = graph.graph_import(nodes(spark), source, "P", "id", {"title": "name", "fax": "no_such"})
    assert {r["key"]: r["props"] for r in found.collect()} == {"1": {"title": "Ann"}, "2": {}}
    everything = graph.graph_import(nodes(spark), source, "P", "id")
    assert {r["key"]: r["props"] for r in everything.collect()} == {"1": {"id": "1", "name": "Ann"}, "2": {"id": "2"}}
    assert graph.graph_import(nodes(spark), source.limit(0), "P", "id").count() == 0
    with pytest.raises(ValueError):
        graph.graph_import(nodes(spark), source, "", "id")


def test_links(spark):
    have = nodes(spark, ("A", "1", {"b": "x"}), ("A", "2", {"b": "x"}), ("A", "3", {"b": "none"}), ("A", "4", {}), ("B", "x", {}))
    edges = graph.link_by_key(have, "A", "b", "B", "OF", {"w": 1})
    assert sorted((r["src"], r["dst"], r["props"]["w"]) for r in edges.collect()) == [("1", "x", "1"), ("2", "x", "1")]
    assert graph.link_by_key(have, "A", "b", "B", "OF", from_key="2").count() == 1
    assert graph.link_by_key(have, "A", "b", "B", "OF", to_key="y").count() == 0
    assert [tuple(r) for r in graph.link_labels(have, [("A", "B", "ALL"), ("A", "Z", "ALL")]).collect()] == [("A", "B", "ALL", 4)]
    with pytest.raises(ValueError):
        graph.link_by_key(have, "A b", "b", "B", "OF")
    none = spark.createDataFrame([("A", "1", "B", None, "OF", {}), ("A", "1", "B", "x", "", {})], edges.schema)
    assert graph.upsert_edges(edges, none).count() == 2


def test_two_hops_are_counted_like_the_join(spark):
    first = [(f"a{i}", f"b{0 if i % 3 else i}") for i in range(60)]
    second = [(f"b{0 if i % 2 else i}", f"c{i}") for i in range(40)]
    rows = [("A", s, "B", d, "F", {}) for s, d in first] + [("B", s, "C", d, "G", {}) for s, d in second]
    edges = spark.createDataFrame(rows, "src_label string, src string, dst_label string, dst string, type string, props map<string,string>")
    want = {}
    for s, m in first:
        n = sum(1 for x, _ in second if x == m)
        if n:
            want[s] = want.get(s, 0) + n
    assert {r["src"]: r["paths"] for r in graph.match_two_hops(edges, ("A", "F", "B"), ("B", "G", "C")).collect()} == want


def lineage(spark):
    def pairs(rows):
        return spark.createDataFrame(rows, "pipeline string, dataset string")

    up = pairs([("p1", "raw"), ("p1", "raw"), ("p1", "dim"), ("p2", "clean"), ("p3", "report"), ("p4", "")])
    down = pairs([("p1", "clean"), ("p1", "rejects"), ("p2", "report"), ("p3", "clean"), ("p4", "")])
    return catalog.record_lineage(up, down)


def test_lineage_is_kept_without_pairs(spark):
    assert lineage(spark).count() == 8


@pytest.mark.parametrize(
    ("start", "direction", "depth", "expected"),
    [
        ("raw", "downstream", 1, {("clean", "downstream", 1), ("rejects", "downstream", 1)}),
        ("raw", "downstream", 9, {("clean", "downstream", 1), ("rejects", "downstream", 1), ("report", "downstream", 2)}),
        ("report", "upstream", 2, {("clean", "upstream", 1), ("raw", "upstream", 2), ("dim", "upstream", 2)}),
        ("clean", "", 0, {("raw", "upstream", 1), ("dim", "upstream", 1), ("report", "upstream", 1), ("report", "downstream", 1)}),
        ("nobody", "both", 3, set()),
    ],
)
def test_lineage_walks(spark, start, direction, depth, expected):
    found = catalog.query_lineage(lineage(spark), start, direction, depth)
    assert {tuple(r) for r in found.collect()} == expected


def test_lineage_direction_and_edges(spark):
    edges = lineage(spark)
    with pytest.raises(ValueError):
        catalog.query_lineage(edges, "raw", "sideways")
    near = catalog.query_lineage(edges, "raw", "downstream", 1)
    assert {(r["src"], r["dst"]) for r in catalog.lineage_edges(edges, near, "raw").collect()} == {
        ("raw", "p1"), ("p1", "clean"), ("p1", "rejects"), ("clean", "p2"), ("p3", "clean"),
    }


def test_a_dataset_may_have_the_name_of_a_pipeline(spark):
    def pairs(rows):
        return spark.createDataFrame(rows, "pipeline string, dataset string")

    edges = catalog.record_lineage(pairs([("orders", "raw"), ("p2", "orders")]), pairs([("orders", "orders"), ("p2", "sums")]))
    found = catalog.query_lineage(edges, "raw", "downstream", 2).collect()
    assert {(r["dataset"], r["depth"]) for r in found} == {("orders", 1), ("sums", 2)}


def test_catalog(spark):
    record = catalog.dataset_record(spark.range(7), "t", "me", ["x"], {"a": "b"}, count_rows=True).first()
    assert (record["field"], record["type"], record["tags"], record["props"]) == ("id", "bigint", ["x"], {"a": "b", "rows": "7"})
    plain = catalog.dataset_record(spark.range(7), "t").first()
    assert (plain["tags"], plain["props"]) == ([], {})
    names = spark.createDataFrame([(f"Sales_{i:02}", "p", "o") for i in range(15)] + [("other", "p", "o")], "name string, platform string, owner string")
    found = catalog.dataset_search(names, "sales").collect()
    assert len(found) == 10 and {r["total"] for r in found} == {15} and found[0]["name"] == "Sales_00"
    assert len(catalog.dataset_search(names, "sales", 12).collect()) == 12
    with pytest.raises(ValueError):
        catalog.dataset_search(names, "")
    urn = spark.range(1).select(catalog.dataset_urn(F.lit(""), F.lit("a.b"))).first()[0]
    assert urn == "urn:li:dataset:(urn:li:dataPlatform:unknown,a.b,PROD)"


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), "run_id string, line string")


def test_structured_test_logs(spark):
    found = event_log_totals(
        lines(
            spark,
            ("a", '{"info": {"name": "TestPass", "msg": "m"}}'),
            ("a", '{"name": "TestFail"}'),
            ("a", '{"info": {"name": "TestError"}, "name": "TestPass"}'),
            ("a", "  "),
            ("a", "plain"),
            ("b", '{"passed": 3, "failed": 1, "errors": 0, "skipped": 2}'),
            ("c", '{"name": "TestSkip", "passed": 9}'),
            ("d", "nothing"),
        )
    )
    assert {r["run_id"]: tuple(r)[1:] for r in found.collect()} == {"a": (1, 1, 1, 0), "b": (3, 1, 0, 2), "c": (0, 0, 0, 1), "d": (0, 0, 0, 0)}


def test_scan_logs(spark):
    found = scan_log_totals(lines(spark, ("a", "2 checks passed"), ("a", " 1 CHECK Failed: x"), ("a", "1 check error"), ("a", "4 checks had error"), ("b", "hm")))
    assert {r["run_id"]: tuple(r)[1:] for r in found.collect()} == {"a": (2, 1, 5), "b": (0, 0, 0)}


def test_expectation_runs(spark):
    stats = '{"validation_result": {"statistics": {"evaluated_expectations": 5, "successful_expectations": 3, "failed_expectations": 2}}}'
    rows = [
        (1, '{"success": true, "evaluated": 1, "successful": 1}'),
        (2, f'{{"success": false, "run_results": {{"x": {stats}, "y": {stats}}}}}'),
        (3, "{}"),
    ]
    found = expectation_totals(spark.createDataFrame(rows, "run_id int, document string"))
    assert {r["run_id"]: tuple(r)[1:] for r in found.collect()} == {1: (True, 1, 1, 0), 2: (False, 10, 6, 4), 3: (False, 0, 0, 0)}


def test_applied_plans_keep_defaults_and_widths(spark):
    wanted = table("users", ("id", "bigint"), ("code", "varchar(12)"))
    wanted["columns"] += [{"name": "state", "type": "varchar(10)", "default": "'new'"}, {"name": "n", "type": "integer", "default": "7"}]
    _, found = diff(spark, [wanted], [table("users", ("id", "int"), ("code", "varchar(5)"))])
    plan = plan_of(found, "users", declared_schema(spark, [wanted])[0])
    df = spark.createDataFrame([(1, "x")], "id int, code string")
    for mode in ("online", "blue_green"):
        out = apply_plan(df, plan, "warn", mode)
        assert out.select("id", "code", "state", "n").first()[:] == (1, "x", "new", 7)
        # What the new table declares is what was wanted, so a second diff is empty.
        columns = [(f.name, declared_type(f)) for f in out.schema.fields]
        assert dict(columns) == {"id": "bigint", "code": "varchar(12)", "state": "varchar(10)", "n": "integer"}
        assert diff(spark, [wanted], [table("users", *columns)])[1].isEmpty()
    with pytest.raises(ValueError):
        apply_plan(df, [{"change": "add_column", "name": "c", "to_type": "text", "default": "x; y"}])
