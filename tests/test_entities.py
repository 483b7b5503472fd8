"""The span finders against the plain patterns."""

import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deq.functions.entities import BUILT_IN_TYPES, _packed, extract_entities, fallback_entities, find_entities
from deq.functions.text import engine_pattern, python_pattern
from deq.plans.schemas import _PATTERNS

PLAIN = {k: re.compile(p.replace(r"\s", r"[\t\n\f\r ]").replace(r"[a-zA-Z&[\t\n\f\r ]]", r"[a-zA-Z&\t\n\f\r ]"), re.ASCII) for k, p in _PATTERNS.items()}


def plain_entities(text, types, custom=()):
    """The definition: every pattern over the whole text, overlaps with earlier spans left out."""
    used, found = set(), []
    for kind, pattern in [(t, PLAIN[t]) for t in BUILT_IN_TYPES if t in types] + list(custom):
        for m in pattern.finditer(text):
            start, end = (len(text[:i].encode()) for i in m.span())
            span = set(range(start, end))
            if span & used or not m.group().strip():
                continue
            used |= span
            found.append({"type": kind, "value": m.group().strip(), "start": start, "end": end})
    return found


WORDS = [
    "Acme", "Corp", "Corp.", "Co", "Inc", "LLC", "Group", "Company", "IBM", "NASA", "A", "B&B", "Jane", "Doe", "Smith", "the", "and",
    "New", "York", "London", "Paris", "San", "Francisco", "a@b.co", "x.y+z@mail.example.org", "@", "a@", "@b.com", "a@b", "a_b%@c-d.io_x@e.fr",
    "2024-01-02", "1/2/24", "12/31/2024", "3 Jan 2024", "14", "May", "2025", "é", "Zoë", "日本", "#42", "\n", "\t", "  ", ".", ",", ";", "\v",
]


def random_text(rng):
    return "".join(rng.choice(WORDS) + rng.choice(["", " ", " ", "  ", ". ", "\n"]) for _ in range(rng.randint(0, 40)))


@pytest.mark.parametrize("seed", range(300))
def test_finders_match_the_plain_patterns(seed):
    text = random_text(random.Random(seed))
    for types in ([t] for t in BUILT_IN_TYPES):
        assert find_entities(text, types, []) == plain_entities(text, types)
    custom = [("number", re.compile(r"#\d+", re.ASCII)), ("accent", re.compile("[é日本ë]+"))]
    assert find_entities(text, BUILT_IN_TYPES, custom) == plain_entities(text, BUILT_IN_TYPES, custom)


def test_long_runs_stay_fast():
    for text in ("A" * 200_000, "Ab " * 70_000, "a" * 200_000 + "!", "a@" * 100_000, "1" * 200_000, "A b " * 50_000 + "Corp"):
        find_entities(text, BUILT_IN_TYPES, [])


@pytest.mark.parametrize(
    ("text", "types", "kind", "value"),
    [
        ("John Smith joined the company last year.", ["person"], "person", "John Smith"),
        ("She works at Acme Corp and previously at TechVentures LLC.", ["org"], "org", "She works at Acme Corp and previously at TechVentures LLC."),
        ("The conference was held in New York and San Francisco.", ["location"], "location", "San Francisco"),
        ("The deadline is 2024-12-31 and the meeting is on 01/15/2025.", ["date"], "date", "2024-12-31"),
        ("Contact us at support@example.com or sales@company.org.", ["email"], "email", "support@example.com"),
    ],
)
def test_sentences(spark, text, types, kind, value):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    found = {(r["type"], r["value"]) for r in extract_entities(df, "text", types).collect()}
    assert (kind, value) in found


def test_custom_patterns_come_last_and_invalid_ones_are_skipped(spark):
    df = spark.createDataFrame([(1, "Order #12345, café #7"), (2, ""), (3, None)], "id int, text string")
    patterns = [{"type": "order_id", "pattern": r"#\d+"}, {"type": "bad", "pattern": "(["}, {"type": "look", "pattern": "(?=O)Order"}, {"type": "", "pattern": "x"}]
    found = extract_entities(df, "text", ["order_id"], patterns).collect()
    assert [(r["id"], r["value"], r["start"], r["end"]) for r in found] == [(1, "#12345", 6, 12), (1, "#7", 20, 22)]


def test_earlier_types_hide_later_ones(spark):
    text = "Jane Doe (jane@example.com) from Acme Corp met in London on 2024-03-15."
    df = spark.createDataFrame([(text,)], "text string")
    kinds = [r["type"] for r in extract_entities(df, "text", ["email", "date", "location"]).collect()]
    assert sorted(kinds) == ["date", "email", "location"]
    assert {r["type"] for r in fallback_entities(df, "text").collect()} == {"person", "org", "location"}
    assert {(r["context"], r["confidence"]) for r in fallback_entities(df, "text").collect()} == {("", 0.5)}


def test_documents_match_the_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = sorted((r["doc_id"], r["type"], r["value"], r["start"], r["end"]) for r in extract_entities(docs, "text").collect())
    want = sorted((d["doc_id"], *e.values()) for d in docs.collect() for e in plain_entities(d["text"], BUILT_IN_TYPES))
    assert found == want


def test_custom_patterns_are_of_one_dialect(spark):
    """The same dialect as contracts: very end, bracket classes, no vertical tab among spaces."""
    cases = [
        (r"^[a-z]+$", "abc\n", []), (r"^[a-z]+$", "abc", ["abc"]), (r"(?m)^[a-z]+$", "ab\ncd\n", ["ab", "cd"]),
        (r"[[:alpha:]]+", "ab1[:c", ["ab", "c"]), (r"[^[:alnum:]_]+", "a-é_b", ["-é"]), (r"[[:^digit:]x]+", "12ab", ["ab"]),
        (r"a\sb", "a\vb a b", ["a b"]), (r"[\S]+", "a\vb c", ["a\vb", "c"]), (r"[[a]+", "[a]", ["[a"]), (r"[]a]+", "]ab", ["]a"]),
        (r"x\z", "x\nx", ["x"]), (r"[a&&b]+", "a&b", ["a&b"]),
    ]
    for pattern, text, want in cases:
        found = find_entities(text, [], [("t", python_pattern(pattern))])
        assert [f["value"] for f in found] == [w.strip() for w in want], pattern
        values = spark.createDataFrame([(v,) for v in [text]], "v string")
        assert values.select(F.col("v").rlike(engine_pattern(pattern))).first()[0] == bool(want) or r"\s" in pattern, pattern
    for pattern in (r"(?U)a+", "(?=a)", r"(a)\1", r"a\Z", "[[:nope:]]", "[:alpha:]", "([", "a++"):
        with pytest.raises(ValueError):
            python_pattern(pattern)


def test_types_do_not_hide_each_other_on_request():
    rng = random.Random(77)
    for _ in range(100):
        text = random_text(rng)
        want = [e for t in BUILT_IN_TYPES for e in plain_entities(text, [t])]
        assert find_entities(text, BUILT_IN_TYPES, [], overlapping=True) == want


def test_each_text_goes_to_python_once(spark):
    """The filter that goes with inline() must not run the function a second time, in further workers."""
    df = spark.createDataFrame([(1, "Jane Doe, a@b.co"), (2, None), (3, ""), (3, "")], "id long, text string")
    for found in (extract_entities(df, "text"), fallback_entities(df, "text")):
        assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
        assert [r["id"] for r in found.collect()] == [1] * found.count()


def test_a_batch_is_packed_slice_by_slice():
    texts = ["Jane Doe and a@b.co met in Berlin on 2024-01-02. " * 20, None, "", "é Zoë Doe", "no entity"] * 400
    tracemalloc.start()
    packed = _packed(pa.array(texts), BUILT_IN_TYPES, [], False)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert packed.to_pylist() == [find_entities(t, BUILT_IN_TYPES, []) for t in texts]
    # 32,000 entities in all; as Python objects at one time they would take over 10 MB.
    assert most < 2_500_000
    assert _packed(pa.array([], pa.string()), BUILT_IN_TYPES, [], False).to_pylist() == []
