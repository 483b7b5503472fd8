"""Personal data: fixed forms, and further identifiers found by bootstrapped contexts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import boxed, in_arrow, keyed, unboxed
from deq.session import materialize

KINDS = ["email", "ip", "card", "phone"]

#: A pattern counts once it has this many different known or accepted identifiers.
MIN_SUPPORT = 3
#: Score from which an identifier counts as discovered.
ACCEPT = 0.9
#: Times that patterns and values weigh each other before the accepted ones are taken over.
ROUNDS = 3

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits either matches from its first digit or not at all, so no later start is tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?\"'()[]{}<>"
_KEY = re.compile(r"^[\w.-]*[A-Za-z][\w.-]*[=:]+[\"']?")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at)):
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind and then start; ends are exclusive."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def shape(value: str) -> str:
    """Letters as ``a``, short numbers as ``9``, longer ones with their length, the rest as it is."""

    def run(m):
        found = m.group()
        return "a" if not found[0].isdigit() else "9" if len(found) < 4 else f"9x{len(found)}"

    return _RUNS.sub(run, value)


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """Known and possible identifiers with their lexical patterns.

    (kind or -1, start, end, digest of the value, digests of its patterns). A possible identifier
    is a token with a digit or an at sign outside all spans, without a leading ``key=`` and edge
    punctuation. Patterns pair the shape of the value with the key, the word before, and the two
    words before it.
    """
    if not spans and "@" not in text and not _DIGIT.search(text):
        return []
    taken = sorted((s, e) for _, s, e in spans)
    starts = {s: (k, e) for k, s, e in reversed(spans)}
    out, last, before, covered, n = [], "", "", 0, 0

    def add(kind: int, start: int, end: int, key: str) -> None:
        value = text[start:end]
        form = shape(value)
        contexts = [f"k {key}"] if key else []
        contexts += [f"1 {last}", f"2 {before} {last}"] if last else []
        out.append((kind, start, end, _digest(value.lower()), [_digest(f"{c}\n{form}") for c in contexts]))

    for m in _TOKEN.finditer(text):
        token, start, end = m.group(), m.start(), m.end()
        while n < len(taken) and taken[n][1] <= start:
            n += 1
        inside = False
        at = n
        while at < len(taken) and taken[at][0] < end:
            inside = True
            if taken[at][0] >= start and taken[at][0] >= covered:
                kind, stop = starts[taken[at][0]]
                head = text[start : taken[at][0]]
                add(kind, taken[at][0], stop, head.lower() if _KEY.match(head) else "")
                covered = stop
            at += 1
        if not inside and start >= covered and ("@" in token or _DIGIT.search(token)):
            found = _KEY.match(token)
            lead = found.end() if found else 0
            core = token[lead:]
            left, right = len(core) - len(core.lstrip(_EDGES)), len(core.rstrip(_EDGES))
            if right - left >= 4:
                add(-1, start + lead + left, start + lead + right, token[:lead].lower())
        before, last = last, token.strip(_EDGES).lower()
    return out


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


_SPAN = pa.struct([("k", pa.int32()), ("s", pa.int64()), ("e", pa.int64())])
_MENTION = pa.struct(
    [("k", pa.int32()), ("s", pa.int64()), ("e", pa.int64()), ("v", pa.int64()), ("p", pa.list_(pa.int64()))]
)


def _scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    spans, found = [], []
    for text in batch.column(3).to_pylist():
        own = base_spans(text or "")
        spans.append([{"k": k, "s": s, "e": e} for k, s, e in own])
        found.append([{"k": k, "s": s, "e": e, "v": v, "p": p} for k, s, e, v, p in mentions(text or "", own)])
    arrays = [*batch.columns[:3], pa.array(spans, pa.list_(_SPAN)), pa.array(found, pa.list_(_MENTION))]
    yield pa.RecordBatch.from_arrays(arrays, ["_a", "_b", "doc_id", "base", "mentions"])


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans and mentions of every document, stored; without the texts."""
    schema = (
        "_a long, _b long, doc_id long, base array<struct<k:int,s:bigint,e:bigint>>, "
        "mentions array<struct<k:int,s:bigint,e:bigint,v:bigint,p:array<bigint>>>"
    )
    return materialize(in_arrow(keyed(docs), _scan, schema))


def _scores(edges: DataFrame, rounds: int, min_support: int) -> DataFrame:
    """``v``, ``score`` and ``kind`` of the values that are not known, from edges (p, v, k, w)."""
    scores = None
    for _ in range(rounds):
        weighed = edges.withColumn("kind", F.col("k"))
        if scores is not None:
            weighed = edges.join(scores, "v", "left").select(
                "p", "v", "k",
                F.when(F.col("k") >= 0, F.col("w")).otherwise(F.coalesce("score", F.lit(0.0))).alias("w"),
                F.when(F.col("k") >= 0, F.col("k")).otherwise(F.coalesce("kind", F.lit(-1))).alias("kind"),
            )
        sums = [F.sum(F.when(F.col("kind") == i, F.col("w")).otherwise(0.0)).alias(f"w{i}") for i in range(len(KINDS))]
        patterns = weighed.groupBy("p").agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("k") >= 0).cast("long")).alias("seeds"), *sums
        )
        best = F.greatest(*[F.struct((F.col(f"w{i}") / F.col("n")).alias("c"), F.lit(i).alias("kind")) for i in range(len(KINDS))])
        strong = patterns.filter(F.col("seeds") >= min_support).select("p", best.alias("b"))
        # A confidence below 1 keeps the logarithm finite; doubt is at least one in a million.
        doubt = F.log(F.greatest(1 - F.col("b.c"), F.lit(1e-6)))
        scores = materialize(
            edges.filter(F.col("k") < 0)
            .join(strong, "p")
            .groupBy("v")
            .agg((1 - F.exp(F.sum(doubt))).alias("score"), F.max("b").alias("b"))
            .select("v", "score", F.col("b.kind").alias("kind"))
        )
    return scores


def discovered(scan: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, accept: float = ACCEPT) -> DataFrame:
    """``v`` and ``kind`` of identifiers that high-confidence patterns point to.

    Patterns and values form a graph with one edge for each pair that occurs. A pattern's confidence
    for a kind is the mean score of its values for it; known identifiers score 1, others what
    their patterns with enough support make likely together. Both are computed in turn. What is
    accepted counts as known from then on, with its score, and so supports further patterns, until
    nothing more is accepted.
    """
    edges = materialize(
        scan.select(F.explode("mentions").alias("m"))
        .select(F.explode("m.p").alias("p"), F.col("m.v").alias("v"), F.col("m.k").alias("k"))
        .groupBy("p", "v")
        .agg(F.max("k").alias("k"))
        .withColumn("w", (F.col("k") >= 0).cast("double"))
    )
    found = None
    while True:
        own = edges
        if found is not None:
            own = edges.join(found, "v", "left").select(
                "p", "v",
                F.when(F.col("k") >= 0, F.col("k")).otherwise(F.coalesce("kind", "k")).alias("k"),
                F.when(F.col("k") >= 0, F.col("w")).otherwise(F.coalesce("score", "w")).alias("w"),
            )
        # Only values that are not accepted yet have a score, so this ends.
        new = materialize(_scores(own, rounds, min_support).filter(F.col("score") >= accept))
        if new.isEmpty():
            return (new if found is None else found).select("v", "kind")
        found = new if found is None else materialize(found.unionByName(new))


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per document: key columns, doc_id, ``base`` and ``extra`` spans (kind, start, end).

    Offsets count code points, ends are exclusive. A null or empty text has no spans; repeated rows
    stay repeated.
    """
    scan = scanned(docs)
    new = (
        scan.select("_a", "_b", F.explode("mentions").alias("m"))
        .filter(F.col("m.k") < 0)
        .select("_a", "_b", F.col("m.v").alias("v"), F.col("m.s").alias("s"), F.col("m.e").alias("e"))
        .join(discovered(scan), "v")
        .groupBy("_a", "_b")
        .agg(F.collect_set(F.struct(F.col("kind").cast("int").alias("k"), "s", "e")).alias("extra"))
    )
    none = F.array().cast("array<struct<k:int,s:bigint,e:bigint>>")
    return scan.drop("mentions").join(new, ["_a", "_b"], "left").withColumn("extra", F.coalesce("extra", none))


def _written(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def personal_table(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans (base and discovered, as text)."""
    found = personal_spans(docs)

    def count(i: int):
        # The function takes one argument: a second one, even with a default, would be the place in the array.
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.encode(_written(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _written(F.concat("base", "extra")).alias("spans"),
        F.size("extra").cast("long").alias("n_discovered"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all columns stay.

    Overlapping spans become one mark, that of the first. Null texts stay null.
    """
    found = personal_spans(docs).select("_a", "_b", F.array_sort(F.transform(F.concat("base", "extra"), _by_start)).alias("_spans"))
    found = found.filter(F.size("_spans") > 0).dropDuplicates(["_a", "_b"])
    rows = boxed(docs)
    text, marks = F.col("_row.text"), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(state, x):
        fresh = x["s"] >= state["at"]
        piece = F.concat(F.substring(text, (state["at"] + 1).cast("int"), (x["s"] - state["at"]).cast("int")), F.get(marks, x["k"]))
        return F.struct(
            F.concat(state["out"], F.when(fresh, piece).otherwise("")).alias("out"),
            F.greatest(state["at"], x["e"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rest = lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.char_length(text)))
    clean = F.when(F.col("_spans").isNull(), text).otherwise(F.aggregate("_spans", start, step, rest))
    return unboxed(rows.join(found, ["_a", "_b"], "left"), docs.columns, text=clean)


def _by_start(x):
    return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))
