"""Entity spans in text.

The span finders are small helpers of one Arrow-batched function; each works in time linear in
the text for the built-in types, whatever the text holds.
"""

from __future__ import annotations

import contextlib
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.functions.text import python_pattern

# What the built-in types look like, in the order they claim text.
BUILT_IN_TYPES = ["email", "date", "org", "location", "person"]
EMAIL_LOCAL = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
EMAIL_DOMAIN = rb"[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
SPACE = rb"[\t\n\f\r ]"
MONTHS = (
    rb"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?"
    rb"|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
)
COMPANY_WORDS = (
    rb"(?:Inc|LLC|Corp|Ltd|Co|Group|Holdings|Technologies|Solutions|Services|International|Enterprises)"
)
CITIES = (
    rb"New York|Los Angeles|San Francisco|Chicago|London|Paris|Berlin|Tokyo|Beijing|Sydney|Toronto|Mumbai|Dubai"
    rb"|Singapore|Boston|Seattle|Austin|Denver|Atlanta|Miami|Phoenix|Dallas|Houston|Washington|Philadelphia"
    rb"|Portland|Minneapolis"
)

# Types and confidence of the plain fallback form.
FALLBACK_TYPES = ["person", "org", "location", "product", "concept"]
FALLBACK_CONFIDENCE = 0.5

ENTITY_TYPE = "array<struct<type:string,value:string,start:int,end:int>>"
_ARROW_TYPE = pa.list_(
    pa.struct([("type", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)
#: Texts of a batch whose entities are Python objects at a time.
SLICE = 100

Span = tuple[int, int]

_domain = re.compile(EMAIL_DOMAIN)
# Each pattern begins with one character class, which lets the search skip to candidates fast.
_date = re.compile(
    rb"\d(?:\d{3}-\d{2}-\d{2}|\d?/\d{1,2}/\d{2,4}|\d?" + SPACE + rb"+" + MONTHS + SPACE + rb"+\d{4})"
)
_city = re.compile(CITIES)
_person = re.compile(rb"[A-Z][a-z]+(?:" + SPACE + rb"+[A-Z][a-z]+){1,3}")
_run = re.compile(rb"[a-zA-Z&\t\n\f\r ]+")
_company_end = re.compile(SPACE + rb"(?=[A-Z])" + COMPANY_WORDS)
_capital = re.compile(rb"[A-Z]")
_acronyms = re.compile(rb"[A-Z][A-Z]+(?:" + SPACE + rb"+[A-Z]{2,})*")


def _email_spans(text: bytes) -> Iterator[Span]:
    """Look at each ``@`` and grow the address to both sides."""
    done, at = 0, text.find(b"@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(EMAIL_LOCAL))
        domain = _domain.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find(b"@", done)


def _org_spans(text: bytes) -> Iterator[Span]:
    """A run of letters, ``&`` and spaces is a company from its first capital to its last company word."""
    company = _company_end.search(text)
    if not company:
        yield from (m.span() for m in _acronyms.finditer(text))
        return
    for run in _run.finditer(text):
        begin, last = run.start(), None
        for last in _company_end.finditer(text, run.start(), run.end()):
            pass
        if last:
            capital = _capital.search(text, run.start(), last.start())
            if capital:
                begin = last.end() + (text[last.end() : last.end() + 1] == b".")
                yield capital.start(), begin
        yield from (m.span() for m in _acronyms.finditer(text, begin, run.end()))


_FINDERS = {
    "email": _email_spans,
    "date": lambda t: (m.span() for m in _date.finditer(t)),
    "org": _org_spans,
    "location": lambda t: (m.span() for m in _city.finditer(t)),
    "person": lambda t: (m.span() for m in _person.finditer(t)),
}


def _custom_spans(pattern: re.Pattern, text: str) -> Iterator[Span]:
    """Byte spans of a user's pattern; character offsets are turned into bytes on the way."""
    chars = size = 0
    for m in pattern.finditer(text):
        size += len(text[chars : m.start()].encode())
        start, chars = size, m.end()
        size += len(m.group().encode())
        yield start, size


def _apart(spans: Iterable[Span], claimed: list[Span]) -> Iterator[Span]:
    """The spans that touch no claimed one; both come in order, so one sweep over both is enough."""
    at = 0
    for start, end in spans:
        while at < len(claimed) and claimed[at][1] <= start:
            at += 1
        if at == len(claimed) or claimed[at][0] >= end:
            yield start, end


def find_entities(
    text: str | None, types: list[str], custom: list[tuple[str, re.Pattern]], overlapping: bool = False
) -> list[dict]:
    """Entities of a text, by type and place.

    Types claim text in their order: a span that overlaps one of an earlier type is left out, unless
    ``overlapping`` asks for each type as if it were alone.
    """
    if not text:
        return []
    raw, claimed, out = text.encode(), [], []
    wanted = [(kind, _FINDERS[kind](raw)) for kind in BUILT_IN_TYPES if kind in types]
    for kind, spans in itertools.chain(wanted, ((kind, _custom_spans(p, text)) for kind, p in custom)):
        cut = [(s, e, raw[s:e].decode().strip()) for s, e in (spans if overlapping else _apart(spans, claimed))]
        out += [{"type": kind, "value": value, "start": s, "end": e} for s, e, value in cut if value]
        claimed = list(heapq.merge(claimed, ((s, e) for s, e, value in cut if value)))
    return out


def _compiled(patterns: list[dict]) -> list[tuple[str, re.Pattern]]:
    """Types and patterns of complete entries; a pattern that is not of the dialect is skipped."""
    out = []
    for entry in patterns:
        if entry.get("type") and entry.get("pattern"):
            with contextlib.suppress(ValueError):
                out.append((entry["type"], python_pattern(entry["pattern"])))
    return out


def _packed(batch: pa.Array, types: list[str], custom: list[tuple[str, re.Pattern]], overlapping: bool) -> pa.Array:
    """Entities of a batch of texts; a slice's are packed before the next slice is looked at."""
    slices = (batch.slice(at, SLICE).to_pylist() for at in range(0, len(batch), SLICE))
    packed = [pa.array([find_entities(t, types, custom, overlapping) for t in texts], _ARROW_TYPE) for texts in slices]
    return pa.concat_arrays(packed) if packed else pa.array([], _ARROW_TYPE)


def _extractor(types: list[str] | None, patterns: list[dict], overlapping: bool):
    wanted = list(types) if types else BUILT_IN_TYPES
    custom = _compiled(list(patterns))

    @F.arrow_udf(ENTITY_TYPE)
    def extract(batch: pa.Array) -> pa.Array:
        return _packed(batch, wanted, custom, overlapping)

    return extract


def entity_column(
    text: Column, types: list[str] | None = None, patterns: list[dict] = (), overlapping: bool = False
) -> Column:
    """Array of ``{type, value, start, end}`` for a text column, offsets in bytes.

    Built-in types claim text in a fixed order, then custom ``{type, pattern}`` entries in theirs;
    an invalid custom pattern is skipped. With ``overlapping`` no type hides another.
    """
    return _extractor(types, patterns, overlapping)(text)


def extract_entities(
    df: DataFrame, text: str, types: list[str] | None = None, patterns: list[dict] = (), overlapping: bool = False
) -> DataFrame:
    """One row per entity: the other columns and ``type, value, start, end``."""
    rest = [c for c in df.columns if c != text]
    # Otherwise the filter that Spark infers for inline() runs the function a second time, in further Python workers.
    once = _extractor(types, patterns, overlapping).asNondeterministic()
    # The text goes to Python alone and does not come back.
    found = df.select(*rest, once(F.col(text)).alias("_entities"))
    return found.select(*rest, F.inline("_entities"))


def fallback_entities(df: DataFrame, text: str, types: list[str] | None = None, patterns: list[dict] = ()) -> DataFrame:
    """Entities as ``type, value, context, confidence``, the form used without a language model."""
    found = extract_entities(df, text, types or FALLBACK_TYPES, patterns)
    return found.drop("start", "end").withColumns(
        {"context": F.lit(""), "confidence": F.lit(FALLBACK_CONFIDENCE)}
    )
