"""Quality rules as a short-circuit cascade, in DataFrame operations alone."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deq.session import materialize

BREAKS = " \t\n\x0b\x0c\r"
BREAK = r"[\x20\x09-\x0D]"

#: Rows on which the cost and the rejections of the rules are estimated.
SAMPLE_ROWS = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null or blank."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BREAK + "+"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def word_chars(words: Column) -> Column:
    """Code points of a list of words."""
    return F.char_length(F.array_join(words, "")).cast("long")


def n_of(text: Column, characters: str) -> Column:
    """How many characters of a text are in these, given as the inside of a pattern's brackets."""
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{characters}]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line."""
    full = F.filter(lines_of(text), lambda line: F.btrim(line, F.lit(BREAKS)) != "")
    return let(full, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def covered(starts: Column, size: int) -> Column:
    """How many places the runs of ``size`` from these sorted starts cover together."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(state, at):
        return F.struct(
            (at + size).alias("end"),
            (state["n"] + at + size - F.greatest(at, state["end"])).alias("n"),
        )

    return F.aggregate(starts, start, step, lambda state: state["n"])


def n_repeat_words(words: Column, size: int = 5) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the list.

    Windows are compared by digest. Only a list with a repeated window is looked at place by place,
    by sorting its windows, so the time stays n log n for any text.
    """

    def windows(digests):
        at = lambda i, j: F.get(digests, i + j)
        last = F.size(digests) - size
        return F.when(
            last > 0,
            F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[at(i, j) for j in range(size)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def twice(found):
        ordered = F.array_sort(F.transform(found, lambda d, i: F.struct(d.alias("d"), i.alias("i"))))

        def starts(s):
            same = lambda x, i: (F.get(s, i)["d"] == x["d"])
            kept = F.filter(s, lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False)))
            return F.array_sort(F.transform(kept, lambda x: x["i"]))

        return covered(let(ordered, starts), size)

    def counted(found):
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(twice(found))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), counted).cast("long")


def n_repeat_neighbours(words: Column) -> Column:
    """Words that equal the word before them."""
    return F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("long")


class Figures:
    """What rules ask of a document; a figure that is already known is taken as given.

    ``words`` may be left out where all figures that need it are known.
    """

    def __init__(self, text: Column, words: Column | None = None, **known: Column):
        self.text, self.words, self.known = text, words, known

    def _get(self, name: str, made: Callable[[], Column]) -> Column:
        return self.known[name] if name in self.known else made()

    @property
    def n_words(self) -> Column:
        return self._get("n_words", lambda: F.size(self.words))

    @property
    def word_chars(self) -> Column:
        return self._get("word_chars", lambda: word_chars(self.words))

    @property
    def n_symbols(self) -> Column:
        return self._get("n_symbols", lambda: n_of(self.text, SYMBOLS))

    @property
    def n_exclamations(self) -> Column:
        return n_of(self.text, "!")

    @property
    def n_capitals(self) -> Column:
        return n_of(self.text, "A-Z")

    @property
    def n_digits(self) -> Column:
        return n_of(self.text, "0-9")

    @property
    def n_lines(self) -> Column:
        return n_of(self.text, "\\n") + 1

    @property
    def n_dup_lines(self) -> Column:
        return self._get("n_dup_lines", lambda: n_dup_lines(self.text))

    @property
    def n_repeat_words(self) -> Column:
        return self._get("n_repeat_words", lambda: n_repeat_words(self.words))

    @property
    def n_repeat_neighbours(self) -> Column:
        return self._get("n_repeat_neighbours", lambda: n_repeat_neighbours(self.words))


@dataclass(frozen=True)
class Rule:
    """A named rule; ``fails`` makes, from the figures, a condition that is true for a bad document."""

    name: str
    fails: Callable[[Figures], Column]


#: Characters that prose hardly has, as the inside of a pattern's brackets.
SYMBOLS = "#*$%&|<>"

#: Rules of the method itself, at their customary cuts. Ratios are whole-number comparisons, so any
#: engine agrees on them.
RULES = [
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("exclamations", lambda f: 2 * f.n_exclamations > f.n_words),
    Rule("capitals", lambda f: 2 * f.n_capitals > f.word_chars),
    Rule("digits", lambda f: 2 * f.n_digits > f.word_chars),
    Rule("repeated_lines", lambda f: 10 * f.n_dup_lines > 3 * f.n_lines),
    Rule("word_length", lambda f: (f.word_chars > 10 * f.n_words) | (f.word_chars < 3 * f.n_words)),
    Rule("repeated_neighbours", lambda f: 5 * f.n_repeat_neighbours > f.n_words),
]

#: The rules every document has to pass besides.
BASE_RULES = [
    Rule("too_short", lambda f: f.n_words < 10),
    Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 20 * f.n_words),
]

#: Runs of each rule on the sample; the median counts.
RUNS = 3


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rate(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimates(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds and share of rejected rows of each rule on a stored sample, best rate first.

    The sample is drawn from the whole table; an empty table leaves the rules in their order. A rule
    is timed several times after its code is compiled; what a job takes that only reads the
    sample and cuts its words is not counted as its cost.
    """
    total = docs.count()
    if not total:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    share = min(1.0, sample_rows / total)
    sample = materialize(docs.select("text").sample(withReplacement=False, fraction=share, seed=7))

    def timed(rule: Rule):
        bad = F.count_if(let(words_of(F.col("text")), lambda w: rule.fails(Figures(F.col("text"), w))))
        job, seconds = sample.agg(F.count(F.lit(1)).alias("n"), bad.alias("bad")), []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            row = job.first()
            seconds.append(time.perf_counter() - began)
        return median(seconds[1:]), row["bad"] / max(row["n"], 1)

    idle, _ = timed(Rule("", lambda f: f.n_words < 0))
    found = []
    for rule in rules:
        seconds, bad = timed(rule)
        found.append(Estimate(rule, max(seconds - idle, 1e-3), bad))
    return sorted(found, key=lambda e: -e.rate)


def _fails(figures: Figures, ordered: list[Rule]) -> Column:
    verdict = F.when(F.lit(False), F.lit(True))
    for rule in ordered:
        verdict = verdict.when(rule.fails(figures), F.lit(True))
    return verdict.otherwise(F.lit(False))


def rejected(text: Column, ordered: list[Rule]) -> Column:
    """Whether a document fails a rule; rules after the first that fails are not computed."""
    return let(words_of(text), lambda w: _fails(Figures(text, w), ordered))


def cascade(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> Column:
    """A column that is true for the documents to keep.

    The order of the rules follows the estimates, hence the machine; the verdict does not depend on
    it. Null and empty texts have no words and no lines with words; they fail ``too_short``.
    """
    ordered = [e.rule for e in estimates(docs, BASE_RULES + RULES if rules is None else rules, sample_rows)]
    return ~rejected(docs["text"], ordered)


def quality_filter(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that pass every rule, with all their columns; repeated rows stay repeated."""
    return docs.filter(cascade(docs, sample_rows=sample_rows))


#: Figures of ``quality_table`` that rules read as they stand.
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_table(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document with its base figures and the verdict; repeated rows stay repeated.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept. A null or empty
    text has zeros and fails. Each figure is computed once; the rules read it.
    """
    text = docs["text"]
    ordered = [e.rule for e in estimates(docs, RULES, sample_rows)]
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            word_chars(w).alias("word_chars"),
            n_repeat_words(w).alias("n_repeat_words"),
            n_repeat_neighbours(w).alias("n_repeat_neighbours"),
        ),
    )
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        of_words.alias("f"),
        n_of(text, SYMBOLS).alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"),
        text.alias("text"),
    ).select("doc_id", "f.*", "n_symbols", "n_dup_lines", "text")
    base = Figures(F.col("text"), **{c: F.col(c) for c in [*FIGURES, "n_repeat_neighbours"]})
    rows = rows.withColumn("base_failed", _fails(base, BASE_RULES))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~_fails(base, ordered))
    return rows.withColumn("kept", kept).select("doc_id", *FIGURES, "base_failed", "kept")
