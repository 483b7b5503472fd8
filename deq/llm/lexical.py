"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton of all item terms."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deq.llm.common import narrowed, utf8

#: Bytes of item texts that make one automaton; more items are searched in further blocks.
BLOCK_BYTES = 4_000_000

#: Cells of the matrix of documents by items that one step of a task sums up.
CELLS = 2_000_000

#: Candidates a task holds before it cuts them back to the best of each item.
HELD = 200_000

#: A-Z become a-z, other bytes of terms stay, all else becomes a blank.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_TERM_TABLE = np.array([c != 32 for c in _TERM_BYTES])


def terms_of(text: bytes) -> list[bytes]:
    """The lower-cased terms of a text, in order, with repeats."""
    return text.translate(_TERM_BYTES).split()


def n_terms(text: bytes) -> int:
    """How many terms a text has: the places where a term begins."""
    inside = _TERM_TABLE[np.frombuffer(text, np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + (len(inside) > 0 and inside[0]))


class TermScanner:
    """Finds the terms of a fixed list in whole texts.

    Each pattern is a term between two blanks, so a term inside a longer word never matches; two
    neighbouring terms share the blank between them.
    """

    def __init__(self, terms: list[bytes]):
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term.decode('latin-1')} ", number)
        self.any = bool(terms)
        if self.any:
            self.automaton.make_automaton()

    def counts(self, text: bytes) -> Counter:
        """How often each term, by its number, occurs in the text."""
        if not self.any:
            return Counter()
        guarded = (b" " + text.translate(_TERM_BYTES) + b" ").decode("latin-1")
        return Counter(map(itemgetter(1), self.automaton.iter(guarded)))


class ItemTerms:
    """Terms of a block of items, numbered, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[bytes]):
        held = [Counter(terms_of(text)) for text in texts]
        self.items = len(texts)
        self.terms = sorted(set().union(*held)) if held else []
        number = {term: i for i, term in enumerate(self.terms)}
        pairs = [(number[term], item, times) for item, own in enumerate(held) for term, times in own.items()]
        postings = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.item, self.times = postings[:, 1], postings[:, 2]
        self.first = np.searchsorted(postings[:, 0], np.arange(len(self.terms) + 1))
        self.most = max((own.total() for own in held), default=0)


_BUILT: dict = {}


def _scanner(key: str, terms: list[bytes]) -> TermScanner:
    """The automaton of a block; a worker builds it once and keeps the latest."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = TermScanner(terms)
    return _BUILT[key]


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first to last (excluded), and the range each comes from."""
    size = last - first
    source = np.repeat(np.arange(len(size)), size)
    return np.arange(len(source)) - np.repeat(np.cumsum(size) - size - first, size), source


def _sums(cell: np.ndarray, value: np.ndarray, cells: int, most: int) -> np.ndarray:
    """Exact 64-bit sums of values by cell; a cell has ``most`` addends at most."""
    if not len(cell):
        return np.zeros(cells, np.int64)
    if most * int(value.max()) < 2**53:
        return np.bincount(cell, value, cells).astype(np.int64)
    low = np.bincount(cell, value & 0xFFFFFF, cells).astype(np.int64)
    return (np.bincount(cell, value >> 24, cells).astype(np.int64) << 24) + low


def _best(rows: np.ndarray, k: int) -> np.ndarray:
    """Of rows (item, score, id, id is null), the k best of each item."""
    rows = rows[np.lexsort((rows[:, 2], -rows[:, 3], -rows[:, 1], rows[:, 0]))]
    start = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
    place = np.arange(len(rows)) - np.maximum.accumulate(np.where(start, np.arange(len(rows)), 0))
    return rows[place < k]


class TopScores:
    """The k best documents of each item among those a task has seen."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.parts, self.held = [], 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of documents (rows) for items (columns)."""
        at, item = np.nonzero(scores >= self.floor)
        if len(at):
            self.parts.append(np.column_stack((item, scores[at, item], ids[at], null[at])))
            self.held += len(at)
            if self.held > HELD:
                self.rows()

    def rows(self) -> np.ndarray:
        best = _best(np.concatenate([np.empty((0, 4), np.int64), *self.parts]), self.k)
        self.parts, self.held = [best], len(best)
        items, n = np.unique(best[:, 0], return_counts=True)
        full = n == self.k
        self.floor[items[full]] = best[np.cumsum(n)[full] - 1, 1]
        return best


def _statistics(docs: DataFrame, held, key: str) -> dict[int, int]:
    """Documents that hold each term; at -1 those with any term, at -2 all terms with repeats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = held.value.terms
        scanner = _scanner(key, terms)
        df, with_terms, total = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for text in utf8(batch.column(1)):
                n = n_terms(text)
                if n:
                    with_terms, total = with_terms + 1, total + n
                    df[list(scanner.counts(text))] += 1
        seen = np.flatnonzero(df)
        numbers = np.r_[seen, -1, -2].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array(np.r_[df[seen], with_terms, total].astype(np.int64))], ["term", "n"]
        )

    counted = docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in counted.collect()}


def _scored(docs: DataFrame, held, key: str, weights: np.ndarray, n_docs: int, n_all: int, k: int) -> DataFrame:
    """The k best documents of each item among those of each task."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        scanner = _scanner(key, items.terms)
        best = TopScores(items.items, k)
        step = max(1, CELLS // max(1, items.items))
        for batch in batches:
            ids = batch.column(0)
            null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), np.int64)
            ids = ids.fill_null(0).to_numpy()
            texts = utf8(batch.column(1))
            for at in range(0, len(texts), step):
                doc, term, tf, size = [], [], [], []
                for i, text in enumerate(texts[at : at + step]):
                    found = scanner.counts(text)
                    if found:
                        doc += [i] * len(found)
                        term += found.keys()
                        tf += found.values()
                        size += [n_terms(text)] * len(found)
                if not doc:
                    continue
                n = min(step, len(texts) - at)
                doc, term, tf, size = (np.array(x, np.int64) for x in (doc, term, tf, size))
                m = 75 + (25 * size * n_docs) // n_all
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                # As many of the found terms at a time as keep the postings within the cells.
                ends = np.cumsum(items.first[term + 1] - items.first[term])
                scores = np.zeros(n * items.items, np.int64)
                lo = 0
                while lo < len(term):
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CELLS, "right")))
                    posting, source = _spread(items.first[term[lo:hi]], items.first[term[lo:hi] + 1])
                    cell = doc[lo:hi][source] * items.items + items.item[posting]
                    scores += _sums(cell, value[lo:hi][source] * items.times[posting], len(scores), items.most)
                    lo = hi
                best.add(scores.reshape(n, -1), ids[at : at + n], null[at : at + n])
        rows = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[:, 0]), pa.array(rows[:, 2], mask=rows[:, 3] > 0), pa.array(rows[:, 1])], ["_item", "doc_id", "score"]
        )

    return docs.mapInArrow(score, "_item long, doc_id long, score long")


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """Items with the number of their block, and how many blocks there are."""
    total = items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    return items.withColumn("_block", block), blocks


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best documents for the text of each item, by a BM25-like score in whole numbers.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Documents
    are scanned twice, once for the numbers of documents by term and once for the scores; nothing
    but those numbers and each task's ``k`` best per item leaves a task, and no index is kept. Item
    texts are taken in blocks of about ``BLOCK_BYTES``, each an automaton and two scans, so what is
    sent to the tasks has a bound.

    ``items`` has ``item_id`` and ``text``; every row is an item of its own, rows alike are ranked
    alike. Null texts have no terms; items without terms and documents that score 0 give no rows.
    Equal scores go by ``doc_id``, null ids first, repeated rows in any order. Empty tables give no
    rows. Returns item_id, rank, doc_id, score; further columns of both tables are left out.
    """
    spark = docs.sparkSession
    docs = narrowed(docs)
    slim = items.select(
        items["item_id"].cast("long").alias("item_id"), F.coalesce(items["text"].cast("string"), F.lit("")).alias("text")
    )
    slim, blocks = _blocks(slim)
    found = spark.createDataFrame([], "_block long, _item long, item_id long, doc_id long, score long")
    for number in range(blocks):
        own = slim.where(F.col("_block") == number).orderBy("item_id", "text").collect()
        if not own:
            continue
        terms = ItemTerms([r.text.encode() for r in own])
        held = spark.sparkContext.broadcast(terms)
        key = uuid.uuid4().hex
        counts = _statistics(docs, held, key)
        n_docs, n_all = counts.get(-1, 0), counts.get(-2, 0)
        if not n_docs:
            continue
        weights = np.array([term_weight(n_docs, counts.get(t, 0)) for t in range(len(terms.terms))], np.int64)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(own)], "_item long, item_id long")
        scored = _scored(docs, held, key, weights, n_docs, n_all, k)
        found = found.unionByName(scored.join(ids, "_item").withColumn("_block", F.lit(number).cast("long")))
    order = Window.partitionBy("_block", "_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
