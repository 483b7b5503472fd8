"""Removal of word runs that occur more than once, by seeds that are extended both ways."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import in_arrow, mixed, narrowed, utf8, window_digests, word_digests
from deq.session import materialize

#: Words in an anchor; a longer one is rarer by chance, a shorter one is needed less often.
ANCHOR = 8

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    if len(_POWERS["up"]) < n:
        size = max(n, 2 * len(_POWERS["up"]), 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed anchors: digest, digest of the extended seed, first window, number of windows.

    The anchor of a window is the first of its runs of ANCHOR words with the least digest, so equal
    windows have equal anchors. Consecutive windows share an anchor; from the first to the last of
    them is how far the seed extends both ways.
    """
    if len(words) < window:
        none = np.empty(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    grams = window_digests(words, ANCHOR)
    per = window - ANCHOR + 1
    owner = np.lib.stride_tricks.sliding_window_view(grams, per).argmin(axis=1) + np.arange(len(words) - window + 1)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    counts = np.diff(np.r_[starts, len(owner)])
    up, down = _powers(len(words) + 1)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(words * up[:-1], dtype=np.uint64)]
    ends = starts + counts - 1 + window
    spans = mixed((sums[ends] - sums[starts]) * down[starts] + counts.astype(np.uint64))
    return grams[owner[starts]], spans, starts, counts


def _rows(docs: DataFrame) -> DataFrame:
    """``_k`` names a row by doc_id and text; rows alike in both share it."""
    slim = narrowed(docs)
    return slim.select(F.xxhash64("text", "doc_id", F.col("doc_id").isNull(), F.col("text").isNull()).alias("_k"), "doc_id", "text")


def _seeds(docs: DataFrame, window: int) -> DataFrame:
    """One row per anchor: a, s (extended seed), _k, and place (first window * 64 + windows)."""

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column(0).to_numpy()
        parts = [anchors(word_digests(d), window) for d in utf8(batch.column(2))]
        sizes = [len(p[0]) for p in parts]
        a, s = (np.concatenate([p[i] for p in parts]).view(np.int64) for i in (0, 1))
        place = np.concatenate([p[2] * 64 + p[3] for p in parts])
        columns = [a, s, np.repeat(keys, sizes), place]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "s", "_k", "place"])

    return in_arrow(_rows(docs), emit, "a long, s long, _k long, place long")


def _packed(docs: DataFrame) -> DataFrame:
    """Rows with their text compressed, which is what is shuffled and stored."""

    def squeeze(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        data = pa.array([press.compress(d) for d in utf8(batch.column(2))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), data], ["_k", "data"])

    return in_arrow(_rows(docs), squeeze, "_k long, data binary")


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """``h`` of each window of the listed places: (_k, data, places of (place, known))."""

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = {"h": [], "_k": [], "at": [], "known": []}
        for k, data, places in zip(*(c.to_pylist() for c in batch.columns)):
            digests = window_digests(word_digests(unpack(data)), window)
            for x in places:
                start, n = divmod(x["place"], 64)
                out["h"].append(digests[start : start + n].view(np.int64))
                out["at"].append(np.arange(start, start + n))
                out["_k"].append(np.full(n, k, np.int64))
                out["known"].append(np.full(n, x["known"], np.int64))
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out.values()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(out))

    return in_arrow(rows, emit, "h long, _k long, at long, known long")


def repeated_places(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """``_k`` with the word ranges (lo, hi) that repeated windows cover, and the packed texts of such rows.

    1. Seeds: anchors that occur twice or more.
    2. Extension: seeds whose whole extension occurs again are repeats as they are. This settles the
       inside of every copied passage without comparing its occurrences in pairs.
    3. Where one anchor has different extensions, the passage ends inside of them: one occurrence of
       each is compared window by window. Words are compared by digests of 64 bits.
    """
    if not ANCHOR < window < ANCHOR + 64:
        raise ValueError("the window must be longer than an anchor, by fewer than 64 words")
    again = _seeds(docs, window).groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    seeds = materialize(_seeds(docs, window).join(again, "a", "left_semi"))
    spans = materialize(
        seeds.groupBy("a", "s").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("_k"), F.min_by("place", "_k").alias("place"))
    )
    same = seeds.join(spans.filter("n > 1").select("a", "s"), ["a", "s"], "left_semi")
    place = F.col("place")
    start, windows = F.shiftright(place, 6), F.pmod(place, F.lit(64))
    whole = same.select("_k", start.alias("lo"), (start + windows - 1 + window).alias("hi"))

    texts = materialize(_packed(docs).join(seeds.select("_k").distinct(), "_k", "left_semi").dropDuplicates(["_k"]))
    several = spans.groupBy("a").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("a")
    listed = (
        spans.join(several, "a", "left_semi")
        .groupBy("_k")
        .agg(F.collect_list(F.struct("place", (F.col("n") > 1).cast("long").alias("known"))).alias("places"))
    )
    ends = materialize(_windows(texts.join(listed, "_k").select("_k", "data", "places"), window))
    twice = ends.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    partly = ends.filter("known = 0").join(twice, "h", "left_semi").select("_k", F.col("at").alias("lo"), (F.col("at") + window).alias("hi"))
    return whole.unionByName(partly), texts


def kept_words(data: bytes, ranges: list[tuple[int, int]]) -> list[bytes]:
    words = data.split()
    edge = np.zeros(len(words) + 1, np.int64)
    for lo, hi in ranges:
        edge[lo] += 1
        edge[hi] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, out in zip(words, gone) if not out]


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per document after every word covered by a repeated window is taken out.

    doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a space), and
    ``kept_text`` for rows that lost words, else null. A window is ``window`` consecutive words of
    one document; it is repeated if its words also start anywhere else, judged on the input. Texts
    shorter than a window, empty and null ones lose nothing; of repeated rows all lose everything
    that is long enough.
    """
    ranges, texts = repeated_places(docs, window)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for k, data, own in zip(*(c.to_pylist() for c in batch.columns)):
            text = unpack(data)
            kept = kept_words(text, [(x["lo"], x["hi"]) for x in own])
            joined = b" ".join(kept)
            rows.append((k, len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "replace")))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["_k", "n_kept", "kept_sha256", "kept_text"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = [d.split() for d in utf8(batch.column(2))]
        sums = pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())
        sizes = pa.array([len(w) for w in words], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, sums], ["_k", "doc_id", "n_words", "whole_sha256"])

    grouped = ranges.groupBy("_k").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    changed = in_arrow(
        texts.join(grouped, "_k").select("_k", "data", "ranges"), cut, "_k long, n_kept long, kept_sha256 string, kept_text string"
    )
    everything = in_arrow(_rows(docs), count, "_k long, doc_id long, n_words long, whole_sha256 string")
    return everything.join(changed, "_k", "left").select(
        "doc_id",
        "n_words",
        (F.col("n_words") - F.coalesce("n_kept", "n_words")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        "kept_text",
    )
