"""Removal of lines that an earlier line equals, for longer lines but for one edit, by deletion neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deq.llm.common import boxed, in_arrow, keyed, mixed, unboxed
from deq.llm.substrings import _powers, unpack
from deq.session import materialize

#: Lines with fewer characters are ambiguous under an edit; only equal ones count as copies.
MIN_CHARS = 20
BREAKS = " \t\n\x0b\x0c\r"
#: Lines that a task remembers as already written.
SEEN = 200_000
#: Remainders by which lines are told apart before a shuffle.
SLOTS = 1 << 25

_KEYS = "_a long, _b long, "


def digest(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace")) - (1 << 63)


def long_lines(text: str | None, min_chars: int) -> Iterator[tuple[int, str]]:
    """Number and bare text of the lines of some length; those without a word have none."""
    for n, line in enumerate((text or "").split("\n")):
        bare = line.strip(BREAKS)
        if len(bare) >= min_chars:
            yield n, bare


#: What a line's neighbourhood has to hold: a changed place in the second or first half, a place left
#: out there, or the line as it is. The first four follow the order of ``half_keys``.
CHANGED_END, CHANGED_FRONT, LEFT_OUT_END, LEFT_OUT_FRONT, WHOLE = 1, 2, 4, 8, 16


def half_keys(line: str) -> list[int]:
    """Digests one of which two lines within one edit share.

    One edit leaves one half of the shorter line whole, at the front or at the end. A line is cut in
    halves for its own length (the first two keys), and as if it had one character less, like a line
    that lacks one of its characters (the other two).
    """
    out = []
    for size in (len(line), len(line) - 1):
        half = size // 2
        out.append(digest(f"{size} front {line[:half]}"))
        out.append(digest(f"{size} end {line[len(line) - (size - half):]}"))
    return out


def variant_keys(line: str, want: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the part of a line's deletion neighbourhood that ``want`` names, and their roles.

    Lines of one length differ in at most one place if they share a variant with the same place
    left out (role 2, whose keys name the place and the length). A line with one character more
    (role 1) has the shorter line (role 0) among its variants. Where the lines share a half, the
    place is in the other one, or in a run of equal characters that reaches it. A rolling digest
    gives all variants in one go.
    """
    codes = mixed(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1))
    n = len(codes)
    up, down = _powers(n + 1)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(codes * up[:-1], dtype=np.uint64)]
    without = sums[:-1] + (sums[-1] - sums[1:]) * down[1]
    size, place = np.full(1, n, np.uint64), np.arange(n)
    left_out = without[((place >= (n - 1) // 2) & bool(want & LEFT_OUT_END)) | ((place <= (n - 1) // 2) & bool(want & LEFT_OUT_FRONT))]
    changed = place[((place >= n // 2) & bool(want & CHANGED_END)) | ((place < n // 2) & bool(want & CHANGED_FRONT))]
    whole = mixed(sums[-1:] + size * np.uint64(0x9E3779B97F4A7C15)) if want & WHOLE else np.empty(0, np.uint64)
    plain = np.unique(mixed(left_out + (size - np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))
    placed = mixed(mixed(without[changed] + changed.astype(np.uint64)) ^ size)
    role = np.repeat(np.arange(3, dtype=np.int32), [len(whole), len(plain), len(placed)])
    return np.r_[whole, plain, placed].view(np.int64), role


def _occurrences(docs: DataFrame) -> DataFrame:
    """Places and digests of all lines that hold a word."""

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [
            (a, b, n, digest(line))
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist())
            for n, line in long_lines(text, 1)
        ]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_a", "_b", "n", "h"])

    return in_arrow(keyed(docs), emit, _KEYS + "n int, h long")


def _halves(docs: DataFrame, min_chars: int) -> DataFrame:
    """Half keys of the lines and their places in ``half_keys``; a line that a task has seen is not written again by it."""

    def emit(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, owners = [], []
            for text in batch.column("text").to_pylist():
                for _, line in long_lines(text, min_chars):
                    h = digest(line)
                    if h in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(h)
                    keys += half_keys(line)
                    owners += [h] * 4
            nth = pa.array(np.tile(np.arange(4, dtype=np.int32), len(keys) // 4))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), nth, pa.array(owners, pa.int64())], ["key", "nth", "h"])

    return docs.select(docs["text"]).mapInArrow(emit, "key long, nth int, h long")


def _candidates(docs: DataFrame, min_chars: int) -> DataFrame:
    """``h`` of the lines that share a half with a line they may be near, and what they ``want`` of their neighbourhood.

    Keys meet in one shuffle. A line that only shares halves cut for other lengths wants nothing.
    """
    group, own = Window.partitionBy("key"), F.col("nth") < 2
    halves = _halves(docs, min_chars).select(
        "h", "nth",
        (F.min(F.when(own, F.col("h"))).over(group) != F.max(F.when(own, F.col("h"))).over(group)).alias("equals"),
        F.min("nth").over(group).alias("least"),
        F.max("nth").over(group).alias("most"),
    )
    part = F.element_at(F.array(*map(F.lit, (CHANGED_END, CHANGED_FRONT, LEFT_OUT_END, LEFT_OUT_FRONT))), F.col("nth") + 1)
    near = F.when((own & F.col("equals")) | (~own & (F.col("least") < 2)), part).otherwise(0)
    want = near + F.when(own & (F.col("most") >= 2), WHOLE).otherwise(0)
    return halves.select("h", want.alias("want")).filter("want > 0").groupBy("h").agg(F.bit_or("want").alias("want"))


def _marked(wanted: DataFrame) -> np.ndarray:
    """One bit for each remainder of the wanted digests modulo ``SLOTS``, as bytes; its size is fixed."""
    slot = F.pmod("h", F.lit(SLOTS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 32).cast("int"))
    words = wanted.groupBy(F.floor(slot / 32).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    marks = np.zeros(SLOTS // 32, "<u4")
    marks[found["at"].to_numpy()] = found["bits"].to_numpy().astype("<u4")
    return marks.view(np.uint8)


def _wanted_lines(docs: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """``wanted`` with the ``line`` of each digest ``h``.

    The texts are read again; a line whose remainder no wanted digest has stays out of the shuffle.
    """
    marks = docs.sparkSession.sparkContext.broadcast(_marked(wanted))

    def emit(batches):
        bits, seen = marks.value, set()
        for batch in batches:
            found = {}
            for text in batch.column("text").to_pylist():
                for _, line in long_lines(text, min_chars):
                    h = digest(line)
                    slot = h % SLOTS
                    if bits[slot >> 3] >> (slot & 7) & 1 and h not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(h)
                        found[h] = line
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(found.values(), pa.string())], ["h", "line"])

    lines = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(emit, "h long, line string")
    return lines.join(wanted, "h").dropDuplicates(["h"])


def _variants(lines: DataFrame) -> DataFrame:
    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for h, line, want in zip(*(batch.column(c).to_pylist() for c in ("h", "line", "want"))):
            keys, role = variant_keys(line, want)
            columns = [pa.array(keys), pa.array(role), pa.array(np.full(len(keys), h, np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "role", "h"])

    return in_arrow(lines, emit, "key long, role int, h long")


def near_copies(docs: DataFrame, firsts: DataFrame, min_chars: int) -> DataFrame:
    """``h`` of lines within one edit, not equal, of a line that first occurs earlier.

    Only lines that share a half with another line get a neighbourhood, and of it what that half leaves
    open, which leaves no pair out. In each group of equal variants lines are compared with the earliest alone: those of one length and
    place all differ from each other in that place; a line one character shorter is within one edit
    of every member. The edit distance of each such pair is then verified.
    """
    wanted = materialize(firsts.join(_candidates(docs, min_chars), "h"))
    lines = materialize(_wanted_lines(docs, wanted.select("h", "want"), min_chars))
    # Few lines can have many variants: each task gets a small share of them.
    keys = _variants(lines.repartition("h"))
    group, order = Window.partitionBy("key"), F.struct("_a", "_b", "n", "h")
    extent = [f("h").over(group).alias(f"{n}_h") for n, f in (("least", F.min), ("most", F.max))]
    extent += [f("role").over(group).alias(f"{n}_role") for n, f in (("least", F.min), ("most", F.max))]
    # Lines of one length need another one; a longer line needs a shorter one, and the other way round.
    several = keys.select("key", "role", "h", *extent).filter("least_h != most_h AND (role = 2 OR (least_role = 0 AND most_role > 0))")
    groups = materialize(several.join(wanted, "h").select("key", "role", order.alias("o")))

    same = groups.filter("role = 2")
    best = same.groupBy("key").agg(F.min("o").alias("w"))
    swapped = same.join(best, "key").filter("o != w").select(F.col("o.h").alias("h"), F.col("w.h").alias("w"))
    short = groups.filter("role = 0").select("key", F.col("o").alias("s"))
    longer = groups.filter("role = 1")
    first_longer = longer.groupBy("key").agg(F.min("o").alias("w"))
    inserted = longer.join(short, "key").filter("s < o").select(F.col("o.h").alias("h"), F.col("s.h").alias("w"))
    deleted = short.join(first_longer, "key").filter("w < s").select(F.col("s.h").alias("h"), F.col("w.h").alias("w"))
    pairs = swapped.unionByName(inserted).unionByName(deleted).distinct()
    left = lines.select("h", F.col("line").alias("x"))
    right = lines.select(F.col("h").alias("w"), F.col("line").alias("y"))
    apart = F.levenshtein("x", "y", 1)
    return pairs.join(left, "h").join(right, "w").filter((apart >= 0) & (apart <= 1)).select("h").distinct()


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``_a``, ``_b`` and the sorted numbers of a row's ``removed`` lines, for rows that lose any.

    A line that holds a word goes if an earlier line equals it or, both having ``min_chars``, is one
    edit (a character put in, left out or changed) away; of the documents the order is by doc_id (null ids first), then by a digest of
    the text, then by line. Repeated rows share their key; all of them but none of their lines count
    as one document.
    """
    rows = materialize(_occurrences(docs))
    first = [F.min(F.struct("_a", "_b", "n")).alias("f"), F.count(F.lit(1)).alias("times")]
    firsts = materialize(rows.groupBy("h").agg(*first).select("h", "f._a", "f._b", "f.n", "times"))
    near = near_copies(docs, firsts.drop("times"), min_chars)
    fate = firsts.join(near.withColumn("near", F.lit(True)), "h", "left").select(
        "h", F.struct("_a", "_b", "n").alias("f"), F.coalesce("near", F.lit(False)).alias("near"), "times"
    )
    # A line that occurs once and is near no other stays, so its rows need not be looked up.
    fate = fate.filter(F.col("near") | (F.col("times") > 1)).drop("times")
    gone = rows.join(fate, "h").filter(F.col("near") | (F.struct("_a", "_b", "n") != F.col("f")))
    return gone.groupBy("_a", "_b").agg(F.array_sort(F.collect_set("n")).alias("removed"))


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_removed and the numbers (from 0) of the ``removed`` lines, per document.

    A null or empty text is one empty line, which stays; so do all lines without a word.
    """
    own = keyed(docs).select("_a", "_b", "doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return own.join(repeated_lines(docs, min_chars), ["_a", "_b"], "left").select(
        "doc_id", "n_lines", F.size(F.coalesce("removed", none)).cast("long").alias("n_removed"), F.coalesce("removed", none).alias("removed")
    )


def _squeezed(text: pd.Series) -> pd.Series:
    press = zstandard.ZstdCompressor(level=3)
    return text.map(lambda t: None if t is None else press.compress(t.encode()))


def _cut(data: pd.Series, removed: pd.Series) -> pd.Series:
    def one(d, gone):
        if d is None:
            return None
        text = unpack(d).decode()
        if gone is None or not len(gone):
            return text
        out = set(gone)
        return "\n".join(line for n, line in enumerate(text.split("\n")) if n not in out)

    return pd.Series([one(d, g) for d, g in zip(data, removed)])


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, drop_emptied: bool = False) -> DataFrame:
    """The documents, all columns, with their repeated lines taken out of the text.

    All rows stay, unless ``drop_emptied`` asks to drop those that lost lines and have no word left.
    """
    gone = repeated_lines(docs, min_chars)
    squeezed, cut = F.pandas_udf(_squeezed, "binary"), F.pandas_udf(_cut, "string")
    rows = boxed(docs, squeezed("text").alias("_data"))
    # The text travels compressed, not beside that in the box.
    rows = rows.withColumn("_row", F.col("_row").dropFields("text"))
    left = rows.join(gone, ["_a", "_b"], "left").withColumn("_text", cut("_data", "removed"))
    if drop_emptied:
        left = left.filter(F.col("removed").isNull() | (F.btrim("_text", F.lit(BREAKS)) != ""))
    return unboxed(left, docs.columns, text=F.col("_text"))
