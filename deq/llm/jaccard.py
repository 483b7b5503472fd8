"""Set-similarity self-join on word n-grams with prefix, length, positional and suffix filters."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deq.llm.common import boxed, in_arrow, keyed, mixed, narrowed, shingles, unboxed, utf8
from deq.llm.components import components
from deq.llm.substrings import unpack
from deq.session import materialize

#: Shingle frequencies are counted in this many cells; rare-first order needs no exact count.
CELLS = 1 << 20
SLICES = 32
#: Parts of the hash range whose sizes the suffix filter compares.
PARTS = 8
#: Rounds in which each list is compared with one member before all that is left is compared.
STAR_ROUNDS = 2
#: A shingle whose cell holds more than one in this many of all shingles is dealt to SALTS tasks.
HOT_SHARE = 10_000
SALTS = 64
#: Groups per slice in which the tasks' counts are first summed up.
MERGES = 256

_MASK = np.uint64(CELLS - 1)


def set_digest(shingle_set: np.ndarray) -> int:
    """A digest of a set of shingles; sets with one digest are one class."""
    if not len(shingle_set):
        return 0
    total = np.sum(mixed(shingle_set ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(mixed(np.array([total ^ np.uint64(len(shingle_set))], np.uint64)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, column: str, size: int) -> list[np.ndarray]:
    return [shingles(d.lower(), size) for d in utf8(batch.column(column))]


def classes(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Rows with their class, and how often shingles fall into each cell, from one scan.

    Rows hold keys, doc_id, n_shingles and the class ``c`` of equal shingle sets (null if empty).
    The counts cover all documents; their array has a fixed size.
    """
    width = CELLS // SLICES
    names = ["_a", "_b", "doc_id", "n_shingles", "c", "slice", "data"]

    def emit(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            sets = _sets(batch, "text", size)
            digests = [set_digest(s) if len(s) else None for s in sets]
            if sets:
                total += np.bincount((np.concatenate(sets) & _MASK).astype(np.int64), minlength=CELLS)
            columns = [*batch.columns[:3], pa.array(map(len, sets), pa.int64()), pa.array(digests, pa.int64())]
            none = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *none], names)
        parts = [zlib.compress(total[i * width : (i + 1) * width].astype("<i8").tobytes(), 1) for i in range(SLICES)]
        blank = [pa.nulls(SLICES, pa.int64()) for _ in range(5)]
        yield pa.RecordBatch.from_arrays([*blank, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names)

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for data in table.column("data").to_pylist():
            total += np.frombuffer(zlib.decompress(data), "<i8")
        merged = zlib.compress(total.astype("<i8").tobytes(), 1)
        return pa.table([table.column("slice").slice(0, 1), pa.array([merged], pa.binary())], ["slice", "data"])

    schema = "_a long, _b long, doc_id long, n_shingles long, c long, slice int, data binary"
    both = materialize(keyed(docs).mapInArrow(emit, schema))
    counted = both.filter("slice is not null").select("slice", "data")
    # Summed up in two levels, so that no group holds what every task has written.
    some = counted.groupBy("slice", F.pmod(F.xxhash64("data"), F.lit(MERGES)))
    counted = some.applyInArrow(merge, "slice int, data binary")
    counts = np.zeros(CELLS, np.int64)
    for row in counted.groupBy("slice").applyInArrow(merge, "slice int, data binary").collect():
        counts[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["data"]), "<i8")
    return both.filter("slice is null").drop("slice", "data"), counts


def prefixes(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """Postings: shingle ``t``, ``salt``, class ``c``, set size and place in rare-first order, ``parts``.

    Two sets that share ``percent`` of their union share one of the first n - ceil(percent * n) + 1
    shingles of any common order; the order here is by frequency cell, then by hash. A class that a
    task has seen is not written again by it. ``at`` holds the size above its 32nd bit and the place
    below. ``salt`` is -1, but for a shingle that may hold more than its share a part of 0 to SALTS - 1,
    by class.
    """
    limit = counts.sum() / HOT_SHARE
    frequent = docs.sparkSession.sparkContext.broadcast(counts.astype(np.float32))
    shift = np.uint64(64 - PARTS.bit_length() + 1)

    def emit(batches):
        seen: set[int] = set()
        counts = frequent.value
        for batch in batches:
            out = {name: [] for name in ("t", "salt", "c", "at", "parts")}
            for s in _sets(batch, "text", size):
                c = set_digest(s)
                if not len(s) or c in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(c)
                n = len(s)
                first = n + (-n * percent) // 100 + 1
                often = counts[(s & _MASK).astype(np.int64)]
                order = np.argsort(often, kind="stable")[:first]
                spread = np.bincount((s >> shift).astype(np.int64), minlength=PARTS)
                # Shares in 255ths, rounded up, so that the filter never underrates an overlap.
                share = -(-spread * 255 // n)
                parts = int.from_bytes(share.astype(np.uint8).tobytes(), "little", signed=True)
                out["t"].append(s[order].view(np.int64))
                out["salt"].append(np.where(often[order] > limit, c % SALTS, -1))
                out["at"].append((n << 32) + np.arange(first))
                for name, value in (("c", c), ("parts", parts)):
                    out[name].append(np.full(first, value, np.int64))
            columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out.values()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], list(out))

    return narrowed(docs).select("text").mapInArrow(emit, "t long, salt long, c long, at long, parts long")


def shared(postings: DataFrame) -> DataFrame:
    """The postings ``t, c, n, i, parts`` of shingles that several classes have, each once.

    One shuffle: a shingle's postings meet in one task, and those that one class alone has end there.
    A shingle that may be hot is spread by class and kept unseen; a list of one class gives no pair.
    """
    once = postings.repartition("t", "salt").groupBy("t", "salt", "c").agg(F.min("at").alias("at"), F.min("parts").alias("parts"))
    own = Window.partitionBy("t", "salt")
    seen = once.withColumns({"a": F.min("c").over(own), "b": F.max("c").over(own)}).filter("a != b or salt >= 0")
    size, place = F.shiftright("at", 32), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    return seen.select("t", "c", size.alias("n"), place.alias("i"), "parts")


def possible(x: str, y: str, percent: int) -> Column:
    """Whether two postings of one shingle can belong to similar sets, by length, place and suffix.

    The overlap is at least percent / (100 + percent) of both sizes. If the shingle at places i and j is
    the first that both have, nothing before it is common, so it and what follows in the shorter rest
    must be enough. At later common shingles this may refuse a pair, but similar sets pass at their
    first one, which both prefixes hold. And no part of the hash range holds more common shingles
    than either set has there.
    """
    n, m, i, j = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.i"), F.col(f"{y}.i")
    length = (100 * F.least(n, m)) >= (percent * F.greatest(n, m))
    place = F.least(n - i, m - j) * (100 + percent) >= percent * (n + m)

    def part(side, size, k):
        return F.shiftright(F.col(f"{side}.parts"), 8 * k).bitwiseAND(F.lit(255).cast("long")) * size

    shared = sum((F.least(part(x, n, k), part(y, m, k)) for k in range(1, PARTS)), F.least(part(x, n, 0), part(y, m, 0)))
    suffix = shared * (100 + percent) >= 255 * percent * (n + m)
    return length & place & suffix


def _pairs(left: DataFrame, right: DataFrame, percent: int, other: Column) -> DataFrame:
    joined = left.alias("x").join(right.alias("y"), F.col("x.t") == F.col("y.t")).filter(other & possible("x", "y", percent))
    return joined.select(F.least("x.c", "y.c").alias("u"), F.greatest("x.c", "y.c").alias("v")).distinct()


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("c")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets share ``percent`` of their union, with exact counts.

    Compressed texts travel, which are smaller than their sets of digests; the sets are made again
    where a pair meets, that of ``v``, by which the pairs are sorted, once for all pairs in a row.
    """

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        u, v, x, y = (batch.column(i) for i in range(4))
        keep, last, right = np.zeros(batch.num_rows, bool), None, None
        for row, key in enumerate(v.to_pylist()):
            if key != last:
                last, right = key, shingles(unpack(y[row].as_py()), size)
            left = shingles(unpack(x[row].as_py()), size)
            common = len(np.intersect1d(left, right, assume_unique=True))
            keep[row] = 100 * common >= percent * (len(left) + len(right) - common)
        yield pa.RecordBatch.from_arrays([u.filter(pa.array(keep)), v.filter(pa.array(keep))], ["u", "v"])

    # Of the texts only those that are compared move.
    texts = texts.join(_members(pairs), "c", "left_semi")
    left = texts.select(F.col("c").alias("u"), F.col("data").alias("x"))
    right = texts.select(F.col("c").alias("v"), F.col("data").alias("y"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y")
    return in_arrow(both, check, "u long, v long")


def _class_texts(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``c`` and the compressed lower-cased text of the wanted classes, each from one of its rows."""

    def squeeze(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        data = pa.array([press.compress(d.lower()) for d in utf8(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], data], ["_a", "_b", "data"])

    chosen = rows.join(wanted, "c", "left_semi").groupBy("c").agg(F.min_by("_b", "_a").alias("_b"), F.min("_a").alias("_a"))
    # Stored, so that its size is known when it meets the texts.
    chosen = materialize(chosen)
    texts = in_arrow(keyed(docs), squeeze, "_a long, _b long, data binary").join(chosen, ["_a", "_b"])
    return texts.select("c", "data").dropDuplicates(["c"])


def similar_classes(docs: DataFrame, rows: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """``c`` and ``m``: classes of equal sets and the least class of their component, where they differ.

    Postings of shingles with one class are dropped. In the star rounds the members of each
    shingle's list are compared with one of them: first that in whose order the shingle comes
    earliest, which is the text the others were made from, as their own changes are rare and come
    first; next one by a hash that is the same for all lists. Then lists are reduced to those that
    still hold several components, and of these all pairs across components are compared. Pairs inside a component cannot change the result and are never
    made, so a group of copies costs its rows, not its pairs. Each pair is verified once.
    """
    lists = materialize(shared(prefixes(docs, counts, size, percent)))
    texts, done, links = None, None, None
    for stage in range(STAR_ROUNDS + 1):
        current = lists.withColumn("m", F.col("c"))
        if links is not None:
            found = components(links)
            current = lists.join(found.withColumnRenamed("u", "c").withColumnRenamed("m", "_m"), "c", "left")
            current = current.withColumn("m", F.coalesce("_m", "c")).drop("_m")
            mixed_lists = current.groupBy("t").agg(F.min("m").alias("a"), F.max("m").alias("b")).filter("a != b").select("t")
            current = materialize(current.join(mixed_lists, "t", "left_semi"))
            lists = current.drop("m")
        if stage < STAR_ROUNDS:
            chance = F.xxhash64("c", F.lit(stage)).bitwiseAND(F.lit(0xFFFFFFFF))
            rank = chance if stage else F.shiftleft("i", 32) + chance
            hub = current.groupBy("t").agg(F.min_by("c", rank).alias("c"))
            hubs = current.join(hub, ["t", "c"], "left_semi")
            pairs = _pairs(current, hubs, percent, F.col("x.m") != F.col("y.m"))
        else:
            pairs = _pairs(current, current, percent, F.col("x.m") < F.col("y.m"))
        if done is not None:
            pairs = pairs.join(done, ["u", "v"], "left_anti")
        pairs = materialize(pairs)
        done = pairs if done is None else done.unionByName(pairs)
        wanted = _members(pairs)
        if texts is not None:
            wanted = wanted.join(texts.select("c"), "c", "left_anti")
        wanted = materialize(wanted)
        if not wanted.isEmpty():
            own = materialize(_class_texts(docs, rows, wanted))
            texts = own if texts is None else texts.unionByName(own)
        if texts is None:
            continue
        new = verified(pairs, texts, size, percent)
        links = materialize(new if links is None else links.unionByName(new))
    if links is None:
        return rows.select("c", F.col("c").alias("m")).limit(0)
    return components(links).withColumnRenamed("u", "c")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]``; a document's set holds its distinct
    shingles of ``size`` words, or all its words as one if there are fewer. Two documents link when
    100 * common >= percent * union. component_id is the smallest doc_id that links reach. A null or
    blank text has no set and is linked with nothing; a null doc_id counts as larger than any other.
    """
    return _named(docs, size, percent).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _named(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Keys, doc_id, n_shingles, component ``m`` and its smallest id, per row."""
    rows, counts = classes(docs, size)
    linked = similar_classes(docs, rows, counts, size, percent)
    named = rows.join(linked, "c", "left").withColumn("m", F.coalesce("m", "c"))
    smallest = materialize(named.filter(F.col("m").isNotNull()).groupBy("m").agg(F.min("doc_id").alias("component_id")))
    return named.join(smallest, "m", "left")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, without those that are near copies of one that stays.

    Of a group the row with the smallest doc_id stays (null ids last, then by text); rows alike in
    id and text count as one, of which one stays. Rows without words all stay.
    """
    named = _named(docs, size, percent).filter(F.col("m").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("last"), "_a", "_b")
    first = named.groupBy("m").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("rows")).select(
        "m", F.col("f._a").alias("_a"), F.col("f._b").alias("_b")
    )
    copies = named.select("m", "_a", "_b").distinct()
    gone = copies.join(first.withColumn("_stays", F.lit(True)), ["m", "_a", "_b"], "left").filter("_stays is null").select("_a", "_b")
    again = named.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_a", "_b", F.lit(True).alias("_again"))
    marked = boxed(docs).join(gone, ["_a", "_b"], "left_anti")
    marked = marked.join(again, ["_a", "_b"], "left")
    single = marked.filter(F.col("_again").isNull())
    repeated = marked.filter("_again").dropDuplicates(["_a", "_b"])
    return unboxed(single.unionByName(repeated), docs.columns)
