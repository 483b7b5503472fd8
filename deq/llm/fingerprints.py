"""Threshold-scaled sketches of word shingles, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deq.llm.common import narrowed
from deq.llm.quality import let, words_of

#: One shingle hash in SCALE is kept.
SCALE = 8
SHINGLE = 5

#: Ranges of ids by approximate quantiles, and equal parts of each, within which ids are ordered.
QUANTILES = 64
PARTS = 16


def sketch(text: Column, scale: int = SCALE, size: int = SHINGLE) -> Column:
    """Sorted distinct shingle hashes below one ``scale``-th of the range, and the least one.

    A text of fewer words is one shingle; a text without words has an empty sketch. Keeping the
    least hash gives every other text a sketch; hashes count as unsigned. Sketches merge: the union
    of two, cut in the same way, is the sketch of both texts' shingles together.
    """
    limit = (1 << 63) // scale

    def hashes(words):
        digests = F.transform(words, lambda w: F.xxhash64(w))

        def windows(d):
            last = F.size(d) - size
            whole = F.array(F.shiftrightunsigned(F.xxhash64(d), 1))
            at = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(d, i + j) for j in range(size)]), 1)
            return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at)).when(F.size(d) > 0, whole).otherwise(
                F.array().cast("array<bigint>")
            )

        return let(digests, windows)

    def kept(found):
        least = F.array_min(found)
        return F.array_sort(F.array_distinct(F.filter(found, lambda h: h < limit))), least

    def cut(found):
        below, least = kept(found)
        return let(below, lambda b: F.when((F.size(b) == 0) & least.isNotNull(), F.array(least)).otherwise(b))

    return let(let(words_of(text), hashes), cut)


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both; two empty sketches are alike."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        let(_shared(a, b), lambda n: n.cast("double") / (F.size(a) + F.size(b) - n))
    )


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other holds, however unequal."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least == 0, (F.size(a) == F.size(b)).cast("double")).otherwise(_shared(a, b).cast("double") / least)


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of the shingles of two sketches together."""
    limit = (1 << 63) // scale
    both = F.array_sort(F.array_union(a, b))
    return F.when(F.size(F.filter(both, lambda h: h < limit)) > 0, F.filter(both, lambda h: h < limit)).otherwise(F.slice(both, 1, 1))


def written(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, carried: list[str], quantiles: int = QUANTILES, parts: int = PARTS) -> DataFrame:
    """Add ``next``: ``carried`` columns of the document with the next lower id; after the last, the first.

    Ids are cut into ranges, by approximate quantiles and equal parts of these, and ordered within
    each; the first row of the following range is added to the end of each range, so at most one row
    per range is copied. Rows of one id are ordered by text; null ids come last. A single document
    follows itself.
    """
    slim = docs.withColumn("_tie", F.xxhash64("text"))
    bounds = slim.agg(F.percentile_approx("doc_id", [i / quantiles for i in range(quantiles + 1)], 10_000)).first()[0]
    bounds = sorted(set(bounds or [0]))
    low = F.array(*[F.lit(b).cast("long") for b in bounds])
    high = F.array(*[F.lit(b).cast("long") for b in [*bounds[1:], bounds[-1] + 1]])
    coarse = let(F.size(F.filter(low, lambda b: b <= F.col("doc_id"))) - 1, lambda i: F.greatest(i, F.lit(0)))

    def fine(i):
        width = F.get(high, i).cast("double") - F.get(low, i).cast("double")
        part = F.floor((F.col("doc_id").cast("double") - F.get(low, i).cast("double")) / width * parts)
        return (i * parts + F.greatest(F.lit(0), F.least(part, F.lit(parts - 1)))).cast("int")

    ranged = slim.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(let(coarse, fine)))
    keys = ranged.groupBy("_range").agg(F.max("doc_id").alias("_d")).join(
        ranged.groupBy("_range", "doc_id").agg(F.min("_tie").alias("_t")).withColumnRenamed("_range", "_r"),
        (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_d")),
    )
    # One row per range: at most quantiles times parts, and one for null ids.
    across = Window.orderBy(F.col("_range"))
    upper = F.coalesce(F.lead("_range").over(across), F.min("_range").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    firsts = keys.select(upper.alias("_into"), "_d", "_t")
    ends = (
        ranged.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_tie") == F.col("_t")))
        .drop("_range", "_d", "_t")
        .withColumnRenamed("_into", "_range")
        .dropDuplicates(["_range"])
        .select(*ranged.columns, F.lit(1).alias("_end"))
    )
    order = Window.partitionBy("_range").orderBy("_end", F.col("doc_id").desc_nulls_last(), "_tie")
    rows = ranged.withColumn("_end", F.lit(0)).unionByName(ends)
    following = F.lead(F.struct(*carried)).over(order)
    return rows.withColumn("next", following).filter(F.col("_end") == 0).drop("_end", "_range", "_tie")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half of code points replaced by the first as many of another."""
    whole, other = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    n = F.char_length(whole)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(whole, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def fingerprint_table(docs: DataFrame, scale: int = SCALE, size: int = SHINGLE) -> DataFrame:
    """One row per document: its sketch, that of its edited text, and likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex, 16 digits a hash),
    near_edited, near_next (shared part of both sketches), contained_edited, contained_next (part of
    the smaller sketch). Null texts count as empty.
    """
    empty = F.lit("")
    slim = narrowed(docs).select("doc_id", F.coalesce("text", empty).alias("text"))
    rows = with_next(slim.withColumn("_own", sketch(F.col("text"), scale, size)), ["text", "_own"])
    rows = rows.withColumn("_edited", edited(F.col("text"), F.col("next.text"))).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        "_own",
        sketch(F.col("_edited"), scale, size).alias("_ed"),
        F.col("next._own").alias("_nx"),
    )
    own, ed, nx = F.col("_own"), F.col("_ed"), F.col("_nx")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", written(own).alias("fingerprint"), written(ed).alias("edited_fingerprint"),
        likeness(own, ed).alias("near_edited"), likeness(own, nx).alias("near_next"),
        containment(own, ed).alias("contained_edited"), containment(own, nx).alias("contained_next"),
    )
