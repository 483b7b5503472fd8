"""How the sources of a language differ in their words: pairs of sources, and the terms that mark a source."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deq.llm.common import utf8
from deq.session import materialize

#: Entries a task counts before it hands them on.
COUNTED = 250_000

#: Counted rows that one group of terms of a language is meant to hold.
GROUP_ROWS = 200_000

#: Cells of the matrix of sources by terms that one step compares.
CELLS = 2_000_000

#: Groups whose skybands one step merges.
FAN_IN = 16

#: A-Z become a-z, other letters and bytes beyond ASCII stay, all else becomes a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def shares(counts: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), by long division, so that nothing overflows."""
    whole = np.asarray(total, np.int64) + 5 * kept
    rest = np.asarray(counts, np.int64) + 5
    share = np.zeros(np.broadcast(rest, whole).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // whole
        rest = rest % whole
    return share + 1


def skyband(counts: np.ndarray, lang_counts: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the terms that fewer than ``k`` others dominate.

    A term dominates another if its group count is not lower, its language count not higher and it
    comes earlier in UTF-8 (``places``). In the order taken here all that dominate a term come before
    it, and ``k`` dominating terms always include ``k`` that are kept themselves.
    """
    order = np.lexsort((places, lang_counts, -counts))
    kept, by_lang, by_place = [], np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    for i in order:
        n = len(kept)
        if n >= k and np.count_nonzero((by_lang[:n] <= lang_counts[i]) & (by_place[:n] <= places[i])) >= k:
            continue
        by_lang[n], by_place[n] = lang_counts[i], places[i]
        kept.append(i)
    return np.array(kept, np.int64)


def _places(terms: pa.Array) -> np.ndarray:
    """The place of each term in the UTF-8 order of all of them."""
    _, place = np.unique(np.array(terms.cast(pa.binary()).to_pylist(), object), return_inverse=True)
    return place


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    entries = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            for at in range(0, len(terms), 100_000):
                part = terms[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([n[t] for t in part], pa.int64()),
                        pa.array([docs[t] for t in part], pa.int64()),
                    ],
                    names,
                )
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
            terms = terms_of(text)
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(terms)
            docs.update(set(terms))
            entries += len(n) - before
            if entries > COUNTED:
                yield from handed_on()
                entries = 0
    yield from handed_on()


BAND = "lang string, source string, item string, counted long, lang_counted long, value long, bucket long"


def _audited(k: int):
    """Sums over the pairs of sources, and skybands, of one group of terms of a language."""

    def audit(key, rows: pa.Table, sources: pa.Table) -> pa.Table:
        lang, bucket = key[0].as_py(), key[1].as_py()
        names = sources.column("source").to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        names = [names[i] for i in order]
        number = {name: i for i, name in enumerate(names)}
        totals = sources.column("total").to_numpy()[order]
        kept, lang_total = sources.column("kept")[0].as_py(), sources.column("lang_total")[0].as_py()
        out = []

        def add(source, item, counted, lang_counted, value) -> None:
            n = len(value)
            out.append(
                pa.table(
                    [
                        pa.array([lang] * n, pa.string()), source, item, pa.array(counted, pa.int64()),
                        pa.array(lang_counted, pa.int64()), pa.array(value, pa.int64()), pa.array([bucket] * n, pa.int64()),
                    ],
                    ["lang", "source", "item", "counted", "lang_counted", "value", "bucket"],
                )
            )

        terms = rows.column("term").combine_chunks()
        source = np.array([number[s] for s in rows.column("source").to_pylist()], np.int64)
        counted, lang_counted = rows.column("n").to_numpy(), rows.column("lang_n").to_numpy()
        place = _places(terms) if len(terms) else np.empty(0, np.int64)
        n_terms = int(place.max()) + 1 if len(place) else 0

        apart = np.zeros((len(names), len(names)), np.int64)
        by_place = np.argsort(place, kind="stable")
        step = max(1, CELLS // max(1, len(names)))
        for at in range(0, n_terms, step):
            lo, hi = np.searchsorted(place, [at, at + step], sorter=by_place)
            some = by_place[lo:hi]
            table = np.zeros((len(names), min(step, n_terms - at)), np.int64)
            table[source[some], place[some] - at] = counted[some]
            table = shares(table, totals[:, None], kept)
            for i in range(len(names) - 1):
                apart[i, i + 1 :] += np.abs(table[i + 1 :] - table[i]).sum(axis=1)
        one, other = np.triu_indices(len(names), 1)
        nulls = pa.nulls(len(one), pa.int64())
        text = np.array(names, object)
        add(pa.array(text[one], pa.string()), pa.array(text[other], pa.string()), nulls, nulls, apart[one, other])

        if len(terms):
            more = shares(counted, totals[source], kept) - shares(lang_counted, lang_total, kept)
            for i in range(len(names)):
                own = np.flatnonzero((source == i) & (more > 0))
                own = own[skyband(counted[own], lang_counted[own], place[own], k)]
                if len(own):
                    add(pa.array([names[i]] * len(own), pa.string()), terms.take(pa.array(own)), counted[own], lang_counted[own], more[own])
        return pa.concat_tables(out)

    return audit


def _merged(k: int):
    def merge(rows: pa.Table) -> pa.Table:
        place = _places(rows.column("item").combine_chunks())
        own = skyband(rows.column("counted").to_numpy(), rows.column("lang_counted").to_numpy(), place, k)
        return rows.take(pa.array(own))

    return merge


def source_divergence(docs: DataFrame, min_docs: int = 30, k: int = 50) -> DataFrame:
    """How far the sources of each language lie apart, and the ``k`` terms that mark each source most.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased; each language keeps
    those of at least ``min_docs`` of its documents. A share is 1 + floor(10^9 (count + 5) /
    (N + 5 V)). Part ``pair`` gives for every other source of the language the sum of differences of
    shares over the kept terms, part ``term`` the terms whose share in the source is above that in
    the language, by difference. As the difference never falls with a higher count in the source
    or a lower one in the language, the best ``k`` lie in the k-skyband of (group count, language
    count, UTF-8 place). Each group of terms keeps its skyband, skybands are merged, what is
    left is ranked exactly.

    Null text, language and source count as empty; an empty language or source is a group like
    others. Groups without kept terms have pairs alone (difference 0 if the language keeps none);
    the only source of a language has no pairs. Repeated rows count each; an empty table gives no
    rows. Only lang, source and text are read. Counts are summed in each task before they are
    shuffled; terms of a language are dealt to groups of about ``GROUP_ROWS`` counted rows.
    """
    slim = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = slim.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counted = materialize(
        counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    by_lang = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    by_lang = by_lang.where(F.col("docs") >= min_docs).drop("docs")
    rows = materialize(counted.drop("docs").join(by_lang, ["lang", "term"]))

    groups = materialize(slim.select("lang", "source").distinct())
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    langs = rows.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")
    )
    sources = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    of_lang = Window.partitionBy("lang")
    sources = materialize(
        sources.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.sum("rows").over(of_lang) / GROUP_ROWS)).cast("long"))
    )
    buckets = sources.select("lang", "buckets").distinct()
    dealt = rows.join(buckets, "lang").withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")))
    everywhere = sources.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))
    audited = materialize(
        dealt.select("lang", "bucket", "source", "term", "n", "lang_n")
        .groupBy("lang", "bucket")
        .cogroup(everywhere.select("lang", "bucket", "source", "total", "kept", "lang_total").groupBy("lang", "bucket"))
        .applyInArrow(_audited(k), BAND)
    )
    one_way = audited.where("counted IS NULL").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = one_way.select("lang", "value", both.alias("_way")).select(
        "lang", "_way.source", F.lit("pair").alias("part"), "_way.item", "value"
    )

    band = audited.where("counted IS NOT NULL")
    most = sources.agg(F.max("buckets")).first()[0] or 1
    while most > 1:
        band = band.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("long"))
        band = band.groupBy("lang", "source", "bucket").applyInArrow(_merged(k), BAND)
        most = -(-most // FAN_IN)
    terms = band.select("lang", "source", F.lit("term").alias("part"), "item", "value")

    best = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.unionByName(pairs.withColumn("rank", F.row_number().over(best)))
