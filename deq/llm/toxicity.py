"""Toxicity by non-negative positive-unlabelled learning over hashed words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import _DIGESTS, in_arrow, keyed, narrowed, utf8

#: Weights of the model; words share one of them by hash.
WEIGHTS = 1 << 18
#: At most so many confirmed toxic and so many unlabelled documents are fitted.
POSITIVES = 3000
UNLABELLED = 9000
#: Words in fewer documents of the sample get no weight.
MIN_DOCUMENTS = 5

#: Strengths of the soft threshold that are tried.
SPARSITIES = (5e-5, 1e-4, 3e-4, 1e-3)

_EDGES = b".,;:!?\"'()[]{}<>#*$%&|"


def word_cells(data: bytes) -> np.ndarray:
    """Cells of the distinct words of a text, without case (A-Z) and edge punctuation."""
    words = {w.strip(_EDGES) for w in data.lower().split()}
    words.discard(b"")
    digests = np.fromiter(map(_DIGESTS.__getitem__, words), np.uint64, len(words))
    return np.unique((digests >> np.uint64(20)).astype(np.int64) & (WEIGHTS - 1))


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All cells in a row, and the document of each."""
    if not sets:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 200, rate: float = 0.1, sparsity: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimize the non-negative positive-unlabelled risk.

    With the logistic loss l and the class prior p, the risk is p E+[l(f, 1)] + max(0, Eu[l(f, -1)]
    - p E+[l(f, -1)]): the second part estimates the risk on negatives from unlabelled documents,
    less what the positives among them add. Where that estimate turns negative, which no true risk
    does, its gradient is followed upwards. Weights are soft-thresholded, so most are zero.
    """
    weights, bias = np.zeros(WEIGHTS), float(np.log(prior / (1 - prior))) if 0 < prior < 1 else 0.0
    if not positive or not unlabelled or not 0 < prior < 1:
        return weights, bias if positive else -40.0
    (cp, rp), (cu, ru) = _flat(positive), _flat(unlabelled)
    seen = np.bincount(cp, minlength=WEIGHTS) + np.bincount(cu, minlength=WEIGHTS)
    used = np.flatnonzero(seen >= MIN_DOCUMENTS)
    place = np.full(WEIGHTS, -1)
    place[used] = np.arange(len(used))
    keep_p, keep_u = place[cp] >= 0, place[cu] >= 0
    cp, rp, cu, ru = place[cp[keep_p]], rp[keep_p], place[cu[keep_u]], ru[keep_u]
    theta = np.zeros(len(used))
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    n, m = len(positive), len(unlabelled)
    for step in range(1, steps + 1):
        fp = np.bincount(rp, theta[cp], n) + bias
        fu = np.bincount(ru, theta[cu], m) + bias
        sp, su = _sigmoid(fp), _sigmoid(fu)
        negative = np.mean(np.logaddexp(0, fu)) - prior * np.mean(np.logaddexp(0, fp))
        if negative >= 0:
            gp, gu = (prior / n) * (sp - 1) - (prior / n) * sp, su / m
        else:
            gp, gu = (prior / n) * sp, -su / m
        gradient = np.r_[np.bincount(cp, gp[rp], len(used)) + np.bincount(cu, gu[ru], len(used)), gp.sum() + gu.sum()]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        pace = rate * sparsity / (np.sqrt(second[:-1] / (1 - 0.999**step)) + 1e-8)
        theta = theta - move[:-1]
        theta = np.sign(theta) * np.maximum(np.abs(theta) - np.minimum(pace, rate), 0.0)
        bias -= move[-1]
    weights[used] = theta
    return weights, bias


def _outputs(sets: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    cells, rows = _flat(sets)
    return np.bincount(rows, weights[cells], len(sets)) + bias


def fit_checked(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, threshold: float = 0.7
) -> tuple[np.ndarray, float]:
    """Fit with the sparsity and the bias that do best on a quarter of the sample kept aside.

    Without known negatives, recall squared over the share called positive takes the place of the
    F measure, to which it is proportional. The bias is moved so that the best cut scores ``threshold``.
    """

    def parts(x):
        return [s for i, s in enumerate(x) if i % 4], x[::4]

    (fp, cp), (fu, cu) = parts(positive), parts(unlabelled)
    if len(cp) < 5 or len(cu) < 5:
        return fit(positive, unlabelled, prior)
    best = (-1.0, 0.0, 0.0)
    for sparsity in SPARSITIES:
        model = fit(fp, fu, prior, sparsity=sparsity)
        zp, zu = np.sort(_outputs(cp, *model)), np.sort(_outputs(cu, *model))
        for rank, cut in enumerate(zp):
            at = np.searchsorted(zu, cut)
            worth = ((len(zp) - rank) / len(zp)) ** 2 / max((len(zu) - at) / len(zu), 1 / len(zu))
            if worth > best[0]:
                below = zu[at - 1] if at else cut
                best = (worth, sparsity, float(np.log(threshold / (1 - threshold)) - (cut + below) / 2))
    weights, bias = fit(positive, unlabelled, prior, sparsity=best[1])
    return weights, bias + best[2]


def _sample(rows: DataFrame, chosen: DataFrame, limit: int, mark: int) -> list[np.ndarray]:
    """Cells of at most ``limit`` of the chosen rows, the least by a hash of their id and text."""

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [word_cells(d) for d in utf8(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], ["cells"])

    # Only keys are sorted; the few that are drawn, at most ``limit``, are joined to the texts.
    order = F.xxhash64("_a", "_b", F.lit(mark))
    drawn = chosen.select("_a", "_b").distinct().orderBy(order).limit(limit)
    texts = rows.join(F.broadcast(drawn), ["_a", "_b"]).select("text").limit(limit)
    return [np.asarray(r[0], np.int64) for r in in_arrow(texts, emit, "cells array<bigint>").collect()]


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[np.ndarray, float]:
    """Fit on labels of rows that are not held out; ``positives`` and ``unlabelled`` bound the sample.

    Documents with toxic = 1 are the positives. Unlabelled are any documents not held out, whatever
    their label. The class prior is the toxic share of all labels that may be used.
    """
    # A label table names a document once; if not, one toxic mark is enough.
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marks = marks.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    rows = keyed(docs).filter(~held_out())
    toxic = rows.select("_a", "_b", "doc_id").join(marks.filter("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    return fit_checked(_sample(rows, toxic, positives, 1), _sample(rows, rows, unlabelled, 2), float(prior))


def held_out():
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id is held out."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(True))


def scored(docs: DataFrame, weights: np.ndarray, bias: float, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted. Null texts count as empty."""
    session = docs.sparkSession.sparkContext
    model = session.broadcast((weights.astype(np.float32), float(bias)))

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        theta, offset = model.value
        cells, rows = _flat([word_cells(d) for d in utf8(batch.column(2))])
        z = np.bincount(rows, theta[cells], batch.num_rows) + offset
        p = _sigmoid(z)
        arrays = [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    slim = narrowed(docs)
    rows = slim.select("doc_id", held_out().alias("held_out"), "text")
    return in_arrow(rows, emit, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model fitted to the labels that may be used."""
    return scored(docs, *train(docs, labels))
