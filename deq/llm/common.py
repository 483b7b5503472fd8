"""What several operators of this subpackage share: row keys, ranks, word digests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deq.session import materialize, prepare

#: Distinct words whose digest one Python worker remembers; beyond that it starts anew. An executor keeps idle
#: workers beside those at work, and each keeps what it remembers, so this is small: rare words cost little to digest again.
REMEMBERED = 100_000


#: Documents in a batch that goes to Python; long ones make even small batches large.
BATCH = 1000


def settled(spark: SparkSession) -> SparkSession:
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return settled(spark).read.parquet(f"{folder}/documents.parquet")


def narrowed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def key_of(doc_id: Column, text: Column) -> list[Column]:
    """Two long columns, never null, that name a row; rows alike in id and text share them."""
    return [
        F.coalesce(doc_id, F.lit(-(2**63))).alias("_a"),
        F.xxhash64(text, doc_id.isNull(), text.isNull()).alias("_b"),
    ]


def keyed(docs: DataFrame) -> DataFrame:
    slim = narrowed(docs)
    return slim.select(*key_of(F.col("doc_id"), F.col("text")), "doc_id", "text")


def boxed(docs: DataFrame, *more: Column) -> DataFrame:
    """Keys and further columns beside ``_row``, which holds all columns whatever their names."""
    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("_row")
    return docs.select(*key_of(docs["doc_id"].cast("long"), docs["text"].cast("string")), whole, *more)


def unboxed(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``_row`` again, some of them changed."""
    return rows.select(*[(changed[c] if c in changed else F.col("_row").getField(c)).alias(c) for c in columns])


def ranked(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``_rank``, gapless from 0 within each key, without bringing a key's rows into one task.

    Rows are stored with the task they came from; they are numbered within (key, task), and the
    counts of a key's tasks, summed up, give each its start.
    """
    rows = materialize(df.withColumn("_task", F.spark_partition_id()))
    counts = rows.groupBy(key, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy(key, "_task").orderBy(*order))
    return (
        rows.withColumn("_own", own - 1)
        .join(starts, [key, "_task"])
        .withColumn("_rank", F.col("_start") + F.col("_own"))
        .drop("_own", "_start", "_task")
    )


def in_arrow(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run a generator of batches over every Arrow batch."""

    def run(batches):
        for batch in batches:
            yield from step(batch)

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """A text column as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class _Digests(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        digest = self[word] = xxhash.xxh3_64_intdigest(word)
        return digest


_DIGESTS = _Digests()


def forget_digests() -> None:
    """Give the memory of word digests back; a worker that goes on to another operator calls it."""
    _DIGESTS.clear()


def word_digests(data: bytes) -> np.ndarray:
    """64-bit digests of the words of a text.

    ``bytes.split`` cuts at space and 0x09 to 0x0D, which is what the contracts call a word break.
    """
    words = data.split()
    return np.fromiter(map(_DIGESTS.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers that give each place in a window its own weight.
WEIGHTS = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def window_digests(words: np.ndarray, size: int) -> np.ndarray:
    """Digest of every run of ``size`` words, by start."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += words[j : j + n] * WEIGHTS[j]
    return mixed(total)


def shingles(data: bytes, size: int) -> np.ndarray:
    """Sorted digests of the distinct word shingles of a text; a shorter text is one shingle."""
    words = word_digests(data)
    if 0 < len(words) < size:
        return window_digests(words, len(words)) ^ WEIGHTS[len(words)]
    return np.unique(window_digests(words, size))
