"""Exact quantiles that never gather one group in one task.

Quantiles of whole columns (:func:`column_quantiles`) are found by narrowing: sketches of bounded size
give a range for each wanted rank, exact counts check it, and only the values of a small range are
sorted. For quantiles by key, ``percentile`` keeps every distinct value of a group in one buffer. Here the values are counted
first (a hot value shrinks to one row per task), then range-partitioned, so that the running
count inside a range starts from the totals of the ranges before it. Only the ranges that hold a
wanted rank are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deq.session import literal_rows, materialize

#: A sketch places a value within this share of the ranks, and its size grows with the inverse.
ACCURACY = 10_000

#: Rows of a range that are sorted in one task; a larger range is narrowed further.
SMALL = 1_000_000


def ranged_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, value, n, part``: how often each value occurs, with the range it fell in."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange(*[F.col(k) for k in keys], F.col(value))
    # The range borders come from a sample, so they are fixed once and reused.
    return materialize(ranged.withColumn("part", F.spark_partition_id()))


def values_at_ranks(
    counts: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column], few_keys: bool = False
) -> DataFrame:
    """Smallest value of each key whose running count reaches the rank.

    ``counts`` comes from :func:`ranged_counts`; ``ranks`` names expressions over the column
    ``total``, the number of values of the key. Result: ``keys, name, value``. With ``few_keys``
    (the keys are column names, so there is one wanted range per column and rank) the wanted
    ranges are broadcast and the counted values stay where they are.
    """
    keys = list(keys)
    present = counts.filter(F.col(value).isNotNull())
    parts = present.groupBy(*keys, "part").agg(F.sum("n").alias("size"), F.min(value).alias("lowest"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("lowest").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        parts.withColumn("total", F.sum("size").over(by_key))
        .withColumn("ahead", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .select(
            *keys,
            "part",
            "size",
            "ahead",
            F.inline(F.array(*[F.struct(F.lit(n).alias("name"), r.cast("double").alias("rank")) for n, r in ranks.items()])),
        )
        .filter((F.col("ahead") < F.col("rank")) & (F.col("ahead") + F.col("size") >= F.col("rank")))
        .drop("size")
    )
    left, right = present.alias("v"), (F.broadcast(wanted) if few_keys else wanted).alias("w")
    same = F.col("v.part") == F.col("w.part")
    for key in keys:
        same = same & F.col(f"v.{key}").eqNullSafe(F.col(f"w.{key}"))
    running = Window.partitionBy(*keys, "name", "part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        left.join(right, same)
        .select(*[F.col(f"v.{k}").alias(k) for k in keys], f"v.{value}", "v.n", "v.part", "w.name", "w.ahead", "w.rank")
        .withColumn("upto", F.col("ahead") + F.sum("n").over(running))
        .filter(F.col("upto") >= F.col("rank"))
        .groupBy(*keys, "name")
        .agg(F.min(value).alias(value))
    )


def empirical_ranks(probabilities: dict[str, float]) -> dict[str, Column]:
    """Ranks of the smallest value whose cumulative share reaches each probability."""
    return {name: F.greatest(F.lit(p) * F.col("total"), F.lit(1.0)) for name, p in probabilities.items()}


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], few_keys: bool = False
) -> DataFrame:
    """Empirical quantiles per key, long form: ``keys, name, value``."""
    return values_at_ranks(ranged_counts(df, keys, value), keys, value, empirical_ranks(probabilities), few_keys)


def exact_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median per key: the mean of the two middle values when their number is even."""
    ranks = {"low": F.col("total") / 2, "high": F.floor(F.col("total") / 2) + 1}
    middle = values_at_ranks(ranged_counts(df, keys, value), keys, value, ranks)
    return middle.groupBy(*keys).agg(F.avg(value).alias(value))


@dataclass
class _Wanted:
    """A rank of a column and the closed range of values it is looked for in; None is an open end."""

    column: str
    name: str
    rank: float
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0
    checked: bool = False

    def holds(self, value: Column) -> Column:
        out = value.isNotNull()
        if self.low is not None:
            out = out & (value >= F.lit(self.low))
        return out & (value <= F.lit(self.high)) if self.high is not None else out

    @property
    def found(self) -> bool:
        return self.checked and self.low is not None and self.low == self.high

    def settle(self, below: int, inside: int) -> None:
        """Take the exact counts; a range that misses the rank gives way to the values beside it."""
        if self.rank <= below:
            self.low, self.high = None, self.low
        elif self.rank > below + inside:
            self.low, self.high = self.high, None
        else:
            self.below, self.inside, self.checked = below, inside, True


def _around(share: float) -> list[float]:
    """Shares that enclose one by more than a sketch can be wrong."""
    return [max(0.0, share - 2 / ACCURACY), min(1.0, share + 2 / ACCURACY)]


def _sketch(value: Column, shares: list[float]) -> Column:
    return F.percentile_approx(value, F.array(*[F.lit(x) for x in shares]), F.lit(ACCURACY))


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """Empirical quantiles of whole columns of numbers, long form: ``column, name, number``.

    The smallest value whose running count reaches the share; NULL is left out, NaN is the largest
    number. A scan sketches all columns, a second one counts what lies below and in each range, and so
    on until each range has few rows or one value, three scans up to some 10^9 rows and two more for
    each factor of 2500. No task holds more than a sketch or a small range; no value is shuffled
    but those of small ranges. A column without values has no rows.
    """
    # A number that is not NaN, for comparisons that hold in every engine.
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    shares = [x for p in probabilities.values() for x in _around(p)]
    first = [[F.count(c), F.count(value[c]), _sketch(value[c], shares)] for c in columns]
    row = df.agg(*[a.alias(f"{k}_{i}") for i, own in enumerate(first) for k, a in zip("nvs", own)]).first()
    wanted, answers = [], []
    for i, c in enumerate(columns):
        total, numbers, ends = row[f"n_{i}"], row[f"v_{i}"], row[f"s_{i}"]
        for at, (name, p) in enumerate(probabilities.items()):
            rank = max(p * total, 1.0)
            if total and rank > numbers:
                answers.append((c, name, float("nan")))
            elif total:
                wanted.append(_Wanted(c, name, rank, ends[2 * at], ends[2 * at + 1]))
    while open_ranges := [w for w in wanted if not w.checked]:
        counts = []
        for i, w in enumerate(open_ranges):
            below = F.count_if(value[w.column] < F.lit(w.low)) if w.low is not None else F.lit(0)
            counts += [below.alias(f"b_{i}"), F.count_if(w.holds(value[w.column])).alias(f"i_{i}")]
        row = df.agg(*counts).first()
        for i, w in enumerate(open_ranges):
            w.settle(row[f"b_{i}"], row[f"i_{i}"])
        large = [w for w in wanted if w.checked and not w.found and w.inside > SMALL]
        if large:
            share = [(w.rank - w.below) / w.inside for w in large]
            found = [_sketch(F.when(w.holds(value[w.column]), value[w.column]), _around(s)) for w, s in zip(large, share)]
            for w, ends in zip(large, df.agg(*found).first()):
                # A range that does not get smaller is sorted as it is: its ends are its values.
                if list(ends) != [w.low, w.high]:
                    w.low, w.high, w.checked = *ends, False
    answers += [(w.column, w.name, w.low) for w in wanted if w.found]
    out = literal_rows(df.sparkSession, answers, "column string, name string, number double")
    small = [w for w in wanted if not w.found]
    if not small:
        return out
    cells = [
        F.when(
            w.holds(value[w.column]),
            F.struct(
                F.lit(w.column).alias("column"), F.lit(w.name).alias("name"), value[w.column].alias("number"),
                F.lit(w.below).cast("bigint").alias("below"), F.lit(w.rank).alias("rank"),
            ),
        )
        for w in small
    ]
    counted = df.select(F.inline(F.array_compact(F.array(*cells))))
    counted = counted.groupBy("column", "name", "below", "rank", "number").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("column", "name").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    reached = counted.withColumn("upto", F.col("below") + F.sum("n").over(running)).filter("upto >= rank")
    return out.unionByName(reached.groupBy("column", "name").agg(F.min("number").alias("number")))
