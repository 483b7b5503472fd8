import random
import statistics

import pytest

from deq.operators import quantiles
from deq.operators.quantiles import column_quantiles, exact_median, exact_quantiles

PROBABILITIES = {"p25": 0.25, "p50": 0.5, "p90": 0.9, "p99": 0.99, "all": 1.0, "none": 0.0}


def empirical(values, p):
    """Smallest value whose cumulative share reaches p."""
    ordered = sorted(values)
    for i, v in enumerate(ordered, 1):
        if i >= p * len(ordered):
            return v


def sample(seed):
    """Keys of very different sizes; one value holds a third of all rows."""
    rng = random.Random(seed)
    rows = [("hot", 5.0)] * 400 + [("hot", rng.uniform(0, 10)) for _ in range(400)]
    rows += [("small", float(rng.randint(0, 3))) for _ in range(7)] + [("one", 1.5)]
    rows += [(None, rng.gauss(0, 1)) for _ in range(101)] + [("empty", None)] * 3 + [("hot", None)] * 5
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("few_keys", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_per_key(spark, seed, few_keys):
    rows = sample(seed)
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    found = {(r["k"], r["name"]): r["v"] for r in exact_quantiles(df, ["k"], "v", PROBABILITIES, few_keys).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        values = [v for key, v in rows if key == k and v is not None]
        if values:
            want.update({(k, n): empirical(values, p) for n, p in PROBABILITIES.items()})
    assert found == want


def test_median_is_the_mean_of_the_two_middle_values(spark):
    rows = sample(3)
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r["k"]: r["v"] for r in exact_median(df, ["k"], "v").collect()}
    groups = {k: [v for key, v in rows if key == k and v is not None] for k in {k for k, _ in rows}}
    assert found == {k: pytest.approx(statistics.median(v)) for k, v in groups.items() if v}


def test_many_ranges(spark):
    df = spark.range(5000).selectExpr("'x' AS k", "cast((id * 7919) % 5000 AS double) AS v")
    found = {r["name"]: r["v"] for r in exact_quantiles(df, ["k"], "v", PROBABILITIES, True).collect()}
    assert found == {n: empirical(range(5000), p) for n, p in PROBABILITIES.items()}


def columns_of(spark):
    """Values all different, one value a third of all, a few far out, few rows, NaN, none."""
    rng = random.Random(8)
    n, rows = 3000, []
    for i in range(n):
        nan = float("nan") if i % 50 == 0 else rng.gauss(0, 1)
        far = rng.choice([1e300, -1e300, 1e-300, float("inf")]) if i % 100 == 0 else rng.random()
        rows.append((float(i * 7919 % n), 5.0 if i % 3 == 0 else rng.uniform(0, 10), far, 3.0 if i == 7 else None, nan, None, i % 4))
    names = ["distinct", "hot", "far", "single", "nan", "empty", "whole"]
    schema = ", ".join(f"{c} double" for c in names[:-1]) + ", whole int"
    return rows, names, spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize("accuracy,small", [(10_000, 1_000_000), (100, 1_000_000), (60, 20)])
def test_quantiles_of_columns(spark, monkeypatch, accuracy, small):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "SMALL", small)
    rows, names, df = columns_of(spark)
    found = {(r["column"], r["name"]): r["number"] for r in column_quantiles(df, names, PROBABILITIES).collect()}
    assert {c for c, _ in found} == {*names} - {"empty"}
    for c, name in found:
        values = [r[names.index(c)] for r in rows if r[names.index(c)] is not None]
        ordered = sorted(values, key=lambda v: (v != v, v))
        want = next(v for i, v in enumerate(ordered, 1) if i >= PROBABILITIES[name] * len(ordered))
        assert found[c, name] == want or (want != want and found[c, name] != found[c, name]), (c, name)
    assert column_quantiles(df.limit(0), names, PROBABILITIES).count() == 0


def test_a_wrong_sketch_is_corrected(spark, monkeypatch):
    """Counts decide; a range that misses its rank is left for the values beside it."""
    monkeypatch.setattr(quantiles, "_sketch", lambda value, shares: quantiles.F.percentile_approx(value, quantiles.F.array(*[quantiles.F.lit(0.9)] * len(shares)), quantiles.F.lit(100)))
    df = spark.range(1000).selectExpr("CAST(id AS double) AS v")
    found = {r["name"]: r["number"] for r in column_quantiles(df, ["v"], {"a": 0.25, "b": 0.999}).collect()}
    assert found == {"a": 249.0, "b": 998.0}
