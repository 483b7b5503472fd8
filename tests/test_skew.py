import pytest
from pyspark.sql import functions as F

from deq.operators import skew
from deq.operators.skew import HOT_SHARE, hot_keys, is_small, join_skewed


@pytest.fixture(params=["salted", "broadcast"])
def way(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 10)
    return request.param


def sides(spark):
    """One key holds a third of the rows, NULL holds some, most keys are rare."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 30000)
    big = spark.range(60000).select(key.alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    unique = spark.range(0, 30000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return big, unique.unionByName(spark.createDataFrame([(7, 14)], "k bigint, v bigint"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_equals_the_plain_one(spark, rows, way, how):
    big, unique = sides(spark)
    columns = ["k", "id"] + (["v"] if how in ("inner", "left") else [])
    assert rows(join_skewed(big, unique, ["k"], how).select(*columns)) == rows(big.join(unique, "k", how).select(*columns))


def test_other_joins_are_refused(spark):
    big, unique = sides(spark)
    with pytest.raises(ValueError):
        join_skewed(big, unique, ["k"], "full_outer")


def test_hot_keys_are_few(spark):
    big, _ = sides(spark)
    assert 0 < hot_keys(big, ["k"]).count() < HOT_SHARE
    assert hot_keys(big.limit(0), ["k"]).count() == 0


def test_small_sides_are_broadcast_and_others_salted(spark, way):
    big, unique = sides(spark)
    joined = join_skewed(big, unique, ["k"], "inner")
    assert "_salt" not in joined.columns
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("explode" in plan) == (way == "salted")
    assert ("strategy=broadcast" in plan) or way == "salted"


def test_size_counts_rows_and_bytes(spark, monkeypatch):
    df = spark.range(100).withColumn("text", F.lit("x" * 100))
    assert is_small(df) and is_small(df.limit(0))
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 10_000)
    assert not is_small(df) and is_small(df.select("id"))
