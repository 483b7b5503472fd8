from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from deq.session import literal_rows, materialize, scratch_path, scratch_root


def session(master, **settings):
    conf = SimpleNamespace(get=lambda k, d: settings.get(k.replace(".", "_"), d), set=lambda k, v: settings.update({k.replace(".", "_"): v}))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="made-up"))


def test_the_named_folder_is_used():
    assert scratch_root(session("spark://host", spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"


def test_only_a_local_session_may_pick_a_folder():
    with pytest.raises(ValueError):
        scratch_root(session("spark://host"))
    local = session("local[4]")
    first = scratch_root(local)
    assert first.startswith("/tmp/run-") and scratch_root(local) == first


def test_paths_are_never_shared(spark):
    assert len({scratch_path(spark, "x") for _ in range(50)}) == 50


def test_a_stored_step_reads_as_it_was(spark, rows):
    df = spark.range(20).select(
        "id",
        F.array("id").alias("a"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"),
        F.lit(None).cast("string").alias("n"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00.123456'").alias("ts"),
    )
    stored = materialize(df)
    # Files make everything nullable; the types stay.
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert rows(stored) == rows(df)
    assert materialize(df.limit(0)).count() == 0


def test_literal_rows(spark, rows):
    assert rows(literal_rows(spark, [(1, None), (2, "x")], "a int, b string")) == [(1, None), (2, "x")]
    assert literal_rows(spark, [], "a int").columns == ["a"]
