"""Lag of change sources, judged batch by batch and, by timers, while nothing arrives."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from deq.operators.change_data import lag_seconds, monitor
from deq.streaming.jobs import trigger

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

HEARD = "source_id string, last_event timestamp_ntz, offsets array<bigint>, sizes array<bigint>"
KNOWN = "source_id string, last_event timestamp_ntz, offset bigint, bytes bigint, batch bigint"


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per source and Arrow batch, so a busy source does not shuffle its events one by one."""
    for frame in frames:
        rows = [
            (source, own["last_event"].max(), own["offset"].tolist(), own["bytes"].tolist())
            for source, own in frame.groupby("source_id", dropna=False)
        ]
        yield pd.DataFrame(rows, columns=["source_id", "last_event", "offsets", "sizes"])


class _Listener(StatefulProcessor):
    """Passes the news of a source on and, when it has none for a while, its last event again and again."""

    def __init__(self, silence: int):
        self.wait = 1000 * silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_event", "last_event timestamp_ntz")

    def _wake_after(self, timer_values) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + self.wait)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        for frame in rows:
            seen = [t for t in [last, frame["last_event"].max()] if not pd.isna(t)]
            last = max(map(pd.Timestamp, seen)) if seen else None
            yield frame[["source_id", "last_event", "offsets", "sizes"]]
        if last is not None:
            self.last.update((last.to_pydatetime() if isinstance(last, pd.Timestamp) else last,))
        self._wake_after(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        self._wake_after(timerValues)
        yield pd.DataFrame({"source_id": [key[0]], "last_event": [pd.Timestamp(last)], "offsets": [[]], "sizes": [[]]})

    def close(self) -> None:
        pass


def acknowledged_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``source_id, acknowledged``: the highest acknowledged offset of each source, as stored by now."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "source_id string, acknowledged bigint")
    return rows.groupBy("source_id").agg(F.max("acknowledged").cast("bigint").alias("acknowledged"))


def _waiting(known: DataFrame, acknowledged: DataFrame) -> DataFrame:
    """The events that are not acknowledged, and one row without an offset for each source."""
    open_events = known.filter("offset IS NOT NULL").join(F.broadcast(acknowledged), "source_id", "left")
    open_events = open_events.filter(F.col("offset") > F.coalesce("acknowledged", F.lit(-1))).drop("acknowledged")
    sources = known.groupBy("source_id").agg(F.max("last_event").alias("last_event"))
    return open_events.distinct().unionByName(sources.withColumns({"offset": F.lit(None).cast("bigint"), "bytes": F.lit(0).cast("bigint")}))


def _summed(known: DataFrame) -> DataFrame:
    return known.groupBy("source_id").agg(
        F.max("last_event").alias("last_event"), F.max("offset").alias("offset"), F.sum("bytes").alias("bytes")
    )


def watch_lag(
    stream: DataFrame,
    alerts: str,
    state: str,
    checkpoint: str,
    clock: Callable[[], datetime] = datetime.now,
    acknowledged: str | int = -1,
    on_critical: Callable[[DataFrame], None] | None = None,
    every: str | None = None,
    silence: int | None = None,
    **thresholds,
) -> StreamingQuery:
    """Store an alert row per source and batch whose lag is not healthy.

    ``clock`` is asked once a batch. ``acknowledged`` is an offset for all sources, or the folder of a
    table ``source_id, acknowledged`` that is read anew in each batch, so bytes fall once offsets are
    acknowledged; an offset that goes back is ignored. The last event of every source seen so far and
    its open bytes (one sum, or with a table the sizes of the events still open) are kept below
    ``state`` in two folders that take turns, so a batch that runs twice starts from the same state.

    With ``silence`` (seconds; needs ``every``) each source has keyed state with a processing-time
    timer: a source without news for so long is judged again, and again after as long, even when no
    source has any news at all. Such a query has to be stopped, it never runs out of batches.

    ``on_critical`` gets the rows of sources that were not critical in the batch before, if any; it
    may :func:`~deq.streaming.jobs.throttle` the stream that feeds the sources. Events without a
    source belong to one source NULL.
    """
    if silence is not None and (silence <= 0 or not every):
        raise ValueError("silence needs a positive number of seconds and a trigger interval")
    constant: Column = F.lit(-1 if isinstance(acknowledged, str) else acknowledged)
    events = stream.select(
        F.col("source_id").cast("string").alias("source_id"),
        F.col("ts").cast("timestamp_ntz").alias("last_event"),
        F.col("seq").cast("bigint").alias("offset"),
        F.when(F.col("seq") > constant, F.octet_length("payload")).otherwise(0).cast("bigint").alias("bytes"),
    )

    def news_of(batch: DataFrame) -> DataFrame:
        if silence is None:
            return batch
        event = F.explode_outer(F.arrays_zip("offsets", "sizes")).alias("_event")
        rows = batch.select("source_id", "last_event", event)
        size = F.coalesce(F.col("_event.sizes"), F.lit(0)).cast("bigint")
        return rows.select("source_id", "last_event", F.col("_event.offsets").alias("offset"), size.alias("bytes"))

    def store(batch: DataFrame, number: int) -> None:
        spark, now = batch.sparkSession, clock()
        known = news_of(batch)
        if number > 0:
            before = spark.read.schema(KNOWN).parquet(f"{state}/turn={(number - 1) % 2}")
            known = known.unionByName(before.drop("batch"))
        known = _waiting(known, acknowledged_offsets(spark, acknowledged)) if isinstance(acknowledged, str) else _summed(known)
        slot = f"{state}/turn={number % 2}"
        known.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(slot)
        known = _summed(spark.read.schema(KNOWN).parquet(slot)).drop("offset").withColumnRenamed("bytes", "lag_bytes")
        lag = monitor(known.withColumn("lag_seconds", lag_seconds(now)), **thresholds)
        lag.filter(F.col("alerts") > 0).write.mode("overwrite").parquet(f"{alerts}/batch={number}")
        if on_critical is not None:
            critical = spark.read.schema(lag.schema).parquet(f"{alerts}/batch={number}").filter("throttle")
            if number > 0:
                earlier = spark.read.schema(lag.schema).parquet(f"{alerts}/batch={number - 1}").filter("throttle")
                earlier = earlier.select(F.col("source_id").alias("_earlier"))
                critical = critical.join(earlier, F.col("source_id").eqNullSafe(F.col("_earlier")), "left_anti")
            if not critical.isEmpty():
                on_critical(critical)

    if silence is None:
        return events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    spark = stream.sparkSession
    heard = (
        events.mapInPandas(_pieces, HEARD)
        .groupBy("source_id")
        .transformWithStateInPandas(_Listener(silence), HEARD, "Update", "ProcessingTime")
    )
    writer = heard.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    # A query keeps the setting it was started with; timers need this kind of state store.
    other = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.trigger(**trigger(every)).start()
    finally:
        spark.conf.unset(_PROVIDER) if other is None else spark.conf.set(_PROVIDER, other)
