"""Structured Streaming jobs on change events and points.

Every job takes a streaming DataFrame and a checkpoint folder and returns the running query.
Sinks are Parquet folders: the file sink commits each batch once, and ``foreachBatch`` writers
put a batch under its own number, so a batch that runs twice replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from deq.operators.change_data import cdc_filter
from deq.operators.lake import as_of, latest_per_key


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    files_per_batch: int | None = None,
    pattern: str = "*.parquet",
) -> DataFrame:
    """A folder of Parquet files as a stream; ``files_per_batch`` is the steady rate limit."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: StructType,
    time_column: str,
    per_batch: int | None = None,
) -> DataFrame:
    """A Kafka topic of JSON rows as a stream; needs Spark's Kafka package on the class path.

    No message is left out, see :func:`parsed_rows`.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return parsed_rows(reader.load(), schema, time_column)


def parsed_rows(messages: DataFrame, schema: StructType, time_column: str) -> DataFrame:
    """The rows in the JSON texts of ``value``, with ``problem`` and ``raw``.

    ``problem`` is NULL for a good row. A text that does not fit the schema, or that has no time,
    keeps its ``raw`` form and says why; :func:`apply_changes` sends it to the rejected rows.
    """
    text = F.col("value").cast("string")
    wide = StructType([*schema.fields]).add("_broken", "string")
    read = messages.select(text.alias("raw"), F.from_json(text, wide, {"columnNameOfCorruptRecord": "_broken"}).alias("_row"))
    broken = F.col("_row").isNull() | F.col("_row._broken").isNotNull()
    problem = F.when(broken, "no row of the schema").when(F.col("_row")[time_column].isNull(), f"no {time_column}")
    kept = F.when(problem.isNotNull(), F.col("raw"))
    return read.select(*[F.col("_row")[c].alias(c) for c in schema.names], problem.alias("problem"), kept.alias("raw"))


def trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def ingest(
    stream: DataFrame,
    dest: str,
    checkpoint: str,
    every: str | None = None,
    rows_per_file: int | None = None,
) -> StreamingQuery:
    """Append a stream to a folder as it is, without rollup.

    ``every`` is the flush interval; without it the job takes what is there and ends.
    """
    writer = stream.writeStream.format("parquet").option("path", dest).option("checkpointLocation", checkpoint)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return writer.outputMode("append").trigger(**trigger(every)).start()


def on_change(
    stream: DataFrame,
    callback: Callable[[DataFrame, int], None],
    checkpoint: str,
    tables: list[str] = (),
    actions: list[str] = (),
    table: str = "tbl",
    op: str = "op",
    every: str | None = None,
) -> StreamingQuery:
    """Call back with the matching events of each batch."""
    matching = cdc_filter(stream, tables, actions, table, op)
    return (
        matching.writeStream.foreachBatch(callback)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def batch_writer(dest: str) -> Callable[[DataFrame, int], None]:
    """A callback that stores each batch under its number."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dest}/batch={number}")

    return store


def apply_changes(
    stream: DataFrame,
    log: str,
    rejected: str,
    checkpoint: str,
    required: list[str],
    every: str | None = None,
) -> StreamingQuery:
    """Check each batch, then add its changes to a change log.

    Rows with a NULL in a required column, or with a ``problem`` of :func:`parsed_rows`, go to
    ``rejected``. The log is read with :func:`current_state` and keeps every good change, so any
    instant can be asked for; a batch writes only its own changes, never the whole table.
    """
    bad: Column = F.col("problem").isNotNull() if "problem" in stream.columns else F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()

    def store(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("_bad", bad).persist()
        try:
            marked.filter("_bad").drop("_bad").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
            marked.filter("NOT _bad").drop("_bad").write.mode("overwrite").parquet(f"{log}/batch={number}")
        finally:
            marked.unpersist()

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def _log_rows(spark: SparkSession, log: str) -> DataFrame:
    """All changes with the number of their batch; columns that later batches brought are NULL before."""
    return spark.read.option("mergeSchema", "true").parquet(log)


def _bases(spark: SparkSession, log: str) -> DataFrame:
    """``upto, newest``: the bases of a log, with the last batch folded into each and the newest time there."""
    fields = "upto bigint, newest timestamp_ntz"
    try:
        spark.read.parquet(f"{log}.bases")
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).parquet(f"{log}.bases")


def _best_base(bases: DataFrame) -> int | None:
    """The base with the most batches."""
    return bases.agg(F.max("upto")).first()[0]


def _base_and_tail(spark: SparkSession, log: str, base: int | None) -> DataFrame:
    rows = _log_rows(spark, log)
    if base is None:
        return rows.drop("batch")
    tail = rows.filter(F.col("batch") > base).drop("batch")
    return spark.read.parquet(f"{log}.base/upto={base}").unionByName(tail, allowMissingColumns=True)


def fold_changes(spark: SparkSession, log: str, keys: list[str], order: list[str], upto: int | None = None) -> int | None:
    """Fold the batches of a change log up to one, that before the newest if none is named, into a new base.

    A base holds the last change of each key, deletions too, and is made of the base before it and the
    batches since. It is stored beside the log and entered in a list when it is complete, so a
    fold that fails leaves nothing that is read, and one that is tried again replaces it. Nothing
    is taken from the log, and older bases stay for older instants. Returns the last batch folded.
    """
    if upto is None:
        newest = _log_rows(spark, log).agg(F.max("batch")).first()[0]
        upto = newest - 1 if newest else None
    before = _best_base(_bases(spark, log))
    if upto is None or (before is not None and upto <= before):
        return before
    rows = _log_rows(spark, log).filter(F.col("batch") <= upto)
    if before is not None:
        rows = rows.filter(F.col("batch") > before)
    rows = rows.drop("batch")
    if before is not None:
        rows = spark.read.parquet(f"{log}.base/upto={before}").unionByName(rows, allowMissingColumns=True)
    # A row without a time belongs to no instant.
    latest_per_key(rows.filter("ts IS NOT NULL"), keys, order).write.mode("overwrite").parquet(f"{log}.base/upto={upto}")
    newest = rows.agg(F.max("ts").cast("timestamp_ntz").alias("newest"))
    entry = newest.select(F.lit(upto).cast("bigint").alias("upto"), "newest")
    entry.coalesce(1).write.mode("append").parquet(f"{log}.bases")
    return upto


def current_state(spark: SparkSession, log: str, keys: list[str], order: list[str], time) -> DataFrame:
    """Table content at an instant, out of a change log that :func:`apply_changes` fills.

    ``order`` has to begin with the time ``ts``. Read are the largest base that holds nothing newer than
    the instant and the batches after it; without such a base (:func:`fold_changes`) the whole log.
    """
    fitting = _bases(spark, log).filter(F.col("newest") <= F.lit(time))
    return as_of(_base_and_tail(spark, log, _best_base(fitting)), keys, order, time=time)


def continuous_aggregate(
    stream: DataFrame,
    dest: str,
    checkpoint: str,
    interval: str,
    keys: list[str],
    aggregates: list[Column],
    delay: str,
    time_column: str = "ts",
    every: str | None = None,
) -> StreamingQuery:
    """Append each bucket once the watermark has passed its end.

    ``time_column`` may lack a zone; it is read as UTC, as event time needs an instant.
    """
    timed = stream.withColumn(time_column, F.col(time_column).cast("timestamp")).withWatermark(time_column, delay)
    grouped = timed.groupBy(F.window(time_column, interval).alias("w"), *keys).agg(*aggregates)
    rows = grouped.withColumn("bucket", F.col("w.start").cast("timestamp_ntz")).drop("w")
    return ingest(rows, dest, checkpoint, every)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait until a job without a flush interval has taken everything that was there."""
    query.awaitTermination()
    return query


def throttle(query: StreamingQuery) -> None:
    """Pause a stream; starting it again on the same checkpoint resumes where it stopped."""
    query.stop()


def stream_status(query: StreamingQuery, name: str, stored: DataFrame, time_column: str) -> DataFrame:
    """One row: ``source_id, state, batches, rows, last_event``.

    Rows and the newest event are those of the sink, so they hold however long the stream has run;
    batches are counted by the number of the last one, over restarts on the same checkpoint too.
    """
    last = query.lastProgress
    # A trigger that found nothing to do reports the number of the batch to come.
    batches = last["batchId"] + ("addBatch" in last["durationMs"]) if last else 0
    return stored.agg(F.count(F.lit(1)).alias("rows"), F.max(time_column).alias("last_event")).select(
        F.lit(name).alias("source_id"),
        F.lit("running" if query.isActive else "stopped").alias("state"),
        F.lit(int(batches)).cast("bigint").alias("batches"),
        "rows",
        "last_event",
    )
