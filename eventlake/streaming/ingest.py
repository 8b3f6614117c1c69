"""Streaming ingest: one parser, two sinks, checkpointed progress.

The same :func:`eventlake.operators.parse.parse` runs on a streaming
DataFrame (``readStream`` over an arrival folder, or any source with a
``value`` column). Each micro-batch is decoded once into the shared scratch
folder, and written from there to two sinks by ``foreachBatch``: valid rows to
bronze, bad messages with their reason to the dead-letter table.

Delivery: source offsets are committed to the checkpoint only after the batch
callback returns, so no message is lost (a failed batch is replayed). Both
sinks write a batch under its name (the query's id and the batch's number) and
replace what that name wrote before, so a replay after a crash between or
after the two writes leaves every row once in each. The ingestion stamp is
``current_timestamp()`` *in the streaming plan*, i.e. the micro-batch's own
timestamp, which a replay reuses: replayed rows fall into the same partitions.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import parse as P
from ..session import configure, path_exists, remove_path
from ..sinks import tables as TB

METRICS = "ingest_counts"


def parsed_stream(source: DataFrame, value: str = "value", mode: str = "deadletter",
                  stamp: Column | None = None) -> DataFrame:
    """Decode a (streaming or batch) DataFrame and attach per-batch counters.

    The counters (``n_messages``, ``n_valid``, ``n_deadletter``) are reported
    in each micro-batch's progress (``observedMetrics``) at no extra pass.
    """
    parsed = P.parse(source, value=value, mode=mode, stamp=stamp)
    return parsed.observe(
        METRICS,
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(F.col("error").isNull()).alias("n_valid"),
        F.count_if(F.col("error").isNotNull()).alias("n_deadletter"),
    )


# Appends a frame under the name of its batch; the same name again replaces the first append.
Sink = Callable[[DataFrame, str], None]


def table_sink(spark: SparkSession, name: str, required: tuple[str, ...], today: Callable | None = None) -> Sink:
    """Append to a catalog table (REQUIRED columns checked in the write, its retention enforced as of ``today()``)."""
    return lambda df, batch: TB.append(spark, df, name, required=required, batch=batch, today=today() if today else None)


def path_sink(path: str, partition_source: str | None = "ingestion_time",
              clustering: tuple[str, ...] = ()) -> Sink:
    """Append Parquet files under ``path``, partitioned by day and batch, sorted by ``clustering``."""

    def write(df: DataFrame, batch: str) -> None:
        keys = []
        if partition_source:
            df, keys = TB.with_partition_date(df, partition_source), [TB.PARTITION_COLUMN]
        df = TB.layout(df, clustering).withColumn(TB.BATCH_COLUMN, F.lit(batch))
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*keys, TB.BATCH_COLUMN).parquet(path)

    return write


def fan_out(bronze: Sink, deadletter: Sink, staging: str, totals: dict | None = None,
            source: Callable[[], str] = lambda: "load", progress: str | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback: one decode, two appends.

    The decoded batch is written once below ``staging`` (a shared folder),
    partitioned by where it goes, and each sink reads its part; a replay finds
    a finished decode and uses it again. The folder of a batch is removed when
    both sinks have it. ``source`` names the stream.

    With ``totals``, the counts of each write are added to ``totals`` when the
    batch is done: exact over any number of batches, and no extra pass. With
    ``progress`` (a shared folder) they are also kept there, see
    :func:`read_progress`.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{source()}-{batch_id}"
        decoded = f"{staging}/decoded-{name}"
        if not path_exists(spark, f"{decoded}/_SUCCESS"):
            # Only dead-letter rows need their raw text (usually the widest column).
            bad = F.col("error").isNotNull()
            routed = batch.withColumn("raw_message", F.when(bad, F.col("raw_message"))).withColumn("bad", bad)
            routed.write.mode("overwrite").partitionBy("bad").parquet(decoded)
        stored = spark.read.schema(_decoded_schema(batch)).parquet(decoded)
        valid = P.valid_rows(stored.where("NOT bad"))
        dead = P.deadletter_rows(stored.where("bad"))
        seen_valid, seen_dead = Observation(), Observation()
        bronze(valid.observe(seen_valid, F.count(F.lit(1)).alias("n")), name)
        deadletter(dead.observe(seen_dead, F.count(F.lit(1)).alias("n")), name)
        if totals is not None or progress:
            n_valid, n_dead = seen_valid.get["n"], seen_dead.get["n"]
        if progress:
            keep_progress(spark, progress, name, batch_id, n_valid, n_dead)
        if totals is not None:
            totals["n_valid"] += n_valid
            totals["n_deadletter"] += n_dead
            totals["n_messages"] += n_valid + n_dead
            totals["batches"] += 1
        remove_path(spark, decoded)

    return write_batch


PROGRESS = "batch_id long, n_messages long, n_valid long, n_deadletter long, finished_at timestamp"


def keep_progress(spark: SparkSession, progress: str, name: str, batch_id: int, n_valid: int, n_dead: int) -> None:
    """Store the counts of a batch that both sinks have, under its name: a replay replaces them."""
    counts = spark.range(0, 1, 1, 1).select(
        F.lit(batch_id).cast("long").alias("batch_id"), F.lit(n_valid + n_dead).cast("long").alias("n_messages"),
        F.lit(n_valid).cast("long").alias("n_valid"), F.lit(n_dead).cast("long").alias("n_deadletter"),
        F.current_timestamp().alias("finished_at"), F.lit(name).alias(TB.BATCH_COLUMN),
    )
    writer = counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(TB.BATCH_COLUMN).parquet(progress)


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """Counts of every finished batch of the streams that keep them in ``progress``, over any number of restarts.

    A row is written after both appends of its batch and before the offsets are
    committed, so the sums equal the rows stored: a batch that died earlier has
    no row until its replay, one that died later is replaced by it.
    """
    if not path_exists(spark, progress):
        return spark.createDataFrame([], f"{PROGRESS}, {TB.BATCH_COLUMN} string")
    return spark.read.schema(f"{PROGRESS}, {TB.BATCH_COLUMN} string").parquet(progress)


def _decoded_schema(batch: DataFrame) -> T.StructType:
    return T.StructType([*batch.schema.fields, T.StructField("bad", T.BooleanType())])


def start_ingest(
    source: DataFrame,
    bronze: Sink,
    deadletter: Sink,
    checkpoint: str,
    trigger: str | None = S.DEFAULT_TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    min_partitions: int | None = None,
    totals: dict | None = None,
    stamp: Column | None = None,
    progress: str | None = None,
) -> StreamingQuery:
    """Start the two-sink ingest of a streaming ``source`` (column ``value``).

    ``trigger`` is the processing-time cadence; ``available_now`` instead
    processes everything that has arrived (bounded by the source's
    per-trigger limits, e.g. ``maxFilesPerTrigger``) and stops.
    ``min_partitions`` round-robins each micro-batch before decoding; set it
    only for a source that yields fewer splits than cores (a few large files).
    A Kafka source has its own ``minPartitions`` option for the same purpose.
    ``progress`` names a shared folder that keeps the counts of every batch.
    """
    configure(source.sparkSession)
    if min_partitions:
        source = source.repartition(min_partitions)
    started, query = threading.Event(), []

    def name() -> str:  # of the query that the checkpoint belongs to, the same after a restart
        started.wait()
        return str(query[0].id)

    writer = (
        parsed_stream(source, stamp=stamp)
        .writeStream.foreachBatch(fan_out(bronze, deadletter, f"{checkpoint}/decoded", totals, name, progress))
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    query.append(writer.start())
    started.set()
    return query[0]


def run_available_now(
    source: DataFrame,
    bronze: Sink,
    deadletter: Sink,
    checkpoint: str,
    timeout_sec: float | None = None,
    min_partitions: int | None = None,
    stamp: Column | None = None,
    progress: str | None = None,
) -> dict:
    """Process what has arrived, stop, and return counters summed over all its batches."""
    totals = {"n_messages": 0, "n_valid": 0, "n_deadletter": 0, "batches": 0}
    query = start_ingest(
        source, bronze, deadletter, checkpoint,
        available_now=True, min_partitions=min_partitions, totals=totals, stamp=stamp, progress=progress,
    )
    query.awaitTermination(timeout_sec)
    if query.isActive:
        query.stop()
        raise TimeoutError("ingest did not finish in time")
    if query.exception() is not None:
        raise query.exception()
    return dict(totals)


def stream_source_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Arrival folder of JSON-lines files as a stream (``value: string``).

    ``max_files_per_trigger`` bounds each pull (a bounded pull per batch).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def stream_source_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A Kafka topic as a stream of messages (``value: binary``; the parser decodes UTF-8).

    Needs the Spark Kafka connector on the classpath (not part of this
    environment). Pass ``minPartitions`` / ``maxOffsetsPerTrigger`` in
    ``options`` to size micro-batches.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
    )
    try:
        return reader.load().select("value")
    except Exception as exc:  # connector missing
        if "kafka" in str(exc).lower():
            raise RuntimeError(
                "the Kafka source is not available in this Spark installation; "
                "use stream_source_lines over an arrival folder instead"
            ) from exc
        raise
