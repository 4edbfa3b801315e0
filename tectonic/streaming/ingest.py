"""Incremental ingest of newly landed catalogue files with Structured Streaming.

The batch pipeline rebuilds the fact from all raw lines. When catalogue files keep
arriving in a landing folder, the same plan runs per micro-batch instead:

    readStream.text(landing) -> non-blank -> slice -> type -> key/dedup/tag (fact_events)
        -> foreachBatch: append the rows whose event_id is not in the fact yet

The fact table itself is the dedup state (no unbounded ``dropDuplicates`` state in the
stream), and because a batch only appends unseen keys, replaying a batch after a failure
writes nothing twice. The checkpoint must sit on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import bronze, silver
from ..schemas import FACT_COLUMNS
from ..session import scratch_path
from ..sinks import paths


def raw_line_stream(spark: SparkSession, landing: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(filename, raw_line)`` over files added to ``landing``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing).select(F.col("_metadata.file_name").alias("filename"),
                                       F.col("value").alias("raw_line"))


def typed_event_stream(spark: SparkSession, landing: str, **options) -> DataFrame:
    """Streaming typed events (stateless: each line is handled on its own)."""
    lines = bronze.nonblank_lines(raw_line_stream(spark, landing, **options))
    return silver.typed_events(bronze.sliced_records(lines))


def append_new_facts(spark: SparkSession, batch_events: DataFrame, dim: DataFrame,
                     fact_path: str | None = None, fact_table: str | None = None) -> None:
    """Fact rows of one batch whose key is not stored yet, appended to the fact.

    The fact is either a Parquet path or a catalog table; a table bucketed by ``event_id``
    (see ``sinks.tables.materialize_bucketed``) lets the key lookup read the stored side in
    place and shuffle only the batch.
    """
    fresh = silver.fact_events(batch_events, dim)
    if fact_table:
        # the table may have been written by another session (the initial load, or an earlier
        # micro-batch's session): drop any cached file listing before reading the keys
        spark.catalog.refreshTable(fact_table)
        known = spark.table(fact_table).select("event_id")
        fresh.join(known, "event_id", "left_anti").select(*FACT_COLUMNS) \
            .write.insertInto(fact_table)
        return
    if paths.exists(spark, fact_path):
        known = spark.read.parquet(fact_path).select("event_id")
        fresh = fresh.join(known, "event_id", "left_anti")
    fresh.select(*FACT_COLUMNS).write.mode("append").parquet(fact_path)


def start_fact_ingest(spark: SparkSession, landing: str, dim: DataFrame,
                      fact_path: str | None = None, checkpoint: str | None = None,
                      available_now: bool = True, processing_time: str | None = None,
                      fact_table: str | None = None) -> StreamingQuery:
    """Start the ingest; ``available_now`` processes what has landed and stops.

    Micro-batches write through their own session: readers of ``fact_table`` in another
    session call ``spark.catalog.refreshTable`` to see the new files, as for any table
    updated elsewhere.

    ``checkpoint`` defaults to a folder under the session's shared ``spark.checkpoint.dir``.
    """
    checkpoint = checkpoint or scratch_path(spark, "fact_ingest")
    events = typed_event_stream(spark, landing)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        append_new_facts(batch.sparkSession, batch, dim, fact_path, fact_table)

    writer = events.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
