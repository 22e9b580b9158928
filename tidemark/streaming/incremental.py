"""Incremental loads as ``availableNow`` streams.

The batch slice keeps a ``processed_dttm`` watermark in a control table; a
file-source stream keeps the same thing in its checkpoint (which files were
already read), commits it only after ``foreachBatch`` returns and replays the
batch after a failure.  The merges are idempotent, so a replayed batch is a
no-op.  ``trigger(availableNow=True)`` processes what is there and stops, which
fits a scheduled job; the checkpoint location must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import materialize

Handler = Callable[[DataFrame, int], None]


def run_available_now(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType | str,
    handle_batch: Handler,
    checkpoint_location: str,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Feed every file not yet seen under ``source_path`` to ``handle_batch``."""
    reader = spark.readStream.format(source_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_path)
    writer = (stream.writeStream
              .foreachBatch(handle_batch)
              .option("checkpointLocation", checkpoint_location)
              .trigger(availableNow=True))
    if query_name:
        writer = writer.queryName(query_name)
    query = writer.start()
    query.awaitTermination()
    return query


def merge_new_files(spark: SparkSession, source_path: str, schema: T.StructType | str, tables, table: str,
                    key_columns: Sequence[str], checkpoint_location: str,
                    transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Upsert (SCD1) the rows of new files into ``table`` of a ``CatalogTables`` store.

    A batch that holds a key twice is refused, as any other upsert is.
    """
    from tidemark.sources.writers import write_scd1

    def handle(batch: DataFrame, epoch_id: int) -> None:
        rows = transform(batch) if transform else batch
        write_scd1(tables, table, materialize(rows), list(key_columns), "upsert")

    return run_available_now(spark, source_path, schema, handle, checkpoint_location)
