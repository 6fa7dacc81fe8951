"""Stream sources over files, and running a query to the end.

``readStream`` points at the landing folder that the ledger exporter writes
to, or at a table's own files; an archive is polled by ``poller``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerlane.sources.tables import SCHEMAS

def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's own files as a stream, read where they are: for queries whose batches don't matter."""
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet*")


def run_to_end(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Start with ``availableNow`` (all data present now, in admission-controlled batches) and wait.

    ``timeout_s`` is for tests; a stream takes as long as its data does.
    """
    q = writer.trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    return q
