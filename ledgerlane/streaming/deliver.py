"""Delivery in micro-batches: ``foreachBatch`` writers (ST4–ST7, ST11, ST12).

Spark's checkpoint (offset log before a batch, commit log after) is the
source of truth for progress; a batch that failed is replayed with the same
batch id on restart.  Every writer below is therefore idempotent per batch
id: it overwrites ``batch_id=N`` rather than appending blindly.
"""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import iso_time
from ledgerlane.session import read_or_empty
from ledgerlane.streaming.dlq import dlq_line, read_dlq
from ledgerlane.streaming.retry import RETRIABLE, Backoff


def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


class TransactionalSink:
    """ST6: all-or-nothing batches: messages and offset are committed together.

    Data first, then a marker that holds the batch id and the batch's last
    offset.  Readers see a batch and its offset only once its marker exists; an
    aborted batch leaves data without a marker and is overwritten when the
    batch is replayed.  An empty batch writes and commits nothing.
    """

    MARKER = "committed_batch bigint, last_offset string, committed_at timestamp, batch_id int"

    def __init__(self, root: str, offset_col: str, fail_before_commit_of: int | None = None):
        self.data, self.commits, self.offset_col = f"{root}/data", f"{root}/commits", offset_col
        self.fail_before_commit_of = fail_before_commit_of

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        df.write.mode("overwrite").parquet(_batch_dir(self.data, batch_id))
        if self.fail_before_commit_of == batch_id:
            raise AbortedCommit(f"commit of batch {batch_id} failed")
        written = df.sparkSession.read.schema(df.schema).parquet(_batch_dir(self.data, batch_id))
        (written.agg(F.lit(batch_id).cast("bigint").alias("committed_batch"), F.max(self.offset_col).cast("string").alias("last_offset"),
                     F.current_timestamp().alias("committed_at"))
         .write.mode("overwrite").parquet(_batch_dir(self.commits, batch_id)))

    def committed(self, spark: SparkSession, schema: str) -> DataFrame:
        """Rows of committed batches: data semi-joined to the markers on the batch id."""
        data = read_or_empty(spark, self.data, f"{schema}, batch_id int")
        return data.join(self.markers(spark).select("batch_id"), "batch_id", "left_semi").drop("batch_id")

    def markers(self, spark: SparkSession) -> DataFrame:
        """(committed_batch, last_offset, committed_at) of every committed batch."""
        return read_or_empty(spark, self.commits, self.MARKER)


class AbortedCommit(RuntimeError):
    """A planned failure between a batch's data and its marker."""


class SendError(RuntimeError):
    """A failed write with the broker's error class, by which it is retried or not."""

    def __init__(self, error_class: str, message: str):
        super().__init__(f"{error_class}: {message}")
        self.error_class = error_class


class BatchErrors(RuntimeError):
    """A write of several batches of which some failed: the error of each, by its number; the others are written."""

    def __init__(self, errors: dict[int, Exception]):
        super().__init__(f"{len(errors)} batches failed")
        self.errors = errors


class DeadLetterWriter:
    """ST5: a batch whose write keeps failing goes to the DLQ; the stream goes on.

    The write is tried under the retry rule (ST8): transient error classes
    again after the rule's wait, at most ``max_attempts`` times, any other
    error once.  Then the batch's events are written to the DLQ as JSON lines
    (ST9) with the reason, the stack trace, the batch id, their offset and the
    number of attempts; a batch log records the outcome.  A failing DLQ write
    raises (the query stops and the batch is replayed) — nothing is dropped.

    A micro-batch is one batch, or, with ``batch_col`` (a number column), as
    many as it has numbers: one write sends them all, overwrites what an
    earlier try wrote, and names those that failed in a ``BatchErrors``; each
    has an outcome and a log row of its own, and only failed ones are
    dead-lettered.  The driver holds a row per batch of the micro-batch.
    """

    LOG = "status string, events bigint, attempts int, batch bigint, batch_id int"

    def __init__(self, root: str, write: Callable[[DataFrame, int], None], offset_col: str, backoff: Backoff = Backoff(),
                 sleep: Callable[[float], None] = time.sleep, batch_col: str | None = None):
        self.sink, self.dlq, self.log = f"{root}/sink", f"{root}/dlq", f"{root}/batch_log"
        self.write, self.offset_col, self.backoff, self.sleep, self.batch_col = write, offset_col, backoff, sleep, batch_col

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # the attempts and the DLQ write reuse one read of the batch
        try:
            self._deliver(df, batch_id)
        finally:
            df.unpersist()

    def _deliver(self, df: DataFrame, batch_id: int) -> None:
        batch = F.lit(batch_id).cast("bigint") if self.batch_col is None else F.col(self.batch_col).cast("bigint")
        events = {r["batch"]: r["n"] for r in df.groupBy(batch.alias("batch")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per batch
        if not events:
            return
        attempts, dead, attempt, sending = dict.fromkeys(events, 1), {}, 0, df
        while len(dead) < len(events):
            attempt += 1
            errors, trace = {}, ""
            try:
                self.write(sending, batch_id)
            except Exception as e:  # noqa: BLE001 - every write error is a delivery failure
                trace = traceback.format_exc()
                errors = e.errors if isinstance(e, BatchErrors) else {b: e for b in events if b not in dead}
            for b, e in errors.items():
                attempts[b] = attempt
                if not transient(e) or attempt == self.backoff.max_attempts:
                    dead[b] = (b, str(e), trace if str(e) in trace else f"{trace}{type(e).__name__}: {e}", attempt)
            again = [b for b in errors if b not in dead]
            if not again:
                break
            attempts.update(dict.fromkeys(again, attempt + 1))
            self.sleep(self.backoff.wait_ms(attempt) / 1000)
            sending = df.filter(~batch.isin(list(dead))) if dead else df  # the write overwrites, so what was sent comes again
        spark = df.sparkSession
        if dead:
            why = F.broadcast(spark.createDataFrame(list(dead.values()), "_batch bigint, _reason string, _trace string, _attempts int"))
            line = dlq_line(iso_time(F.current_timestamp()), F.col("_reason"), F.col("_trace"),
                            F.create_map(F.lit("batch"), F.col("_batch").cast("string"), F.lit("offset"), F.col(self.offset_col).cast("string"),
                                         F.lit("attempts"), F.col("_attempts").cast("string")), F.struct(*df.columns))
            (df.withColumn("_of", batch).join(why, F.col("_of") == F.col("_batch")).select(line.alias("value"))
             .write.mode("overwrite").text(_batch_dir(self.dlq, batch_id)))
        log = [("dead_letter" if b in dead else "delivered", n, attempts[b], b) for b, n in sorted(events.items())]
        spark.createDataFrame(log, "status string, events bigint, attempts int, batch bigint").coalesce(1).write.mode("overwrite").parquet(_batch_dir(self.log, batch_id))

    def delivered(self, spark: SparkSession, schema: str) -> DataFrame:
        """What the sink holds; nothing if every batch was dead-lettered."""
        return read_or_empty(spark, self.sink, f"{schema}, batch_id int").drop("batch_id")

    def dead(self, spark: SparkSession) -> DataFrame:
        """The DLQ's entries; nothing if every batch was delivered."""
        return read_dlq(spark, self.dlq)


def transient(e: Exception) -> bool:
    """Whether the retry rule takes an error for a passing one, by its class."""
    return (e.error_class if isinstance(e, SendError) else type(e).__name__) in RETRIABLE


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedupe(stream: DataFrame, keys: list[str]) -> DataFrame:
    """ST7: suppress events already seen, across micro-batches and restarts.

    Streaming ``dropDuplicates``: the seen keys live in the state store,
    hash-partitioned by key over the query's shuffle partitions and
    checkpointed with it, so each micro-batch shuffles only its own rows and
    a replay after a restart (same checkpoint) is dropped too.  No watermark:
    a replay may come at any time, and expiring keys would let it through.
    The state grows with the distinct keys, so it is kept on disk (RocksDB);
    memory holds its cache only.  The store is set here, before the query's
    first start, which fixes it in the checkpoint.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    return stream.dropDuplicates(keys)


class OffsetCommitter:
    """ST4: write a batch, then commit the last offset per stream; commits are monotone.

    The log is two snapshots of all streams' offsets, written in turn: each
    commit merges the other one with the batch by ``max``, so a late or
    replayed batch moves nothing back, a commit that dies half-way leaves the
    other snapshot, and the log doesn't grow with the batches.  An empty batch
    writes nothing to the sink, but carries the snapshot over, so the other one
    is always that of the batch before.
    """

    SCHEMA = "stream string, offset string, half int"

    def __init__(self, root: str, stream_col: str, write: Callable[[DataFrame, int], None], offset_col: str = "ledger_offset"):
        self.root, self.stream_col, self.offset_col, self.write = root, stream_col, offset_col, write

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            self.write(df, batch_id)  # raises: nothing is committed, and the batch is replayed
        new = df.select(F.col(self.stream_col).alias("stream"), F.col(self.offset_col).alias("offset"))
        old = read_or_empty(df.sparkSession, f"{self.root}/half={1 - batch_id % 2}", "stream string, offset string")
        (old.unionByName(new).groupBy("stream").agg(F.max("offset").alias("offset"))
         .write.mode("overwrite").parquet(f"{self.root}/half={batch_id % 2}"))

    def committed(self, spark: SparkSession) -> DataFrame:
        return (read_or_empty(spark, self.root, self.SCHEMA).groupBy(F.col("stream").alias(self.stream_col))
                .agg(F.max("offset").alias("committed_offset")))


class FanOut:
    """ST12: one stream, several sinks: the batch is cached once and written to each.

    Events land partitioned by topic (one folder per destination); per-topic
    counts go to a second sink.  Both overwrite their ``batch_id=N`` folder.
    """

    def __init__(self, events_root: str, counts_root: str, partition_col: str = "topic"):
        self.events_root, self.counts_root, self.partition_col = events_root, counts_root, partition_col

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            df.write.mode("overwrite").partitionBy(self.partition_col).parquet(_batch_dir(self.events_root, batch_id))
            (df.groupBy(self.partition_col).agg(F.count(F.lit(1)).alias("events"))
             .write.mode("overwrite").parquet(_batch_dir(self.counts_root, batch_id)))
        finally:
            df.unpersist()

    def events(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.events_root).drop("batch_id")

    def counts(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.counts_root)
