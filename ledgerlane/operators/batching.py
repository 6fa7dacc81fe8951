"""Batches of a routed event table (ST3, table form).

The reference groups a stream into batches of at most ``n`` events or a time
limit, whichever comes first.  On a table, a batch is ``(stream, slot,
batch_no)``: slots are the time limit's intervals of the arrival time, and in
a slot ``batch_no = (row number in offset order - 1) div n``; without a limit
all events are in slot 0.  Numbering is chunked (``number_rows``) so a stream
holding most rows still spreads over many tasks.  Empty batches never appear:
a batch exists only through its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.columns import max_offset, min_offset
from ledgerlane.operators.sequence import number_rows, offset_chunk

BATCH_SIZE = 100  # fixed value: events per batch
PAGE_SIZE = 100   # fixed value: events per poll
PAGE_CHUNK = 100_000


def assign_batches(events: DataFrame, stream_col: str = "topic", size: int = BATCH_SIZE,
                   order_col: str = "ledger_offset", arrival_ms: Column | None = None, within_ms: int | None = None) -> DataFrame:
    """Add ``slot`` and ``batch_no``.  ``arrival_ms`` doesn't fall along ``order_col`` within a stream."""
    slot = F.floor(arrival_ms / within_ms).cast("bigint") if within_ms else F.lit(0).cast("bigint")
    n = number_rows(events.withColumn("slot", slot), [stream_col, "slot"], [F.col(order_col)], offset_chunk(order_col), "_rn")
    return n.withColumn("batch_no", F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn")


def batch_manifest(batched: DataFrame, stream_col: str = "topic", order_col: str = "ledger_offset", opaque: bool = False) -> DataFrame:
    """One row per batch: stream, slot, batch_no, events, first and last (fixed-width, or ``opaque``) offset."""
    return batched.groupBy(stream_col, "slot", "batch_no").agg(
        F.count(F.lit(1)).alias("events"), min_offset(order_col, opaque).alias("first_offset"),
        max_offset(order_col, opaque).alias("last_offset"))


def pages(events: DataFrame, key: str, size: int = PAGE_SIZE) -> DataFrame:
    """The table as a poller with a page limit sees it: add ``page`` (0, 1, ... in ``key`` order) and ``cursor``.

    A poll gets at most ``size`` events after the cursor, the key of the last
    event seen.  Numbered by chunks of the (non-negative integer) key, so no
    task orders the whole table; a page's window holds ``size`` rows.
    """
    n = number_rows(events.withColumn("_all", F.lit(0)), ["_all"], [F.col(key)], F.floor(F.col(key) / PAGE_CHUNK).cast("bigint"), "_rn")
    paged = n.withColumn("page", F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn", "_all")
    return paged.withColumn("cursor", F.max(key).over(Window.partitionBy("page")))
