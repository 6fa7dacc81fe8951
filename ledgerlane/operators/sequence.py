"""Per-group row numbering and lag without one task per group.

A plain ``row_number() OVER (PARTITION BY topic ORDER BY offset)`` sends a
whole topic to one task; when one topic holds a third of all rows that task
is the job.  Here the order is cut into chunks (a coarse, order-preserving
key such as an offset prefix): rows are numbered inside ``(group, chunk)``
and shifted by the row count of the group's earlier chunks, which come from
a small pre-aggregated table (one row per group and chunk).  Tasks then
hold one chunk each, whatever the skew of the groups.  The prefix over
chunks is itself two-level (inside super-chunks of ``CHUNK_FANOUT`` chunks,
then across super-chunks), so no window of the small tables grows with the
data either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.columns import OFFSET_WIDTH, is_fixed_width
from ledgerlane.session import scratch

# Chunks per super-chunk: prefix counts are summed inside super-chunks, then
# across them, so neither window holds more than ~this many rows per group
# (a one-level prefix would put every chunk of a hot group in one task).
CHUNK_FANOUT = 1000


def offset_chunk(offset: str | Column = "ledger_offset", digits: int = 6) -> Column:
    """Chunk of a fixed-width offset: its value without the last ``digits`` digits (≤ 10**digits offsets per chunk).

    Offsets of another form come after all of those, in one chunk by their text.
    """
    c = F.col(offset) if isinstance(offset, str) else offset
    return F.when(is_fixed_width(c), F.substring(c, 1, OFFSET_WIDTH - digits).cast("bigint")).otherwise(10 ** (OFFSET_WIDTH - digits))


def _super(chunk: str, fanout: int) -> Column:
    return F.floor(F.col(chunk) / fanout).cast("bigint")


def number_rows(df: DataFrame, keys: list[str], order: list[Column | str], chunk: Column,
                name: str = "rn", fanout: int = CHUNK_FANOUT) -> DataFrame:
    """Add ``name`` = 1-based row number within ``keys`` by ``order``.

    ``chunk`` must be a non-negative integer, non-decreasing along ``order``
    within a group.
    """
    d = df.withColumn("_chunk", chunk)
    counts = (d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_super", _super("_chunk", fanout)))
    # rows of the group's earlier super-chunks, then of earlier chunks of the same super-chunk
    supers = counts.groupBy(*keys, "_super").agg(F.sum("_n").alias("_sn"))
    s_before = Window.partitionBy(*keys).orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    sbase = supers.select(*keys, "_super", F.coalesce(F.sum("_sn").over(s_before), F.lit(0)).alias("_sbase"))
    c_before = Window.partitionBy(*keys, "_super").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    cbase = counts.select(*keys, "_super", "_chunk", F.coalesce(F.sum("_n").over(c_before), F.lit(0)).alias("_cbase"))
    bases = (cbase.join(sbase, [*keys, "_super"])
             .select(*keys, "_chunk", (F.col("_sbase") + F.col("_cbase")).alias("_base")))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (d.join(bases, [*keys, "_chunk"])
            .withColumn(name, (F.row_number().over(inner) + F.col("_base")).cast("bigint"))
            .drop("_chunk", "_base"))


def lag_rows(df: DataFrame, keys: list[str], order: list[Column | str], chunk: Column,
             value: str, name: str, fanout: int = CHUNK_FANOUT) -> DataFrame:
    """Add ``name`` = ``value`` of the previous row within ``keys`` by ``order``.

    Inside a chunk this is ``lag``; the first row of a chunk takes the last
    value of the group's closest earlier chunk, found in a small per-chunk
    table (two levels: within the super-chunk, else the previous super-chunk's
    last).  ``chunk`` as for ``number_rows``.
    """
    d = df.withColumn("_chunk", chunk)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    # A single (numeric) ordering column keeps the buffer fixed-width (hash aggregate).
    by = order_cols[0] if len(order_cols) == 1 else F.struct(*order_cols)
    last = (d.groupBy(*keys, "_chunk").agg(F.max_by(F.col(value), by).alias("_last"))
            .withColumn("_super", _super("_chunk", fanout)))
    in_super = Window.partitionBy(*keys, "_super").orderBy("_chunk")
    chunks = last.select(*keys, "_super", "_chunk", F.lag("_last").over(in_super).alias("_prev_chunk"),
                         (F.row_number().over(in_super) == 1).alias("_first"))
    supers = last.groupBy(*keys, "_super").agg(F.max_by("_last", "_chunk").alias("_slast"))
    s_prev = Window.partitionBy(*keys).orderBy("_super")
    sprev = supers.select(*keys, "_super", F.lag("_slast").over(s_prev).alias("_prev_super"))
    carry = (chunks.join(sprev, [*keys, "_super"])
             .select(*keys, "_chunk", F.when(F.col("_first"), F.col("_prev_super"))
                     .otherwise(F.col("_prev_chunk")).alias("_carry")))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (d.join(carry, [*keys, "_chunk"])
            .withColumn(name, F.coalesce(F.lag(value).over(inner),
                                         F.when(F.row_number().over(inner) == 1, F.col("_carry"))))
            .drop("_chunk", "_carry"))


def number_rows_ranged(df: DataFrame, keys: list[str], order: list[Column | str], name: str = "rn",
                       partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number within ``keys`` by ``order``, for groups of any size.

    For orders without a chunk key, such as the events of one transaction.
    The rows are range-partitioned on (keys, order) and written, so a group
    that holds most rows lies in many partitions of bounded size and every
    later read finds the same rows in the same partition; a row's number is
    its place in the partition plus the group's rows in earlier partitions
    (one row per group and partition).  Rows equal in ``order`` must be
    interchangeable.
    """
    parts = [partitions] if partitions else []
    placed = df.repartitionByRange(*parts, *keys, *order).withColumn("_pid", F.spark_partition_id())
    path = scratch(df.sparkSession, "ranged")
    placed.write.parquet(path)
    rows = df.sparkSession.read.schema(placed.schema).parquet(path)
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = (rows.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"))
            .select(*keys, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    inner = Window.partitionBy(*keys, "_pid").orderBy(*order)
    return (rows.join(base, [*keys, "_pid"])
            .withColumn(name, (F.row_number().over(inner) + F.col("_base")).cast("bigint")).drop("_pid", "_base"))
