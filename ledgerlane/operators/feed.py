"""Feeds and ordered delivery (L1, L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEED_SIZE = 200  # fixed value: the UI keeps the newest 200 events


def latest_feed(events: DataFrame, n: int = FEED_SIZE) -> DataFrame:
    """L1: newest-first, last ``n`` events.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n``, then only ``n × tasks`` rows meet — no global sort.
    """
    return events.orderBy(F.desc("ledger_offset"), F.desc("event_type"), F.desc_nulls_last("choice")).limit(n)


def ordered_for_delivery(events: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """L2: lay events out so that each (topic, key) is delivered in offset order.

    Range partitioning on (keys, offset) gives ordered, size-balanced
    partitions: a hot key spans several consecutive partitions instead of
    one task, and a sink sending partitions in index order (each sorted)
    delivers every key's events in ledger order.
    """
    order = [*keys, "ledger_offset", "event_type"]
    parts = [partitions] if partitions else []
    return events.repartitionByRange(*parts, *order).sortWithinPartitions(*order)


def delivery_report(delivered: DataFrame, keys: list[str], offset: str = "ledger_offset") -> DataFrame:
    """Check for L2: per ``keys[0]`` (the topic, null included): ``events``, ``keys`` (distinct key groups)
    and ``out_of_order`` (events whose offset is below the previous event of the same key in delivery order).

    Delivery order is (partition index, position in partition).  Each event
    is compared with the one before it in its partition (a window over the
    partition, whose size the layout bounds); keys that go on in the next
    partition are stitched in an edge table of one row per partition, whose
    size is the partition count, not the data.
    """
    topic = keys[0]
    # The position is taken in the delivered partition, before any shuffle.
    d = delivered.select(*keys, F.col(offset).alias("_o"), F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    d = d.select(F.col(topic).alias("topic"), F.struct(*keys).alias("_k"), "_o", "_p", "_i")
    inside = Window.partitionBy("_p").orderBy("_i")
    rows = d.withColumns({"_b": F.lag(F.struct("_k", "_o")).over(inside), "_last": F.lead("_i").over(inside).isNull()})
    same = F.col("_b").isNotNull() & F.col("_b._k").eqNullSafe(F.col("_k"))
    per = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("events"), F.count_if(~same).alias("new_keys"),
                                    F.count_if(same & (F.col("_o") < F.col("_b._o"))).alias("bad"))
    # The first and the last event of each partition: before a first one stands the last of the partition before.
    edges = rows.filter(F.col("_b").isNull() | F.col("_last")).withColumn("_e", F.lag(F.struct("_k", "_o")).over(Window.orderBy("_p", "_i")))
    on = edges.filter(F.col("_b").isNull() & F.col("_e").isNotNull() & F.col("_e._k").eqNullSafe(F.col("_k")))
    carried = on.groupBy(F.col("topic").alias("t")).agg(F.count(F.lit(1)).alias("continued"), F.count_if(F.col("_o") < F.col("_e._o")).alias("edge_bad"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (per.join(carried, F.col("topic").eqNullSafe(F.col("t")), "left")
            .select("topic", F.col("events").cast("bigint").alias("events"), (F.col("new_keys") - n("continued")).cast("bigint").alias("keys"),
                    (F.col("bad") + n("edge_bad")).cast("bigint").alias("out_of_order")))
