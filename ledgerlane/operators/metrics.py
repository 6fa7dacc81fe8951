"""Delivery metrics as aggregations over event, batch and error logs.

The reference bumps in-process counters; here each metric is a grouped
aggregate (partial aggregation map-side, then a small shuffle of partial
results), so it reads the same on a table or, where noted, on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.columns import offset_number

# Processing-lag histogram buckets in seconds (upper bounds).
LAG_BUCKETS = ["0.1", "0.25", "0.5", "1.0", "2.5", "5.0", "10.0", "30.0", "60.0", "300.0"]
# Default histogram buckets for publish durations in seconds.
DEFAULT_BUCKETS = ["0.005", "0.01", "0.025", "0.05", "0.075", "0.1", "0.25", "0.5", "0.75", "1.0", "2.5", "5.0",
                   "7.5", "10.0"]


def counter(df: DataFrame, labels: list[str], name: str = "value") -> DataFrame:
    """A labelled counter: events per label set (M1, M3)."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias(name))


def histogram(df: DataFrame, value: str | Column, buckets: list[str], labels: list[str] = (),
              weight: str | None = None) -> DataFrame:
    """Cumulative histogram rows ``(labels..., le, cumulative_count, sample_sum, sample_count)``.

    One aggregation pass (a ``count_if`` per bucket), then the bucket columns
    are unpivoted with ``stack``; ``+Inf`` is the total count.  The sum is
    exact (decimal) and reported as a double, as exposition formats do.  With
    ``weight``, a row stands for that many samples of its value.
    """
    v = F.col(value) if isinstance(value, str) else value
    v = v.cast("decimal(20,6)")
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    aggs = [F.sum(F.when(v <= F.lit(b).cast("decimal(20,6)"), w).otherwise(F.lit(0))).alias(f"_b{i}") for i, b in enumerate(buckets)]
    agg = df.groupBy(*labels).agg(*aggs, F.sum(F.when(v.isNotNull(), w).otherwise(F.lit(0))).alias("sample_count"),
                                  F.sum(v * w if weight else v).cast("double").alias("sample_sum"))
    if not labels:  # no rows at all: zero samples
        agg = agg.na.fill(0, [c for c in agg.columns if c != "sample_sum"])
    pairs = ", ".join([f"'{b}', _b{i}" for i, b in enumerate(buckets)] + ["'+Inf', sample_count"])
    return agg.select(*labels, "sample_sum", "sample_count",
                      F.expr(f"stack({len(buckets) + 1}, {pairs}) AS (le, cumulative_count)"))


def last_offset_gauge(df: DataFrame, labels: list[str], offset: str = "ledger_offset",
                      order: str | Column = "ledger_offset") -> DataFrame:
    """M4: per label set, the numeric value of the last offset that parses; unparseable ones are skipped.

    ``order`` is best numeric (``offset_value``): a fixed-width ordering
    keeps the aggregation hash-based.
    """
    n = offset_number(offset)
    o = F.col(order) if isinstance(order, str) else order
    return (df.select(*labels, n.alias("_n"), o.alias("_o"))
            .filter(F.col("_n").isNotNull())
            .groupBy(*labels).agg(F.max_by("_n", "_o").alias("last_offset")))


def latest_status(log: DataFrame, key: str, status: str, order: str) -> DataFrame:
    """M9: latest status per system (gauge)."""
    return log.groupBy(key).agg(F.max_by(status, order).alias("status"), F.max(order).alias("as_of"))


def transitions(log: DataFrame, key: str, status: str, order: str, chunk: Column,
                src: int = 0, dst: int = 1) -> DataFrame:
    """Per key, how many times the status went ``src`` → ``dst`` in ``order``.

    One scan and one shuffle by (key, chunk): each chunk counts its own
    transitions and keeps its first and last status; the steps from one chunk
    to the next are counted over those, one row per key and chunk.  One busy
    system is spread over as many tasks as it has chunks.
    """
    rows = log.select(key, F.col(status).alias("_s"), F.col(order).alias("_o"), chunk.alias("_c"))
    inside = Window.partitionBy(key, "_c").orderBy("_o")
    step = (F.lag("_s").over(inside) == src) & (F.col("_s") == dst)
    per = (rows.withColumn("_t", step).groupBy(key, "_c")
           .agg(F.count_if("_t").alias("_n"), F.min_by("_s", "_o").alias("_first"), F.max_by("_s", "_o").alias("_last")))
    edge = (F.lag("_last").over(Window.partitionBy(key).orderBy("_c")) == src) & (F.col("_first") == dst)
    return (per.withColumn("_e", F.coalesce(edge.cast("int"), F.lit(0))).groupBy(key)
            .agg((F.sum("_n") + F.sum("_e")).cast("bigint").alias("reconnects")))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))
