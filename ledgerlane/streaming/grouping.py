"""ST3 on a stream: batches by size or time that stay open between micro-batches.

The open batch of every stream is a row of a small tail table, written per
micro-batch in two alternating versions.  A micro-batch continues the tails:
its events are numbered from where the tail's slot stands, whole batches go to
the manifest, and the rest is the new tail.  So the batches are the same
however the stream was cut into micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import max_offset, min_offset
from ledgerlane.operators.batching import BATCH_SIZE
from ledgerlane.operators.sequence import number_rows, offset_chunk
from ledgerlane.session import read_or_empty

MANIFEST = "stream string, slot bigint, batch_no bigint, events bigint, first_offset string, last_offset string"
TAIL = f"{MANIFEST}, done boolean"  # done: it is full and in the manifest, and kept for its number


class OpenBatches:
    """``foreachBatch`` writer of the manifest: at most ``size`` events or ``within_ms`` of arrival time a batch.

    Events of a stream come in the order of ``offset_col`` (fixed-width), and
    a slot of ``within_ms`` closes for all streams when an event of a later
    slot has come from any of them: the ledger's clock is its order.
    A micro-batch that is tried again reads the other version of the tail and
    overwrites its own, and its manifest.
    """

    def __init__(self, root: str, stream_col: str, arrival_ms: Column, within_ms: int, size: int = BATCH_SIZE, offset_col: str = "ledger_offset"):
        self.root, self.stream_col, self.arrival_ms, self.within_ms, self.size, self.offset_col = root.rstrip("/"), stream_col, arrival_ms, within_ms, size, offset_col
        self.last = 0

    def _tail(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return read_or_empty(spark, f"{self.root}/tail/version={batch_id % 2}", TAIL)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        tail = self._tail(spark, batch_id - 1) if batch_id else spark.createDataFrame([], TAIL)
        slot = F.floor(self.arrival_ms / self.within_ms).cast("bigint")
        events = df.select(F.col(self.stream_col).alias("stream"), F.col(self.offset_col).alias("offset"), slot.alias("slot"))
        numbered = number_rows(events, ["stream", "slot"], [F.col("offset")], offset_chunk("offset"), "n")
        carried = tail.select("stream", "slot", (F.col("batch_no") * self.size + F.col("events")).alias("before"))
        numbered = numbered.join(carried, ["stream", "slot"], "left")
        no = F.floor((F.col("n") + F.coalesce("before", F.lit(0)) - 1) / self.size).cast("bigint")
        parts = (numbered.withColumn("batch_no", no).groupBy("stream", "slot", "batch_no")
                 .agg(F.count("*").alias("events"), min_offset("offset").alias("first_offset"), max_offset("offset").alias("last_offset")))
        merged = (parts.withColumn("done", F.lit(False)).unionByName(tail).groupBy("stream", "slot", "batch_no")
                  .agg(F.sum("events").alias("events"), min_offset("first_offset").alias("first_offset"), max_offset("last_offset").alias("last_offset"),
                       F.bool_or("done").alias("done"))).persist()
        try:
            clock = merged.agg(F.max("slot")).first()[0]
            full = F.col("events") == self.size
            closed = ~F.col("done") & (full | (F.col("slot") < F.lit(clock)))
            merged.filter(closed).drop("done").write.mode("overwrite").parquet(f"{self.root}/manifest/micro_batch={batch_id}")
            now = merged.filter(F.col("slot") == F.lit(clock))
            last = now.groupBy("stream").agg(F.max("batch_no").alias("batch_no"))
            (now.join(last, ["stream", "batch_no"], "left_semi").withColumn("done", full).select(*tail.columns)
             .write.mode("overwrite").parquet(f"{self.root}/tail/version={batch_id % 2}"))
            self.last = batch_id
        finally:
            merged.unpersist()

    def manifest(self, spark: SparkSession) -> DataFrame:
        """The closed batches, and the open ones of a stream that has ended after micro-batch ``last``."""
        done = read_or_empty(spark, f"{self.root}/manifest", f"{MANIFEST}, micro_batch int").drop("micro_batch")
        left = self._tail(spark, self.last).filter("NOT done").drop("done")
        return done.unionByName(left).withColumnRenamed("stream", self.stream_col)
