"""L1 on a stream: the newest events, kept up to date micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.operators.feed import FEED_SIZE, latest_feed
from ledgerlane.session import read_or_empty


class FeedSink:
    """``foreachBatch`` writer of a snapshot of the newest ``n`` events, in two versions written in turn.

    The newest of a union are the newest of its parts' newest, so a snapshot
    and a batch merge in any order.  A batch that is tried again reads the
    other version and overwrites its own; an empty batch carries it over.
    """

    def __init__(self, root: str, schema: str, n: int = FEED_SIZE):
        self.root, self.schema, self.n, self.last = root.rstrip("/"), schema, n, 0

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        old = self._version(spark, batch_id - 1) if batch_id else spark.createDataFrame([], self.schema)
        latest_feed(old.unionByName(df.select(*old.columns)), self.n).write.mode("overwrite").parquet(f"{self.root}/version={batch_id % 2}")
        self.last = batch_id

    def _version(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return read_or_empty(spark, f"{self.root}/version={batch_id % 2}", self.schema)

    def feed(self, spark: SparkSession) -> DataFrame:
        return self._version(spark, self.last)
