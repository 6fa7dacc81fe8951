"""ST10: the dead-letter queue as a stream that goes through the normal path again, exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.session import read_or_empty
from ledgerlane.streaming.deliver import TransactionalSink
from ledgerlane.streaming.dlq import DLQ_LINE_SCHEMA

REPLAYS = "replays"  # the metadata entry that counts how often an entry was sent again


def dlq_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The entries of a DLQ folder as a stream; entries that are written while it runs come too."""
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").text(path)
    return raw.select(F.from_json("value", DLQ_LINE_SCHEMA).alias("d"), "value").select("d.*", "value")


class Reprocessor:
    """``foreachBatch`` writer that sends DLQ entries again.

    Entries that ``accepts`` takes go to a transactional sink: data first,
    then one marker, which is the replay mark; a batch that dies between is
    tried again under its number and overwrites its data, so nothing is there
    twice.  The others go back to the DLQ with one more replay counted, as
    the file of this batch, and after ``most`` replays into quarantine; so do
    entries that can't be decoded.
    """

    def __init__(self, root: str, dlq: str, schema: str, accepts: Callable[[], Column], most: int = 3, fail_before_mark_of: int | None = None):
        self.root, self.dlq, self.schema, self.accepts, self.most = root.rstrip("/"), dlq.rstrip("/"), schema, accepts, most
        self.sink = TransactionalSink(f"{self.root}/sent", "event_id", fail_before_mark_of)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        times = F.coalesce(F.try_element_at("metadata", F.lit(REPLAYS)).try_cast("int"), F.lit(0))
        got = df.withColumn("_e", F.from_json("event", self.schema)).withColumn("_replays", times).persist()
        try:
            decoded = F.col("_e.event_id").isNotNull()
            entry = F.struct("timestamp", "reason", "stackTrace", "metadata", "value")
            good = got.filter(decoded).select(entry.alias("_entry"), "reason", F.col("_replays").alias("replays"), "_e.*").withColumn("_ok", F.coalesce(self.accepts(), F.lit(False)))
            failed = good.filter("NOT _ok")
            event = [F.col(c) for c in self.spark_columns(df.sparkSession)]
            more = F.map_concat(F.map_filter(F.coalesce("_entry.metadata", F.create_map().cast("map<string,string>")), lambda k, _: k != REPLAYS),
                                F.create_map(F.lit(REPLAYS), (F.col("replays") + 1).cast("string")))
            again = F.to_json(F.struct("_entry.timestamp", "reason", "_entry.stackTrace", more.alias("metadata"), F.struct(*event).alias("event")))
            # The way back first: were it last, a batch that dies after its mark would not be tried again and lose it.
            failed.filter(F.col("replays") + 1 < self.most).select(again.alias("value")).write.mode("overwrite").text(f"{self.dlq}/replayed={batch_id}")
            out = failed.filter(F.col("replays") + 1 >= self.most).select("_entry.value").unionByName(got.filter(~F.coalesce(decoded, F.lit(False))).select("value"))
            out.write.mode("overwrite").text(f"{self.root}/quarantine/batch_id={batch_id}")
            sent = good.filter("_ok").select("reason", "replays", *event)
            self.sink(sent, batch_id)
        finally:
            got.unpersist()

    def spark_columns(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.schema).columns

    def sent(self, spark: SparkSession) -> DataFrame:
        """(reason, replays, the event's columns) of every entry that was sent."""
        return self.sink.committed(spark, f"reason string, replays int, {self.schema}")

    def quarantined(self, spark: SparkSession) -> DataFrame:
        raw = read_or_empty(spark, f"{self.root}/quarantine", "value string", "text")
        return raw.select(F.from_json("value", DLQ_LINE_SCHEMA).alias("d"), "value").select("d.*", "value")
