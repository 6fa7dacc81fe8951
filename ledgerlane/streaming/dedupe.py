"""ST7 with bounded state: committed ids in a table cut by offset, behind Bloom filters.

A batch looks only at the buckets of offsets that its events fall into, and
of those opens only the ones whose filter knows one of its ids; a batch of new
events opens none.  There is no state store: what a batch holds is the batch,
the filters of its buckets and the ids of the buckets that it opens, however
long the stream runs, and a replay of any age is still found.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.session import read_or_empty

FILTER_BITS = 1 << 15  # a piece of a Bloom filter, as the bitmap functions cut it
HASHES = 4
BITS_PER_ID = 12


class SeenIds:
    """The ids that were committed, by bucket of ``width`` offsets; ``ids`` is how many a bucket holds about."""

    def __init__(self, spark: SparkSession, root: str, id_type: str, width: int, ids: int | None = None):
        self.spark, self.root, self.id_type, self.width = spark, root.rstrip("/"), id_type, width
        self.pieces = 1 << max(0, math.ceil(math.log2((ids or width) * BITS_PER_ID / FILTER_BITS)))
        self.opened: list[int] = []  # buckets that the last batch opened

    def _bits(self, df: DataFrame) -> DataFrame:
        """(bucket, id, piece, bit): the bits of each id."""
        bits = F.array(*[F.pmod(F.xxhash64(F.lit(j), F.col("id")), F.lit(self.pieces * FILTER_BITS)) for j in range(HASHES)])
        return df.select("bucket", "id", F.explode(bits).alias("at")).select("bucket", "id", F.floor(F.col("at") / FILTER_BITS).alias("piece"), (F.col("at") % FILTER_BITS).alias("bit"))

    def _before(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Without what this very batch wrote when it was tried before."""
        return df.filter(F.col("batch") < batch_id)

    def unseen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of ``batch`` (with ``bucket`` and ``id``) whose id no earlier batch has committed."""
        ids = batch.select("bucket", "id").distinct()
        filters = read_or_empty(self.spark, f"{self.root}/filters", "piece bigint, bits binary, bucket bigint, batch int")
        touched = [r["bucket"] for r in ids.select("bucket").distinct().collect()]  # a number for each bucket that the batch falls into
        filters = self._before(filters.filter(F.col("bucket").isin(touched)), batch_id).groupBy("bucket", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
        asked = self._bits(ids)
        byte = F.conv(F.hex(F.expr("substring(bits, CAST(bit div 8 AS INT) + 1, 1)")), 16, 10).cast("bigint")
        known = asked.join(filters, ["bucket", "piece"], "left").withColumn("set", F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1L, CAST(bit % 8 AS INT))")) != 0, F.lit(False)))
        maybe = known.groupBy("bucket", "id").agg(F.bool_and("set").alias("maybe")).filter("maybe").select("bucket", "id")
        self.opened = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())
        if not self.opened:
            return batch
        seen = read_or_empty(self.spark, f"{self.root}/ids", f"id {self.id_type}, bucket bigint, batch int").filter(F.col("bucket").isin(self.opened))
        return batch.join(self._before(seen, batch_id).select("bucket", "id").distinct(), ["bucket", "id"], "left_anti")

    def commit(self, rows: DataFrame, batch_id: int) -> None:
        """Remember the ids of ``rows`` (bucket, id); a batch tried again writes the same places again."""
        ids = rows.select("bucket", "id").distinct()
        pieces = self._bits(ids).groupBy("bucket", "piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
        for name, df in (("ids", ids), ("filters", pieces)):
            (df.withColumn("batch", F.lit(batch_id)).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "batch").parquet(f"{self.root}/{name}"))


class DedupeSink:
    """Writes each event id once, across batches, restarts and replays of any age.

    The data of a batch is written before its ids: a batch that dies between
    is tried again, finds its own ids not there (or leaves out its own), and
    overwrites its data.  Of rows with one id in a batch one stays.
    """

    def __init__(self, spark: SparkSession, root: str, id_col: str, offset_col: str, schema: str, width: int, ids: int | None = None):
        self.root, self.id_col, self.offset_col, self.schema = root.rstrip("/"), id_col, offset_col, schema
        id_type = next(f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema if f.name == id_col)
        self.seen = SeenIds(spark, f"{self.root}/seen", id_type, width, ids)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        bucket = F.floor(F.col(self.offset_col).cast("bigint") / self.seen.width).cast("bigint")
        rows = df.dropDuplicates([self.id_col]).withColumn("bucket", bucket).withColumn("id", F.col(self.id_col)).persist()
        try:
            new = self.seen.unseen(rows, batch_id).persist()
            try:
                new.select(*df.columns).write.mode("overwrite").parquet(f"{self.root}/data/batch_id={batch_id}")
                self.seen.commit(new, batch_id)
            finally:
                new.unpersist()
        finally:
            rows.unpersist()

    def written(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, f"{self.root}/data", f"{self.schema}, batch_id int").drop("batch_id")
