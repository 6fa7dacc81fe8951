"""Live metrics: observed on the stream (M12), and folds that take rows in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerlane.operators.metrics import latest_status, transitions
from ledgerlane.session import read_or_empty

DELIVERY = "delivery"
REMEMBERED = "spark.sql.streaming.numRecentProgressUpdates"  # a query forgets its earlier micro-batches: 99 stay unless this says more


def remembering(spark: SparkSession) -> SparkSession:
    """A session set up as ``spark`` is, but whose queries remember the progress of every micro-batch, however many there are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(REMEMBERED, 2**31 - 1)
    return own


def observed(stream: DataFrame, groups: dict[str, Column], failed: Column, name: str = DELIVERY) -> DataFrame:
    """``stream`` with received and failed counts per group observed on the way: no pass of their own."""
    parts = []
    for i, condition in enumerate(groups.values()):
        parts += [F.count_if(condition).alias(f"received_{i}"), F.count_if(condition & failed).alias(f"failed_{i}")]
    return stream.observe(name, *parts)


class MetricsLog(StreamingQueryListener):
    """Takes the observed counts of every micro-batch from the query's progress."""

    def __init__(self, groups: list[str], name: str = DELIVERY):
        self.groups, self.name, self.rows = groups, name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(event.progress)

    def take(self, progress) -> None:
        """One micro-batch's counts; a progress that is reported twice counts once."""
        got = progress.observedMetrics.get(self.name)
        if got is not None:
            for i, g in enumerate(self.groups):
                self.rows[(str(progress.runId), progress.batchId, g)] = (got[f"received_{i}"], got[f"failed_{i}"])

    def finish(self, query: StreamingQuery) -> None:
        """What the ended query still remembers: the listener is told later than the query ends.  All of it, if it ran in a ``remembering`` session."""
        for p in query.recentProgress:
            self.take(p)

    def table(self, spark: SparkSession) -> DataFrame:
        """(batch_id, destination_type, received, processed, failed): a row per micro-batch and group."""
        rows = [(b, g, r, r - f, f) for (_, b, g), (r, f) in sorted(self.rows.items())]
        return spark.createDataFrame(rows, "batch_id bigint, destination_type string, received bigint, processed bigint, failed bigint")


class StatusFold:
    """``foreachBatch`` writer that keeps latest status and transitions per key, with rows in any order.

    Rows are kept by chunk of their order; a micro-batch folds the chunks it
    touches again, each to its first and last status and its number of
    transitions.  Folds of chunks put together give the whole, so a late
    chunk in the middle is one more row.
    """

    def __init__(self, root: str, key: str, status: str, order: str, width: int):
        self.root, self.key, self.status, self.order, self.width = root.rstrip("/"), key, status, order, width
        self.rows = f"{key} string, {status} int, {order} bigint, chunk bigint, batch int"
        self.folds = f"{key} string, n bigint, first_at bigint, first int, last_at bigint, last int, chunk bigint"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = df.select(F.col(self.key).cast("string").alias(self.key), F.col(self.status).cast("int").alias(self.status), F.col(self.order).cast("bigint").alias(self.order),
                         F.floor(F.col(self.order) / self.width).cast("bigint").alias("chunk"), F.lit(batch_id).alias("batch")).persist()
        try:
            touched = [r["chunk"] for r in rows.select("chunk").distinct().collect()]  # a number for each chunk that the batch falls into
            if not touched:
                return
            (rows.repartition("chunk").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk", "batch").parquet(f"{self.root}/rows"))
            here = read_or_empty(spark, f"{self.root}/rows", self.rows).filter(F.col("chunk").isin(touched))
            # The chunk's own transitions: those of its rows as if there were no other chunk.
            steps = transitions(here.withColumn("k", F.struct(self.key, "chunk")), "k", self.status, self.order, F.lit(0)).select("k", F.col("reconnects").alias("n"))
            ends = here.groupBy(F.struct(self.key, "chunk").alias("k")).agg(
                F.min(self.order).alias("first_at"), F.min_by(self.status, self.order).alias("first"), F.max(self.order).alias("last_at"), F.max_by(self.status, self.order).alias("last"))
            (steps.join(ends, "k").select(f"k.{self.key}", "n", "first_at", "first", "last_at", "last", "k.chunk").repartition("chunk")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(f"{self.root}/folds"))
        finally:
            rows.unpersist()

    def _folds(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, f"{self.root}/folds", self.folds)

    def reconnects(self, spark: SparkSession) -> DataFrame:
        """(key, reconnects): the chunks' own transitions and those from one chunk to the next."""
        folds = self._folds(spark)
        ends = folds.select(self.key, F.col("first").alias("s"), (F.col("chunk") * 2).alias("o")).unionByName(folds.select(self.key, F.col("last").alias("s"), (F.col("chunk") * 2 + 1).alias("o")))
        # A chunk's first and last status may differ without being next to each other: that step is not counted here.
        inside = folds.groupBy(self.key).agg(F.sum("n").alias("n"), F.count_if((F.col("first") == 0) & (F.col("last") == 1)).alias("own"))
        between = transitions(ends, self.key, "s", "o", F.floor(F.col("o") / 2_000))
        return between.join(inside, self.key).select(self.key, (F.col("reconnects") - F.col("own") + F.col("n")).cast("bigint").alias("reconnects"))

    def latest(self, spark: SparkSession) -> DataFrame:
        return latest_status(self._folds(spark).withColumnRenamed("last", self.status), self.key, self.status, "last_at")
