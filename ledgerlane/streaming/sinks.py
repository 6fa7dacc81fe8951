"""ST12 with sinks that fail alone: each has its own commit log and catches up from its own last offset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.session import read_or_empty
from ledgerlane.sources.archive import Archive

LOG = "first_after string, upto string, events bigint, caught_up boolean, sink string"
BEGIN = ""  # before every offset


class IndependentSinks:
    """``foreachBatch`` writer to several named sinks over one polled archive.

    A sink is a function of (events, part): it overwrites the part, whose name
    is the offset before its first event.  A sink that raises keeps its
    position; the others go on.  At the next micro-batch it is given, from
    the archive, all events after its position, in one part.  So a part and
    its commit are written once or again, and no event is lost or sent to a
    sink twice.
    """

    def __init__(self, archive: Archive, root: str, sinks: dict[str, Callable[[DataFrame, str], None]]):
        self.archive, self.root, self.sinks = archive, root.rstrip("/"), sinks
        self.errors: dict[str, str] = {}  # the last error of each sink that is behind

    def log(self, spark: SparkSession) -> DataFrame:
        """(sink, first_after, upto, events, caught_up): a row per part."""
        return read_or_empty(spark, f"{self.root}/commits", LOG)

    def position(self, spark: SparkSession, sink: str) -> str:
        return self.log(spark).filter(F.col("sink") == sink).agg(F.max("upto")).first()[0] or BEGIN

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark, offset = df.sparkSession, self.archive.offset_col
        df = df.persist()
        try:
            least, last = df.agg(F.min(offset), F.max(offset)).first()
            if last is None:
                return
            for name in self.sinks:
                at = self.position(spark, name)
                if at >= last:
                    continue  # a micro-batch tried again, for the sake of another sink
                behind = self.archive.files(at, last) if at < least else []
                fresh = not self._missing(at, least, behind)
                events = df.filter(F.col(offset) > at) if fresh else self.archive.replay(at, last).select(*df.columns)
                self._send(name, events, at, last, not fresh)
        finally:
            df.unpersist()

    def _missing(self, at: str, least: str, files: list[str]) -> bool:
        """Whether the archive has events after the sink's position and before the micro-batch."""
        return bool(files) and not self.archive.replay(at, least).filter(F.col(self.archive.offset_col) < least).isEmpty()

    def _send(self, name: str, events: DataFrame, at: str, last: str, caught_up: bool) -> None:
        spark, part = events.sparkSession, at or "begin"
        try:
            self.sinks[name](events, part)
        except Exception as e:  # noqa: BLE001 - a sink's error is its own
            self.errors[name] = str(e)
            return
        self.errors.pop(name, None)
        (spark.range(1).select(F.lit(at).alias("first_after"), F.lit(last).alias("upto"), F.lit(events.count()).cast("bigint").alias("events"), F.lit(caught_up).alias("caught_up"))
         .write.mode("overwrite").parquet(f"{self.root}/commits/sink={name}/part={part}"))

    def catch_up(self, spark: SparkSession) -> list[str]:
        """Give every sink that is behind the rest of the archive; returns the sinks that still fail."""
        last = self.archive.index().agg(F.max("last_offset")).first()[0]
        for name in self.sinks:
            at = self.position(spark, name)
            if last is not None and at < last:
                self._send(name, self.archive.replay(at, last), at, last, True)
        return sorted(self.errors)
