"""Dead-letter queue as JSON lines (ST9) and its inspection / replay (ST10)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.session import read_or_empty

DLQ_LINE_SCHEMA = ("timestamp string, reason string, stackTrace string, metadata map<string,string>, "
                   "event string")


def dlq_line(timestamp: Column, reason: Column, stack: Column, metadata: Column, event: Column) -> Column:
    """One DLQ line: ``{timestamp, reason, stackTrace, metadata{}, event{}}``; escaping is ``to_json``'s."""
    return F.to_json(F.struct(timestamp.alias("timestamp"), reason.alias("reason"), stack.alias("stackTrace"),
                              metadata.alias("metadata"), event.alias("event")))


def write_dlq(lines: DataFrame, path: str, col: str = "line") -> None:
    """Append lines to the DLQ folder (text files, one JSON object per line)."""
    lines.select(F.col(col).alias("value")).write.mode("append").text(path)


def read_dlq(spark: SparkSession, path: str) -> DataFrame:
    """Parse the DLQ back; ``event`` stays JSON text, to be decoded by its producer's schema."""
    raw = read_or_empty(spark, path, "value string", "text", nested=True)
    return raw.select(F.from_json("value", DLQ_LINE_SCHEMA).alias("d")).select("d.*")


def by_reason(dlq: DataFrame) -> DataFrame:
    """ST10, inspection: entries per reason."""
    return dlq.groupBy("reason").agg(F.count(F.lit(1)).alias("entries"))


def replay(dlq: DataFrame, schema: str, send: Callable[[DataFrame], None]) -> None:
    """ST10, reprocessing: decode the entries' events and send them again; their reason goes along."""
    send(dlq.select("reason", F.from_json("event", schema).alias("e")).select("reason", "e.*"))
