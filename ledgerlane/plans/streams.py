"""Registered queries that run a Structured Streaming query to the end (S3, S5, ST2, ST4–ST7, ST9–ST12).

Where batches matter, the input is an event archive in the shared folder that
the stream polls page by page; elsewhere a table's own files are streamed.
Each callable runs its stream to the end and returns a batch DataFrame over
what the sink committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from ledgerlane.functions.columns import iso_time, offset_of
from ledgerlane.operators import route as R
from ledgerlane.plans.delivery import BACKOFF, _retry_sql, failed_sends
from ledgerlane.plans.metrics import _DEST_SQL, _K_SQL, record_results, status_log
from ledgerlane.plans.oracle import offset_at_sql, with_ledger, with_routed
from ledgerlane.plans.registry import ORACLE, register
from ledgerlane.plans.routing import routed_flat
from ledgerlane.plans.scans import ARCHIVE_FILE_ROWS, ledger_archive
from ledgerlane.session import read_or_empty, scratch
from ledgerlane.sources.archive import Archive
from ledgerlane.sources.ledger import bounded_orders, flat_events_from_orders, offset_at
from ledgerlane.sources.tables import table
from ledgerlane.streaming import deliver as DV
from ledgerlane.streaming import dlq as Q
from ledgerlane.streaming import retry as RT
from ledgerlane.streaming.dedupe import DedupeSink
from ledgerlane.streaming.feed import FeedSink
from ledgerlane.streaming.live import MetricsLog, StatusFold, observed, remembering
from ledgerlane.streaming.poller import MOST_PAGES, PAGE_SIZE, drain, polled
from ledgerlane.streaming.reprocess import REPLAYS, Reprocessor, dlq_stream
from ledgerlane.streaming.sinks import IndependentSinks
from ledgerlane.streaming.sources import run_to_end, table_stream

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
FLAT_OUT = ["event_id", "ledger_offset", "event_type", "template_id", "contract_id"]


def _orders_stream(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Orders as a stream, in the key range that an offset range ``(start, end]`` implies (it reaches the scan)."""
    return bounded_orders(table_stream(spark, sf_dir, "orders"), start, end)


# Events with a fixed-width offset of their own, as the archive orders them.
EVENTS = "ledger_offset string, event_id bigint, event_type string, user_id bigint, value double"
BATCH_PAGES = 20    # polls of 100 events in a micro-batch
DEDUPE_PAGES = 100
EVENT_FILE_ROWS = 100_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(offset_of("event_id").alias("ledger_offset"), "event_id", "event_type", "user_id", "value")


def _events_archive(spark: SparkSession, events: DataFrame) -> Archive:
    out = Archive(spark, scratch(spark, "events-archive"), EVENTS, file_rows=EVENT_FILE_ROWS)
    out.append(events)
    return out


def _to_parquet(stream: DataFrame, spark: SparkSession, name: str) -> str:
    out, ck = scratch(spark, f"{name}-sink"), scratch(spark, f"{name}-ckpt")
    run_to_end(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck))
    return out


SCAN_FROM = (1, 5)  # shares of the ledger's range of offsets
SCAN_TO = (2, 3)
STORED = (1, 10)


@register("scan_flat_events", with_ledger(
    f"SELECT {', '.join(FLAT_OUT)} FROM flat_ledger WHERE ledger_offset > {offset_at_sql(SCAN_FROM)}"))
def scan_flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: flat-transaction stream from a start offset (exclusive), a fifth along the ledger; the derivation runs on the stream."""
    start = offset_at(spark, sf_dir, SCAN_FROM)
    ev = flat_events_from_orders(_orders_stream(spark, sf_dir, start=start))
    out = _to_parquet(ev.filter(F.col("ledger_offset") > F.lit(start)).select(*FLAT_OUT), spark, "scan")
    return spark.read.parquet(out)


@register("bounded_stream", with_ledger(
    f"SELECT {', '.join(FLAT_OUT)} FROM flat_ledger WHERE ledger_offset <= {offset_at_sql(SCAN_TO)}"))
def bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: stream up to an explicit end offset, two thirds along the ledger, then stop (``availableNow``)."""
    end = offset_at(spark, sf_dir, SCAN_TO)
    ev = flat_events_from_orders(_orders_stream(spark, sf_dir, end=end))
    out = _to_parquet(ev.filter(F.col("ledger_offset") <= F.lit(end)).select(*FLAT_OUT), spark, "bounded")
    return spark.read.parquet(out)


POLLED = "event_id string, ledger_offset string, page bigint, cursor string"


class Stopped(RuntimeError):
    """A planned stop of a stream."""


def _stopping(write, at: int | None):
    """``write``, but ended before micro-batch ``at``."""
    def batch(df: DataFrame, batch_id: int) -> None:
        if batch_id == at:
            raise Stopped(f"before batch {batch_id}")
        write(df, batch_id)
    return batch


def _drain_twice(stream, write, checkpoint: str, stop_at: int) -> None:
    """Run until micro-batch ``stop_at`` is refused, then again from the checkpoint to the end."""
    try:
        drain(stream().writeStream.foreachBatch(_stopping(write, stop_at)).option("checkpointLocation", checkpoint))
    except StreamingQueryException as e:
        if Stopped.__name__ not in str(e):
            raise
    drain(stream().writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))


@register("paged_ingest", with_ledger(f"""
SELECT event_id, page, max(ledger_offset) OVER (PARTITION BY page) AS cursor
FROM (SELECT event_id, ledger_offset, CAST((row_number() OVER (ORDER BY ledger_offset) - 1) // {PAGE_SIZE} AS BIGINT) AS page
      FROM flat_ledger WHERE ledger_offset > {offset_at_sql(STORED)})"""))
def paged_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger polled from a stored offset, 100 events a poll, stopped after the first micro-batch and gone on with.

    Each event comes with the poll that got it and the cursor which that poll leaves behind.
    """
    archive = ledger_archive(spark, sf_dir, ARCHIVE_FILE_ROWS)
    out, start = scratch(spark, "polled"), offset_at(spark, sf_dir, STORED)

    def write(df: DataFrame, batch_id: int) -> None:
        df.select("event_id", "page", "cursor").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _drain_twice(lambda: polled(archive, POLLED, start, pages_per_batch=DEDUPE_PAGES, most_pages=MOST_PAGES), write, scratch(spark, "polled-ckpt"), stop_at=1)
    return read_or_empty(spark, out, "event_id string, page bigint, cursor string, batch_id int").drop("batch_id")


@register("commit_offsets", with_ledger("""
SELECT c_mktsegment AS stream_id, max(ledger_offset) AS committed_offset
FROM flat_ledger JOIN customer ON cust_key = c_custkey GROUP BY c_mktsegment"""))
def commit_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4: after each batch, the last offset per stream is committed; reads are monotone (max)."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust_key"),
                                                    F.col("c_mktsegment").alias("stream_id"))
    ev = flat_events_from_orders(_orders_stream(spark, sf_dir)).join(cust, "cust_key")
    sink = scratch(spark, "offsets-sink")
    com = DV.OffsetCommitter(scratch(spark, "offsets"), "stream_id",
                             lambda df, batch: df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch}"))
    run_to_end(ev.select("stream_id", "ledger_offset").writeStream.foreachBatch(com)
               .option("checkpointLocation", scratch(spark, "offsets-ckpt")))
    return com.committed(spark)


def poisoned(df: DataFrame) -> list[int]:
    """The numbers of the batches that hold a poison event."""
    bad = df.filter((F.col("event_type") == "error") & (F.col("value") > 300)).select("batch").distinct()
    return [r["batch"] for r in bad.collect()]  # a number for each batch of a micro-batch at most


_BATCHED_SQL = f"SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // {BATCH_PAGES * PAGE_SIZE} AS batch, event_type = 'error' AND value > 300 AS bad FROM events"


@register("dead_letter_batches", f"""WITH b AS ({_BATCHED_SQL}), bad AS (SELECT DISTINCT batch FROM b WHERE bad)
SELECT event_id, CASE WHEN batch IN (SELECT batch FROM bad) THEN 'dead_letter' ELSE 'delivered' END AS outcome FROM b""")
def dead_letter_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: a batch whose write fails (it holds a poison event) goes to the DLQ; the other batches still flow.

    A batch is 20 polls; a micro-batch over a backlog has many, each with an outcome of its own.
    """
    archive = _events_archive(spark, _events(spark, sf_dir))
    root = scratch(spark, "dlq-batches")

    def write(df: DataFrame, batch_id: int) -> None:
        bad = poisoned(df)
        df.filter(~F.col("batch").isin(bad)).drop("batch").write.mode("overwrite").parquet(f"{root}/sink/batch_id={batch_id}")
        if bad:
            raise DV.BatchErrors({b: DV.SendError("RecordTooLargeException", "broker rejected batch") for b in bad})

    w = DV.DeadLetterWriter(root, write, "event_id", BACKOFF, batch_col="batch")
    stream = polled(archive, f"{EVENTS}, page bigint", pages_per_batch=BATCH_PAGES, most_pages=MOST_PAGES)
    stream = stream.withColumn("batch", F.floor(F.col("page") / BATCH_PAGES).cast("bigint")).drop("page")
    drain(stream.writeStream.foreachBatch(w).option("checkpointLocation", scratch(spark, "dlq-ckpt")))
    ok = w.delivered(spark, "event_id bigint").select("event_id", F.lit("delivered").alias("outcome"))
    bad = w.dead(spark).select(F.get_json_object("event", "$.event_id").cast("bigint").alias("event_id"), F.lit("dead_letter").alias("outcome"))
    return ok.unionByName(bad)


SENT = "event_id bigint, event_type string, user_id bigint"


@register("transactional_batches", "SELECT event_id, event_type, user_id FROM events")
def transactional_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: all-or-nothing batches; the commit of batch 2 fails once, the restart replays it."""
    archive = _events_archive(spark, _events(spark, sf_dir))
    root, ck = scratch(spark, "txn"), scratch(spark, "txn-ckpt")

    def run(sink: DV.TransactionalSink) -> None:
        drain(polled(archive, SENT, pages_per_batch=BATCH_PAGES, most_pages=MOST_PAGES).writeStream.foreachBatch(sink).option("checkpointLocation", ck))

    try:
        run(DV.TransactionalSink(root, "event_id", fail_before_commit_of=2))
    except StreamingQueryException as e:
        if DV.AbortedCommit.__name__ not in str(e):
            raise  # only the planned abort, which left data without a marker: invisible to readers
    sink = DV.TransactionalSink(root, "event_id")
    run(sink)
    return sink.committed(spark, SENT)


@register("dedupe_events", "SELECT event_id, event_type, user_id FROM events")
def dedupe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: a replay re-sends every 97th event at the end of the ledger; the sink keeps each event id once."""
    events = _events(spark, sf_dir)
    archive = _events_archive(spark, events)
    last = events.agg(F.max("event_id")).first()[0]
    again = events.filter(F.col("event_id") % 97 == 0)
    if last is not None:  # the replay's own offsets follow the ledger's
        archive.append(again.withColumn("ledger_offset", offset_of(F.col("event_id") + last + 1)))
    sink = DedupeSink(spark, scratch(spark, "dedupe"), "event_id", "event_id", SENT, width=DEDUPE_PAGES * PAGE_SIZE)
    drain(polled(archive, SENT, pages_per_batch=DEDUPE_PAGES, most_pages=MOST_PAGES).writeStream.foreachBatch(sink).option("checkpointLocation", scratch(spark, "dedupe-ckpt")))
    return sink.written(spark)


def dlq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DLQ lines for sends that ended dead-lettered under the retry rule (ST8)."""
    f = failed_sends(spark, sf_dir)
    n = RT.attempts(F.col("error_class"), F.col("failures"), BACKOFF)
    dead = f.withColumn("attempts", n).filter(RT.outcome(F.col("error_class"), F.col("failures"), BACKOFF)
                                              == "dead_letter")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id", "value")
    j = dead.join(ev, "event_id")
    line = Q.dlq_line(iso_time("ts"),
                      F.concat(F.col("error_class"), F.lit(" after "), F.col("attempts").cast("string"),
                               F.lit(" attempts")),
                      F.concat(F.lit('SendError: "'), F.col("error_class"), F.lit('"\n\tat send(attempt '), F.col("attempts").cast("string"), F.lit(")")),
                      F.create_map(F.lit("offset"), offset_of("event_id"), F.lit("attempts"),
                                   F.col("attempts").cast("string")),
                      F.struct("event_id", "event_type", "user_id", F.col("value").cast("decimal(12,2)").alias("value")))
    return j.select("event_id", line.alias("line"))


_DEAD_SQL = f"""dead AS (
  SELECT e.*, p.error_class, p.attempts FROM events e JOIN (
    {_retry_sql()}) p USING (event_id)
  WHERE p.outcome = 'dead_letter')"""


@register("dlq_jsonl", f"""WITH {_DEAD_SQL}
SELECT '{{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","reason":"' || error_class || ' after ' ||
  CAST(attempts AS VARCHAR) || ' attempts","stackTrace":"SendError: \\"' || error_class || '\\"\\n\\tat send(attempt ' || CAST(attempts AS VARCHAR) ||
  ')","metadata":{{"offset":"' ||
  lpad(CAST(event_id AS VARCHAR), 18, '0') || '","attempts":"' || CAST(attempts AS VARCHAR) ||
  '"}},"event":{{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '","user_id":' ||
  CAST(user_id AS VARCHAR) || ',"value":' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || '}}}}' AS line
FROM dead""")
def dlq_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST9: dead-lettered sends written as JSON lines, read back as written."""
    path = scratch(spark, "dlq-jsonl")
    Q.write_dlq(dlq_lines(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("dlq_replay", f"""WITH {_DEAD_SQL}
SELECT event_id, error_class || ' after ' || CAST(attempts AS VARCHAR) || ' attempts' AS reason, event_type, user_id
FROM dead""")
def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10: read the DLQ, decode its events and send them through a sink again."""
    path, sink = scratch(spark, "dlq-replay"), scratch(spark, "dlq-replay-sink")
    Q.write_dlq(dlq_lines(spark, sf_dir), path)
    schema = "event_id bigint, event_type string, user_id bigint, value decimal(12,2)"
    Q.replay(Q.read_dlq(spark, path), schema, lambda df: df.write.parquet(sink))
    return read_or_empty(spark, sink, f"reason string, {schema}").select("event_id", "reason", "event_type", "user_id")


@register("dlq_by_reason", f"""WITH {_DEAD_SQL}
SELECT error_class || ' after ' || CAST(attempts AS VARCHAR) || ' attempts' AS reason, count(*) AS entries FROM dead GROUP BY 1""")
def dlq_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10, inspection: how many entries the DLQ has for each reason."""
    path = scratch(spark, "dlq-reasons")
    Q.write_dlq(dlq_lines(spark, sf_dir), path)
    return Q.by_reason(Q.read_dlq(spark, path))


@register("resume_stream", "SELECT event_id, event_type, user_id FROM events")
def resume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST11: the first part of the ledger is there and read, the rest is appended, a restart on the same checkpoint goes on: each event once."""
    events = _events(spark, sf_dir)
    lo, hi = events.agg(F.min("event_id"), F.max("event_id")).first()
    early = F.col("event_id") <= F.lit(None if lo is None else lo + (hi - lo) * 3 // 5)
    archive = _events_archive(spark, events.filter(early))
    out, ck = scratch(spark, "resume-sink"), scratch(spark, "resume-ckpt")

    def run() -> None:
        drain(polled(archive, SENT, pages_per_batch=DEDUPE_PAGES, most_pages=MOST_PAGES).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck))

    run()
    archive.append(events.filter(~early))
    run()
    return read_or_empty(spark, out, SENT)


@register("fan_out", with_routed("""
SELECT event_id, topic, count(*) OVER (PARTITION BY topic) AS topic_events FROM routed WHERE event_type <> 'exercised'"""))
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST12: one routed stream written to two sinks: events by topic folder, and counts per topic (both are read back)."""
    ev = R.route_topic(flat_events_from_orders(_orders_stream(spark, sf_dir)), R.routing_table(spark))
    sink = DV.FanOut(scratch(spark, "fan-events"), scratch(spark, "fan-counts"))
    run_to_end(ev.select("event_id", "topic", "ledger_offset").writeStream.foreachBatch(sink)
               .option("checkpointLocation", scratch(spark, "fan-ckpt")))
    counts = sink.counts(spark).groupBy("topic").agg(F.sum("events").alias("topic_events"))
    return sink.events(spark).select("event_id", "topic").join(counts, "topic").select("event_id", "topic", "topic_events")


STATUS_CHUNK = 10_000
STATUS_RUNS = 1 << 20
FEED_SCHEMA = "event_id string, ledger_offset string, event_type string, template_id string, contract_id string, choice string"
LIVE_PAGES = 100


@register("latest_feed_stream", with_ledger("""
SELECT event_id, ledger_offset, event_type, template_id, contract_id, choice FROM flat_ledger
ORDER BY ledger_offset DESC, event_type DESC, choice DESC NULLS LAST LIMIT 200"""))
def latest_feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on a stream: the newest 200 events of the flat ledger, merged micro-batch by micro-batch."""
    archive = ledger_archive(spark, sf_dir, ARCHIVE_FILE_ROWS)
    sink = FeedSink(scratch(spark, "feed"), FEED_SCHEMA)
    stream = polled(archive, pages_per_batch=LIVE_PAGES, most_pages=MOST_PAGES).withColumn("choice", F.lit(None).cast("string"))
    drain(stream.writeStream.foreachBatch(sink).option("checkpointLocation", scratch(spark, "feed-ckpt")))
    return sink.feed(spark)


@register("fan_out_alone", with_ledger("""
SELECT sink, event_id FROM flat_ledger, (VALUES ('steady'), ('down for a while')) s(sink)"""))
def fan_out_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST12: two sinks over one stream; one refuses its first three parts, then catches up from its own last offset."""
    archive = ledger_archive(spark, sf_dir, ARCHIVE_FILE_ROWS)
    root, refused = scratch(spark, "alone"), []

    def write(name: str):
        def part(events: DataFrame, number: str) -> None:
            if name == "down for a while" and len(refused) < 3:
                refused.append(number)
                raise DV.SendError("NetworkException", "sink is down")
            events.select("event_id").write.mode("overwrite").parquet(f"{root}/sink={name}/part={number}")
        return part

    sinks = IndependentSinks(archive, scratch(spark, "alone-log"), {n: write(n) for n in ("steady", "down for a while")})
    drain(polled(archive, pages_per_batch=LIVE_PAGES // 2, most_pages=MOST_PAGES).writeStream.foreachBatch(sinks).option("checkpointLocation", scratch(spark, "alone-ckpt")))
    while sinks.catch_up(spark):  # a short ledger ends while the sink is still down
        pass
    return read_or_empty(spark, root, "event_id string, sink string, part string").select("sink", "event_id")


MOST_REPLAYS = 3


@register("dlq_reprocess", f"""WITH {_DEAD_SQL}
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'quarantined' ELSE 'sent' END AS outcome,
       CASE WHEN user_id % 3 = 0 THEN {MOST_REPLAYS - 1} WHEN user_id % 3 = 1 THEN 1 ELSE 0 END AS replays FROM dead""")
def dlq_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10: the DLQ streamed through a transactional sink; some entries pass at once, some at the second try, some never.

    The first batch's mark fails once; the restart sends it again, once.
    """
    dlq, root, ck = scratch(spark, "dlq-again"), scratch(spark, "reprocess"), scratch(spark, "reprocess-ckpt")
    Q.write_dlq(dlq_lines(spark, sf_dir), dlq)
    schema = "event_id bigint, event_type string, user_id bigint, value decimal(12,2)"

    def accepts():
        return (F.col("user_id") % 3 == 2) | ((F.col("user_id") % 3 == 1) & (F.col("replays") >= 1))

    def run(fail: int | None) -> Reprocessor:
        out = Reprocessor(root, dlq, schema, accepts, MOST_REPLAYS, fail)
        drain(dlq_stream(spark, dlq).writeStream.foreachBatch(out).option("checkpointLocation", ck))
        return out

    try:
        run(0)
    except StreamingQueryException as e:
        if DV.AbortedCommit.__name__ not in str(e):
            raise
    done = run(None)
    sent = done.sent(spark).select("event_id", F.lit("sent").alias("outcome"), "replays")
    held = done.quarantined(spark)
    held = held.select(F.get_json_object("event", "$.event_id").cast("bigint").alias("event_id"), F.lit("quarantined").alias("outcome"), F.col("metadata")[REPLAYS].cast("int").alias("replays"))
    return sent.unionByName(held)


@register("failure_rate_live", with_routed(f"""
SELECT {_DEST_SQL} AS destination_type, count(*) AS received, count(*) FILTER (WHERE NOT failed) AS processed, count(*) FILTER (WHERE failed) AS failed
FROM (SELECT topic, {_K_SQL} % 13 = 0 AS failed FROM routed WHERE event_type <> 'exercised') GROUP BY 1"""))
def failure_rate_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 live: received, processed and failed per destination, observed on the delivery stream micro-batch by micro-batch.

    The counts are read from the ended query, so it runs where no micro-batch's progress is forgotten.
    """
    archive = Archive(remembering(spark), scratch(spark, "routed-archive"), "ledger_offset string, event_id string, topic string, failed boolean", file_rows=ARCHIVE_FILE_ROWS)
    archive.append(record_results(routed_flat(spark, sf_dir)))
    kinds = sorted({d for _, d in R.DESTINATION_TYPES} | {R.DEFAULT_DESTINATION})
    log = MetricsLog(kinds)
    stream = polled(archive, pages_per_batch=LIVE_PAGES, most_pages=MOST_PAGES).withColumn("kind", R.destination_type())
    seen = observed(stream, {k: F.col("kind") == k for k in kinds}, F.col("failed"))
    log.finish(drain(seen.writeStream.format("noop").option("checkpointLocation", scratch(spark, "live-ckpt"))))
    out = log.table(spark).groupBy("destination_type").agg(*[F.sum(c).alias(c) for c in ("received", "processed", "failed")])
    return out.filter("received > 0")


@register("reconnects_stream", ORACLE["reconnects"])
def reconnects_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 on a stream: the status log comes in two halves, the later one first; the fold's count is that of the whole."""
    log = status_log(spark, sf_dir).select(F.col("event_id").alias("at"), "system", "status")
    lo, hi = log.agg(F.min("at"), F.max("at")).first()
    fold = StatusFold(scratch(spark, "status-fold"), "system", "status", "at", width=STATUS_CHUNK)
    middle = None if lo is None else (lo + hi) // 2
    for i, half in enumerate((F.col("at") > F.lit(middle), F.col("at") <= F.lit(middle))):
        archive = Archive(spark, scratch(spark, "status-archive"), "ledger_offset string, at bigint, system string, status int", tie=("at",), file_rows=EVENT_FILE_ROWS)
        archive.append(log.filter(half).withColumn("ledger_offset", offset_of("at")))
        first = i * STATUS_RUNS  # batch numbers of the second run go on after those of the first
        drain(polled(archive, "at bigint, system string, status int", pages_per_batch=BATCH_PAGES, most_pages=MOST_PAGES).writeStream
              .foreachBatch(lambda df, n, first=first: fold(df, first + n)).option("checkpointLocation", scratch(spark, "status-ckpt")))
    return fold.reconnects(spark)
