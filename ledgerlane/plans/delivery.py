"""Registered queries: feed, ordering and delivery in table form (L1, L2, ST1, ST3, ST8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import offset_value
from ledgerlane.functions.joins import small
from ledgerlane.operators import feed as L
from ledgerlane.operators.batching import assign_batches, batch_manifest
from ledgerlane.plans.metrics import _STREAM_CTE, stream_positions
from ledgerlane.plans.oracle import with_ledger, with_routed
from ledgerlane.plans.registry import ORACLE, register
from ledgerlane.plans.routing import routed_flat, routed_ledger
from ledgerlane.plans.scans import ARCHIVE_FILE_ROWS
from ledgerlane.session import scratch
from ledgerlane.sources.archive import Archive
from ledgerlane.sources.ledger import ledger
from ledgerlane.sources.tables import table
from ledgerlane.streaming import retry as RT
from ledgerlane.streaming.grouping import OpenBatches
from ledgerlane.streaming.poller import MOST_PAGES, drain, polled

FEED_COLS = ["event_id", "ledger_offset", "event_type", "template_id", "contract_id", "choice"]


@register("latest_feed", with_ledger(f"""
SELECT {', '.join(FEED_COLS)} FROM ledger
ORDER BY ledger_offset DESC, event_type DESC, choice DESC NULLS LAST LIMIT 200"""))
def latest_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: newest-first feed of the last 200 events (a top-k report).

    Offsets grow with the order key and every order has an event of its own,
    so the newest 200 events belong to the newest 200 orders: their least key
    is found first (a top-k of one column), and only events from that key on
    are derived; the bound reaches both scans.
    """
    newest = table(spark, sf_dir, "orders").select("o_orderkey").orderBy(F.desc("o_orderkey")).limit(L.FEED_SIZE)
    least = newest.agg(F.min("o_orderkey")).first()[0]
    start = f"{least * 10 - 1:018d}" if least else None
    return L.latest_feed(ledger(spark, sf_dir, start).select(*FEED_COLS))


@register("ordered_delivery", with_routed("""
SELECT topic, count(*) AS events, count(DISTINCT contract_id) AS keys, CAST(0 AS BIGINT) AS out_of_order
FROM routed GROUP BY topic"""))
def ordered_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: events keyed by (topic, contract) delivered in offset order; the check counts violations."""
    keys = ["topic", "contract_id"]
    d = L.ordered_for_delivery(routed_ledger(spark, sf_dir).select("topic", "contract_id", "ledger_offset", "event_type"),
                               keys)
    return L.delivery_report(d, keys)


BATCH_WITHIN_MS = 2_700  # the time limit of a batch
MANIFEST_PAGES = 50      # polls in a micro-batch: their ends fall inside batches


@register("batch_manifest", with_routed(f"""
SELECT topic, slot, batch_no, count(*) AS events, min(ledger_offset) AS first_offset, max(ledger_offset) AS last_offset
FROM (SELECT topic, slot, ledger_offset,
             CAST((row_number() OVER (PARTITION BY topic, slot ORDER BY ledger_offset) - 1) // 100 AS BIGINT) AS batch_no
      FROM (SELECT topic, ledger_offset, CAST(ledger_offset AS BIGINT) // {BATCH_WITHIN_MS} AS slot FROM routed WHERE event_type <> 'exercised'))
GROUP BY topic, slot, batch_no"""))
def batch_manifest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: per stream, batches of at most 100 events or 2.7 s, in offset order, open between micro-batches.

    The replayed ledger is taken to arrive at one offset per millisecond.
    """
    archive = Archive(spark, scratch(spark, "routed-archive"), "ledger_offset string, event_id string, topic string", file_rows=ARCHIVE_FILE_ROWS)
    archive.append(routed_flat(spark, sf_dir))
    out = OpenBatches(scratch(spark, "manifest"), "topic", offset_value("ledger_offset"), BATCH_WITHIN_MS)
    drain(polled(archive, "ledger_offset string, topic string", pages_per_batch=MANIFEST_PAGES, most_pages=MOST_PAGES).writeStream.foreachBatch(out)
          .option("checkpointLocation", scratch(spark, "manifest-ckpt")))
    return out.manifest(spark)


@register("batch_manifest_table", ORACLE["batch_manifest"])
def batch_manifest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3, table form: the same batches from the whole table at once."""
    arrival = offset_value("ledger_offset")
    return batch_manifest(assign_batches(routed_flat(spark, sf_dir), "topic", arrival_ms=arrival, within_ms=BATCH_WITHIN_MS), "topic")


# Start strategy per stream (market segment).
START_STRATEGIES = [("AUTOMOBILE", "last-known", None), ("BUILDING", "beginning", None),
                    ("FURNITURE", "end", None), ("HOUSEHOLD", "last-known", None),
                    ("MACHINERY", "specific", "000000000000050000")]
LEDGER_BEGIN = "000000000000000000"


@register("start_offsets", with_ledger(f"""
SELECT s.stream_id, s.strategy,
       CASE WHEN e.end_offset IS NULL THEN '{LEDGER_BEGIN}'
            WHEN s.strategy = 'beginning' THEN '{LEDGER_BEGIN}'
            WHEN s.strategy = 'end' THEN e.end_offset
            WHEN s.strategy = 'specific' THEN s.given
            ELSE coalesce(c.committed_offset, e.end_offset) END AS start_offset
FROM (VALUES {', '.join(f"('{a}', '{b}', {repr(c) if c else 'NULL'})" for a, b, c in START_STRATEGIES)})
     s(stream_id, strategy, given)
LEFT JOIN (SELECT stream_id, max(ledger_offset) AS end_offset FROM streams GROUP BY stream_id) e USING (stream_id)
LEFT JOIN committed c USING (stream_id)""", _STREAM_CTE))
def start_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: start offset per stream: beginning / end / last known (else end) / specific; empty ledger → begin."""
    strat = small(spark.createDataFrame(START_STRATEGIES, "stream_id string, strategy string, given string"),
                  len(START_STRATEGIES))
    j = strat.join(stream_positions(spark, sf_dir), "stream_id", "left")
    s = F.col("strategy")
    start = (F.when(F.col("end_offset").isNull(), LEDGER_BEGIN)
             .when(s == "beginning", LEDGER_BEGIN).when(s == "end", F.col("end_offset"))
             .when(s == "specific", F.col("given"))
             .otherwise(F.coalesce("committed_offset", "end_offset")))
    return j.select("stream_id", "strategy", start.alias("start_offset"))


# Error class of a failed send, chosen by event_id % 4.
SEND_ERRORS = ["TimeoutException", "NetworkException", "NotEnoughReplicasException", "RecordTooLargeException"]
BACKOFF = RT.Backoff()


def send_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-send outcome of every ``events`` row: every 50th send fails, and keeps failing ``id % 7 + 1`` times.

    ``error_class`` is null and ``failures`` 0 for sends that succeed at once.
    """
    ev = table(spark, sf_dir, "events")
    failed = F.col("event_id") % 50 == 0
    err = F.element_at(F.array(*[F.lit(e) for e in SEND_ERRORS]), (F.col("event_id") % 4 + 1).cast("int"))
    return ev.select("event_id", F.when(failed, err).alias("error_class"),
                     F.when(failed, F.col("event_id") % 7 + 1).otherwise(0).cast("int").alias("failures"))


def failed_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sends whose first attempt failed."""
    return send_log(spark, sf_dir).filter(F.col("failures") > 0)


def _retry_sql() -> str:
    b = BACKOFF
    cls = "CASE event_id % 4 " + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(SEND_ERRORS)) + " END"
    retr = ", ".join(f"'{e}'" for e in RT.RETRIABLE)
    # closed form of sum_{j=1..m} min(initial * 2^j, max) for initial=100, factor=2, max=1000 (cap from j=4)
    return f"""
SELECT event_id, error_class, retriable, attempts,
       CAST(100 * (power(2, least(attempts - 1, 3) + 1) - 2) + greatest(attempts - 1 - 3, 0) * 1000 AS BIGINT)
         AS total_wait_ms,
       CASE WHEN failures = 0 OR (retriable AND failures < {b.max_attempts}) THEN 'delivered' ELSE 'dead_letter' END
         AS outcome
FROM (SELECT event_id, error_class, failures, retriable,
             CAST(CASE WHEN failures = 0 OR NOT retriable THEN 1 ELSE least(failures + 1, {b.max_attempts}) END
                  AS INTEGER) AS attempts
      FROM (SELECT event_id, error_class, failures, coalesce(error_class IN ({retr}), false) AS retriable
            FROM (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN {cls} END AS error_class,
                         CAST(CASE WHEN event_id % 50 = 0 THEN event_id % 7 + 1 ELSE 0 END AS INTEGER) AS failures
                  FROM events)))"""


@register("retry_plan", _retry_sql())
def retry_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8: per send: retriable?, attempts, total backoff wait and final outcome (first-try successes: 1, 0)."""
    f = send_log(spark, sf_dir)
    cls, fails = F.col("error_class"), F.col("failures")
    n = RT.attempts(cls, fails, BACKOFF)
    return f.select("event_id", "error_class", RT.retriable(cls).alias("retriable"), n.alias("attempts"),
                    RT.total_wait_ms(n, BACKOFF).alias("total_wait_ms"), RT.outcome(cls, fails, BACKOFF).alias("outcome"))
