"""Registered queries: delivery metrics."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import epoch_micros, max_offset, offset_value
from ledgerlane.operators import metrics as M
from ledgerlane.operators import route as R
from ledgerlane.operators.batching import BATCH_SIZE
from ledgerlane.plans.oracle import TXN_SQL, with_ledger, with_routed
from ledgerlane.plans.registry import register
from ledgerlane.plans.routing import record_results, routed_flat, routed_ledger
from ledgerlane.sources import documents as D
from ledgerlane.sources.ledger import flat_ledger, ledger
from ledgerlane.sources.tables import table

_DEST_SQL = "CASE topic WHEN 'iou-events' THEN 'kafka' WHEN 'asset-events' THEN 'pulsar' ELSE 'kinesis' END"
_MANIFEST_CTE = ("batched AS (SELECT *, CAST((row_number() OVER (PARTITION BY topic ORDER BY ledger_offset) - 1) // 100 "
                 "AS BIGINT) AS batch_no FROM routed WHERE event_type <> 'exercised'),\n"
                 "manifest AS (SELECT topic, batch_no, count(*) AS events FROM batched GROUP BY topic, batch_no)")
_K_SQL = "(CAST(ledger_offset AS BIGINT) // 10)"
_ERR_SQL = (f"CASE {_K_SQL} % 3 WHEN 0 THEN 'ProvisionedThroughputExceededException' WHEN 1 THEN 'InternalFailure' "
            "ELSE 'ServiceUnavailable' END")


def _hist_sql(src: str, value: str, buckets: list[str], labels: str = "") -> str:
    lab = f"{labels}, " if labels else ""
    grp = f"GROUP BY {labels}" if labels else ""
    bvals = ", ".join(f"('{b}', CAST('{b}' AS DECIMAL(20,6)))" for b in buckets) + ", ('+Inf', NULL)"
    join = f"USING ({labels})" if labels else "ON true"
    return f"""
SELECT {lab}h.le, CAST(h.cumulative_count AS BIGINT) AS cumulative_count, s.sample_sum, s.sample_count FROM
 (SELECT {lab}b.le, sum(CASE WHEN b.ub IS NULL OR CAST({value} AS DECIMAL(20,6)) <= b.ub THEN 1 ELSE 0 END) AS cumulative_count
  FROM {src} CROSS JOIN (VALUES {bvals}) b(le, ub) GROUP BY {lab}b.le) h
 JOIN (SELECT {lab}CAST(sum(CAST({value} AS DECIMAL(20,6))) AS DOUBLE) AS sample_sum, count(*) AS sample_count
       FROM {src} {grp}) s {join}"""


@register("events_processed", with_routed(
    "SELECT event_type, template_id, topic, count(*) AS events FROM routed GROUP BY event_type, template_id, topic"))
def events_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: events processed per (event type, template, destination topic)."""
    return M.counter(routed_ledger(spark, sf_dir), ["event_type", "template_id", "topic"], "events")


@register("batches_processed", with_routed(f"""
SELECT {_DEST_SQL} AS destination_type, count(*) AS batches, CAST(sum(events) AS BIGINT) AS events
FROM manifest GROUP BY 1""", _MANIFEST_CTE))
def batches_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: batches (and their events) per destination type: a stream of n events has ceil(n / size) batches."""
    n = routed_flat(spark, sf_dir).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return (n.groupBy(R.destination_type().alias("destination_type"))
            .agg(F.sum(F.ceil(F.col("n") / BATCH_SIZE)).cast("bigint").alias("batches"), F.sum("n").cast("bigint").alias("events")))


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of every stage as one log: ``(stage, error_type, dlq_id, replayed)``.

    source: malformed transaction documents; transform: envelopes that do not
    decode; sink: records the broker rejected.
    """
    from ledgerlane.plans.encoding import decode_tx_envelope
    src = (D.parse_documents(D.transaction_documents(flat_ledger(spark, sf_dir)))
           .filter(F.col("parse_error").isNotNull())
           .select(F.lit("source").alias("stage"), F.lit("serialization").alias("error_type"),
                   F.concat(F.lit("source:"), "transaction_id").alias("dlq_id"), F.lit(False).alias("replayed")))
    dec = (decode_tx_envelope(spark, sf_dir).filter(F.col("decode_error").isNotNull())
           .select(F.lit("transform").alias("stage"), F.lit("validation").alias("error_type"),
                   F.concat(F.lit("transform:"), "transaction_id").alias("dlq_id"), F.lit(False).alias("replayed")))
    sink = (record_results(routed_flat(spark, sf_dir)).filter("failed")
            .select(F.lit("sink").alias("stage"), F.col("error_code").alias("error_type"),
                    F.concat(F.lit("sink:"), "event_id").alias("dlq_id"),
                    (F.col("error_code") == "ServiceUnavailable").alias("replayed")))
    return src.unionByName(dec).unionByName(sink)


_ERRLOG_CTE = f"""errlog AS (
  SELECT DISTINCT 'source' AS stage, 'serialization' AS error_type, 'source:' || transaction_id AS dlq_id
    FROM flat_ledger WHERE {TXN_SQL} % 97 = 0
  UNION ALL
  SELECT DISTINCT 'transform', 'validation', 'transform:' || transaction_id
    FROM flat_ledger WHERE ({TXN_SQL} % 89 = 0 OR {TXN_SQL} % 83 = 0)
  UNION ALL
  SELECT 'sink', {_ERR_SQL}, 'sink:' || event_id FROM flat_ledger WHERE {_K_SQL} % 13 = 0)"""


@register("processing_errors", with_ledger(
    "SELECT stage, error_type, count(*) AS errors FROM errlog GROUP BY stage, error_type", _ERRLOG_CTE))
def processing_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: errors per (stage, error type)."""
    return M.counter(error_log(spark, sf_dir), ["stage", "error_type"], "errors")


@register("last_offset_gauge", with_routed("""
SELECT 'participant1' AS participant_id, topic AS subscription_id, arg_max(n, ledger_offset) AS last_offset
FROM (SELECT topic, ledger_offset, TRY_CAST(nullif(regexp_replace(shown, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS n
      FROM (SELECT topic, ledger_offset, CASE WHEN CAST(ledger_offset AS BIGINT) % 7 = 0 THEN 'v1.2.' || ledger_offset
              WHEN CAST(ledger_offset AS BIGINT) % 11 = 0 THEN 'offset-' || ledger_offset ELSE ledger_offset END AS shown
            FROM routed))
WHERE n IS NOT NULL GROUP BY topic"""))
def last_offset_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: last offset per subscription as a number; offsets that do not parse are skipped."""
    num = F.col("ledger_offset").cast("bigint")
    shown = (F.when(num % 7 == 0, F.concat(F.lit("v1.2."), "ledger_offset"))
             .when(num % 11 == 0, F.concat(F.lit("offset-"), "ledger_offset")).otherwise(F.col("ledger_offset")))
    df = routed_ledger(spark, sf_dir).select(F.col("topic").alias("subscription_id"), "ledger_offset",
                                             shown.alias("shown"))
    g = M.last_offset_gauge(df, ["subscription_id"], offset="shown", order=offset_value("ledger_offset"))
    return g.select(F.lit("participant1").alias("participant_id"), "subscription_id", "last_offset")


@register("lag_histogram", _hist_sql("events", "value", M.LAG_BUCKETS))
def lag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: processing-lag histogram (lag = the event's ``value`` in seconds), cumulative buckets + sum + count."""
    return M.histogram(table(spark, sf_dir, "events"), "value", M.LAG_BUCKETS)


def _durations(sizes: DataFrame) -> DataFrame:
    """``(destination_type, duration, batches)`` from the events ``n`` of each stream.

    A batch's duration is modelled from its size and its number modulo 5, so
    a stream has at most six kinds of batches: full ones by that remainder,
    and the last.
    """
    full = F.floor(F.col("n") / BATCH_SIZE)
    kinds = F.array(*[F.struct(F.lit(BATCH_SIZE).cast("bigint").alias("events"), F.lit(m).cast("bigint").alias("m"),
                               F.floor((full - m + 4) / 5).alias("batches")) for m in range(5)],
                    F.struct((F.col("n") % BATCH_SIZE).alias("events"), (full % 5).alias("m"), F.lit(1).cast("bigint").alias("batches")))
    k = sizes.select("topic", F.explode(kinds).alias("k")).filter("k.events > 0 AND k.batches > 0")
    d = (F.col("k.events").cast("decimal(20,6)") * F.lit(Decimal("0.003"))
         + F.col("k.m").cast("decimal(20,6)") * F.lit(Decimal("0.05")))
    return k.select(R.destination_type().alias("destination_type"), d.cast("decimal(20,6)").alias("duration"), F.col("k.batches").alias("batches"))


@register("publish_histogram", with_routed(_hist_sql(
    f"(SELECT {_DEST_SQL} AS destination_type, CAST(events * 0.003 + (batch_no % 5) * 0.05 AS DECIMAL(20,6)) AS duration "
    "FROM manifest)", "duration", M.DEFAULT_BUCKETS, "destination_type").replace("\nSELECT", "SELECT", 1),
    _MANIFEST_CTE))
def publish_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: publish-duration histogram per destination type (duration modelled from batch size)."""
    sizes = routed_flat(spark, sf_dir).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return M.histogram(_durations(sizes), "duration", M.DEFAULT_BUCKETS, ["destination_type"], "batches")


@register("dlq_depth", with_ledger(f"""
SELECT stage, count(*) AS dlq_depth FROM errlog
WHERE dlq_id NOT IN (SELECT 'sink:' || event_id FROM flat_ledger WHERE {_K_SQL} % 13 = 0 AND {_K_SQL} % 3 = 2)
GROUP BY stage""", _ERRLOG_CTE))
def dlq_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: DLQ entries not yet replayed, per stage (those the broker was unavailable for have been)."""
    return error_log(spark, sf_dir).filter(~F.col("replayed")).groupBy("stage").agg(F.count(F.lit(1)).alias("dlq_depth"))


# Destination of an events row by user_id % 3, system by user_id % 5.
EVENT_DESTINATIONS = ["kafka", "pulsar", "kinesis"]
SYSTEMS = ["canton_ledger", "kafka_broker", "schema_registry", "pulsar_broker", "kinesis_stream"]


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _case_sql(expr: str, values: list[str]) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


@register("events_in_flight", f"""
WITH e AS (SELECT {_case_sql('user_id % 3', EVENT_DESTINATIONS)} AS destination_type,
                  CASE WHEN event_id % 50 = 0 THEN NULL ELSE epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) END AS ack_us
           FROM events),
     t AS (SELECT max(epoch_us(ts)) AS now_us FROM events)
SELECT destination_type, count(*) AS sent, count(*) FILTER (WHERE ack_us <= now_us) AS acked,
       count(*) FILTER (WHERE ack_us IS NULL OR ack_us > now_us) AS in_flight
FROM e CROSS JOIN t GROUP BY destination_type""")
def events_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: sent minus acknowledged per destination at the log's last send time.

    An event is acknowledged ``value`` seconds after it was sent; every 50th
    is never acknowledged.  "Now" is one scalar aggregate joined as a
    single broadcast row.
    """
    ev = table(spark, sf_dir, "events")
    sent = epoch_micros("ts")
    e = ev.select(_pick(EVENT_DESTINATIONS, F.col("user_id") % 3).alias("destination_type"),
                  F.when(F.col("event_id") % 50 == 0, None)
                  .otherwise(sent + F.round(F.col("value") * 1000000).cast("bigint")).alias("ack_us"))
    now = ev.agg(F.max(sent)).scalar()  # scalar subquery: evaluated once, no join
    acked = F.col("ack_us") <= now
    return e.groupBy("destination_type").agg(F.count(F.lit(1)).alias("sent"), F.count_if(acked).alias("acked"),
                                             F.count_if(F.col("ack_us").isNull() | ~acked).alias("in_flight"))


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection status log from ``events``: signup = connected (1), error = disconnected (0)."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    return ev.select(_pick(SYSTEMS, F.col("user_id") % 5).alias("system"), "event_id", "ts",
                     F.when(F.col("event_type") == "signup", 1).otherwise(0).alias("status"))


_STATUS_CTE = (f"status_log AS (SELECT {_case_sql('user_id % 5', SYSTEMS)} AS system, event_id, "
               "CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS status FROM events "
               "WHERE event_type IN ('signup', 'error'))")


@register("connection_status", f"""WITH {_STATUS_CTE}
SELECT system, CAST(arg_max(status, event_id) AS INTEGER) AS status, max(event_id) AS as_of FROM status_log GROUP BY system""")
def connection_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: latest connection status per system."""
    return M.latest_status(status_log(spark, sf_dir), "system", "status", "event_id")


@register("reconnects", f"""WITH {_STATUS_CTE}
SELECT system, count(*) FILTER (WHERE prev = 0 AND status = 1) AS reconnects
FROM (SELECT system, status, lag(status) OVER (PARTITION BY system ORDER BY event_id) AS prev FROM status_log)
GROUP BY system""")
def reconnects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disconnected → connected transitions per system."""
    log = status_log(spark, sf_dir)
    return M.transitions(log, "system", "status", "event_id", F.floor(F.col("event_id") / 100000))


LAG_COMMIT_BEFORE = "1996-01-01"
STREAMS_WITHOUT_COMMIT = ["AUTOMOBILE", "BUILDING"]


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events with their stream id (the customer's market segment)."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust_key"),
                                                    F.col("c_mktsegment").alias("stream_id"))
    return ledger(spark, sf_dir).join(cust, "cust_key")


def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stream, in one pass over the ledger: the ledger end and the committed offset.

    The committed offset is the last one processed before ``LAG_COMMIT_BEFORE``
    (two streams have none yet) — the offset table of a connector that ran
    until then.
    """
    done = ((F.col("record_time") < F.lit(LAG_COMMIT_BEFORE).cast("timestamp_ntz"))
            & ~F.col("stream_id").isin(STREAMS_WITHOUT_COMMIT))
    return stream_events(spark, sf_dir).groupBy("stream_id").agg(
        max_offset("ledger_offset").alias("end_offset"),
        max_offset(F.when(done, F.col("ledger_offset"))).alias("committed_offset"))


def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset table: last committed offset per stream (streams without a commit have no row)."""
    return stream_positions(spark, sf_dir).filter(F.col("committed_offset").isNotNull()) \
        .select("stream_id", "committed_offset")


_STREAM_CTE = ("streams AS (SELECT l.*, c_mktsegment AS stream_id FROM ledger l JOIN customer ON cust_key = c_custkey), "
               "committed AS (SELECT stream_id, max(ledger_offset) AS committed_offset FROM streams "
               f"WHERE record_time < TIMESTAMP '{LAG_COMMIT_BEFORE}' AND stream_id NOT IN "
               f"({', '.join(repr(s) for s in STREAMS_WITHOUT_COMMIT)}) GROUP BY stream_id)")


@register("offset_lag", with_ledger("""
SELECT s.stream_id, s.end_offset, c.committed_offset,
       CAST(s.end_offset AS BIGINT) - coalesce(CAST(c.committed_offset AS BIGINT), 0) AS offset_lag
FROM (SELECT stream_id, max(ledger_offset) AS end_offset FROM streams GROUP BY stream_id) s
LEFT JOIN committed c USING (stream_id)""", _STREAM_CTE))
def offset_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger end minus committed offset, per stream."""
    j = stream_positions(spark, sf_dir)
    lag = offset_value("end_offset") - F.coalesce(offset_value("committed_offset"), F.lit(0))
    return j.select("stream_id", "end_offset", "committed_offset", lag.alias("offset_lag"))


@register("failure_rate", with_routed(f"""
SELECT {_DEST_SQL} AS destination_type, count(*) AS received, count(*) FILTER (WHERE NOT failed) AS processed,
       count(*) FILTER (WHERE failed) AS failed, CAST(count(*) FILTER (WHERE failed) AS DOUBLE) / count(*) AS failure_rate
FROM (SELECT topic, {_K_SQL} % 13 = 0 AS failed FROM routed WHERE event_type <> 'exercised') GROUP BY 1"""))
def failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received / processed / failed and the failure rate per destination type."""
    r = record_results(routed_flat(spark, sf_dir)).withColumn("destination_type", R.destination_type())
    g = r.groupBy("destination_type").agg(F.count(F.lit(1)).alias("received"),
                                          F.count_if(~F.col("failed")).alias("processed"),
                                          F.count_if("failed").alias("failed"))
    return g.withColumn("failure_rate", M.ratio(F.col("failed"), F.col("received")))


@register("reconcile_delivery", with_ledger(f"""
SELECT coalesce(e.event_type, d.event_type) AS event_type, coalesce(e.template_id, d.template_id) AS template_id,
       coalesce(e.choice, d.choice) AS choice, coalesce(e.n, 0) AS expected, coalesce(d.n, 0) AS delivered,
       coalesce(e.n, 0) - coalesce(d.n, 0) AS diff
FROM (SELECT event_type, template_id, coalesce(choice, '-') AS choice, count(*) AS n FROM ledger GROUP BY 1, 2, 3) e
FULL OUTER JOIN (SELECT event_type, template_id, coalesce(choice, '-') AS choice, count(*) AS n FROM ledger
                 WHERE template_id IN ('Main:Iou', 'Main:Asset') AND {_K_SQL} % 13 <> 0 GROUP BY 1, 2, 3) d
  USING (event_type, template_id, choice)
WHERE coalesce(e.n, 0) <> coalesce(d.n, 0)"""))
def reconcile_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected vs delivered per (kind, template, choice); rows that differ.

    Delivered = routed without a default topic (unmapped templates are not
    sent) and not rejected by the sink.  Delivered events are a subset of the
    expected ones, so both counts come from one pass and one aggregation (a
    conditional count) instead of two scans and a full outer join.
    """
    keys = ["event_type", "template_id", "choice"]
    lg = ledger(spark, sf_dir).withColumn("choice", F.coalesce("choice", F.lit("-")))
    routed = record_results(R.route_topic(lg, R.routing_table(spark), default_topic=None))
    counts = routed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(F.col("topic").isNotNull() & ~F.col("failed")).alias("delivered"))
    return counts.withColumn("diff", F.col("expected") - F.col("delivered")).filter(F.col("diff") != 0)
