"""Registered queries: routing and sink records (K) plus the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import epoch_micros, max_offset
from ledgerlane.operators import route as R
from ledgerlane.plans.oracle import with_routed
from ledgerlane.plans.registry import register
from ledgerlane.sources.ledger import ledger


def routed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.route_topic(ledger(spark, sf_dir), R.routing_table(spark))


@register("topic_summary", with_routed("""
SELECT topic, event_type, count(*) AS n_events, max(ledger_offset) AS last_offset,
       count(*) FILTER (WHERE amount > 250000) AS n_big
FROM routed GROUP BY topic, event_type"""))
def topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: route every event, then per topic and kind: count, last offset, big deals."""
    return (routed_ledger(spark, sf_dir)
            .groupBy("topic", "event_type")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 max_offset("ledger_offset").alias("last_offset"),
                 F.count_if(F.col("payload.deal.amount") > 250000).alias("n_big")))


from ledgerlane.operators import encode as E  # noqa: E402
from ledgerlane.plans.oracle import FLAT_JSON_SQL, OPT_PAYLOAD_SQL, TXN_SQL, with_ledger  # noqa: E402
from ledgerlane.sources.ledger import flat_ledger  # noqa: E402


@register("route_topic", with_ledger(f"""
SELECT event_id, template_id, coalesce(r.topic, '{R.DEFAULT_TOPIC}') AS topic, r.topic AS topic_no_default
FROM ledger LEFT JOIN routes r USING (template_id)""", "routes(template_id, topic) AS (VALUES " + ", ".join(
    f"('{t}', '{d}')" for t, d in R.ROUTES) + ")"))
def route_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: template → topic, else default; without a default, unmapped → null."""
    out = R.route_topic(ledger(spark, sf_dir), R.routing_table(spark), default_topic=None)
    return out.select("event_id", "template_id", F.coalesce("topic", F.lit(R.DEFAULT_TOPIC)).alias("topic"),
                      F.col("topic").alias("topic_no_default"))


@register("topic_prefix", with_ledger(f"""
SELECT event_id, '{R.STATIC_TOPIC}' AS static_topic,
       '{R.TOPIC_PREFIX}.' || replace(split_part(template_id, ':', -2), '.', '-') || '.' || split_part(template_id, ':', -1)
         AS prefix_topic
FROM ledger"""))
def topic_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: static topic name vs ``prefix.module.name`` per template."""
    return ledger(spark, sf_dir).select("event_id", F.lit(R.STATIC_TOPIC).alias("static_topic"),
                                        R.prefix_topic().alias("prefix_topic"))


def party_routes(spark: SparkSession) -> DataFrame:
    """Per-party, per-template destinations: every nation party routes its Iou and Asset events."""
    rows = [(f"Nation{n}", t, f"nation{n}-{t.split(':')[1].lower()}") for n in range(25)
            for t in ("Main:Iou", "Main:Asset")]
    from ledgerlane.functions.joins import small
    return small(spark.createDataFrame(rows, "party string, template_id string, destination string"), len(rows))


@register("route_party_template", with_ledger("""
SELECT event_id, observer AS party, 'nation' || CAST(cust_key % 25 AS VARCHAR) || '-' || lower(split_part(template_id, ':', 2))
  AS destination
FROM ledger WHERE template_id IN ('Main:Iou', 'Main:Asset')"""))
def route_party_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: destination per (stakeholder party, template)."""
    return R.route_party_template(ledger(spark, sf_dir), party_routes(spark)).select("event_id", "party", "destination")


def routed_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.route_topic(flat_ledger(spark, sf_dir), R.routing_table(spark))


@register("kafka_record_tx", with_routed(f"SELECT topic, transaction_id AS key, {FLAT_JSON_SQL} AS value "
                                         "FROM routed WHERE event_type <> 'exercised'"))
def kafka_record_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: Kafka record keyed by transaction id; value is the flat JSON event."""
    df = routed_flat(spark, sf_dir)
    return df.select("topic", F.col("transaction_id").alias("key"), E.flat_json(df).alias("value"))


_TS_JSON_SQL = (f"'{{\"type\":\"' || CASE event_type WHEN 'created' THEN 'Created' ELSE 'Archived' END || "
                f"'\",\"contractId\":\"' || contract_id || '\",\"templateId\":\"' || template_id || '\"' || "
                f"{OPT_PAYLOAD_SQL} || ',\"offset\":\"' || ledger_offset || '\"}}'")


def ts_event_json() -> Column:
    kind = F.when(F.col("event_type") == "created", "Created").otherwise("Archived")
    return F.to_json(F.struct(kind.alias("type"), F.col("contract_id").alias("contractId"),
                              F.col("template_id").alias("templateId"), E.daml_payload("payload").alias("payload"),
                              F.col("ledger_offset").alias("offset")))


from pyspark.sql import Column  # noqa: E402


def _contract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = routed_flat(spark, sf_dir)
    kind = F.when(F.col("event_type") == "created", "Created").otherwise("Archived")
    return df.select("topic", F.col("contract_id").alias("key"), ts_event_json().alias("value"),
                     R.kafka_headers({"templateId": F.col("template_id"), "eventType": kind}).alias("headers"))


@register("kafka_record_contract", with_routed(f"""
SELECT topic, contract_id AS key, {_TS_JSON_SQL} AS value,
       'templateId=' || template_id || ';eventType=' || CASE event_type WHEN 'created' THEN 'Created' ELSE 'Archived' END
         AS headers
FROM routed WHERE event_type <> 'exercised'"""))
def kafka_record_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: Kafka record keyed by contract id with templateId / eventType headers."""
    return _contract_records(spark, sf_dir).withColumn("headers", R.render_headers("headers"))


STATIC_HEADERS = {"source": "ledger", "format": "json"}


@register("static_headers", with_routed(f"""
SELECT topic, contract_id AS key, {_TS_JSON_SQL} AS value,
       'templateId=' || template_id || ';eventType=' || CASE event_type WHEN 'created' THEN 'Created' ELSE 'Archived' END
         || ';source=ledger;format=json' AS headers
FROM routed WHERE event_type <> 'exercised'"""))
def static_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: configured static headers appended to every record."""
    r = _contract_records(spark, sf_dir)
    return r.select("topic", "key", "value", R.render_headers(R.with_static_headers(F.col("headers"), STATIC_HEADERS))
                    .alias("headers"))


@register("pulsar_record", with_ledger(f"""
SELECT contract_id AS key, {FLAT_JSON_SQL} AS value, event_id, epoch_ms(record_time) AS event_time,
       CAST(ledger_offset AS BIGINT) AS sequence_id, CAST(NULL AS BIGINT) AS unnamed_sequence_id
FROM flat_ledger"""))
def pulsar_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: Pulsar record for a named producer, and the sequence id of an unnamed one (none)."""
    df = flat_ledger(spark, sf_dir)
    named, unnamed = R.pulsar_sequence("ledger"), R.pulsar_sequence(None)
    return df.select(F.col("contract_id").alias("key"), E.flat_json(df).alias("value"), "event_id",
                     F.floor(epoch_micros("record_time") / 1000).cast("bigint").alias("event_time"),
                     named.alias("sequence_id"), unnamed.alias("unnamed_sequence_id"))


def _envelope_sql() -> str:
    from ledgerlane.plans.encoding import _CE_SQL
    return (f"SELECT transaction_id, tx_offset, '{{\"type\":\"transaction\",\"event\":{{\"eventId\":\"' || transaction_id || "
            f"'\",\"workflowId\":\"wf-' || CAST({TXN_SQL} % 10 AS VARCHAR) || '\",\"offset\":\"' || tx_offset || "
            f"'\",\"contractEvents\":[' || string_agg({_CE_SQL}, ',' ORDER BY ledger_offset) || ']}}}}' AS envelope "
            "FROM flat_ledger GROUP BY transaction_id, tx_offset")


@register("kinesis_record", with_ledger(
    f"SELECT transaction_id, 'wf-' || CAST({TXN_SQL} % 10 AS VARCHAR) AS pk_workflow, transaction_id AS pk_fallback, "
    "tx_offset AS pk_offset, envelope AS data FROM envelopes", f"envelopes AS ({_envelope_sql()})"))
def kinesis_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: partition key = a top-level *string* field of the event, else the event id.

    ``workflowId`` is a string field; ``transactionId`` is not a field of the
    envelope (falls back); ``offset`` is a string field.
    """
    env = E.tx_envelopes(flat_ledger(spark, sf_dir))
    pk = lambda f: F.coalesce(R.top_level_string(F.col("envelope"), "$.event", f), F.col("transaction_id"))
    return env.select("transaction_id", pk("workflowId").alias("pk_workflow"), pk("transactionId").alias("pk_fallback"),
                      pk("offset").alias("pk_offset"), F.col("envelope").alias("data"))


@register("partition_key", with_ledger(
    "SELECT event_id, contract_id AS pk_contract, coalesce(issuer, contract_id) AS pk_field FROM ledger"))
def partition_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: record key by contract id, or by a payload field with the contract id as fallback."""
    return ledger(spark, sf_dir).select("event_id", R.partition_key("contract-id").alias("pk_contract"),
                                        R.partition_key("payload-field", "issuer").alias("pk_field"))


@register("pack_requests", with_routed("""
SELECT event_id, topic, CAST((row_number() OVER (PARTITION BY topic ORDER BY ledger_offset) - 1) // 500 AS BIGINT)
  AS request_no
FROM routed WHERE event_type <> 'exercised'"""))
def pack_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 500 records per PutRecords request, per stream, in offset order."""
    return R.pack_requests(routed_flat(spark, sf_dir), "topic").select("event_id", "topic", "request_no")


# Error codes of failed records (chosen by contract number % 3).
RECORD_ERRORS = ["ProvisionedThroughputExceededException", "InternalFailure", "ServiceUnavailable"]


def record_results(df: DataFrame) -> DataFrame:
    """Per-record outcome of a put: records of every 13th contract fail."""
    k = F.expr("CAST(ledger_offset AS BIGINT) div 10")
    err = F.element_at(F.array(*[F.lit(e) for e in RECORD_ERRORS]), (k % 3 + 1).cast("int"))
    return df.withColumn("failed", k % 13 == 0).withColumn("error_code", F.when(k % 13 == 0, err))


@register("partial_failures", with_routed("""
SELECT topic, request_no, count(*) AS total, count(*) FILTER (WHERE failed) AS failed,
       arg_min(CASE WHEN failed THEN error_code END, CASE WHEN failed THEN ledger_offset END) AS first_error
FROM (SELECT *, (CAST(ledger_offset AS BIGINT) // 10) % 13 = 0 AS failed,
        CASE (CAST(ledger_offset AS BIGINT) // 10) % 3 WHEN 0 THEN 'ProvisionedThroughputExceededException'
          WHEN 1 THEN 'InternalFailure' ELSE 'ServiceUnavailable' END AS error_code,
        CAST((row_number() OVER (PARTITION BY topic ORDER BY ledger_offset) - 1) // 500 AS BIGINT) AS request_no
      FROM routed WHERE event_type <> 'exercised') t
GROUP BY topic, request_no"""))
def partial_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request, failed of total and the first error."""
    packed = R.pack_requests(routed_flat(spark, sf_dir), "topic")
    return R.partial_failures(record_results(packed), ["topic", "request_no"])
