"""Registered queries: encoders and record shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import contract_abbrev, offset_value, template_short
from ledgerlane.operators import encode as E
from ledgerlane.operators import route as R
from ledgerlane.operators import schemas as SC
from ledgerlane.plans.oracle import (FLAT_JSON_SQL, ISO_SQL, OPT_PAYLOAD_SQL, PAYLOAD_TEXT_SQL, TXN_SQL, arr_sql, with_ledger,
                                     with_routed)
from ledgerlane.plans.registry import register
from ledgerlane.sources.documents import tx_number
from ledgerlane.sources.ledger import flat_ledger, ledger

Q = "'\"'"  # a double quote in SQL


@register("encode_flat_json", with_ledger(f"SELECT event_id, {FLAT_JSON_SQL} AS value FROM flat_ledger"))
def encode_flat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flat_ledger(spark, sf_dir)
    return df.select("event_id", E.flat_json(df).alias("value"))


_CE_SQL = (f"'{{\"type\":\"' || event_type || '\",\"event\":{{\"templateId\":\"' || template_id || "
           f"'\",\"contractId\":\"' || contract_id || '\"' || {OPT_PAYLOAD_SQL} || '}}}}'")


@register("encode_tx_envelope", with_ledger(f"""
SELECT transaction_id, '{{"type":"transaction","event":{{"eventId":"' || transaction_id || '","workflowId":"wf-' ||
  CAST({TXN_SQL} % 10 AS VARCHAR) || '","offset":"' || tx_offset || '","contractEvents":[' ||
  string_agg({_CE_SQL}, ',' ORDER BY ledger_offset) || ']}}}}' AS envelope
FROM flat_ledger GROUP BY transaction_id, tx_offset"""))
def encode_tx_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.tx_envelopes(flat_ledger(spark, sf_dir))


@register("decode_tx_envelope", with_ledger(f"""
SELECT transaction_id, CAST(row_number() OVER (PARTITION BY transaction_id ORDER BY ledger_offset) - 1 AS INTEGER) AS idx,
       event_type, contract_id, template_id, CASE WHEN issuer IS NOT NULL THEN {PAYLOAD_TEXT_SQL} END AS payload,
       CAST(NULL AS VARCHAR) AS decode_error
FROM flat_ledger WHERE {TXN_SQL} % 89 <> 0 AND {TXN_SQL} % 83 <> 0
UNION ALL
SELECT DISTINCT transaction_id, CAST(-1 AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CASE WHEN {TXN_SQL} % 89 = 0 THEN 'LedgerEvent expected' ELSE 'ContractEvent expected' END
FROM flat_ledger WHERE {TXN_SQL} % 89 = 0 OR {TXN_SQL} % 83 = 0"""))
def decode_tx_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode envelopes; every 89th has a wrong top tag, every 83rd unknown contract-event tags."""
    env = E.tx_envelopes(flat_ledger(spark, sf_dir))
    n = tx_number()
    bad_top = F.regexp_replace("envelope", r'^\{"type":"transaction"', '{"type":"checkpoint"')
    bad_ce = F.regexp_replace("envelope", r'\{"type":"(created|archived)"', '{"type":"divulged"')
    env = env.withColumn("envelope", F.when(n % 89 == 0, bad_top).when(n % 83 == 0, bad_ce).otherwise(F.col("envelope")))
    return E.decode_envelopes(env)


@register("encode_snake_json", with_ledger(f"""
SELECT event_id, '{{"event_type":"' || CASE event_type WHEN 'created' THEN 'create' WHEN 'archived' THEN 'archive'
  ELSE 'exercise' END || '","contract_id":"' || contract_id || '","template_id":"' || template_id || '"' ||
  {OPT_PAYLOAD_SQL} || CASE WHEN choice IS NULL THEN '' ELSE ',"choice":"' || choice || '"' END ||
  ',"signatories":' || {arr_sql('signatory')} || ',"observers":' || {arr_sql('observer')} ||
  ',"transaction_id":"' || transaction_id || '","offset":"' || ledger_offset || '"}}' AS value
FROM ledger"""))
def encode_snake_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ledger(spark, sf_dir)
    return df.select("event_id", E.snake_json(df).alias("value"))


@register("encode_meta_json", with_ledger(f"""
SELECT event_id, '{{"meta":{{"eventId":"' || event_id || '","workflowId":"","offset":"' || ledger_offset ||
  '","domainId":"default","contractId":"' || contract_id || '","templateId":"' || template_id ||
  '","signatories":' || {arr_sql('signatory')} || ',"observers":' || {arr_sql('observer')} ||
  ',"agreementText":""}},"event":{{' || CASE event_type
    WHEN 'created' THEN '"created":{{"payload":' || {PAYLOAD_TEXT_SQL} || '}}'
    WHEN 'archived' THEN '"archived":{{"contractId":"' || contract_id || '"}}'
    ELSE '"exercised":{{"choice":"' || choice || '"}}' END || '}}}}' AS value
FROM ledger"""))
def encode_meta_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ledger(spark, sf_dir)
    return df.select("event_id", E.meta_json(df).alias("value"))


@register("avro_created", with_ledger(f"""
SELECT event_id AS "eventId", contract_id AS "contractId", template_id AS "templateId",
       {PAYLOAD_TEXT_SQL} AS payload, {arr_sql('signatory')} AS signatories, {arr_sql('observer')} AS observers,
       transaction_id AS "transactionId", {ISO_SQL} AS "ledgerEffectiveTime"
FROM flat_ledger WHERE event_type = 'created'"""))
def avro_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = E.avro_created(flat_ledger(spark, sf_dir))
    return r.withColumn("signatories", F.to_json("signatories")).withColumn("observers", F.to_json("observers"))


@register("avro_archived", with_ledger(f"""
SELECT event_id AS "eventId", contract_id AS "contractId", template_id AS "templateId",
       {arr_sql('signatory')} AS signatories, {arr_sql('observer')} AS observers, transaction_id AS "transactionId"
FROM flat_ledger WHERE event_type = 'archived'"""))
def avro_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = E.avro_archived(flat_ledger(spark, sf_dir))
    return r.withColumn("signatories", F.to_json("signatories")).withColumn("observers", F.to_json("observers"))


@register("avro_union", with_ledger(f"""
SELECT event_id, CASE WHEN event_type = 'created' THEN 'created' ELSE 'archived' END AS branch,
  '{{"' || event_type || '":{{"eventId":"' || event_id || '","contractId":"' || contract_id || '","templateId":"' ||
  template_id || '"' || CASE WHEN event_type = 'created'
    THEN ',"payload":"' || replace({PAYLOAD_TEXT_SQL}, '"', '\\"') || '"' ELSE '' END ||
  ',"signatories":' || {arr_sql('signatory')} || ',"observers":' || {arr_sql('observer')} ||
  ',"transactionId":"' || transaction_id || '"' ||
  CASE WHEN event_type = 'created' THEN ',"ledgerEffectiveTime":"' || {ISO_SQL} || '"' ELSE '' END || '}}}}' AS record
FROM flat_ledger"""))
def avro_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = E.avro_union(flat_ledger(spark, sf_dir))
    branch = F.when(F.col("created").isNotNull(), "created").otherwise("archived")
    return u.select("event_id", branch.alias("branch"), F.to_json(F.struct("created", "archived")).alias("record"))


def _pretty_sql(pairs: list[tuple[str, str]], depth: int = 1) -> str:
    """SQL text of a JSON object, indented by two; values are SQL texts."""
    pad = "  " * depth
    body = " || ',' || chr(10) || ".join(f"'{pad}\"{k}\" : ' || {v}" for k, v in pairs)
    return f"'{{' || chr(10) || {body} || chr(10) || '{'  ' * (depth - 1)}}}'"


def _text_sql(x: str) -> str:
    return f"'\"' || {x} || '\"'"


_HEAD = [("type", "event_type"), ("offset", "ledger_offset"), ("transactionId", "transaction_id"), ("contractId", "contract_id"),
         ("templateId", "template_id")]
_DEAL = _pretty_sql([("amount", _text_sql("CAST(amount AS VARCHAR)")), ("status", _text_sql("status")), ("priority", _text_sql("priority")),
                     ("urgent", "CASE WHEN urgent THEN 'true' ELSE 'false' END"), ("units", "CAST(units AS VARCHAR)")], 3)
_PRETTY_PAYLOAD = _pretty_sql([("issuer", _text_sql("issuer")), ("owner", _text_sql("owner")), ("deal", _DEAL)], 2)
_PRETTY_HEAD = [(k, _text_sql(c)) for k, c in _HEAD]


@register("encode_pretty", with_ledger(f"""
SELECT event_id, CASE WHEN issuer IS NULL THEN {_pretty_sql(_PRETTY_HEAD)}
  ELSE {_pretty_sql([*_PRETTY_HEAD, ("payload", _PRETTY_PAYLOAD)])} END AS value
FROM flat_ledger"""))
def encode_pretty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event of P1, pretty-printed."""
    return flat_ledger(spark, sf_dir).select("event_id", E.pretty(E.flat_event()).alias("value"))


@register("template_schemas", with_ledger("""
SELECT template_id, path, type, count(*) AS events FROM flat_ledger, (VALUES ('issuer', 'STRING'), ('owner', 'STRING'), ('deal.amount', 'STRING'),
  ('deal.status', 'STRING'), ('deal.priority', 'STRING'), ('deal.urgent', 'BOOLEAN'), ('deal.units', 'BIGINT')) p(path, type)
WHERE event_type = 'created' GROUP BY template_id, path, type"""))
def template_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: one payload schema per template: its field paths and their types, over all its events."""
    df = flat_ledger(spark, sf_dir).filter(F.col("event_type") == "created")
    return SC.field_types(df.select("template_id", E.payload_json("payload").alias("doc")), ["template_id"], "doc")


@register("schema_subjects", with_routed("""
SELECT DISTINCT template_id, topic, topic || '-value' AS topic_subject, template_id AS record_subject
FROM routed WHERE event_type = 'created'"""))
def schema_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject names per strategy: ``<topic>-value`` (topic) or the template id (record)."""
    routed = R.route_topic(flat_ledger(spark, sf_dir).filter(F.col("event_type") == "created"), R.routing_table(spark))
    return (routed.select("template_id", "topic").distinct()
            .select("template_id", "topic", F.concat("topic", F.lit("-value")).alias("topic_subject"),
                    F.col("template_id").alias("record_subject")))


_V1 = [("issuer", "STRING"), ("deal.units", "BIGINT"), ("deal.urgent", "BOOLEAN")]
_V2 = [("issuer", "STRING"), ("deal.units", "STRING"), ("deal.status", "STRING")]


def _values(rows) -> str:
    return "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in rows) + ") p(path, type)"


@register("schema_evolution", with_ledger(f"""
SELECT template_id, path, o.type AS old_type, n.type AS new_type,
       CASE WHEN o.type IS NULL THEN 'added' WHEN n.type IS NULL THEN 'removed' WHEN o.type <> n.type THEN 'retyped' ELSE 'same' END AS change
FROM (SELECT DISTINCT template_id, path, type FROM created, {_values(_V1)} WHERE half = 1) o
FULL JOIN (SELECT DISTINCT template_id, path, type FROM created, {_values(_V2)} WHERE half = 2) n USING (template_id, path)""",
    "created AS (SELECT template_id, CASE WHEN CAST(ledger_offset AS BIGINT) <= (SELECT (min(CAST(ledger_offset AS BIGINT)) + "
    "max(CAST(ledger_offset AS BIGINT))) // 2 FROM flat_ledger) THEN 1 ELSE 2 END AS half FROM flat_ledger WHERE event_type = 'created')"))
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per template and field path: added, removed, retyped or the same between two offset ranges.

    The ranges are the lower and the upper half of the ledger's offsets.  From
    the upper half on the producer writes the next version of its payload:
    units as text, a status, no urgent flag.
    """
    df = flat_ledger(spark, sf_dir)
    n = offset_value("ledger_offset")
    ends = df.agg(((F.min(n) + F.max(n)) / 2).cast("bigint")).first()[0]
    p = F.col("payload")
    old = F.to_json(F.struct(p["issuer"].alias("issuer"), F.struct(p["deal"]["units"].alias("units"), p["deal"]["urgent"].alias("urgent")).alias("deal")))
    new = F.to_json(F.struct(p["issuer"].alias("issuer"),
                             F.struct(p["deal"]["units"].cast("string").alias("units"), p["deal"]["status"].alias("status")).alias("deal")))
    created = df.filter(F.col("event_type") == "created")
    is_old = n <= (ends if ends is not None else 0)
    docs = created.select("template_id", is_old.alias("is_old"), F.when(is_old, old).otherwise(new).alias("doc"))
    return SC.schema_changes(docs, "template_id", "is_old", "doc")


@register("template_short", with_ledger("SELECT event_id, template_id, split_part(template_id, ':', -1) AS short FROM ledger"))
def template_short_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).select("event_id", "template_id", template_short("template_id").alias("short"))


@register("contract_abbrev", with_ledger("SELECT event_id, substr(contract_id, 1, 30) || '...' AS short FROM ledger"))
def contract_abbrev_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).select("event_id", contract_abbrev("contract_id").alias("short"))


@register("streamed_event", with_ledger(f"""
SELECT signatory AS emitter, observer AS consumer, template_id, contract_id, {PAYLOAD_TEXT_SQL} AS payload,
       {ISO_SQL} AS emitted_at
FROM flat_ledger WHERE event_type = 'created'"""))
def streamed_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = E.streamed_events(flat_ledger(spark, sf_dir))
    return s.select("emitter", "consumer", F.col("event.templateId").alias("template_id"),
                    F.col("event.contractId").alias("contract_id"), F.col("event.payload").alias("payload"),
                    F.col("event.emittedAt").alias("emitted_at"))


# From which tenth of the ledger on the producer writes which version of its payload.
VERSION_FROM = [(1, 0), (2, 3), (3, 7)]
_VERSION_SQL = "CASE WHEN tenth >= 7 THEN 3 WHEN tenth >= 3 THEN 2 ELSE 1 END"


@register("schema_versions", with_ledger(f"""
SELECT template_id, version, min(tenth) AS first_range, max(tenth) AS last_range, 3 AS fields,
       CASE v WHEN 1 THEN 0 ELSE 1 END * (version > 1)::INT AS added, CASE v WHEN 1 THEN 0 ELSE 1 END * (version > 1)::INT AS removed,
       CASE v WHEN 2 THEN 1 ELSE 0 END * (version > 1)::INT AS retyped,
       CASE WHEN version > 1 THEN false END AS backward, CASE WHEN version > 1 THEN false END AS forward
FROM (SELECT *, dense_rank() OVER (PARTITION BY template_id ORDER BY v) AS version
      FROM (SELECT template_id, tenth, {_VERSION_SQL} AS v FROM created))
GROUP BY template_id, version, v""",
    "ends AS (SELECT min(CAST(ledger_offset AS BIGINT)) AS lo, max(CAST(ledger_offset AS BIGINT)) AS hi FROM flat_ledger)",
    "created AS (SELECT template_id, (CAST(ledger_offset AS BIGINT) - lo) * 10 // (hi - lo + 1) AS tenth FROM flat_ledger, ends WHERE event_type = 'created')"))
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 over ten ranges: the versions of each template's payload, their change points and whether readers of one read the other.

    The producer writes (issuer, units, urgent), then units as text and a
    status in place of urgent, then a priority in place of the status.
    """
    df = flat_ledger(spark, sf_dir)
    n = offset_value("ledger_offset")
    lo, hi = df.agg(F.min(n), F.max(n)).first()
    tenth = F.floor((n - F.lit(lo)) * 10 / F.lit(1 if lo is None else hi - lo + 1)).cast("bigint")
    p, deal = F.col("payload"), F.col("payload")["deal"]
    one = F.to_json(F.struct(p["issuer"].alias("issuer"), F.struct(deal["units"].alias("units"), deal["urgent"].alias("urgent")).alias("deal")))
    two = F.to_json(F.struct(p["issuer"].alias("issuer"), F.struct(deal["units"].cast("string").alias("units"), deal["status"].alias("status")).alias("deal")))
    three = F.to_json(F.struct(p["issuer"].alias("issuer"), F.struct(deal["units"].cast("string").alias("units"), deal["priority"].alias("priority")).alias("deal")))
    created = df.filter(F.col("event_type") == "created").withColumn("tenth", tenth)
    doc = F.when(F.col("tenth") >= VERSION_FROM[2][1], three).when(F.col("tenth") >= VERSION_FROM[1][1], two).otherwise(one)
    return SC.schema_versions(created.select("template_id", "tenth", doc.alias("doc")), "template_id", "tenth", "doc")
