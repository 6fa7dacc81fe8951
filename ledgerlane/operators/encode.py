"""Event encoders (P1–P15): one named encoder per JSON / record shape.

Every encoder is a Column expression (``to_json`` over a ``struct``), so it
runs per row inside whole-stage codegen on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import iso_time


def daml_payload_sql(payload: str = "payload") -> str:
    """SQL text of ``daml_payload`` (for use inside larger SQL expressions)."""
    p = payload
    return (f"CASE WHEN {p} IS NOT NULL THEN named_struct('issuer', {p}.issuer, 'owner', {p}.owner, "
            f"'deal', named_struct('amount', CAST({p}.deal.amount AS STRING), 'status', {p}.deal.status, "
            f"'priority', {p}.deal.priority, 'urgent', {p}.deal.urgent, 'units', {p}.deal.units)) END")


def daml_payload(payload: str = "payload") -> Column:
    """Payload struct in Daml-JSON form: Numeric fields become strings ("100.00")."""
    return F.expr(daml_payload_sql(payload))


def payload_json(payload: str | Column = "payload") -> Column:
    """Compact Daml-JSON text of the payload; null for events without one."""
    return F.to_json(daml_payload(payload))


def _ids(*pairs) -> list[Column]:
    return [F.col(c).alias(a) for c, a in pairs]


def flat_json(df: DataFrame, payload: Column | None = None) -> Column:
    """``{"type","offset","transactionId","contractId","templateId","payload"}``; no payload when archived.

    ``payload`` defaults to the ledger's typed payload; pass ``parse_json(text)``
    to embed a payload that arrives as JSON text.
    """
    return F.to_json(flat_event(payload))


def flat_event(payload: Column | None = None) -> Column:
    """The struct behind ``flat_json``, for other renderings of the same event."""
    p = daml_payload("payload") if payload is None else payload
    return F.struct(*_ids(("event_type", "type"), ("ledger_offset", "offset"), ("transaction_id", "transactionId"),
                          ("contract_id", "contractId"), ("template_id", "templateId")), p.alias("payload"))


def contract_event(df: DataFrame) -> Column:
    """Tagged contract event ``{"type": kind, "event": {templateId, contractId, payload?}}``."""
    return F.struct(F.col("event_type").alias("type"),
                    F.struct(*_ids(("template_id", "templateId"), ("contract_id", "contractId")),
                             daml_payload("payload").alias("payload")).alias("event"))


def workflow_id(transaction_id: str = "transaction_id") -> Column:
    from ledgerlane.sources.documents import tx_number
    return F.concat(F.lit("wf-"), (tx_number(transaction_id) % 10).cast("string"))


def tx_envelopes(events: DataFrame) -> DataFrame:
    """One tagged envelope per transaction: ``(transaction_id, envelope)``.

    Contract events keep ledger order through ``array_sort`` on the offset.
    """
    g = (events.groupBy("transaction_id", "tx_offset")
         .agg(F.array_sort(F.collect_list(F.struct("ledger_offset", contract_event(events).alias("ce")))).alias("evs")))
    env = F.to_json(F.struct(
        F.lit("transaction").alias("type"),
        F.struct(F.col("transaction_id").alias("eventId"), workflow_id().alias("workflowId"),
                 F.col("tx_offset").alias("offset"),
                 F.transform("evs", lambda e: e["ce"]).alias("contractEvents")).alias("event")))
    return g.select("transaction_id", env.alias("envelope"))


ENVELOPE_SCHEMA = ("type string, event struct<eventId:string, workflowId:string, offset:string, "
                   "contractEvents:array<struct<type:string, event:struct<templateId:string, contractId:string, "
                   "payload:string>>>>")


def decode_envelopes(envs: DataFrame, col: str = "envelope") -> DataFrame:
    """Envelope → contract events; an unknown tag fails the whole envelope.

    Output: kept input columns, ``idx``, ``event_type``, ``contract_id``,
    ``template_id``, ``payload`` and ``decode_error`` (null on good rows; a
    failed envelope gives one row with ``idx = -1`` and the error).
    """
    keep = [c for c in envs.columns if c != col]
    p = F.from_json(F.col(col), ENVELOPE_SCHEMA)
    d = envs.select(*keep, p.alias("_e"))
    ces = F.col("_e.event.contractEvents")
    # The two error texts are fixed values.
    err = (F.when(F.col("_e").isNull() | F.coalesce(F.col("_e.type") != "transaction", F.lit(True)),
                  "LedgerEvent expected")
           .when(F.exists(ces, lambda x: ~F.coalesce(x["type"].isin("created", "archived"), F.lit(False))),
                 "ContractEvent expected"))
    items = F.when(err.isNull(), F.transform(ces, lambda x, i: F.struct(i.alias("idx"), x.alias("x")))) \
        .otherwise(F.array(F.struct(F.lit(-1).cast("int").alias("idx"),
                                    F.lit(None).cast(d.schema["_e"].dataType["event"].dataType["contractEvents"]
                                                     .dataType.elementType).alias("x"))))
    out = d.select(*keep, err.alias("decode_error"), F.explode(items).alias("it"))
    return out.select(*keep, F.col("it.idx").alias("idx"), F.col("it.x.type").alias("event_type"),
                      F.col("it.x.event.contractId").alias("contract_id"),
                      F.col("it.x.event.templateId").alias("template_id"),
                      F.col("it.x.event.payload").alias("payload"), "decode_error")


def snake_json(df: DataFrame) -> Column:
    """Public snake-case event with signatories and observers."""
    kind = F.col("event_type")
    k = F.when(kind == "created", "create").when(kind == "archived", "archive").when(kind == "exercised", "exercise")
    return F.to_json(F.struct(k.alias("event_type"), *_ids(("contract_id", "contract_id"), ("template_id", "template_id")),
                              daml_payload("payload").alias("payload"), F.col("choice").alias("choice"),
                              *_ids(("signatories", "signatories"), ("observers", "observers"),
                                    ("transaction_id", "transaction_id"), ("ledger_offset", "offset"))))


def meta_json(df: DataFrame) -> Column:
    """P5: metadata split from the payload: ``{"meta": {...}, "event": {"created": {"payload": ...}}}``."""
    meta = F.struct(F.col("event_id").alias("eventId"), F.lit("").alias("workflowId"),
                    F.col("ledger_offset").alias("offset"), F.lit("default").alias("domainId"),
                    *_ids(("contract_id", "contractId"), ("template_id", "templateId"),
                          ("signatories", "signatories"), ("observers", "observers")),
                    F.lit("").alias("agreementText"))
    ev = F.struct(
        F.when(F.col("event_type") == "created", F.struct(daml_payload("payload").alias("payload"))).alias("created"),
        F.when(F.col("event_type") == "archived", F.struct(F.col("contract_id").alias("contractId"))).alias("archived"),
        F.when(F.col("event_type") == "exercised", F.struct(F.col("choice").alias("choice"))).alias("exercised"))
    return F.to_json(F.struct(meta.alias("meta"), ev.alias("event")))


def avro_created(df: DataFrame) -> DataFrame:
    """The 8-field CreatedEvent record; payload as compact JSON text."""
    return df.filter(F.col("event_type") == "created").select(
        *_ids(("event_id", "eventId"), ("contract_id", "contractId"), ("template_id", "templateId")),
        payload_json("payload").alias("payload"),
        *_ids(("signatories", "signatories"), ("observers", "observers"), ("transaction_id", "transactionId")),
        iso_time("record_time").alias("ledgerEffectiveTime"))


def avro_archived(df: DataFrame) -> DataFrame:
    """The 6-field ArchivedEvent record."""
    return df.filter(F.col("event_type") == "archived").select(
        *_ids(("event_id", "eventId"), ("contract_id", "contractId"), ("template_id", "templateId"),
              ("signatories", "signatories"), ("observers", "observers"), ("transaction_id", "transactionId")))


def avro_union(df: DataFrame) -> DataFrame:
    """One topic carrying both records: ``struct<created, archived>`` with one non-null, in one pass."""
    ids = _ids(("event_id", "eventId"), ("contract_id", "contractId"), ("template_id", "templateId"))
    parties = _ids(("signatories", "signatories"), ("observers", "observers"), ("transaction_id", "transactionId"))
    created = F.struct(*ids, payload_json("payload").alias("payload"), *parties, iso_time("record_time").alias("ledgerEffectiveTime"))
    kind = F.col("event_type")
    return (df.filter(kind.isin("created", "archived"))
            .select("event_id", F.when(kind == "created", created).alias("created"),
                    F.when(kind == "archived", F.struct(*ids, *parties)).alias("archived")))


def pretty(c: Column) -> Column:
    """The pretty-print switch: the same JSON, indented."""
    return F.to_json(c, {"pretty": "true"})


def streamed_events(df: DataFrame) -> DataFrame:
    """Emitter → consumer published events: one row per observer of a created event."""
    ev = df.filter(F.col("event_type") == "created").select(
        F.element_at("signatories", 1).alias("emitter"), "observers",
        F.struct(F.col("template_id").alias("templateId"), F.col("contract_id").alias("contractId"),
                 payload_json("payload").alias("payload"), iso_time("record_time").alias("emittedAt")).alias("event"))
    return ev.select("emitter", F.explode("observers").alias("consumer"), "event")
