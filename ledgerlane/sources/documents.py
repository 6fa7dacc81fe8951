"""Transaction documents (JSON text) and their parser.

``transaction_documents`` renders each transaction of the ledger as one JSON
document — the input shape of the reference's stream parser; one in 97
transactions is deliberately malformed.  ``parse_documents`` is the parser:
``from_json`` with a corrupt-record column (failures are kept, not fatal),
then ``posexplode`` of the events; ``created`` wins over ``archived``
(then ``exercised``); unknown kinds are dropped; a missing or empty
``events`` array gives no rows.  Both run per row / per transaction, so
they work on streaming frames too (the render needs a grouping by
transaction, bounded by the transaction size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.operators.encode import daml_payload_sql
from ledgerlane.operators.sequence import number_rows_ranged

BROKEN_EVERY = 97  # transactions with tx_number % 97 = 0 are rendered malformed

_EV = "eventId:string,contractId:string,templateId:string"
EVENT_TYPE = (f"struct<created:struct<{_EV},payload:string>,archived:struct<{_EV}>,"
              f"exercised:struct<{_EV},choice:string>>")
DOC_SCHEMA = f"offset string, events array<{EVENT_TYPE}>, _corrupt string"


def tx_number(transaction_id: str | Column = "transaction_id") -> Column:
    c = F.col(transaction_id) if isinstance(transaction_id, str) else transaction_id
    return F.substring(c, 4, 40).cast("bigint")


def _event_json_sql() -> str:
    """SQL text of one document event ``{created|archived|exercised: {...}}``."""
    ids = "'eventId', event_id, 'contractId', contract_id, 'templateId', template_id"
    return (f"named_struct("
            f"'created', CASE WHEN event_type = 'created' THEN named_struct({ids}, 'payload', "
            f"{daml_payload_sql('payload')}) END, "
            f"'archived', CASE WHEN event_type = 'archived' THEN named_struct({ids}) END, "
            f"'exercised', CASE WHEN event_type = 'exercised' THEN named_struct({ids}, 'choice', choice) END)")


def transaction_documents(events: DataFrame, max_events: int | None = None) -> DataFrame:
    """One JSON document per transaction: ``(transaction_id, tx_offset, doc)``.

    Events are ordered by (ledger_offset, choice) inside the document.  A
    document is a transaction whatever its size; with ``max_events`` a larger
    one is rendered as several documents (``part``), each with the number of
    its first event (``first``), which the parser adds to positions, so the
    events that come out are the same.  Events are then numbered by ranges
    (``number_rows_ranged``), so a transaction that holds most events is many
    bounded tasks' work.
    """
    keys = ["transaction_id", "tx_offset"]
    if max_events is not None:
        choice = F.coalesce(F.col("choice"), F.lit("")) if "choice" in events.columns else F.lit("")
        numbered = number_rows_ranged(events.withColumn("_choice", choice), ["transaction_id"],
                                      ["ledger_offset", "_choice", "event_id", "record_time"], "_rn")
        events = numbered.withColumn("part", F.expr(f"(_rn - 1) div {max_events}")).drop("_rn", "_choice")
        keys.append("part")
    grouped = (events.groupBy(*keys)
               .agg(F.expr(f"array_sort(collect_list(named_struct('ledger_offset', ledger_offset, "
                           f"'_c', coalesce(choice, ''), 'ev', {_event_json_sql()})))").alias("evs")))
    n = "CAST(substring(transaction_id, 4, 40) AS BIGINT)"
    good = "to_json(named_struct('offset', tx_offset, 'events', transform(evs, e -> e.ev)))"
    broken_a = """concat('{"offset":"', tx_offset, '","events":[{"created":"not_an_object"}]}')"""
    broken_b = """concat('{"offset":"', tx_offset, '","events":[{"created":{')"""
    doc = (f"CASE WHEN {n} % {BROKEN_EVERY} <> 0 THEN {good} "
           f"WHEN floor({n} / {BROKEN_EVERY}) % 2 = 0 THEN {broken_a} ELSE {broken_b} END")
    first = [f"part * {max_events}L AS first"] if max_events is not None else []
    return grouped.selectExpr(*keys, *first, f"{doc} AS doc")


def parse_failures(docs: DataFrame, trees: bool = False) -> DataFrame:
    """Malformed transactions, one row each: ``(transaction_id, parse_error)``.

    Only failed rows are grouped, and only where documents are parts.
    """
    bad = parse_documents(docs, trees=trees).filter(F.col("parse_error").isNotNull()).select("transaction_id", "parse_error")
    return bad.distinct() if "part" in docs.columns else bad


def parse_documents(docs: DataFrame, doc_col: str = "doc", trees: bool = False) -> DataFrame:
    """Parse documents into one row per event, plus a ``parse_error`` row per bad document.

    Output: the input columns except the document, ``parse_error`` (null when
    fine), ``offset``, ``idx`` (position in the transaction), ``event_type``,
    ``event_id``, ``contract_id``, ``template_id``, ``payload`` (JSON text),
    ``choice``.
    """
    keep = [f"`{c}`" for c in docs.columns if c != doc_col]
    position = "CAST(first + idx AS INT)" if "first" in docs.columns else "idx"
    parsed = docs.selectExpr(*keep, f"from_json(`{doc_col}`, '{DOC_SCHEMA}', "
                                    "map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_corrupt')) AS _p")
    # One pass: a bad document becomes a single marker item (idx -1), a good
    # one its positioned events; one explode, no second scan, no union.
    items = (f"CASE WHEN _p IS NULL OR _p._corrupt IS NOT NULL "
             f"THEN array(named_struct('idx', -1, 'e', CAST(NULL AS {EVENT_TYPE}))) "
             f"ELSE transform(_p.events, (e, i) -> named_struct('idx', i, 'e', e)) END")
    ev = (parsed.selectExpr(*keep, "_p.offset AS offset", f"explode({items}) AS it")
          .selectExpr(*keep, "offset", "it.idx AS idx", "it.e AS e"))
    kinds = [("e.created", "created"), ("e.archived", "archived")] + ([("e.exercised", "exercised")] if trees else [])
    kind = "CASE " + " ".join(f"WHEN {s_} IS NOT NULL THEN '{name}'" for s_, name in kinds) + " END"

    def pick(f: str) -> str:
        return "coalesce(" + ", ".join(f"{s_}.{f}" for s_, _ in kinds) + ")"

    ok = "idx <> -1"
    return (ev.selectExpr("*", f"CASE WHEN {ok} THEN {kind} END AS event_type")
            .filter(f"NOT ({ok}) OR event_type IS NOT NULL")
            .selectExpr(*keep, f"CASE WHEN NOT ({ok}) THEN 'malformed transaction document' END AS parse_error",
                        f"CASE WHEN {ok} THEN offset END AS offset", f"CASE WHEN {ok} THEN {position} END AS idx",
                        "event_type", f"{pick('eventId')} AS event_id", f"{pick('contractId')} AS contract_id",
                        f"{pick('templateId')} AS template_id",
                        "CASE WHEN event_type = 'created' THEN e.created.payload END AS payload",
                        ("e.exercised.choice" if trees else "CAST(NULL AS STRING)") + " AS choice"))
