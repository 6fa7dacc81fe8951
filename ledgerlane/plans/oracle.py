"""SQL text of the oracle side: the same ``ledger`` derivation in plain SQL.

Each registered query has an ANSI SQL twin (DuckDB dialect) that starts
from these common table expressions; the two are compared row by row.
"""

from __future__ import annotations

from ledgerlane.operators.route import DEFAULT_TOPIC, ROUTES
from ledgerlane.sources.ledger import CHOICE_BY_RETURNFLAG, TEMPLATES_BY_PRIORITY, TX_SIZE


def _case(expr: str, pairs) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {expr} {whens} END"


def _off(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 18, '0')"


_TEMPLATE = _case("substr(o_orderpriority, 1, 1)", TEMPLATES_BY_PRIORITY)
_COMMON = (
    "'#' || CAST({k} AS VARCHAR) || ':0' AS contract_id, template_id, "
    "'tr-' || CAST({k} // %d AS VARCHAR) AS transaction_id, "
    + _off("{k} // %d") + " AS tx_offset, "
    "'Cust' || CAST(o_custkey AS VARCHAR) AS signatory, "
    "'Nation' || CAST(o_custkey %% 25 AS VARCHAR) AS observer, o_custkey AS cust_key"
) % (TX_SIZE, TX_SIZE)

_PAYLOAD = (
    "'Cust' || CAST(o_custkey AS VARCHAR) AS issuer, 'Nation' || CAST(o_custkey % 25 AS VARCHAR) AS owner, "
    "CAST(o_totalprice AS DECIMAL(15,2)) AS amount, o_orderstatus AS status, o_orderpriority AS priority, "
    "starts_with(o_orderpriority, '1') AS urgent, CAST(o_orderkey % 100 AS BIGINT) AS units"
)
_NO_PAYLOAD = ("CAST(NULL AS VARCHAR) AS issuer, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS DECIMAL(15,2)) AS amount, "
               "CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS priority, CAST(NULL AS BOOLEAN) AS urgent, "
               "CAST(NULL AS BIGINT) AS units")

# Flat columns: payload fields are spread out (issuer .. units), one
# signatory and one observer per event (the arrays have one element).
LEDGER_CTE = f"""
_o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
              {_TEMPLATE} AS template_id FROM orders),
flat_ledger AS (
  SELECT 'created' AS event_type, {_off('o_orderkey * 10')} AS ledger_offset,
         {_off('o_orderkey * 10')} || ':0' AS event_id, {_COMMON.format(k='o_orderkey')},
         {_PAYLOAD}, o_orderdate AS record_time, CAST(NULL AS VARCHAR) AS choice
  FROM _o
  UNION ALL
  SELECT 'archived', {_off('o_orderkey * 10 + 9')}, {_off('o_orderkey * 10 + 9')} || ':0',
         {_COMMON.format(k='o_orderkey')}, {_NO_PAYLOAD}, o_orderdate, CAST(NULL AS VARCHAR)
  FROM _o WHERE o_orderstatus = 'F'
),
exercised AS (
  SELECT 'exercised' AS event_type, {_off('l_orderkey * 10 + l_linenumber')} AS ledger_offset,
         {_off('l_orderkey * 10 + l_linenumber')} || ':0' AS event_id, {_COMMON.format(k='l_orderkey')},
         {_NO_PAYLOAD}, l_shipdate AS record_time, {_case('l_returnflag', CHOICE_BY_RETURNFLAG)} AS choice
  FROM lineitem JOIN _o ON l_orderkey = o_orderkey
),
ledger AS (SELECT * FROM flat_ledger UNION ALL SELECT * FROM exercised)
"""


ROUTES_CTE = "routes(template_id, topic) AS (VALUES " + ", ".join(
    f"('{t}', '{d}')" for t, d in ROUTES) + ")"

ROUTED_CTE = f"""{ROUTES_CTE},
routed AS (SELECT l.*, coalesce(r.topic, '{DEFAULT_TOPIC}') AS topic
           FROM ledger l LEFT JOIN routes r USING (template_id))
"""


def offset_at_sql(share: tuple[int, int]) -> str:
    """The offset at a share of the way from the least order to the greatest, as a scalar subquery."""
    return f"(SELECT {_off(f'(min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) * {share[0]} // {share[1]}) * 10')} FROM orders)"


def with_ledger(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([LEDGER_CTE.strip(), *[c.strip() for c in extra_ctes]])
    return f"WITH {ctes}\n{body}"


def with_routed(body: str, *extra_ctes: str) -> str:
    return with_ledger(body, ROUTED_CTE, *extra_ctes)


# Daml-JSON text of the payload (numerics as strings), as ``payload_json`` renders it.
PAYLOAD_TEXT_SQL = (
    "'{\"issuer\":\"' || issuer || '\",\"owner\":\"' || owner || '\",\"deal\":{\"amount\":\"' || "
    "CAST(amount AS VARCHAR) || '\",\"status\":\"' || status || '\",\"priority\":\"' || priority || "
    "'\",\"urgent\":' || CASE WHEN urgent THEN 'true' ELSE 'false' END || ',\"units\":' || "
    "CAST(units AS VARCHAR) || '}}'"
)
OPT_PAYLOAD_SQL = f"CASE WHEN issuer IS NULL THEN '' ELSE ',\"payload\":' || {PAYLOAD_TEXT_SQL} END"
FLAT_JSON_SQL = ("'{\"type\":\"' || event_type || '\",\"offset\":\"' || ledger_offset || '\",\"transactionId\":\"' || transaction_id || "
                 "'\",\"contractId\":\"' || contract_id || '\",\"templateId\":\"' || template_id || '\"' || " + OPT_PAYLOAD_SQL + " || '}'")
ISO_SQL = "strftime(record_time, '%Y-%m-%dT%H:%M:%SZ')"
TXN_SQL = "CAST(substr(transaction_id, 4) AS BIGINT)"


def arr_sql(x: str) -> str:
    """JSON text of a one-element string array."""
    return f"'[\"' || {x} || '\"]'"
