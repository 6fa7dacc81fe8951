"""The ``ledger`` event table derived from the input tables.

Created events come from ``orders`` (one per order), archived events from
fulfilled orders, exercised events from ``lineitem`` joined to its order.
Three consecutive orders form one transaction.  Every column is a pure
expression of the input rows, so the derivation runs the same on a batch
table and (for created/archived) on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.sources.tables import spread_table, table

# Template chosen by the first character of o_orderpriority.
TEMPLATES_BY_PRIORITY = [
    ("1", "Main:Iou"),
    ("2", "Main:Asset"),
    ("3", "Token:Fungible"),
    ("4", "SupplyChain:Shipment"),
    ("5", "Unknown:Template"),
]
# Exercised choice by l_returnflag.
CHOICE_BY_RETURNFLAG = [("R", "Return"), ("A", "Accept"), ("N", "Transfer")]

TX_SIZE = 3  # orders per transaction

# Ledger value type of payload paths that are not implied by the Spark type.
# Strings are Text unless listed here as Party.
PAYLOAD_TAGS = {("issuer",): "party", ("owner",): "party"}

LEDGER_COLUMNS = [
    "event_type", "ledger_offset", "event_id", "contract_id", "template_id",
    "transaction_id", "tx_offset", "payload", "signatories", "observers",
    "record_time", "choice", "cust_key",
]


def _case_sql(expr: str, pairs) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {expr} {whens} END"


def _offset_sql(n: str) -> str:
    return f"if(length(CAST({n} AS STRING)) > 18, CAST({n} AS STRING), lpad(CAST({n} AS STRING), 18, '0'))"


# The derivation is written as SQL expression text: the JVM parses each
# expression in one call, where a Column tree costs a driver round trip per
# node (thousands per query).  The plan is the same either way.
def _common_sql(orderkey: str, custkey: str, priority: str) -> list[str]:
    tx = f"{orderkey} div {TX_SIZE}"
    return [
        f"concat('#', CAST({orderkey} AS STRING), ':0') AS contract_id",
        f"{_case_sql(f'substr({priority}, 1, 1)', TEMPLATES_BY_PRIORITY)} AS template_id",
        f"concat('tr-', CAST({tx} AS STRING)) AS transaction_id",
        f"{_offset_sql(tx)} AS tx_offset",
        f"array(concat('Cust', CAST({custkey} AS STRING))) AS signatories",
        f"array(concat('Nation', CAST({custkey} % 25 AS STRING))) AS observers",
    ]


PAYLOAD_SQL = (
    "named_struct('issuer', concat('Cust', CAST(o_custkey AS STRING)), "
    "'owner', concat('Nation', CAST(o_custkey % 25 AS STRING)), "
    "'deal', named_struct('amount', CAST(o_totalprice AS DECIMAL(15,2)), 'status', o_orderstatus, "
    "'priority', o_orderpriority, 'urgent', startswith(o_orderpriority, '1'), "
    "'units', CAST(o_orderkey % 100 AS BIGINT)))"
)


def payload_struct() -> Column:
    """Typed payload of a created event (Daml record → Spark struct)."""
    return F.expr(PAYLOAD_SQL)


PAYLOAD_TYPE = ("struct<issuer:string,owner:string,deal:struct<amount:decimal(15,2),"
                "status:string,priority:string,urgent:boolean,units:bigint>>")


def key_bounds(start: str | None, end: str | None) -> tuple[int | None, int | None]:
    """Order-key range implied by an offset range ``(start, end]``.

    Every event of order ``k`` has an offset in ``[10k, 10k + 9]``, so
    ``offset > start`` needs ``k >= start div 10`` and ``offset <= end``
    needs ``k <= end div 10``.  The bounds are a superset; the exact offset
    predicate stays on top.  Unlike the offset text, they are plain column
    predicates that reach the parquet scan (row-group skipping by min/max).
    """
    lo = int(start) // 10 if start is not None else None
    hi = int(end) // 10 if end is not None else None
    return lo, hi


def offset_at(spark: SparkSession, sf_dir: str, share: tuple[int, int]) -> str | None:
    """The offset at ``share`` (numerator, denominator) of the way from the ledger's least order to its greatest; None for an empty ledger."""
    lo, hi = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return None if lo is None else f"{(lo + (hi - lo) * share[0] // share[1]) * 10:018d}"


def _bounded(df: DataFrame, key: str, bounds) -> DataFrame:
    lo, hi = bounds or (None, None)
    if lo is not None:
        df = df.filter(F.col(key) >= lo)
    if hi is not None:
        df = df.filter(F.col(key) <= hi)
    return df


def bounded_orders(orders: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """A (batch or streaming) ``orders`` frame cut to the key range of an offset range."""
    return _bounded(orders, "o_orderkey", key_bounds(start, end))


def _orders(spark: SparkSession, sf_dir: str, bounds=None, spread: bool = True) -> DataFrame:
    """Orders, spread when they feed the per-row event derivation (not as a join's build side)."""
    o = (spread_table(spark, sf_dir, "orders", "o_orderkey") if spread else table(spark, sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return _bounded(o, "o_orderkey", bounds)


def flat_events_from_orders(orders: DataFrame) -> DataFrame:
    """Created and archived events of a (batch or streaming) ``orders`` frame."""
    # One pass over orders: each order yields its created event and, when
    # fulfilled, its archived event (no second scan, no union shuffle).
    base = orders.selectExpr("*", "explode(if(o_orderstatus = 'F', array(0, 9), array(0))) AS _kind")
    off = _offset_sql("o_orderkey * 10 + _kind")
    return base.selectExpr(
        "if(_kind = 0, 'created', 'archived') AS event_type",
        f"{off} AS ledger_offset",
        f"concat({off}, ':0') AS event_id",
        *_common_sql("o_orderkey", "o_custkey", "o_orderpriority"),
        f"if(_kind = 0, {PAYLOAD_SQL}, CAST(NULL AS {PAYLOAD_TYPE})) AS payload",
        "o_orderdate AS record_time",
        "CAST(NULL AS STRING) AS choice",
        "o_custkey AS cust_key",
    )


def exercised_events(spark: SparkSession, sf_dir: str, bounds=None) -> DataFrame:
    """Exercised events: each lineitem is a choice exercised on its order's contract.

    The join is an equi-join on the order key; at scale both sides are large,
    so Spark shuffles both on the key (sort-merge), and AQE splits skewed keys.
    """
    li = _bounded(spread_table(spark, sf_dir, "lineitem", "l_orderkey")
                  .select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"),
                  "l_orderkey", bounds)
    o = _orders(spark, sf_dir, bounds, spread=False).select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    off = _offset_sql("l_orderkey * 10 + l_linenumber")
    return j.selectExpr(
        "'exercised' AS event_type",
        f"{off} AS ledger_offset",
        f"concat({off}, ':0') AS event_id",
        *_common_sql("l_orderkey", "o_custkey", "o_orderpriority"),
        f"CAST(NULL AS {PAYLOAD_TYPE}) AS payload",
        "l_shipdate AS record_time",
        f"{_case_sql('l_returnflag', CHOICE_BY_RETURNFLAG)} AS choice",
        "o_custkey AS cust_key",
    )


def flat_ledger(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Created + archived events (the flat transaction stream); offsets are unique.

    ``start``/``end`` restrict to offsets in ``(start, end]``, pruning the scan.
    """
    df = flat_events_from_orders(_orders(spark, sf_dir, key_bounds(start, end)))
    return _offset_range(df, start, end)


def ledger(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """All events: created, archived and exercised (transaction-tree mode), optionally in ``(start, end]``."""
    b = key_bounds(start, end)
    df = flat_events_from_orders(_orders(spark, sf_dir, b)).unionByName(exercised_events(spark, sf_dir, b))
    return _offset_range(df, start, end)


def _offset_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col("ledger_offset") > start)
    if end is not None:
        df = df.filter(F.col("ledger_offset") <= end)
    return df
