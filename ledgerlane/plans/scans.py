"""Registered queries: sources and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.plans.oracle import offset_at_sql, with_ledger
from ledgerlane.plans.registry import register
from ledgerlane.session import scratch
from ledgerlane.sources import documents as D
from ledgerlane.sources.archive import Archive
from ledgerlane.sources.ledger import flat_ledger, ledger, offset_at
from ledgerlane.sources.tables import table

_TXN = "CAST(substr(transaction_id, 4) AS BIGINT)"
ARCHIVE_FILE_ROWS = 20_000  # events of an archive file: small, as the given tables are
_GOOD = f"{_TXN} % 97 <> 0"


def flat_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.transaction_documents(flat_ledger(spark, sf_dir))


def tree_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.transaction_documents(ledger(spark, sf_dir))


@register("parse_transactions", with_ledger(f"""
SELECT transaction_id, tx_offset AS doc_offset,
       CAST(row_number() OVER (PARTITION BY transaction_id ORDER BY ledger_offset) - 1 AS INTEGER) AS idx,
       event_type, event_id, contract_id, template_id, issuer, CAST(amount AS VARCHAR) AS amount_text
FROM flat_ledger WHERE {_GOOD}"""))
def parse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents → one row per event; events inherit the document offset."""
    ev = D.parse_documents(flat_documents(spark, sf_dir)).filter(F.col("parse_error").isNull())
    return ev.select("transaction_id", F.col("offset").alias("doc_offset"), "idx", "event_type", "event_id", "contract_id", "template_id",
                     F.get_json_object("payload", "$.issuer").alias("issuer"),
                     F.get_json_object("payload", "$.deal.amount").alias("amount_text"))


@register("parse_failures", with_ledger(f"""
SELECT DISTINCT transaction_id, parse_error FROM
  (SELECT transaction_id, 'malformed transaction document' AS parse_error FROM flat_ledger WHERE NOT ({_GOOD}))"""))
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed documents are captured as rows (for the DLQ), not fatal."""
    return D.parse_failures(flat_documents(spark, sf_dir))


@register("scan_transaction_trees", with_ledger(f"""
SELECT transaction_id, tx_offset AS doc_offset, event_type, event_id, contract_id, template_id, choice
FROM ledger WHERE {_GOOD}"""))
def scan_transaction_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction-tree documents: exercised events (with choice) besides create/archive."""
    ev = D.parse_documents(tree_documents(spark, sf_dir), trees=True).filter(F.col("parse_error").isNull())
    return ev.select("transaction_id", F.col("offset").alias("doc_offset"), "event_type", "event_id", "contract_id", "template_id", "choice")


REPLAY_FROM, REPLAY_TO = (1, 5), (4, 5)  # shares of the ledger's range of offsets


@register("replay_range", with_ledger(f"""
SELECT event_id, ledger_offset, event_type, contract_id FROM ledger
WHERE ledger_offset > {offset_at_sql(REPLAY_FROM)} AND ledger_offset <= {offset_at_sql(REPLAY_TO)}"""))
def replay_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay the ledger over ``(start, end]``, offsets a fifth and four fifths along the table's own range.

    Fixed-width offsets compare lexically; their key range reaches the scans.
    """
    start, end = offset_at(spark, sf_dir, REPLAY_FROM), offset_at(spark, sf_dir, REPLAY_TO)
    return ledger(spark, sf_dir, start, end).select("event_id", "ledger_offset", "event_type", "contract_id")


ARCHIVED = "ledger_offset string, event_id string, event_type string, template_id string, contract_id string"
ARCHIVE_FROM, ARCHIVE_TO = (49, 100), (50, 100)


def ledger_archive(spark: SparkSession, sf_dir: str, file_rows: int) -> Archive:
    """The flat ledger as an archive of its own."""
    out = Archive(spark, scratch(spark, "archive"), ARCHIVED, indexed=("template_id", "contract_id"), file_rows=file_rows)
    out.append(flat_ledger(spark, sf_dir))
    return out


@register("archive_replay", with_ledger(f"""
SELECT ledger_offset, event_id, event_type, template_id, contract_id FROM flat_ledger
WHERE ledger_offset > {offset_at_sql(ARCHIVE_FROM)} AND ledger_offset <= {offset_at_sql(ARCHIVE_TO)}"""))
def archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 on an archive: the ledger written in offset order, a hundredth of its range replayed from the files that the index names."""
    archive = ledger_archive(spark, sf_dir, ARCHIVE_FILE_ROWS)
    return archive.replay(offset_at(spark, sf_dir, ARCHIVE_FROM), offset_at(spark, sf_dir, ARCHIVE_TO))


@register("archive_contract", with_ledger("""
SELECT ledger_offset, event_id, event_type, template_id, contract_id FROM flat_ledger
WHERE contract_id IN (SELECT '#' || CAST(min(o_orderkey) AS VARCHAR) || ':0' FROM orders UNION ALL SELECT '#' || CAST(max(o_orderkey) AS VARCHAR) || ':0' FROM orders)"""))
def archive_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 by contract: the events of the ledger's first and last contract, from the files whose Bloom filter knows them."""
    lo, hi = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    wanted = [] if lo is None else [f"#{lo}:0", f"#{hi}:0"]
    return ledger_archive(spark, sf_dir, ARCHIVE_FILE_ROWS).replay(having={"contract_id": wanted})
