"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage works on all that its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import staged
from ledgerlane.llm.decontaminate import contamination
from ledgerlane.llm.line_dedup import line_dedup
from ledgerlane.llm.packing import pack
from ledgerlane.llm.quality_rules import kept_rows
from ledgerlane.llm.simhash import drop_near_duplicates
from ledgerlane.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return kept_rows(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go; a null text stays null, ``n_chars`` follows the text."""
    out = line_dedup(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    new = {"text": text, "n_chars": F.when(F.col("row.n_chars").isNotNull(), F.char_length(text)).cast(docs.schema["n_chars"].dataType)}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    out = contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns).filter(F.size("marks") == 0)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of 1024 ids."""
    return pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: No SQL form: the quality rules' EM, XXH64 fingerprints and the tokenizer aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
