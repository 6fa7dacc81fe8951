"""Column helpers and row identity shared by the corpus operators.

Row identity.  Documents are keyed by a 128-bit digest of (id, text) or of the
text alone, computed by two chained XXH64; equal rows share the key on
purpose, so a decision taken for one holds for every repeat of it.

Extra columns.  Operators that return rows keep the caller's columns packed in
one struct column ``row``; no working column can clash with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.session import scratch

# Fixed values of the contracts: the white space between words and around lines.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does it where every character is one byte, the rest goes by ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def digest(*cols: Column) -> tuple[Column, Column]:
    """A 128-bit digest as two longs; nulls are told from every value (XXH64 alone skips them)."""
    parts = [x for c in cols for x in (c.isNull(), c)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(0x9E3779B9), *parts)


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text, k1, k2): the caller's columns in one struct, null text as empty, the row's digest."""
    k1, k2 = digest(F.col(id_col), F.col(text_col))
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"), k1.alias("k1"), k2.alias("k2"))


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The caller's columns out of ``row`` again, some replaced."""
    return df.select(*[replaced.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


BATCH_ROWS = 1024  # wide rows (texts, ids, stripes) that a task gets in one Arrow batch


def staged(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """``df`` as a written table of the shared folder.

    Cuts the lineage (a lost executor re-reads files), runs the work above it
    once, and lets a join with it be split: an aggregate joined on its own
    keys has no exchange of its own, and the skew join needs one.  ``wide``:
    the tasks that write it get ``BATCH_ROWS`` rows at a time, at most.
    """
    path = scratch(df.sparkSession, name)
    with batches_of(df.sparkSession, BATCH_ROWS) if wide else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` rows at most (fewer where the session says so) in what is run meanwhile."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


FILTER_WORDS = 1 << 17  # words of the bit table of ``likely``: fixed, whatever the input


def likely(docs: DataFrame, wanted: DataFrame, key1: str, key2: str) -> DataFrame:
    """Rows of ``docs`` that may have a digest (``key1``, ``key2``) of ``wanted``: a fixed-size bit table, so no wanted row is lost.

    It only saves shuffling texts that aren't wanted; the exact join follows.
    """
    return likely_rows(docs, wanted, key1, key2, FILTER_WORDS)


def likely_rows(rows: DataFrame, wanted: DataFrame, key1: str, key2: str, words: int) -> DataFrame:
    """``likely`` with a table of ``words`` words."""
    cell = lambda: F.pmod(F.col(key1), F.lit(words)).alias("cell")
    bit = lambda: F.expr(f"shiftleft(1L, cast(pmod({key2}, 64) as int))")
    table = staged(wanted.select(cell(), bit().alias("b")).groupBy("cell").agg(F.bit_or("b").alias("bits")), "text-filter")
    return (rows.withColumn("cell", cell()).join(F.broadcast(table), "cell")  # so many rows of two longs at most
            .filter(F.col("bits").bitwiseAND(bit()) != 0).drop("cell", "bits"))


def remove(table: DataFrame) -> None:
    """Delete a staged table's files, once nothing will read them: what was made from it must be written itself."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
