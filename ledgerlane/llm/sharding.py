"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in the files of a written table.  How many rows of each file go to
each shard is drawn first, exactly as a uniform permutation of all rows would
deal them (multivariate hypergeometric, file by file); each file's rows are
then permuted on their own and dealt by those counts, exchanged, and permuted
again inside the shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlane.llm.common import remove
from ledgerlane.session import scratch

FILE_ROWS = 1 << 20    # rows of a staged file at most: one file's permutation fits a task
BLOCK_ROWS = 1 << 14   # rows of a block of a shard, about: one block is sorted in a task


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart; the first shards have the one more."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows of partition i that go to shard j, drawn as a uniform permutation deals them.

    Each partition draws without replacement from the places that are left in
    the shards; row and column sums are exact.  A draw is a chain of
    hypergeometric draws, one for each shard; where more than 10^9 places are
    left (numpy's bound), the partition's places are drawn themselves.
    """
    rng = np.random.Generator(np.random.Philox(seed))
    left = np.array(sizes, np.int64)
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for i, n in enumerate(counts):
        if left.sum() < 1_000_000_000:
            places, rest = int(left.sum()), n
            for j, free in enumerate(left.tolist()):
                places -= free
                out[i, j] = rng.hypergeometric(free, places, rest) if rest else 0
                rest -= int(out[i, j])
        else:
            ends = np.cumsum(left)
            out[i] = np.bincount(np.searchsorted(ends, _distinct(rng, int(ends[-1]), n), "right"), minlength=len(sizes))
        left -= out[i]
    return out


def _distinct(rng: np.random.Generator, total: int, n: int) -> np.ndarray:
    """n distinct whole numbers below ``total``, every set equally likely (n is the rows of one file)."""
    got = np.unique(rng.integers(0, total, n))
    while len(got) < n:  # later draws are kept in the order drawn, so no value is favoured
        more = rng.integers(0, total, n - len(got))
        got = np.union1d(got, more)
    return got


def _deal(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Shard and second-permutation key of each row of a file, from its place in the file's own permutation."""
    held: tuple[int, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        files = batch.column("file").to_numpy(zero_copy_only=False)
        rows = batch.column("at").to_numpy(zero_copy_only=False)
        cuts = batch.column("cuts")
        shard, key = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int64)
        edges = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)] if len(files) else [0]
        for a, b in zip(edges, edges[1:]):
            file, cut = int(files[a]), np.asarray(cuts[a].as_py(), np.int64)
            if held is None or held[0] != file:
                rng = np.random.Generator(np.random.Philox([seed, file]))
                held = file, rng.permutation(int(cut[-1])), rng.integers(-(1 << 63), (1 << 63) - 1, int(cut[-1]), np.int64, True)
            shard[a:b] = np.searchsorted(cut, held[1][rows[a:b]], "right")
            key[a:b] = held[2][rows[a:b]]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shard), pa.array(key)],
                                         names=[*batch.schema.names[:-1], "shard", "key"])


def shard_rows(df: DataFrame, shards: int = 8, seed: int = 42, file_rows: int = FILE_ROWS,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row: ``row`` (its columns), ``shard`` and ``slot``: a uniform permutation of all rows, cut into shards.

    Shard sizes are at most one apart and slots gapless from 0.  The rows are
    staged in the shared folder, so a lost executor's tasks find the same rows
    at the same places and deal them alike.  The driver sees one count for
    each file and block.  A shard is cut into blocks of ``block_rows`` rows on
    average by its random keys, so the second permutation needs no task for a
    whole shard; which rows are equal or hot plays no part in any of this.

    Null values and repeated rows are rows like any other; an empty table
    gives no rows; more shards than rows leave some empty.
    """
    spark = df.sparkSession
    path = scratch(spark, "shard")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows.write.option("maxRecordsPerFile", file_rows).parquet(path)
    staged = (spark.read.schema(rows.schema).parquet(path)
              .select("row", F.col("_metadata.file_name").alias("name"), F.col("_metadata.row_index").alias("at")))
    counts = sorted((r["name"], r["count"]) for r in staged.groupBy("name").count().collect())
    n = sum(c for _, c in counts)
    sizes = shard_sizes(n, shards)
    cuts = np.cumsum(communication_matrix([c for _, c in counts], sizes, seed), axis=1)
    matrix = spark.createDataFrame([(name, i, cuts[i].tolist()) for i, (name, _) in enumerate(counts)],
                                   "name string, file int, cuts array<bigint>")
    dealt = staged.join(F.broadcast(matrix), "name").select("row", "file", "at", "cuts")  # one row a file, which the driver has
    schema = StructType([rows.schema["row"], *StructType.fromDDL("file int, at bigint, shard int, key bigint")])
    dealt = dealt.mapInArrow(lambda it: _deal(it, seed), schema)
    blocks = max(1, -(-(n // shards) // block_rows))
    # Equal cuts of the keys' range: blocks of about equal size in key order.
    width = (1 << 64) // blocks + 1
    dealt = dealt.withColumn("block", F.expr(f"cast(floor((cast(key as decimal(20,0)) + 9223372036854775808) / {width}) as int)"))
    dealt_path = scratch(spark, "shard-dealt")
    dealt.write.parquet(dealt_path)
    remove(staged)  # dealt: nothing reads them again
    dealt = spark.read.schema(dealt.schema).parquet(dealt_path)
    before = (Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    firsts = dealt.groupBy("shard", "block").count().select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("key", "file", "at")
    return (dealt.withColumn("i", F.row_number().over(inside)).join(firsts, ["shard", "block"])
            .select("row", "shard", (F.col("first") + F.col("i") - 1).alias("slot")))
