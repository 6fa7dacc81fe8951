"""An event archive in offset order, with an index that is read before any file is.

An append is range-clustered by offset into files of about ``FILE_ROWS``
events, sorted inside.  The index holds, for every file, its number of
events, its least and greatest offset and Bloom filters of its templates and
contracts; it is written last, so an append is there as a whole or not at
all.  Offsets of an append follow those of the appends before, so the files
in index order are the ledger in order, and an event has a place: the number
of events before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.session import read_or_empty

FILE_ROWS = 1_000_000
FILTER_BITS = 1 << 15   # a piece of a Bloom filter, as the bitmap functions cut it
BITS_PER_VALUE = 12     # with HASHES, about one false answer in 300
HASHES = 4

INDEX = "file string, events bigint, first_offset string, last_offset string, append int"
FILTERS = "file string, field string, piece bigint, bits binary, append int"


class OutOfOrder(ValueError):
    """An append whose offsets don't follow the archive's."""


class Archive:
    """The archive under ``root``.  ``schema`` is that of its events, in DDL form."""

    def __init__(self, spark: SparkSession, root: str, schema: str, offset_col: str = "ledger_offset", tie: tuple[str, ...] = ("event_id",),
                 indexed: tuple[str, ...] = (), file_rows: int = FILE_ROWS):
        self.spark, self.root, self.schema, self.offset_col = spark, root.rstrip("/"), schema, offset_col
        self.tie, self.indexed, self.file_rows = tie, indexed, file_rows
        # A power of two pieces, the same for every file, so that a value's place is known without the file.
        self.pieces = 1 << max(0, math.ceil(math.log2(file_rows * BITS_PER_VALUE / FILTER_BITS)))

    def index(self) -> DataFrame:
        """(file, events, first_offset, last_offset, append) of every file."""
        return read_or_empty(self.spark, f"{self.root}/index", INDEX)

    def append(self, events: DataFrame) -> int:
        """Add events whose offsets follow the archive's; returns the append's number.  An empty append adds nothing."""
        last = self.index().agg(F.max("append").alias("append"), F.max("last_offset").alias("offset")).first()
        number = 0 if last["append"] is None else last["append"] + 1
        events = events.select(*self.spark.createDataFrame([], self.schema).columns)
        n, least = events.agg(F.count("*"), F.min(self.offset_col).cast("string")).first()
        if not n:
            return number - 1
        if last["offset"] is not None and least <= last["offset"]:
            raise OutOfOrder(f"offset {least} of an append doesn't follow {last['offset']}")
        data = f"{self.root}/data/append={number}"
        order = [self.offset_col, *self.tie]
        (events.repartitionByRange(math.ceil(n / self.file_rows), *order).sortWithinPartitions(*order)
         .write.mode("overwrite").parquet(data))
        placed = self.spark.read.schema(self.schema).parquet(data).withColumn("file", F.col("_metadata.file_path"))
        if self.indexed:
            self._filters(placed).write.mode("overwrite").parquet(f"{self.root}/filters/append={number}")
        (placed.groupBy("file").agg(F.count("*").alias("events"), F.min(self.offset_col).cast("string").alias("first_offset"),
                                    F.max(self.offset_col).cast("string").alias("last_offset"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/index/append={number}"))
        return number

    def _bits(self, field: str, value: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(field), F.lit(j), value), F.lit(self.pieces * FILTER_BITS)) for j in range(HASHES)]

    def _filters(self, placed: DataFrame) -> DataFrame:
        # The bits are sorted by file, field and piece: as numbers, for there are eight times as many of them as events.
        names = sorted(r["file"] for r in placed.select("file").distinct().collect())  # a name for each file of the append
        files = F.broadcast(self.spark.createDataFrame(list(enumerate(names)), "_file int, file string"))
        bits = F.array(*[F.struct(F.lit(i).alias("field"), b.alias("bit")) for i, c in enumerate(self.indexed) for b in self._bits(c, F.col(c).cast("string"))])
        each = placed.join(files, "file").select("_file", F.explode(bits).alias("b")).select("_file", F.col("b.field").alias("_field"), F.floor(F.col("b.bit") / FILTER_BITS).alias("piece"), (F.col("b.bit") % FILTER_BITS).alias("bit"))
        made = each.groupBy("_file", "_field", "piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
        field = F.element_at(F.array(*[F.lit(c) for c in self.indexed]), F.col("_field") + 1)
        return made.join(files, "_file").select("file", field.alias("field"), "piece", "bits")

    def files_with(self, field: str, values: Iterable[str]) -> DataFrame:
        """(file): the files that may hold one of ``values``; a file left out holds none."""
        asked = self.spark.createDataFrame([(str(v),) for v in sorted(set(values))], "value string")
        bits = F.array(*self._bits(field, F.col("value")))
        asked = asked.select("value", F.explode(bits).alias("at")).distinct().select("value", F.floor(F.col("at") / FILTER_BITS).alias("piece"), (F.col("at") % FILTER_BITS).alias("bit"))
        need = asked.groupBy("value").agg(F.count("*").alias("need"))
        known = read_or_empty(self.spark, f"{self.root}/filters", FILTERS).filter(F.col("field") == field)
        byte = F.conv(F.hex(F.expr("substring(bits, CAST(bit div 8 AS INT) + 1, 1)")), 16, 10).cast("bigint")
        hit = known.join(asked, "piece").filter(byte.bitwiseAND(F.expr("shiftleft(1L, CAST(bit % 8 AS INT))")) != 0)
        return hit.groupBy("file", "value").agg(F.count("*").alias("n")).join(need, "value").filter("n = need").select("file").distinct()

    def files(self, start: str | None = None, end: str | None = None, having: dict[str, Iterable[str]] | None = None) -> list[str]:
        """The files that may hold events of offsets in ``(start, end]`` and of the given values, in ledger order: from the index alone."""
        found = self.index()
        if start is not None:
            found = found.filter(F.col("last_offset") > start)
        if end is not None:
            found = found.filter(F.col("first_offset") <= end)
        for field, values in (having or {}).items():
            if field not in self.indexed:
                raise ValueError(f"{field} isn't indexed")
            found = found.join(self.files_with(field, values), "file", "left_semi")
        return [r["file"] for r in found.orderBy("append", "first_offset").select("file").collect()]  # a name for each file that is then opened

    def replay(self, start: str | None = None, end: str | None = None, having: dict[str, Iterable[str]] | None = None) -> DataFrame:
        """The events of ``(start, end]`` with the given values; other files aren't opened."""
        names = self.files(start, end, having)
        if not names:
            return self.spark.createDataFrame([], self.schema)
        out = self.spark.read.schema(self.schema).parquet(*names)
        offset = F.col(self.offset_col).cast("string")
        if start is not None:
            out = out.filter(offset > start)
        if end is not None:
            out = out.filter(offset <= end)
        for field, values in (having or {}).items():
            out = out.filter(F.col(field).isin(sorted(set(values))))
        return out
