"""A streaming source that polls an event archive page by page.

A poll gets at most ``pageSize`` events after the cursor; the cursor is then
the place of the last event seen.  A micro-batch is ``pagesPerBatch`` polls at
most, read by tasks in page-aligned ranges; the driver reads the index only.
With ``mostPages`` a backlog is caught up with: a micro-batch that was full is
followed by one of twice its pages, up to that many, and one that wasn't by one
of ``pagesPerBatch`` again, so the number of micro-batches over a long backlog
is that of ``mostPages`` in it, and their ends stay multiples of
``pagesPerBatch``.
The stream's offsets are places in the ledger, kept in its checkpoint, so it
goes on where it stopped, and an append between two polls is simply there at
the next one (a page that wasn't full is filled up; its earlier events keep
the cursor they had).
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ledgerlane.sources.archive import Archive

PAGE_SIZE = 100        # fixed value: events per poll
TASK_ROWS = 250_000    # events that one task reads
MOST_PAGES = 20_000    # polls in a micro-batch that catches up with a backlog: two million events, a few hundred MB

PAGE_COLUMNS = {"page": pa.int64(), "cursor": pa.string()}  # the poll that got the event, and the last offset of that poll


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def _rows(file: str, columns: list[str], start: int, stop: int) -> pa.Table:
    """Rows start:stop of a file; only their row groups are read."""
    where, path = _located(file)
    with where.open_input_file(path) as f:
        parquet = pq.ParquetFile(f)
        groups, before, first = [], 0, 0
        for g in range(parquet.num_row_groups):
            rows = parquet.metadata.row_group(g).num_rows
            if before < stop and before + rows > start:
                first = first if groups else before
                groups.append(g)
            before += rows
        return parquet.read_row_groups(groups, columns=columns).slice(start - first, stop - start)


@dataclass
class Rows(InputPartition):
    """Rows ``first`` to ``last`` (exclusive) of a file, whose first row has the place ``place``; pages start at ``base``.

    ``close`` is the file and row of the last event of a page that goes on in another file.
    """

    file: str
    first: int
    last: int
    place: int
    base: int
    close: tuple[str, int] | None


class Files:
    """The archive's files in ledger order, with the place of each one's first event."""

    def __init__(self, root: str):
        self.root, self.names, self.places, self.last, self.appends = root.rstrip("/"), [], [0], [], set()

    def refresh(self) -> None:
        """Read the index of appends that are new."""
        where, path = _located(f"{self.root}/index")
        if where.get_file_info(path).type == fs.FileType.NotFound:
            return
        found = {}
        for info in where.get_file_info(fs.FileSelector(path)):
            number = int(info.base_name.partition("append=")[2] or -1)
            if number >= 0 and number not in self.appends and where.get_file_info(f"{info.path}/_SUCCESS").type != fs.FileType.NotFound:
                found[number] = pq.read_table(info.path, filesystem=where, partitioning=None)
        for number, t in sorted(found.items()):
            self.appends.add(number)
            for row in t.sort_by("first_offset").to_pylist():
                self.names.append(row["file"])
                self.places.append(self.places[-1] + row["events"])
                self.last.append(row["last_offset"])

    def place_after(self, offset: str, offset_col: str) -> int:
        """The number of events up to ``offset``: the index finds the file, of which only the offsets are read."""
        i = bisect.bisect_right(self.last, offset)
        if i == len(self.names):
            return self.places[-1]
        where, path = _located(self.names[i])
        offsets = pq.read_table(path, filesystem=where, columns=[offset_col], partitioning=None).column(0).cast(pa.string())
        return self.places[i] + (pc.sum(pc.less_equal(offsets, offset)).as_py() or 0)


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.files, self.names, self.offset_col = Files(options["path"]), schema.names, options.get("offsetCol", "ledger_offset")
        self.page, self.pages = int(options.get("pageSize", PAGE_SIZE)), int(options.get("pagesPerBatch", 1))
        self.start, self.task_rows = options.get("startingOffset"), int(options.get("taskRows", TASK_ROWS))
        self.most = int(options.get("mostPages", self.pages)) // self.pages * self.pages  # a multiple, so batches end where they would
        self.planned: int | None = None  # the end of the last batch that was planned
        self.admit = self.pages          # pages of the next batch

    def initialOffset(self) -> dict:
        self.files.refresh()
        seen = self.files.place_after(self.start, self.offset_col) if self.start else 0
        return {"seen": seen, "base": seen}

    def latestOffset(self) -> dict:
        self.files.refresh()
        if self.planned is None:
            at = self.initialOffset()
            self.planned, self.base = at["seen"], at["base"]
        full = (self.planned - self.base) // self.page * self.page + self.base  # a page that wasn't full is the next batch's first
        return {"seen": min(full + self.page * self.admit, self.files.places[-1]), "base": self.base}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        # After a restart the engine plans the last batch again before it asks for more, so the cursor is known from here.
        self.planned, self.base = end["seen"], end["base"]
        got = (end["seen"] - start["seen"]) // self.page  # known from the offsets, so a batch planned again changes nothing
        self.admit = max(self.pages, min(2 * (got // self.pages * self.pages), self.most))
        if not self.files.names:
            self.files.refresh()
        step = max(1, self.task_rows // self.page) * self.page
        out = []
        at = start["seen"]
        while at < end["seen"]:
            i = bisect.bisect_right(self.files.places, at) - 1
            stop = min(end["seen"], self.files.places[i + 1], end["base"] + ((at - end["base"]) // step + 1) * step)
            page_end = min(end["seen"], end["base"] - (end["base"] - stop) // self.page * self.page)
            j = bisect.bisect_right(self.files.places, page_end - 1) - 1
            close = (self.files.names[j], page_end - 1 - self.files.places[j]) if page_end > stop else None
            out.append(Rows(self.files.names[i], at - self.files.places[i], stop - self.files.places[i], self.files.places[i], end["base"], close))
            at = stop
        return out

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        columns = list(dict.fromkeys([c for c in self.names if c not in PAGE_COLUMNS] + [self.offset_col]))
        t = _rows(partition.file, columns, partition.first, partition.last)
        places = range(partition.place + partition.first - partition.base, partition.place + partition.last - partition.base)
        page = pa.array([p // self.page for p in places], pa.int64())
        offsets = t.column(self.offset_col).cast(pa.string())
        last = pa.table({"page": page, "o": offsets}).group_by("page").aggregate([("o", "max")])
        cursor = dict(zip(last.column("page").to_pylist(), last.column("o_max").to_pylist()))
        if partition.close:
            file, row = partition.close
            cursor[page[-1].as_py()] = str(_rows(file, [self.offset_col], row, row + 1).column(0)[0].as_py())
        t = t.append_column("page", page).append_column("cursor", pa.array([cursor[p] for p in page.to_pylist()], pa.string()))
        yield from t.select(self.names).to_batches(max_chunksize=10_000)


class LedgerPoll(DataSource):
    """``readStream.format("ledger_poll").schema(...).option("path", archive)``; options ``startingOffset`` (exclusive), ``pageSize``, ``pagesPerBatch``, ``mostPages``, ``taskRows``, ``offsetCol``."""

    @classmethod
    def name(cls) -> str:
        return "ledger_poll"

    def schema(self) -> StructType:
        raise ValueError("name the schema of the archive's events, and of page and cursor where they are wanted")

    def streamReader(self, schema: StructType) -> PollReader:
        return PollReader(self.options, schema)


def polled(archive: Archive, columns: str | None = None, start: str | None = None, pages_per_batch: int = 1, page_size: int = PAGE_SIZE,
           most_pages: int | None = None) -> DataFrame:
    """The archive as a stream of polls from offset ``start`` (exclusive) on; ``columns`` (DDL) may name ``page`` and ``cursor``.

    ``most_pages``: micro-batches grow up to that many polls while there is a backlog.
    """
    spark = archive.spark
    spark.dataSource.register(LedgerPoll)
    reader = (spark.readStream.format("ledger_poll").schema(columns or archive.schema).option("path", archive.root).option("offsetCol", archive.offset_col)
              .option("pageSize", page_size).option("pagesPerBatch", pages_per_batch).option("mostPages", most_pages or pages_per_batch))
    return (reader.option("startingOffset", start) if start is not None else reader).load()


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Run batch after batch until the archive has no more events, then stop (``availableNow`` would end after the first page)."""
    q = writer.trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q
