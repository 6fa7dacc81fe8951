"""Benchmark decontamination: Wu-Manber search for word windows of test items.

The alphabet is words.  Windows of one length are searched together: a block
of two words ending at the scan position looks up a shift table, which says
how far the search may jump without missing a window; only blocks that end
some window (shift 0) look up their suffix bucket, and only the windows in it
are compared, word by word, with the text.
"""

from __future__ import annotations

import functools
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlane.llm.common import digest
from ledgerlane.llm.files import located
from ledgerlane.llm.words import NOT_ALNUM, Words, slices, split_words
from ledgerlane.session import scratch

TABLE_BITS = 16
# Windows of a block, which a task holds the search tables of: more windows are more blocks.
BLOCK_WINDOWS = 50_000


class WuManber:
    """Search of word sequences of one length ``m``; ``patterns`` maps their words to the items that have them."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.m, self.block = m, min(2, m)
        self.patterns = list(patterns.items())
        # Patterns' words hashed as the texts' words are, so both meet in the same tables.
        flat = split_words(pa.array([b" ".join(p).decode() for p, _ in self.patterns]), NOT_ALNUM)
        h = flat.hashes().reshape(len(self.patterns), m)
        size = m - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, size, np.int64)
        for j in range(self.block - 1, m):
            np.minimum.at(self.shift, self._slot(h, j), m - 1 - j)
        self.buckets: dict[int, list[int]] = defaultdict(list)
        for i, slot in enumerate(self._slot(h, m - 1).tolist()):
            self.buckets[slot].append(i)

    def _slot(self, h: np.ndarray, j: int) -> np.ndarray:
        """Table slot of the block that ends at word j (along the last axis)."""
        x = h[..., j] if self.block == 1 else h[..., j] + h[..., j - 1] * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of the block ending at each word of a text run."""
        x = h.copy()
        if self.block == 2:
            x[1:] += h[:-1] * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, words: Words, jumps: list[int], slots: np.ndarray, first: int, last: int) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of each occurrence among words first:last."""
        at, m = first + self.m - 1, self.m
        while at < last:
            jump = jumps[at]
            if jump:
                at += jump
                continue
            for i in self.buckets.get(int(slots[at]), ()):
                pattern, items = self.patterns[i]
                start = at - m + 1
                if all(words.word(start + k) == w for k, w in enumerate(pattern)):
                    yield start, items
            at += 1


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(words, item): ``window`` consecutive words of an item, or all its words where it has fewer, by the texts' own word rule."""
    for batch in batches:
        for part in slices(batch, "text"):
            w = split_words(part.column("text"), NOT_ALNUM, lower=True)
            items = part.column("item").to_pylist()
            bounds = w.bounds.tolist()
            for item, a, b in zip(items, bounds, bounds[1:]):
                m = min(window, b - a)
                word = [w.word(i).decode() for i in range(a, b)]
                for at in range(0, len(word) - m + 1 if m else 0, 10_000):
                    found = [word[s:s + m] for s in range(at, min(at + 10_000, len(word) - m + 1))]
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), pa.array([item] * len(found), pa.string())], names=["words", "item"])


def window_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_windows: int) -> list[str]:
    """The items' windows as written files of at most ``block_windows`` each: a block is a file, whose name is all that the driver sees."""
    spark = items.sparkSession
    src = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    path = scratch(spark, "benchmark-windows")
    schema = "words array<string>, item string"
    src.mapInArrow(lambda it: _windows(it, window), schema).write.option("maxRecordsPerFile", block_windows).parquet(path)
    written = spark.read.schema(schema).parquet(path)
    full = written.groupBy(F.input_file_name().alias("file")).count().orderBy("file")
    return [unquote(r["file"]) for r in full.collect()]  # a name for each block


@functools.lru_cache(maxsize=1)
def _tables(file: str | None) -> list[WuManber]:
    """The search tables of a block, built in the task from its file."""
    if file is None:
        return []
    where, path = located(file)
    rows = pq.read_table(path, filesystem=where, partitioning=None)
    by: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for words, item in zip(rows.column("words").to_pylist(), rows.column("item").to_pylist()):
        by[len(words)][tuple(w.encode() for w in words)].update([] if item is None else [item])
    return [WuManber(m, p) for m, p in sorted(by.items())]


def _search(batches: Iterator[pa.RecordBatch], file: str | None) -> Iterator[pa.RecordBatch]:
    tables = _tables(file)
    for batch in batches:
        for part in slices(batch, "text"):
            words = split_words(part.column("text"), NOT_ALNUM, lower=True)
            h = words.hashes()
            n = part.num_rows
            marks: list[list[int]] = [[] for _ in range(n)]
            found: list[set[str]] = [set() for _ in range(n)]
            bounds = words.bounds.tolist()
            for t in tables:
                slots = t.slots(h)
                jumps = t.shift[slots].tolist()
                for d in range(n):
                    for start, items in t.find(words, jumps, slots, bounds[d], bounds[d + 1]):
                        marks[d].append((start - bounds[d]) << 8 | t.m)
                        found[d] |= items
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in part.schema.names if c != "text"],
                 pa.array(np.diff(words.bounds), pa.int64()), pa.array(marks, pa.list_(pa.int64())),
                 pa.array([sorted(x) for x in found], pa.list_(pa.string()))],
                names=[*[c for c in part.schema.names if c != "text"], "n_words", "marks", "items"])


def contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 10,
                  block_windows: int = BLOCK_WINDOWS, keep: list[str] | None = None) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``marks`` (``start << 8 | length`` of each window found) and ``items`` found.

    The items are a stated query set: their windows are cut by tasks and
    written in blocks of at most ``block_windows``; a task builds a block's
    tables from its file, and every row is searched for every block: one scan
    of the texts for each block, with no shuffle of any text.  The driver
    sees the blocks' names only.  ``keep`` names columns to carry, which
    clash with nothing.  Long texts are searched whole, a slice of rows at a time.

    Null text or item text: no words, so nothing is found.  Items with a null
    id mark the words they hit but are not listed.  Repeated rows and items
    are handled each on their own; an empty table of items marks nothing.
    Windows are up to 255 words.
    """
    if not 1 <= window <= 255:
        raise ValueError("a window is 1 to 255 words")
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep or [])]
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carried)
    found = list(StructType.fromDDL("n_words bigint, marks array<bigint>, items array<string>"))
    schema = StructType([*src.drop("text").schema, *found])
    blocks = window_blocks(items, item_id, item_text, window, block_windows)
    if len(blocks) <= 1:
        return _found(src, blocks[0] if blocks else None, schema)
    # More blocks: the same rows once for each block, met again by digest (equal rows have equal answers).
    k1, k2 = digest(F.col("id"), F.col("text"))
    src = src.select("*", k1.alias("k1"), k2.alias("k2"))
    schema = StructType([*src.drop("text").schema, *found])
    first = _found(src, None, schema)
    hits = None
    for file in blocks:
        part = _found(src.select("id", "text", *[f"c{i}" for i in range(len(keep or []))], "k1", "k2"), file, schema)
        part = part.filter(F.size("marks") > 0).select("k1", "k2", "marks", "items").distinct()
        hits = part if hits is None else hits.unionByName(part)
    hits = hits.groupBy("k1", "k2").agg(F.flatten(F.collect_list("marks")).alias("m"),
                                        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("i"))
    return (first.join(hits, ["k1", "k2"], "left")
            .withColumns({"marks": F.coalesce("m", "marks"), "items": F.coalesce("i", "items")}).drop("k1", "k2", "m", "i"))


def _found(src: DataFrame, file: str | None, schema: StructType) -> DataFrame:
    return src.mapInArrow(lambda it: _search(it, file), schema)


def hit_words(marks: str = "marks") -> Column:
    """The number of words inside any window found: the union of the marked ranges."""
    return F.expr(f"""aggregate(array_sort(transform({marks}, x -> named_struct('a', shiftright(x, 8), 'b', shiftright(x, 8) + (x & 255)))),
        named_struct('n', 0L, 'to', 0L),
        (s, r) -> named_struct('n', s.n + greatest(0L, r.b - greatest(r.a, s.to)), 'to', greatest(s.to, r.b)), s -> s.n)""")


def items_digest(items: list[str]) -> str:
    """SHA-256 of the sorted item ids, comma-joined (as the query's column; for tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
