"""Arrival of files in a landing folder, page by page, for tests of streams."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGED_FILES = 5
# A staged file covers at most this many keys, so one writing task stays
# bounded however large the table; a page wider than that is several files.
PAGE_FILE_KEYS = 5_000_000


def key_ranges(df: DataFrame, key: str, n: int) -> list[tuple[int, int]]:
    """``n`` contiguous ``[lo, hi)`` ranges of an integer key (one small aggregate)."""
    row = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if row is None or row["lo"] is None:
        return []
    lo, hi = int(row["lo"]), int(row["hi"])
    width = max(1, math.ceil((hi - lo + 1) / n))
    return [(lo + i * width, lo + (i + 1) * width) for i in range(n) if lo + i * width <= hi]


def page_files(ranges: list[tuple[int, int]]) -> int:
    """Files per staged page: enough that no file spans more than ``PAGE_FILE_KEYS`` keys."""
    width = max((hi - lo for lo, hi in ranges), default=1)
    return max(1, math.ceil(width / PAGE_FILE_KEYS))


def stage_files(df: DataFrame, key: str, out_dir: str, n: int = STAGED_FILES,
                ranges: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
    """Write ``df`` to ``out_dir`` as ``n`` pages, one per key range, in key order.

    Each page is written by its own job, after the previous one, so file
    modification times follow the pages.  A page is ``page_files(ranges)``
    files (range-partitioned on the key, written in parallel); on the test
    tables that is one file per page.  Read them back with
    ``files_per_trigger=page_files(ranges)`` to get one micro-batch per page.
    """
    ranges = ranges if ranges is not None else key_ranges(df, key, n)
    k = page_files(ranges)
    for lo, hi in ranges:
        page = df.filter((F.col(key) >= lo) & (F.col(key) < hi))
        (page.repartitionByRange(k, key) if k > 1 else page.coalesce(1)).write.mode("append").parquet(out_dir)
    return ranges
