"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A configuration table (routes, handlers, subscriptions) is broadcast only
# while it holds at most this many rows and bytes; larger ones take a shuffle join.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 << 20


def small(df: DataFrame, known_rows: int | None = None, max_rows: int = BROADCAST_MAX_ROWS,
          max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its size is proven within ``max_rows`` and ``max_bytes``.

    ``known_rows`` is given when the caller built the table from a list that
    the driver holds; else at most ``max_rows + 1`` rows of it are read and
    their bytes summed (bounded work).
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and ``max_bytes``; at most ``max_rows + 1`` rows of it are read."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes
