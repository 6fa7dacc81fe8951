"""Small Column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_WIDTH = 18  # fixed-width offsets: lexical order is ledger order


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def offset_of(n: str | Column) -> Column:
    """Zero-padded fixed-width ledger offset from a non-negative integer (a longer number is kept whole)."""
    text = col_(n).cast("string")
    return F.when(F.length(text) > OFFSET_WIDTH, text).otherwise(F.lpad(text, OFFSET_WIDTH, "0"))


def offset_value(o: str | Column) -> Column:
    """Integer value of a fixed-width digit offset: same order as the text.

    Aggregates over it (``max``, ``max_by`` ordering) keep fixed-width buffers
    and so plan as HashAggregate; over the text they fall back to a
    sort-based aggregate.  Null for offsets that aren't digits.
    """
    return col_(o).try_cast("bigint")


def is_fixed_width(o: str | Column) -> Column:
    """Whether an offset is ``OFFSET_WIDTH`` digits.  In ledger order all others come after those, by their text."""
    return col_(o).rlike(f"^[0-9]{{{OFFSET_WIDTH}}}$")


def max_offset(o: str | Column, opaque: bool = False) -> Column:
    """Last (greatest) fixed-width offset of a group, as offset text; ``opaque``: of offsets of any form."""
    digits = offset_of(F.max(offset_value(o)))  # where some aren't digits, those decide
    return F.coalesce(F.max(F.when(~is_fixed_width(o), col_(o))), digits) if opaque else digits


def min_offset(o: str | Column, opaque: bool = False) -> Column:
    """First (least) fixed-width offset of a group, as offset text; ``opaque``: of offsets of any form."""
    if not opaque:
        return offset_of(F.min(offset_value(o)))
    return F.coalesce(offset_of(F.min(F.when(is_fixed_width(o), offset_value(o)))), F.min(col_(o)))


def iso_time(ts: str | Column) -> Column:
    """ISO-8601 UTC text with second precision (``2024-01-01T00:00:07Z``)."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def template_short(t: str | Column) -> Column:
    """Last ``:`` segment of a template id, for display."""
    return F.element_at(F.split(col_(t), ":"), -1)


def template_key(t: str | Column) -> Column:
    """Package-hash-agnostic template key: the last two segments ``Module:Name``."""
    parts = F.split(col_(t), ":")
    return F.array_join(F.slice(parts, -2, 2), ":")


def contract_abbrev(c: str | Column, width: int = 30) -> Column:
    """First ``width`` characters of a contract id followed by ``...``."""
    return F.concat(F.substring(col_(c), 1, width), F.lit("..."))


def offset_number(o: str | Column) -> Column:
    """Offset as a number: keep digits and dots, parse; null when unparseable."""
    return F.regexp_replace(col_(o), r"[^0-9.]", "").try_cast("double")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` column, independent of the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})")
