"""Retry with exponential backoff (ST8): the plan per failed record, as a table.

A send is retried while its error class is retriable and attempts remain;
the wait before retry ``j`` is ``min(initial * factor**j, max)`` (the first
wait is already ``initial * factor``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error classes the Kafka sink treats as transient.
RETRIABLE = ["TimeoutException", "NetworkException", "LeaderNotAvailableException", "NotEnoughReplicasException"]


@dataclass(frozen=True)
class Backoff:
    initial_ms: int = 100
    factor: float = 2.0
    max_ms: int = 1000
    max_attempts: int = 5

    def wait_ms(self, j: int) -> int:
        return int(min(self.initial_ms * self.factor ** j, self.max_ms))


def retriable(error_class: Column) -> Column:
    return F.coalesce(error_class.isin(RETRIABLE), F.lit(False))


def attempts(error_class: Column, failures_before_success: Column, b: Backoff) -> Column:
    """Attempts made: 1 for a first-try success or a permanent error, else failures + 1, at most ``max_attempts``."""
    return F.when((failures_before_success == 0) | ~retriable(error_class), F.lit(1)) \
        .otherwise(F.least(failures_before_success + 1, F.lit(b.max_attempts))).cast("int")


def total_wait_ms(n_attempts: Column, b: Backoff) -> Column:
    """Sum of the waits between ``n_attempts`` attempts (JVM-side higher-order functions)."""
    waits = F.transform(F.sequence(F.lit(1), F.greatest(n_attempts - 1, F.lit(1))),
                        lambda j: F.least(F.lit(float(b.initial_ms)) * F.pow(F.lit(b.factor), j),
                                          F.lit(float(b.max_ms))))
    s = F.aggregate(waits, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(n_attempts > 1, F.round(s).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def outcome(error_class: Column, failures_before_success: Column, b: Backoff) -> Column:
    ok = (failures_before_success == 0) | (retriable(error_class) & (failures_before_success < b.max_attempts))
    return F.when(ok, "delivered").otherwise("dead_letter")
