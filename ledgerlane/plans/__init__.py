"""Query catalog: importing this package registers every query."""

from ledgerlane.plans import delivery, encoding, filtering, metrics, routing, scans, streams  # noqa: F401
from ledgerlane.plans.registry import ORACLE, QUERIES  # noqa: F401
