"""Ledger event analytics on Spark: parse, filter, route, encode, deliver and measure ledger events."""

__version__ = "0.1.0"
