"""Small fixtures and comparisons of the corpus tests."""

from collections import Counter

import pyarrow.parquet as pq

DATA = "/root/testdata"


def docs_of(sf: str, table: str = "documents", cols: tuple = ("doc_id", "text")) -> list[tuple]:
    t = pq.read_table(f"{DATA}/{sf}/{table}.parquet", columns=list(cols))
    return list(zip(*(t.column(c).to_pylist() for c in cols)))


def texts() -> list[tuple]:
    """(doc_id, text): nulls, empty, very long, repeats, odd white space and characters."""
    long = " ".join(f"word{i % 977} und{i}" for i in range(30_000)) + "\nlast line"
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three\nfour"), (5, "one two three\nfour"),
            (6, "one two three\nfour"), (None, "one two three\nfour"), (None, None), (7, long), (8, long + " x"),
            (9, "Ünïcode ТЕКСТ 文字 \U0001f600 a b c"), (10, "\n\n a \n\x0bA\r\na"), (-3, "tie tie tie tie tie tie tie")]


def same_rows(a, b) -> None:
    a, b = Counter(map(tuple, a)), Counter(map(tuple, b))
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
