"""Routing of units in bounded parts of a batch."""

import numpy as np
import pyarrow as pa

from ledgerlane.llm import packing as P


def test_routing_gives_a_batch_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 50, n).astype("<u4").tobytes() for n in rng.integers(1, 40, 60)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(60)), "doc_tokens": [len(x) // 4 for x in ids], "ids": pa.array(ids, pa.binary()), "unit": list(range(60))})
    topics, idf = rng.normal(size=(4, P.DIMS)), rng.random(50) + 0.1
    whole = pa.Table.from_batches(P._route(iter([batch]), idf, 20.0, topics, 16, "<u2"))
    monkeypatch.setattr(P, "BATCH_IDS", 200)
    parts = list(P._route(iter([batch]), idf, 20.0, topics, 16, "<u2"))
    assert len(parts) > 3 and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()
