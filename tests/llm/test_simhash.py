"""SimHash near-dedup against a plain all-pairs version."""

import re

import numpy as np
import pytest
import xxhash

from ledgerlane.llm import simhash as S
from tests.llm.helpers import docs_of, same_rows, texts


def brute_print(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows: list[tuple]) -> dict:
    """fingerprint -> smallest id reachable, over all pairs."""
    prints = sorted({f for _, f in rows})
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    ids = {}
    for i, f in rows:
        if i is not None:
            ids[find(f)] = min(i, ids.get(find(f), i))
    return {f: ids.get(find(f)) for f in prints}


def expected(rows: list[tuple]) -> list[tuple]:
    prints = [(i, brute_print(t)) for i, t in rows]
    comp = brute_components(prints)
    return [(i, f, comp[f]) for i, f in prints]


def got(df) -> list[tuple]:
    return [(r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()]


def test_matches_all_pairs_on_documents(spark):
    rows = docs_of("sf0.001")
    out = S.simhash_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    same_rows(got(out), expected(rows))


def test_edge_rows(spark):
    rows = texts() + [(50, "A b"), (51, "a B"), (52, "one"), (None, "a b"), (53, " \x0b\r"), (54, "x y Éa éa")]
    out = S.simhash_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    same_rows(got(out), expected(rows))


def test_empty_and_extra_columns(spark):
    assert S.simhash_components(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    df = spark.createDataFrame([(1, "a b c d", 9, 8, 7), (2, "a b c d", 9, 8, 7), (2, "a b c d", 9, 8, 7), (3, "q r s t", 9, 8, 7)],
                               "doc_id bigint, text string, fp int, k1 int, row int")
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_counters(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 1, np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (200, 8)).astype(np.uint64))
    points = np.unique(np.bitwise_xor.reduce(np.concatenate([flips[:, :7], np.broadcast_to(base, (200, 1))], 1), axis=1))
    planes = S.Planes(points)
    words = np.arange(planes.planes.shape[1])
    valid = np.array([sum(1 << i for i in range(min(64, len(points) - 64 * w))) for w in words], np.uint64)
    for q in points[:20]:
        near = planes.near(np.full(len(words), q), words, radius, valid)
        lanes = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
        assert lanes.tolist() == [i for i, p in enumerate(points) if int(p ^ q).bit_count() <= radius]


@pytest.mark.parametrize("bucket", [100, 1 << 16])
def test_links_keep_components(spark, bucket):
    """Crowded buckets are split or compared by breadth-first search; the components stay those of all pairs."""
    rng = np.random.default_rng(7)
    base = [int(x) for x in rng.integers(0, 1 << 63, 4, np.uint64)]
    prints = sorted({b ^ sum({1 << int(i) for i in rng.integers(0, 64, rng.integers(0, 7))}) for b in base for _ in range(150)})
    rows = list(enumerate(prints))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in rows]
    out = S.near_duplicates(spark.createDataFrame(signed, "id bigint, fp bigint"), bucket=bucket)
    assert {r["fp"] % (1 << 64): r["component_id"] for r in out.collect()} == brute_components(rows)


def test_masks_cover_every_pair():
    for r in (1, 2, 3):
        for bits in ([0, 1, 2], [0, 32, 63], [10, 11, 45]):
            diff = sum(1 << b for b in bits[:r])
            assert any(not m & diff for m in S.bucket_masks(r))
