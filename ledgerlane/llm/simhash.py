"""SimHash near-dedup: fingerprints of word shingles, linked by bit-sliced comparison.

Two fingerprints that differ in at most r of 64 bits agree on at least two of
r + 2 blocks of bits, so each is put in one bucket for every pair of blocks.
In a bucket, 64 fingerprints lie in one word per bit (bit planes); a query
adds its difference in each plane to 64 counters at once, kept as bit-sliced
carry-save counters, and leaves a word as soon as all its counters are over r.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import digest, staged
from ledgerlane.llm.components import components
from ledgerlane.llm.words import slices, split_words

SEED = 42
# Fingerprints of a bucket that one task compares.  Larger buckets are split by more agreeing bits; as
# fingerprints are distinct, a bucket that agrees on 48 bits has 65,536 at most, so splitting ends.
BUCKET = 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
ONE = np.uint64(1)


def simhash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per group bounds[i]:bounds[i + 1] of 64-bit hashes: each bit that over half of them have (no hash: zero)."""
    n = np.diff(bounds)
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > n[some, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """Fingerprints of texts: XXH64 of every run of ``shingle`` lower-cased words, space-joined (fewer words: all of them)."""
    w = split_words(texts, lower=True)
    size = w.ends - w.starts
    # All words again, one space apart: a shingle is then one byte range.
    ends = np.cumsum(size + 1) - 1
    begins = ends - size
    flat = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    inside = np.repeat(w.starts - begins, size) + _runs(begins, size)
    flat[_runs(begins, size)] = w.data[inside]
    raw = flat.tobytes()
    count = np.diff(w.bounds)
    n = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(w.bounds[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
    last = np.minimum(first + shingle, np.repeat(w.bounds[1:], n)) - 1
    digest64 = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest64(raw[a:b], SEED) for a, b in zip(begins[first].tolist(), ends[last].tolist())), np.uint64, len(first))
    return simhash(hashes, bounds)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] values, then the next run."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            fp = fingerprints_of(part.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(fp)], names=[*part.schema.names[:-1], "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, k1, k2, fp) per row: its id, the digest of (id, text) and the fingerprint as a signed long."""
    k1, k2 = digest(F.col(id_col), F.col(text_col))
    src = df.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    return src.mapInArrow(lambda it: _fingerprints(it, shingle),
                          f"id {df.schema[id_col].dataType.simpleString()}, k1 bigint, k2 bigint, fp bigint")


class Planes:
    """Words of 64 fingerprints each, one bit plane per row: planes[b, w] holds bit b of the 64 in word w."""

    def __init__(self, points: np.ndarray):
        lanes = np.zeros((-(-len(points) // 64), 64), np.uint64) if points.ndim == 1 else points
        if points.ndim == 1:
            lanes.reshape(-1)[:len(points)] = points
        bits = np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), 64, 8), axis=2, bitorder="little")
        self.planes = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64)[..., 0]

    def near(self, queries: np.ndarray, words: np.ndarray, radius: int, valid: np.ndarray) -> np.ndarray:
        """For each (query, word): the lanes of the word, among ``valid``, within ``radius`` differing bits of the query."""
        k = radius.bit_length()
        start = (1 << k) - 1 - radius  # so a counter's carry out says: more than the radius
        out = np.zeros(len(words), np.uint64)
        alive = np.arange(len(words))
        q, w, over = queries, words, ~valid
        count = [np.full(len(words), ALL if start >> j & 1 else 0, np.uint64) for j in range(k)]
        for b in range(64):
            carry = self.planes[b, w] ^ (np.uint64(0) - ((q >> np.uint64(b)) & ONE))
            for c in count:
                carry, c[...] = c & carry, c ^ carry
            over |= carry
            if b % 8 == 7 and b < 63:
                left = over != ALL
                if not left.all():  # the words whose 64 lanes are all too far are left
                    alive, q, w, over = alive[left], q[left], w[left], over[left]
                    count = [c[left] for c in count]
                    if not len(alive):
                        return out
        out[alive] = ~over
        return out


def _small(groups: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of buckets of up to 64 fingerprints, all at once: one word for each bucket.

    A point names its lowest neighbour and those neighbours that aren't that
    one's; the others it is linked to through it.
    """
    sizes = np.array([len(g) for g in groups])
    lanes = np.zeros((len(groups), 64), np.uint64)
    word = np.repeat(np.arange(len(groups)), sizes)
    lane = _runs(np.zeros(len(sizes), np.int64), sizes)
    points = np.concatenate(groups)
    lanes[word, lane] = points
    bit = ONE << lane.astype(np.uint64)
    valid = (ALL >> (np.uint64(64) - sizes.astype(np.uint64)))[word]
    near = Planes(lanes).near(points, word, radius, valid) & ~bit
    first = np.cumsum(sizes) - sizes
    low = near & (bit - ONE)
    mine = np.flatnonzero(low)
    lowest = low[mine] & (~low[mine] + ONE)
    at = first[word[mine]] + np.bitwise_count(lowest - ONE)
    a, b = [points[mine]], [points[at]]
    rest = low[mine] & ~lowest & ~near[at]
    while (more := np.flatnonzero(rest)).size:
        mine, rest = mine[more], rest[more]
        lowest = rest & (~rest + ONE)
        a.append(points[mine])
        b.append(points[first[word[mine]] + np.bitwise_count(lowest - ONE)])
        rest = rest ^ lowest
    return np.concatenate(a), np.concatenate(b)


def _large(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a bucket's links: breadth first, each point compared with those not reached yet."""
    planes = Planes(points)
    words = planes.planes.shape[1]
    todo = np.full(words, ALL, np.uint64)
    if len(points) % 64:
        todo[-1] = ALL >> np.uint64(64 - len(points) % 64)
    a, b = [], []
    for start in range(len(points)):
        if not todo[start // 64] >> np.uint64(start % 64) & ONE:
            continue
        todo[start // 64] &= ~(ONE << np.uint64(start % 64))
        front = [start]
        while front:
            i = front.pop()
            w = np.flatnonzero(todo)
            if not len(w):
                break
            near = planes.near(np.full(len(w), points[i]), w, radius, todo[w])
            todo[w] &= ~near
            hit = np.flatnonzero(near)
            lanes = np.flatnonzero(np.unpackbits(near[hit].view(np.uint8), bitorder="little"))
            found = w[hit[lanes // 64]] * 64 + lanes % 64
            front.extend(found.tolist())
            a.append(np.full(len(found), points[i]))
            b.append(points[found])
    return np.concatenate([*a, np.zeros(0, np.uint64)]), np.concatenate([*b, np.zeros(0, np.uint64)])


def _link(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links inside the buckets of a sorted partition; a bucket may span batches."""
    def links(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held: list[np.ndarray] = []
    last, waiting, n = None, [], 0

    def closed():
        nonlocal waiting, n
        points = np.concatenate(held) if len(held) > 1 else held[0]
        if len(points) > 64:
            yield links(*_large(points, radius))
        elif len(points) > 1:
            waiting.append(points)
            n += 1
            if n == 2048:
                yield links(*_small(waiting, radius))
                waiting, n = [], 0

    for batch in batches:
        mask, value, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "value", "fp"))
        if not len(fp):
            continue
        cut = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)]):
            key = (mask[a], value[a])
            if held and key != last:
                yield from closed()
                held = []
            last = key
            held.append(fp[a:b].astype(np.int64).view(np.uint64))
    if held:
        yield from closed()
    if waiting:
        yield links(*_small(waiting, radius))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _parts(bits: list[int], n: int) -> list[int]:
    """The bits in n parts of about equal size, as masks."""
    return [sum(1 << b for b in bits[i * len(bits) // n:(i + 1) * len(bits) // n]) for i in range(n)]


def bucket_masks(radius: int) -> list[int]:
    """The bits that buckets agree on: every pair of radius + 2 blocks."""
    return [a | b for a, b in combinations(_parts(list(range(64)), radius + 2), 2)]


def _split_masks(mask: int, radius: int) -> list[int]:
    """A crowded bucket's children: one of radius + 1 parts of the other bits agrees as well."""
    return [mask | p for p in _parts([b for b in range(64) if not mask >> b & 1], radius + 1)]


def links(unique: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b): fingerprint pairs within ``radius`` bits whose components are those of all such pairs.

    ``unique`` has distinct fingerprints ``fp``.  Buckets over ``bucket`` are
    split by one more part of agreeing bits until none is; no pair is lost, as
    the parts are one more than the bits that may differ.
    """
    spark = unique.sparkSession
    masks = bucket_masks(radius)
    rows = unique.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    ready = None
    while True:
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        crowded = staged(rows.groupBy("mask", "value").count().filter(F.col("count") > bucket).drop("count"), "crowded")
        if crowded.isEmpty():
            break
        calm = rows.join(crowded, ["mask", "value"], "left_anti")
        ready = calm if ready is None else ready.unionByName(calm)
        children = spark.createDataFrame([(_signed(m), [_signed(c) for c in _split_masks(m, radius)]) for m in masks],
                                         "mask bigint, children array<bigint>")
        rows = staged(rows.join(crowded, ["mask", "value"], "left_semi").join(children, "mask")
                      .select("fp", F.explode("children").alias("mask")).distinct(), "split-buckets")
        masks = [c for m in masks for c in _split_masks(m, radius)]
    rows = (rows if ready is None else ready.unionByName(rows)).select("mask", "value", "fp")
    buckets = rows.repartition("mask", "value").sortWithinPartitions("mask", "value")
    return buckets.mapInArrow(lambda it: _link(it, radius), "a bigint, b bigint").distinct()


def near_duplicates(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``prints`` (id, fp).

    ``component_id`` is the smallest id reachable over links, ``root`` the
    component's smallest fingerprint.  Equal fingerprints are one node, so
    copies cost one row whatever their number.  Null ids are not the smallest;
    a component of nulls alone has a null id.
    """
    unique = staged(prints.groupBy("fp").agg(F.min("id").alias("first")), "fingerprints")
    label = staged(components(staged(links(unique, radius, bucket), "links")), "labels")
    rooted = staged(unique.join(label, unique.fp == label.node, "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    return staged(rooted.join(ids, "root").select("fp", "root", "component_id"), "components")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
                       bucket: int = BUCKET) -> DataFrame:
    """Per row: ``id``, ``k1``, ``k2``, ``fp``, ``root`` and ``component_id``.

    Null or empty text, or one without words: fingerprint zero, linked like
    any other.  Repeated rows share all; an empty table gives no rows.  A text
    of any length is fingerprinted whole.  Other columns are not read.
    Whole texts are read once; only digests and fingerprints are shuffled.
    """
    prints = staged(fingerprints(df, id_col, text_col, shingle), "prints", wide=True)
    return prints.join(near_duplicates(prints, radius, bucket), "fp")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``df`` without near duplicates: one of each component, that with the smallest id.

    Of repeated rows one stays; so does one row, any, of a component that has
    only null ids.
    """
    found = simhash_components(df, id_col, text_col, shingle, radius).filter(F.col("id").eqNullSafe(F.col("component_id")))
    kept = staged(found.groupBy("root").agg(F.min_by(F.struct("k1", "k2"), F.struct("k1", "k2")).alias("k")).select("k.k1", "k.k2"), "kept")
    k1, k2 = digest(F.col(id_col), F.col(text_col))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    return (rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
            .select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns]))
