"""Lexical retrieval packing: windows of related documents, found in a sharded BM25 index.

A document's ids are cut into windows; what fills a window is a sequence of
its own, and the rest, shorter than a window, is a unit to be packed.  Every
unit belongs to one shard of the index: that of its topic, the nearest of at
most ``TOPICS`` centroids of hashed BM25 weights, and inside a topic that is
larger than a shard, of the smallest hash among its heaviest ids, so that
units with the same rare ids meet.  In a shard a seed, the next unused unit,
takes its unused neighbours, best first by BM25 over their whole documents,
until its window is full; the last is cut, and its remainder stays unused.

A shard has about ``shard_units`` units, and a seed sees its own shard only:
``shard_units`` of all units or more makes one shard, which is exact.
"""

from __future__ import annotations

import base64
import functools
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import staged
from ledgerlane.llm.words import mix, slices

END = 0                # the id that ends a document
SHARD_UNITS = 1024     # units of a shard, about; one task packs it
OVERSIZE = 2           # a topic is cut only where it has so many times a shard's units
TOPICS = 256           # centroids at most: the model that tasks get doesn't grow with the table
DIMS = 256             # hashed dimensions of a unit's BM25 weights
SAMPLE = 16_384        # units that the centroids are fitted on, at most; every unit is indexed
HEAVIEST = 12          # ids of a unit, by weight, among which the smallest hash decides inside a topic
K1, B = 1.2, 0.75
BATCH_IDS = 1 << 18    # ids whose weights are computed at once, or one document's


@functools.lru_cache(maxsize=2)
def tokenizer(json_name: str):
    """(encode one text, vocabulary size) of a byte-level BPE named by its JSON file.

    The ranks file of the same vocabulary gives the same ids four times as
    fast (the tests compare them); the JSON file's own library takes over
    where there is none.
    """
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(P.path(json_name))
    slow.encode_special_tokens = True
    by_slow = lambda text: slow.encode(text, add_special_tokens=False).ids
    try:
        with open(P.path(json_name.replace(".json", ".tiktoken")), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    except FileNotFoundError:
        return by_slow, slow.get_vocab_size()
    fast = tiktoken.Encoding(json_name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return fast, slow.get_vocab_size()


TOKENS = "doc_tokens bigint, ids binary, unit bigint, stats array<bigint>"


def _tokenize(batches: Iterator[pa.RecordBatch], json_name: str) -> Iterator[pa.RecordBatch]:
    """Each text's ids and the end id, as little-endian 32-bit numbers; then the task's share of the index's statistics."""
    encode, vocabulary = tokenizer(json_name)
    part = TaskContext.get().partitionId() << 40
    df, units, tokens = np.zeros(vocabulary, np.int64), 0, 0
    id_type = None

    def out(ids, n, data, unit, stats):
        return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(data, pa.binary()), pa.array(unit, pa.int64()), pa.array(stats, pa.list_(pa.int64()))],
                                          names=["id", "doc_tokens", "ids", "unit", "stats"])

    for batch in batches:
        id_type = batch.schema.field("id").type
        for piece in slices(batch, "text"):
            n, data, unit = [], [], []
            for text in piece.column("text").to_pylist():
                ids = array("I", encode(text or ""))
                ids.append(END)
                data.append(np.frombuffer(ids, np.uint32).astype("<u4", copy=False).tobytes())
                n.append(len(data[-1]) // 4)
                unit.append(part | units)
                units, tokens = units + 1, tokens + n[-1]
            for a, b in _cuts(np.array(n)):
                df += np.bincount(_counted(data[a:b], vocabulary)[0], minlength=vocabulary)
            yield out(piece.column("id"), n, data, unit, [None] * len(n))
    if id_type is not None:
        yield out(pa.nulls(1, id_type), [None], [None], [None], [[units, tokens, *df.tolist()]])


def _mixed(x: np.ndarray) -> np.ndarray:
    return mix(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _cuts(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of documents of about ``BATCH_IDS`` ids."""
    if not len(sizes):
        return []
    at = np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_IDS)) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(sizes)]))


def _counted(docs: list[bytes], vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, counts, bounds, sizes): each document's distinct ids, ascending, and how often it has them."""
    size = np.array([len(x) // 4 for x in docs])
    pairs = np.repeat(np.arange(len(docs)) * vocabulary, size) + np.frombuffer(b"".join(docs), "<u4")
    pairs.sort()
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    first = np.flatnonzero(new)
    doc, term = np.divmod(pairs[first], vocabulary)
    return term, np.diff(np.append(first, len(pairs))), np.searchsorted(doc, np.arange(len(docs) + 1)), size


def _bm25(term: np.ndarray, tf: np.ndarray, size: np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    return idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))


@functools.lru_cache(maxsize=2)
def _hashes(vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, dimension, sign) of every id."""
    h = _mixed(np.arange(vocabulary))
    return h, (h % np.uint64(DIMS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def hashed(term: np.ndarray, weight: np.ndarray, bounds: np.ndarray, vocabulary: int) -> np.ndarray:
    """Each document's weights in ``DIMS`` hashed dimensions with hashed signs, of length one."""
    _, dim, sign = _hashes(vocabulary)
    n = len(bounds) - 1
    v = np.bincount(np.repeat(np.arange(n) * DIMS, np.diff(bounds)) + dim[term], sign[term] * weight, n * DIMS).reshape(n, DIMS)
    return v / np.array([max(np.sqrt(x @ x), 1e-12) for x in v])[:, None]


def centroids(points: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """k directions by spherical k-means, from points drawn far from those drawn before."""
    rng = np.random.default_rng(0)
    c = np.empty((k, points.shape[1]))
    c[0] = points[0]
    far = 1 - points @ c[0]
    for i in range(1, k):
        chance = np.maximum(far, 0) ** 2
        drawn = rng.choice(len(points), 8, p=chance / chance.sum()) if chance.sum() > 1e-9 else [i % len(points)]
        c[i] = max((points[j] for j in drawn), key=lambda p: np.maximum(far - (1 - points @ p), 0).sum())  # the draw that covers most
        far = np.minimum(far, 1 - points @ c[i])
    for _ in range(rounds):
        near = (points @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, points)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def _vectors(batches: Iterator[pa.RecordBatch], idf: np.ndarray, mean: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs = b.column("ids").to_pylist()
        for at, to in _cuts(np.array([len(x) // 4 for x in docs])):
            term, tf, bounds, size = _counted(docs[at:to], len(idf))
            rows = hashed(term, _bm25(term, tf, np.repeat(size, np.diff(bounds)), idf, mean), bounds, len(idf)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.list_(pa.float32()))], names=["v"])


ROUTED = "doc_tokens bigint, tail binary, terms binary, tf binary, unit bigint, topic int, mark bigint"


def _route(batches: Iterator[pa.RecordBatch], idf: np.ndarray, mean: float, topics: np.ndarray, window: int, width: str) -> Iterator[pa.RecordBatch]:
    """Each unit with its topic and the mark that decides its shard inside the topic."""
    marks = _hashes(len(idf))[0]
    for b in batches:
        if not b.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(b.column("ids")).to_numpy()) // 4
        for at, to in _cuts(sizes):
            part = b.slice(at, to - at)
            docs = part.column("ids").to_pylist()
            tails, terms, tfs, mark = [], [], [], []
            term, tf, bounds, size = _counted(docs, len(idf))
            weight = _bm25(term, tf, np.repeat(size, np.diff(bounds)), idf, mean)
            topic = (hashed(term, weight, bounds, len(idf)) @ topics.T).argmax(1).astype(np.int32)
            short, often = term.astype(width), tf.astype("<u4")
            for x, i, j in zip(docs, bounds[:-1].tolist(), bounds[1:].tolist()):
                tails.append(np.frombuffer(x, "<u4")[len(x) // 4 // window * window:].astype(width).tobytes())
                terms.append(short[i:j].tobytes())
                tfs.append(often[i:j].tobytes())
                heavy = term[i:j][np.argpartition(-weight[i:j], HEAVIEST)[:HEAVIEST]] if j - i > HEAVIEST else term[i:j]
                mark.append(int(marks[heavy].min() >> np.uint64(1)))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("doc_tokens"), pa.array(tails, pa.binary()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary()),
                                              part.column("unit"), pa.array(topic), pa.array(mark, pa.int64())],
                                             names=["id", "doc_tokens", "tail", "terms", "tf", "unit", "topic", "mark"])


def _width(vocabulary: int) -> str:
    return "<u4" if vocabulary > 65536 else "<u2"


class Shard:
    """The inverted index of a shard: for each id the units that have it and their BM25 weights."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean: float):
        self._index(*_counted([u.astype("<u4").tobytes() for u in units], len(idf)), idf, mean)

    @classmethod
    def of_counts(cls, terms: list[np.ndarray], tf: list[np.ndarray], idf: np.ndarray, mean: float) -> Shard:
        """The index of documents given by their distinct ids, ascending, and counts."""
        out = cls.__new__(cls)
        bounds = np.cumsum([0, *map(len, terms)])
        out._index(np.concatenate(terms), np.concatenate(tf).astype(np.int64), bounds, np.array([int(x.sum()) for x in tf]), idf, mean)
        return out

    def _index(self, term: np.ndarray, tf: np.ndarray, bounds: np.ndarray, size: np.ndarray, idf: np.ndarray, mean: float) -> None:
        self.n = len(size)
        self.terms, self.mine = term, bounds  # each unit's own terms
        unit = np.repeat(np.arange(self.n), np.diff(bounds))
        order = np.argsort(term, kind="stable")
        self.unit = unit[order]
        self.weight = _bm25(term, tf, size[unit], idf, mean)[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(idf)))])
        self.count = self.n

    def keep(self, unused: np.ndarray) -> None:
        """Drop the postings of used units where they are half of them or more: their scores are not asked for again."""
        left = np.count_nonzero(unused)
        if 2 * left <= self.count:
            kept = unused[self.unit] > 0
            self.first = np.concatenate([[0], np.cumsum(kept)])[self.first]
            self.unit, self.weight, self.count = self.unit[kept], self.weight[kept], left

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every unit (but those dropped) for the seed's terms."""
        q = self.terms[self.mine[seed]:self.mine[seed + 1]]
        spans = [slice(a, b) for a, b in zip(self.first[q].tolist(), self.first[q.astype(np.int64) + 1].tolist()) if a < b]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.unit[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)


def fill_windows(units: list[np.ndarray], window: int, idf: np.ndarray, mean: float,
                 index: Shard | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (unit, start, length): a seed, then its unused neighbours, best first; with none left, the next unused.

    All windows but the last are full.  ``index`` is that of the units' whole documents.
    """
    index = index or Shard(units, idf, mean)
    at = [0] * len(units)  # ids of each unit that are packed already
    unused = np.ones(len(units))
    seed = 0
    while True:
        while seed < len(units) and not unused[seed]:
            seed += 1
        if seed == len(units):
            return
        out, free, scores, nearest, filler = [], window, None, seed, seed
        while True:
            take = min(free, len(units[nearest]) - at[nearest])
            out.append((nearest, at[nearest], take))
            at[nearest] += take
            free -= take
            if at[nearest] == len(units[nearest]):
                unused[nearest] = 0
            if not free:
                break
            if scores is None:
                index.keep(unused)
                scores = index.scores(seed)
            scores *= unused
            nearest = int(scores.argmax())
            if scores[nearest] <= 0:
                while filler < len(units) and not unused[filler]:
                    filler += 1
                if filler == len(units):
                    break
                nearest = filler
        yield out


PIECE = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
NUMBERS = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _pack(table: pa.Table, window: int, width: str, idf: np.ndarray, mean: float, id_type: pa.DataType) -> pa.Table:
    """The pieces of a shard's windows."""
    table = table.sort_by("unit")
    units = [np.frombuffer(t, width) for t in table.column("tail").to_pylist()]
    index = Shard.of_counts([np.frombuffer(t, width) for t in table.column("terms").to_pylist()], [np.frombuffer(n, "<u4") for n in table.column("tf").to_pylist()], idf, mean)
    before = table.column("doc_tokens").to_numpy() - np.array([len(u) for u in units])
    which, start, length, data, sequence, offset = [], [], [], [], [], []
    shard = table.column("shard")[0].as_py()
    for s, pieces in enumerate(fill_windows(units, window, idf, mean, index)):
        o = 0
        for u, a, n in pieces:
            which.append(u)
            start.append(int(before[u]) + a)
            length.append(n)
            data.append(units[u][a:a + n].astype("<u4").tobytes())
            sequence.append((shard << 20 | s) << 1 | 1)
            offset.append(o)
            o += n
    pick = table.take(pa.array(which, pa.int64()))
    return pa.table([pick.column("id").cast(id_type), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.binary()),
                     pick.column("doc_tokens"), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=PIECE)


def routed_units(docs: DataFrame, n: int, idf: np.ndarray, mean: float, window: int, shard_units: int) -> DataFrame:
    """(id, doc_tokens, tail, terms, tf, unit, shard): the units and their shards; ``n``: how many documents there are."""
    spark = docs.sparkSession
    width = _width(len(idf))
    k = max(1, min(TOPICS, -(-n // shard_units)))
    shared = spark.sparkContext.broadcast(idf)  # one number for each id of the vocabulary
    share = min(1.0, min(SAMPLE, 64 * k) / n)  # of the documents, by a hash: about so many rows, found in one scan
    sample = docs.filter(F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) if k > 1 else 1 << 30))
    sample = (sample if k > 1 else sample.limit(1)).select("ids")
    points = sample.mapInArrow(lambda it: _vectors(it, shared.value, mean), "v array<float>").toArrow()  # at most SAMPLE rows of DIMS numbers
    points = np.array(points.column("v").to_pylist(), np.float64)
    topics = centroids(points, min(k, len(points))) if len(points) else np.zeros((1, DIMS))
    units = docs.filter(F.col("doc_tokens") % window > 0)
    id_type = docs.schema["id"].dataType.simpleString()
    routed = staged(units.select("id", "doc_tokens", "ids", "unit").mapInArrow(lambda it: _route(it, shared.value, mean, topics, window, width), f"id {id_type}, {ROUTED}"), "routed", wide=True)
    # Inside a topic shards by mark; where one mark has more units than a shard, by unit.
    sizes = {r["topic"]: r["count"] for r in routed.groupBy("topic").count().collect()}  # TOPICS rows at most
    parts = F.element_at(F.array(*[F.lit(max(1, math.ceil(sizes.get(t, 0) / (OVERSIZE * shard_units)))) for t in range(len(topics))]), F.col("topic") + 1)
    placed = routed.withColumn("part", F.pmod("mark", parts).cast("bigint"))
    full = staged(placed.groupBy("topic", "part").count().select("topic", "part", F.greatest(F.lit(1), F.ceil(F.col("count") / (OVERSIZE * shard_units))).cast("bigint").alias("cuts")), "shard-sizes")
    cut = F.pmod(F.xxhash64("unit"), F.col("cuts"))
    shard = F.col("topic").cast("bigint") * (1 << 34) + F.col("part") * (1 << 14) + cut  # 2^20 shards of a topic by mark, 2^14 of a mark
    return placed.join(full, ["topic", "part"]).select("id", "doc_tokens", "tail", "terms", "tf", "unit", shard.alias("shard"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, json_name: str = "byte_bpe_50k.json",
         shard_units: int = SHARD_UNITS) -> DataFrame:
    """Pieces: ``id``, ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``.

    Every row's ids and the end id lie in exactly one piece each.  One method
    at every size: units are dealt to shards, each packed by one task; only a
    shard's last window may have padding.  The index's statistics (documents,
    mean length, documents that have an id) cover all documents; the driver
    gets one number for each id of the vocabulary, the centroids' sample and
    the sizes of the topics.  The sample only places the centroids: every unit
    is indexed.  A topic, or copies that all have the same heaviest ids, of any size
    are many shards.

    Null or empty text: the end id alone.  A text of any length is one value
    in one task, whose query is all its ids.  Ties in score: the unit that
    comes first.  Repeated rows are packed each on its own; an empty table
    gives no pieces.  Other columns are not read.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    done = staged(src.mapInArrow(lambda it: _tokenize(it, json_name), f"id {id_type}, {TOKENS}"), "tokens", wide=True)
    stats = dict(done.select(F.posexplode("stats").alias("at", "n")).groupBy("at").agg(F.sum("n")).collect())
    docs = done.filter("unit is not null")
    size = 4 * window
    whole = docs.filter(F.col("doc_tokens") >= window)
    full = (whole.select("id", "doc_tokens", "ids", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("doc_tokens") / window) - 1)).alias("w"))
            .select("id", (F.col("w") * window).alias("start"), F.lit(window).cast("long").alias("length"),
                    F.expr(f"substring(ids, CAST(w * {size} + 1 AS INT), {size})").alias("ids"), "doc_tokens",
                    F.shiftleft(F.monotonically_increasing_id(), 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    n = int(stats.get(0, 0))
    if not n:
        return full
    mean = stats[1] / n
    df_of = np.array([stats.get(i + 2, 0) for i in range(len(stats) - 2)], float)
    idf = np.log(1 + (n - df_of + 0.5) / (df_of + 0.5))
    width = _width(len(idf))
    dealt = routed_units(docs, n, idf, mean, window, shard_units)
    shared = spark.sparkContext.broadcast(idf)
    arrow_id = pa.schema(spark.createDataFrame([], f"id {id_type}").toArrow().schema).field("id").type
    return full.unionByName(dealt.groupBy("shard").applyInArrow(lambda t: _pack(t, window, width, shared.value, mean, arrow_id), f"id {id_type}, {NUMBERS}"))
