"""Centroid clustering on integer vectors, by equal-average equal-variance search.

Centroids are sorted by their component sum.  A vector scans outward from its
own sum: with S the component sums, V the lengths of what is left after the
mean is taken away and d the number of components,

    distance >= (S_x - S_c)^2 / d + (V_x - V_c)^2,

so once the first term alone is over the best distance found, no centroid
further out can win and the scan ends; a centroid whose both terms are over it
is left out.  The bounds are floating-point numbers taken a little too small;
what decides is the exact integer distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import staged

SAFE = 1 - 1e-9   # bounds are multiplied by it, far more than what rounding can add
ROWS = 1 << 14    # vectors searched at once


def component_limit(dim: int) -> int:
    """Components up to it, in either sign, have squared distances below 2^63."""
    return isqrt(((1 << 63) - 1) // (4 * dim))


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: int = 256) -> DataFrame:
    """(id, vec): the vectors of ``dim`` finite components as integers floor(scale * x); all others are left out.

    A component whose integer is beyond ``component_limit`` ends the job with
    an error that names it: its distances don't fit 64 bits.
    """
    v = F.col(f"`{vec_col}`")
    fit = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))  # NaN is over every number
    limit = component_limit(dim)
    return (df.filter((F.size(v) == dim) & fit)
            .select(F.col(f"`{id_col}`").alias("id"), F.transform(v, lambda x: _whole(x, scale, limit)).alias("vec")))


def _whole(x, scale: int, limit: int):
    y = F.lit(float(scale)) * x.cast("double")
    error = F.raise_error(F.concat(F.lit("component too large for 64-bit distances: "), x.cast("string"))).cast("bigint")
    return F.when(F.abs(y) < float(limit), F.floor(y)).otherwise(error)


class Search:
    """Nearest of the centroids (a row each) for many vectors at once; the smaller number wins a tie."""

    def __init__(self, centroids: np.ndarray):
        self.dim = centroids.shape[1]
        total = centroids.sum(1)
        self.order = np.argsort(total, kind="stable")
        self.points, self.total = centroids[self.order], total[self.order]
        self.spread = self._spread(self.points, self.total)

    def _spread(self, x: np.ndarray, total: np.ndarray) -> np.ndarray:
        rest = x - (total / self.dim)[:, None]
        return np.sqrt((rest * rest).sum(1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) per row of ``x`` and how many distances were computed."""
        n, k = len(x), len(self.points)
        total = x.sum(1)
        spread = self._spread(x, total)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, k)
        right = np.searchsorted(self.total, total)
        left = right - 1
        alive, work = np.arange(n), 0
        while len(alive):
            # The next centroid outward: the nearer in sum of the one to the left and the one to the right.
            lo, hi, s = left[alive], right[alive], total[alive]
            gap_lo = np.where(lo >= 0, np.abs(s - self.total[np.maximum(lo, 0)]), np.iinfo(np.int64).max)
            gap_hi = np.where(hi < k, np.abs(self.total[np.minimum(hi, k - 1)] - s), np.iinfo(np.int64).max)
            go_left = gap_lo <= gap_hi
            gap = np.where(go_left, gap_lo, gap_hi)
            c = np.where(go_left, lo, hi)
            mean_bound = gap.astype(float) ** 2 / self.dim * SAFE
            more = (gap < np.iinfo(np.int64).max) & (mean_bound <= best[alive])
            alive, c, go_left, mean_bound = alive[more], c[more], go_left[more], mean_bound[more]
            if not len(alive):
                break
            left[alive[go_left]] -= 1
            right[alive[~go_left]] += 1
            apart = np.abs(spread[alive] - self.spread[c]) - 1e-9 * (spread[alive] + self.spread[c])
            near = mean_bound + np.maximum(apart, 0) ** 2 * SAFE <= best[alive]
            row, c = alive[near], c[near]
            step = x[row] - self.points[c]
            d = np.einsum("ij,ij->i", step, step)
            work += len(row)
            number = self.order[c]
            better = (d < best[row]) | ((d == best[row]) & (number < found[row]))
            best[row[better]], found[row[better]] = d[better], number[better]
        return found, best, work


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per task and centroid: the number and the componentwise sum of its vectors."""
    k, dim = centroids.shape
    search = Search(centroids)
    count, total = np.zeros(k, np.int64), np.zeros((k, dim), object)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            x = _matrix(batch.column("vec").slice(at, ROWS), dim)
            near = search.nearest(x)[0]
            order = np.argsort(near, kind="stable")
            kinds, first = np.unique(near[order], return_index=True)
            total[kinds] += np.add.reduceat(x[order], first, axis=0)
            count += np.bincount(near, minlength=k)
    some = np.flatnonzero(count)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, dim)), pa.array(np.tile(np.arange(dim), len(some))),
                                          pa.array(np.repeat(count[some], dim)), pa.array([str(s) for s in total[some].ravel()])],
                                         names=["cluster", "j", "n", "total"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    search = Search(centroids)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            near, d, _ = search.nearest(_matrix(part.column("vec"), centroids.shape[1]))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.astype(np.int32)), pa.array(d)], names=[*part.schema.names, "cluster", "distance"])


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, k: int = 40, rounds: int = 5,
                    scale: int = 256, salt: str = "2:") -> DataFrame:
    """Per kept vector: ``id``, ``vec`` (its integers), ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid``.

    Centroids start as the ``k`` kept vectors with the smallest hex SHA-256 of
    ``salt`` and the id.  Each round assigns every vector to its nearest
    centroid and moves every non-empty centroid to the componentwise floor of
    its vectors' mean; then all are assigned once more.

    The integers are written once and read in every pass.  A task adds up its
    own vectors, so what is shuffled is a row per task, centroid and
    component, whatever the size of a cluster; the driver sees k * dim
    numbers a round.  Sums are exact (decimals of 38 digits).

    Null, shorter, longer, NaN or infinite vectors are left out; a null id
    counts as an empty text in the hash.  Ties: the smaller centroid number;
    equal hashes by the vector.  Repeated rows are each kept, and may start
    several centroids.  Fewer than ``k`` vectors start fewer centroids; an
    empty table gives no rows.  Other columns are not read.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, vec array<bigint>"
    vectors = staged(integer_vectors(df, id_col, vec_col, dim, scale), "vectors")
    rank = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = vectors.select("vec", rank.alias("h")).orderBy("h", "vec").limit(k).select("vec").collect()  # k * dim numbers
    if not start:
        return spark.createDataFrame([], f"{schema}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    centroids = np.array([r["vec"] for r in start], np.int64)
    for _ in range(rounds):
        sums = (vectors.select("vec").mapInArrow(lambda it, c=centroids: _sums(it, c), "cluster bigint, j bigint, n bigint, total string")
                .groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        moved = centroids.copy()
        for r in sums.collect():  # k * dim rows
            moved[r["cluster"], r["j"]] = int(r["total"]) // r["n"]
        centroids = moved
    out = staged(vectors.mapInArrow(lambda it: _assigned(it, centroids), f"{schema}, cluster int, distance bigint"), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    every = sum(inertia.values())
    found = spark.createDataFrame([(c, s, every, centroids[c].tolist()) for c, s in sorted(inertia.items())],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return out.join(F.broadcast(found), "cluster")  # k rows at most
