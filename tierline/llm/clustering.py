"""Clustering around centroids by equal-average equal-variance search, in whole numbers.

A squared distance is at least dim * (mean x - mean c)^2 + (dev x - dev c)^2, where dev is the
length of a vector's deviation from its own mean. So the centroids are sorted by mean, and
each vector scans outward from its own: the first centroid whose mean alone is too far ends
the scan on that side, one whose mean and deviation are too far is passed over, and only
the others are compared component by component. The bounds are floating point numbers
lowered by more than their error; every distance that counts is an exact integer.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import python_tasks
from tierline.session import stage

#: Components beyond this could make a squared distance, or a sum of them, leave 64 bits.
MOST_COMPONENT = 1 << 27

#: Part of the mean and deviation by which a bound is lowered against rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class Centroids:
    """Centroids by number, with what the search needs, sorted by mean."""

    vectors: np.ndarray
    order: np.ndarray
    sums: np.ndarray
    deviations: np.ndarray

    @classmethod
    def of(cls, vectors: list[list[int]]) -> "Centroids":
        rows = np.array(vectors, dtype=np.int64)
        sums = rows.sum(axis=1)
        order = np.lexsort((np.arange(len(rows)), sums))
        return cls(rows, order, sums[order], _deviations(rows)[order])

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row (ties: the smallest), and the squared
        distance to it."""
        n, dim = rows.shape
        k = len(self.order)
        sums, deviations = rows.sum(axis=1), _deviations(rows)
        best = np.full(n, k, dtype=np.int64)
        distance = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        active = np.arange(n)
        while len(active):
            # The nearer side by mean; a side that is used up is infinitely far.
            lo, hi, own = down[active], up[active], sums[active]
            below = np.where(lo >= 0, (own - self.sums[lo]).astype(np.float64), np.inf)
            above = np.where(hi < k, (self.sums[np.minimum(hi, k - 1)] - own).astype(np.float64), np.inf)
            take_low = below <= above
            gap = np.where(take_low, below, above)
            by_mean = gap * gap / dim * (1 - SLACK)
            # The other centroids of both sides are farther by mean: the scan is over.
            open_ = by_mean <= distance[active]
            active, take_low, by_mean = active[open_], take_low[open_], by_mean[open_]
            at = np.where(take_low, lo[open_], hi[open_])
            down[active[take_low]] -= 1
            up[active[~take_low]] += 1
            mine, theirs = deviations[active], self.deviations[at]
            apart = np.maximum(np.abs(mine - theirs) - SLACK * (mine + theirs), 0.0)
            close = by_mean + apart * apart * (1 - SLACK) <= distance[active]
            rest, number = active[close], self.order[at[close]]
            steps = rows[rest] - self.vectors[number]
            exact = np.einsum("ij,ij->i", steps, steps)
            better = (exact < distance[rest]) | ((exact == distance[rest]) & (number < best[rest]))
            distance[rest[better]] = exact[better]
            best[rest[better]] = number[better]
            active = active[(down[active] >= 0) | (up[active] < k)]
        return best, distance


def _deviations(rows: np.ndarray) -> np.ndarray:
    # Whole numbers up to the square root: no cancellation where components are alike.
    dim = rows.shape[1]
    apart = (dim * rows - rows.sum(axis=1, keepdims=True)).astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", apart, apart)) / dim


def whole_components(vector: Column, dim: int, scale: int) -> Column:
    """The vector's components x as floor(scale * x); null unless it has ``dim`` components,
    none null, NaN or infinite."""
    usable = (F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _mapped(df: DataFrame, centroids: list[list[int]], schema: str, made: Callable) -> DataFrame:
    shipped = df.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from made(Centroids.of(shipped.value), batches)

    return df.mapInArrow(run, schema)


def _summed(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of the vectors nearest to each centroid. Every task sends
    one row a centroid and component, so a centroid with most vectors costs no hot task;
    centroids times components is what reaches the driver."""
    dim = len(centroids[0])

    def sums(search: Centroids, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centroids), dim), dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            rows = _rows_of(batch.column("v"), dim)
            cluster, _ = search.nearest(rows)
            np.add.at(total, cluster, rows)
            count += np.bincount(cluster, minlength=len(centroids))
        used = np.flatnonzero(count)
        columns = [np.repeat(used, dim), np.tile(np.arange(dim), len(used)), total[used].ravel(), np.repeat(count[used], dim)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["cluster", "i", "total", "n"])

    parts = _mapped(vectors.select("v"), centroids, "cluster long, i long, total long, n long", sums)
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "i").agg(*exact).collect():
        out.setdefault(r["cluster"], (int(r["n"]), [0] * dim))[1][r["i"]] = int(r["total"])
    return out


def fit(vectors: DataFrame, start: list[list[int]], rounds: int) -> list[list[int]]:
    """The centroids after some rounds over ``vectors`` (column ``v``, whole components):
    each centroid becomes the floor of the mean of the vectors nearest to it, one that has
    none stays."""
    centroids = start
    for _ in range(rounds if start else 0):
        found = _summed(vectors, centroids)
        centroids = [[s // found[c][0] for s in found[c][1]] if c in found else old for c, old in enumerate(centroids)]
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``key``, ``cluster`` and squared ``distance`` of every vector (columns ``key``, ``v``)."""
    kind, dim = vectors.schema["key"].dataType.simpleString(), len(centroids[0])

    def nearest(search: Centroids, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = search.nearest(_rows_of(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(cluster), pa.array(distance)], names=["key", "cluster", "distance"])

    return _mapped(vectors.select("key", "v"), centroids, f"key {kind}, cluster long, distance long", nearest)


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """One row per usable vector: ``key``, ``cluster``, squared ``distance`` to its centroid,
    ``cluster_inertia`` and ``inertia`` (distances summed over the cluster and over all),
    and ``centroid_sha256`` of the centroid's components as decimals joined by commas.

    Vectors that are null, have not ``dim`` components, or have a null, NaN or infinite one
    are left out. Components become floor(scale * x). The centroids start as the ``k``
    vectors with the smallest SHA-256 of ``seed:key`` (a null key counts as empty text;
    equal keys are ordered by their components); with fewer vectors there are fewer. Ties of
    distance go to the smaller number. Repeated rows count as often as they are there; an
    empty table gives an empty one. A component beyond 2^27 after scaling fails the job:
    its distances need not fit 64 bits. Other columns are left out.
    """
    spark = df.sparkSession
    # The vectors of one batch and their differences stay within some 10 MB.
    python_tasks(spark, rows=10_000)
    whole = whole_components(df[vector], dim, scale)
    checked = F.when(F.forall("v", lambda x: F.abs(x) <= MOST_COMPONENT), F.col("v")).otherwise(
        F.raise_error(F.lit("a component is too large for exact 64-bit distances")).cast("array<bigint>")
    )
    vectors = stage(df.select(df[key].alias("key"), whole.alias("v")).where("v is not null").withColumn("v", checked), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    start = [r["v"] for r in vectors.orderBy(digest, "v").limit(k).select("v").collect()]
    centroids = fit(vectors, start, rounds)
    if not centroids:
        centroids = [[0] * dim]
    found = stage(assign(vectors, centroids), "assigned")
    # As many rows as there are centroids: that is the bound of this broadcast.
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    about = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    named = spark.createDataFrame(about, "cluster long, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(named), "cluster")
    return joined.select(F.col("key").alias(key), F.col("cluster").cast("int"), "distance", "cluster_inertia", "inertia", "centroid_sha256")
