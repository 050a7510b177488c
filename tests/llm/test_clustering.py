import hashlib
import math
import random

import numpy as np
import pytest

from tierline.llm.clustering import Centroids, cluster

SCHEMA = "vec_id long, embedding array<float>"


def _brute(rows, k, rounds, dim, scale):
    """Every vector against every centroid, in whole numbers."""
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dim and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(scale * float(np.float32(x))) for x in vector]))
    def digest(key):
        return hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()

    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    found = [(key, *nearest(v)[::-1]) for key, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(key, c, d, inertia[c], sum(inertia.values()), digests[c]) for key, c, d in found]


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize(("seed", "k", "dim"), [(1, 5, 4), (2, 16, 8), (3, 3, 1)])
def test_equals_brute_force(spark, seed, k, dim):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0, rng.gauss(0, 1)]) for _ in range(dim)]) for i in range(300)]
    # A third of the rows are one vector; some are repeated rows.
    rows += [(1000 + i, [0.25] * dim) for i in range(150)] + rows[:20]
    rows += [(None, [1.0] * dim), (2001, None), (2002, [1.0] * (dim + 1)), (2003, []), (2004, [None] * dim), (2005, [float("nan")] * dim), (2006, [float("-inf")] * dim)]
    got = cluster(spark.createDataFrame(rows, SCHEMA).repartition(7), k=k, dim=dim)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert _order(map(tuple, got.collect())) == _order(_brute(rows, k, 3, dim, 64))


@pytest.mark.parametrize("spread", [1, 3, 1000, 1 << 26])
def test_search_finds_the_first_nearest(spread):
    rng = np.random.default_rng(spread)
    centroids = rng.integers(-spread, spread + 1, (40, 6))
    # Equal means, equal centroids, centroids mirrored around a vector.
    centroids[10:20] = centroids[0:10]
    centroids[20:25] = centroids[0:5, ::-1]
    rows = np.concatenate([rng.integers(-spread, spread + 1, (500, 6)), centroids, np.zeros((3, 6), dtype=np.int64)])
    best, distance = Centroids.of(centroids.tolist()).nearest(rows)
    exact = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in centroids] for x in rows])
    assert (distance == exact.min(axis=1)).all()
    assert (best == exact.argmin(axis=1)).all()


def test_the_search_passes_centroids_over():
    """Most centroids are far by mean or deviation, and are not compared."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-50, 50, (200, 16)) + np.arange(200)[:, None] * 40

    class Counted(np.ndarray):
        seen = 0

        def __getitem__(self, at):
            out = super().__getitem__(at)
            Counted.seen += len(out)
            return out.view(np.ndarray)

    search = Centroids.of(centroids.tolist())
    search = Centroids(search.vectors.view(Counted), search.order, search.sums, search.deviations)
    search.nearest(centroids[::2] + 1)
    assert Counted.seen < 100 * 10


def test_empty_small_and_clashing(spark):
    assert cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    assert cluster(spark.createDataFrame([(1, [1.0])], SCHEMA)).count() == 0
    rows = [(1, [1.0, 2.0], 9, "x"), (1, [1.0, 2.0], 9, "x"), (2, [1.0, 2.5], None, None)]
    got = cluster(spark.createDataFrame(rows, SCHEMA + ", cluster int, v string"), dim=2).collect()
    assert sorted((r["vec_id"], r["distance"]) for r in got) == [(1, 0), (1, 0), (2, 0)]
    assert len({r["centroid_sha256"] for r in got}) == 2
    with pytest.raises(Exception, match="too large"):
        cluster(spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA), dim=2).count()
