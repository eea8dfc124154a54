"""Exact clustering around centroids. A lower bound on each vector's distance to all other centroids is carried from
round to round; planar geometry of each cluster's sphere says how much of a centroid's drift it must give up."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, lean, written

#: Components are held to this size, so that every squared distance is a long.
LARGEST = 1 << 27
#: Share by which bounds are kept on the safe side of rounding.
SAFE = 1e-9
STATE = "vec_id long, vector array<int>, cluster int, lower double, distance long, sums array<long>, n long, radius double, scanned long"


def loss(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """By how much a centroid that moves from old to new can come nearer to a point of the sphere at most: the largest
    |x - old| - |x - new| over the sphere, bounded in the plane of its centre, old and new.

    Points that gain s lie on a branch of the hyperbola with foci old and new, within its asymptotes' cone, whose apex
    is half-way: seen from there at an angle t from the direction of the move, s is drift * cos(t) at most, and the
    branch's vertex is s / 2 from there. The least angle to the sphere is its centre's less what its radius covers.
    Never more than the drift; 0 if the whole sphere lies behind the half-way plane."""
    move = new.astype(np.float64) - old
    drift = math.sqrt(move @ move)
    if not drift:
        return 0.0
    apart = centre - (old.astype(np.float64) + new) / 2
    along = float(apart @ move) / drift
    far = math.sqrt(apart @ apart)
    across = math.sqrt(max(far * far - along * along, 0.0))
    gain = min(drift, max(0.0, 2 * (along + radius)))
    if far > radius:
        nearest = max(0.0, math.atan2(across, along) - math.asin(radius / far))
        gain = min(gain, drift * max(0.0, math.cos(nearest)))
    return gain * (1 + SAFE) + SAFE


def losses(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, what its vectors' lower bounds lose: the most over all other centroids' moves."""
    k = len(old)
    return np.array([max((loss(old[i].astype(np.float64), radii[i], old[j], new[j]) for j in range(k) if j != i), default=0.0) for i in range(k)])


def assigned(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray | None, lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """cluster, squared distance, lower bound of each vector, and how many had to be scanned. A vector keeps its
    cluster if its centroid is nearer than the bound, or than half the way to the nearest other centroid; both are
    strict, so that no tie is hidden. All others are compared with all centroids, in whole numbers."""
    k = len(centroids)
    if cluster is None:
        cluster, lower, open_ = np.zeros(len(x), dtype=np.int64), np.zeros(len(x)), np.arange(len(x))
        distance = np.zeros(len(x), dtype=np.int64)
    else:
        cluster, lower = cluster.copy(), lower.copy()
        distance = np.square(x - centroids[cluster]).sum(1)
        between = np.sqrt(np.square(centroids[:, None] - centroids[None]).sum(2).astype(np.float64))
        between[np.diag_indices(k)] = np.inf
        sure = np.maximum(lower, between.min(1)[cluster] / 2 * (1 - SAFE))
        open_ = np.flatnonzero(np.sqrt(distance.astype(np.float64)) * (1 + SAFE) >= sure)
    if len(open_):
        every = np.stack([np.square(x[open_] - c).sum(1) for c in centroids], 1)
        best = every.argmin(1)
        cluster[open_], distance[open_] = best, every[np.arange(len(open_)), best]
        every = every.astype(np.float64)
        every[np.arange(len(open_)), best] = np.inf
        lower[open_] = np.sqrt(every.min(1)) * (1 - SAFE)
    return cluster, distance, lower, len(open_)


def _round(state: DataFrame, centroids: np.ndarray, lost: np.ndarray | None) -> DataFrame:
    """One assignment of all vectors, written: a row for each vector with its new state and, from each task, one for
    each cluster that it met, with the sum of its vectors, their number, the largest distance and how many vectors the
    task scanned. lost: None in the first round."""
    wide, k = centroids.shape[1], len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n, radius, scanned = np.zeros((k, wide), dtype=np.int64), np.zeros(k, dtype=np.int64), np.zeros(k), 0
        for batch in batches:
            size = len(batch)
            if not size:
                continue
            x = np.asarray(batch.column("vector").flatten()).reshape(size, wide).astype(np.int64)
            was = low = None
            if lost is not None:
                was = np.asarray(batch.column("cluster")).astype(np.int64)
                low = np.asarray(batch.column("lower")) - lost[was]
            cluster, distance, low, some = assigned(x, centroids, was, low)
            scanned += some
            for c in np.unique(cluster):
                own = cluster == c
                sums[c] += x[own].sum(0)
                n[c] += own.sum()
                radius[c] = max(radius[c], math.sqrt(int(distance[own].max())) * (1 + SAFE))
            none = pa.nulls(size)
            vector = pa.ListArray.from_arrays(np.arange(0, size * wide + 1, wide, dtype=np.int32), pa.array(x.ravel().astype(np.int32)))
            columns = [batch.column("vec_id"), vector, pa.array(cluster, pa.int32()), pa.array(low), pa.array(distance), none.cast(pa.list_(pa.int64())), none.cast(pa.int64()), none.cast(pa.float64()), none.cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
        met = np.flatnonzero(n)
        none = pa.nulls(len(met))
        task = [scanned if c == met[0] else 0 for c in met]
        columns = [none.cast(pa.int64()), none.cast(pa.list_(pa.int32())), pa.array(met, pa.int32()), none.cast(pa.float64()), none.cast(pa.int64()), pa.array(sums[met].tolist(), pa.list_(pa.int64())), pa.array(n[met]), pa.array(radius[met]), pa.array(task, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)

    names = [c.split(" ")[0] for c in STATE.split(", ")]
    return written(state.mapInArrow(lean(run), STATE), "assigned")


def _summed(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """New centroids, each cluster's radius about its old one, and how many vectors were scanned. A row a cluster and
    component reaches the driver."""
    of = state.where("n is not null").select("cluster", "n", "radius", "scanned", F.posexplode("sums").alias("dim", "x"))
    rows = of.groupBy("cluster", "dim").agg(F.sum("x").alias("x"), F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("scanned").alias("scanned")).collect()
    new, radii = centroids.copy(), np.zeros(len(centroids))
    for r in rows:
        new[r.cluster, r.dim] = r.x // r.n
        radii[r.cluster] = r.radius
    return new, radii, sum(r.scanned for r in rows if r.dim == 0)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", scans: list[int] | None = None) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance (squared) of each vector kept; the final centroids). Kept are vectors of exactly
    `dims` components, none null or non-finite; a component x becomes floor(scale * x), held to +-2**27. Centroids
    start as the k kept vectors whose sha256 of "seed:id" is least; each round assigns all vectors (ties: smaller
    number) and moves each centroid to its vectors' mean, rounded down; empty clusters stay. Then all are assigned once
    more. scans, if given, gets the number of vectors that each assignment had to scan.

    Each round reads and writes the kept vectors with their bounds once, in place: nothing is shuffled but k rows a
    task. Equal vectors tie, so the smaller number gets all of them. Fewer than k kept vectors: as many centroids.
    None: no rows. Repeated rows each get their row, and may be several of the first centroids; a null id counts as
    the empty text after "seed:"; other columns are ignored."""
    spark, x = vectors.sparkSession, vectors[vector_col]
    whole = (F.size(x) == dims) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    fixed = F.transform("vector_", lambda v: F.greatest(F.least(F.floor(v.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    kept = vectors.where(x.isNotNull() & whole).select(vectors[id_col].cast("long").alias("vec_id"), x.alias("vector_")).select("vec_id", fixed.alias("vector"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(order.alias("hash_"), "vector").orderBy("hash_", "vector").limit(k).collect()  # k rows
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), dtype=np.int64)
    centroids = np.array([r.vector for r in first], dtype=np.int64)
    state, lost = kept, None
    for at in range(rounds + 1):
        before, state = state, _round(state if at == 0 else state.where("n is null"), centroids, lost)
        if at:
            dropped(before)
        if at < rounds or scans is not None:
            new, radii, scanned = _summed(state, centroids)
            if scans is not None:
                scans.append(scanned)
            if at < rounds:
                lost = losses(centroids, new, radii)
                centroids = new
    return state.where("n is null").select("vec_id", "cluster", "distance"), centroids
