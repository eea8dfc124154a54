"""Approximate nearest neighbours by an adaptive dimension scan of probed lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLOCK = 16
#: Of the hypothesis test: larger keeps more candidates.
EPSILON = 2.1
#: Candidates and queries of one cell at most, on average.
CELL_VECTORS, CELL_QUERIES = 20_000, 2_000
SEEDS, STEP, QUERIES_AT_ONCE, PAIRS_AT_ONCE = 128, 4096, 256, 1 << 16


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten(), dtype=np.float64)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 0)


class Index:
    """Rotation and list centres, fitted on a bounded sample. A vector x gets one more component that makes all norms
    equal (queries get 0), so that the largest inner product is the least distance."""

    def __init__(self, sample: np.ndarray, lists: int, largest: float, rounds: int = 8, seed: int = 5) -> None:
        d = sample.shape[1] + 1
        rng = np.random.default_rng(seed)
        self.largest = largest
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0].astype(np.float32)
        points = self.rotated(sample)
        centres = points[np.sort(rng.choice(len(points), min(lists, len(points)), replace=False))]
        for _ in range(rounds):
            of = self.nearest(points, centres, 1)[:, 0]
            counts = np.bincount(of, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, of, points)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres).astype(np.float32)
        self.centres = centres

    def rotated(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        rest = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(0, self.largest - (vectors**2).sum(1)))
        return np.column_stack([vectors, rest]).astype(np.float32) @ self.rotation

    def probes(self, sample: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
        """How many lists must be probed for that share of the k nearest in the sample, over some of its points."""
        points, asked = self.rotated(sample), self.rotated(sample[:: max(1, len(sample) // queries)][:queries], True)
        of, order = self.nearest(points, self.centres, 1)[:, 0], np.argsort((self.centres**2).sum(1) - 2 * asked @ self.centres.T, axis=1)
        places = np.argsort(order, axis=1)
        near = np.argsort((points**2).sum(1) - 2 * asked @ points.T, axis=1, kind="stable")[:, 1 : k + 1]
        needed = np.sort(np.take_along_axis(places, of[near], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(len(needed) * recall))]) + 1 if len(needed) else len(self.centres)

    @staticmethod
    def nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
        out, sizes = [], (centres**2).sum(1)
        for a in range(0, len(points), 4096):
            apart = sizes - 2 * (points[a : a + 4096] @ centres.T)
            near = np.argpartition(apart, n - 1, axis=1)[:, :n] if n < len(centres) else np.tile(np.arange(len(centres)), (len(apart), 1))
            out.append(near)
        return np.concatenate(out) if out else np.empty((0, n), dtype=np.int64)


def scan_list(vectors: np.ndarray, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """For each (rotated) query, the candidates that may be among its k nearest. Components are read in blocks of
    columns; after each, a candidate whose partial distance, scaled to all components, is beyond what the k-th best so
    far makes likely is abandoned. Random rotation makes the scaled distance concentrate about the whole one."""
    n, d = vectors.shape
    columns = [np.ascontiguousarray(vectors[:, a : a + BLOCK]) for a in range(0, d, BLOCK)]
    seen = [min(d, a + BLOCK) for a in range(0, d, BLOCK)]
    factor = [(t / d) * (1 + EPSILON / np.sqrt(t)) ** 2 if t < d else 1.0 + 1e-5 for t in seen]
    norms = (columns[0] ** 2).sum(1)
    out = []
    for a in range(0, len(queries), QUERIES_AT_ONCE):
        q = queries[a : a + QUERIES_AT_ONCE]
        first = min(n, SEEDS)
        apart = ((q**2).sum(1)[:, None] + (vectors[:first] ** 2).sum(1) - 2 * q @ vectors[:first].T).astype(np.float64)
        best = np.sort(apart, axis=1)[:, :k]
        kept = [[np.arange(first)] for _ in q]
        dist = [[x] for x in apart]
        own = (q[:, :BLOCK] ** 2).sum(1)[:, None]
        for b in range(first, n, STEP):
            part = own + norms[b : b + STEP] - 2 * q[:, :BLOCK] @ columns[0][b : b + STEP].T
            limit = best[:, -1] if best.shape[1] == k else np.full(len(q), np.inf)
            asking, near = np.nonzero(part <= (limit * factor[0])[:, None])
            found = []
            for p in range(0, len(near), PAIRS_AT_ONCE):
                of, at = asking[p : p + PAIRS_AT_ONCE], near[p : p + PAIRS_AT_ONCE] + b
                far = part[of, at - b]
                for c in range(1, len(columns)):
                    if not len(at):
                        break
                    far = far + ((columns[c][at] - q[of, c * BLOCK : (c + 1) * BLOCK]) ** 2).sum(1)
                    stay = far <= limit[of] * factor[c]
                    of, at, far = of[stay], at[stay], far[stay]
                found.append((of, at, far))
            if not found:
                continue
            of, at, far = (np.concatenate(x) for x in zip(*found, strict=True))
            ends = np.searchsorted(of, np.arange(len(q) + 1))
            for i in np.unique(of).tolist():
                kept[i].append(at[ends[i] : ends[i + 1]])
                dist[i].append(far[ends[i] : ends[i + 1]])
            if b + STEP < n:
                ranked = [np.sort(np.concatenate([best[i], far[ends[i] : ends[i + 1]]]))[:k] for i in range(len(q))]
                width = min(map(len, ranked))
                best = np.array([x[:width] for x in ranked])
        for i in range(len(q)):
            at, far = np.concatenate(kept[i]), np.concatenate(dist[i])
            limit = np.partition(far, k - 1)[k - 1] if len(far) > k else np.inf
            out.append(at[far <= limit + 1e-4 * abs(limit)])
    return out


def ranked_ids(vectors: np.ndarray, queries: np.ndarray, names: np.ndarray, sizes: np.ndarray, found: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query's place, id and inner product of the k best candidates found for each query, the best first, ties to the
    smaller id. names: the ids of each vector one after another, sizes: how many each has."""
    at, of = np.concatenate(found), np.repeat(np.arange(len(found)), [len(x) for x in found])
    score, copies = (vectors[at] * queries[of]).sum(1), sizes[at]
    start = np.cumsum(sizes) - sizes
    within = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    of, score, vec = np.repeat(of, copies), np.repeat(score, copies), names[np.repeat(start[at], copies) + within]
    order = np.lexsort((vec, -score, of))
    of, score, vec = of[order], score[order], vec[order]
    best = np.arange(len(of)) - np.searchsorted(of, of) < k
    return of[best], vec[best], score[best]


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.96, most_lists: int = 2048, sample_per_list: int = 32,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """For each row for which is_query holds, its k nearest among all other rows by inner product: query_id, rank
    (from 1), vec_id, score (double precision, on the original vectors); ties go to the smaller id.

    About sqrt(n) lists (most_lists at most) are fitted on a sample of most_lists * sample_per_list rows at most; all
    rows are then put into lists. As many lists are probed as the sample needs for the given share of the neighbours
    that lie in it: few where vectors cluster, most where they are noise. Equal vectors are one candidate with its k + 1 smallest ids, and queries with equal
    vectors are searched once, so copies cost nothing. A list with many rows or queries is cut into cells of bounded
    size. Null ids, and vectors that are null, empty, zero, hold null or non-finite components or have another number
    of components than most do, take no part. Rows repeated with their id count once. No rows: no result."""
    spark = vectors.sparkSession
    values = F.col("embedding")
    # scores are of the vectors as they are: only single precision is kept as such
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size(values).alias("d")).count().orderBy(F.desc("count"), "d").head()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    rows = rows.where(F.size(values) == sizes.d)
    # any rows of one id and vector are one; then the least ids of each vector, few of which leave a task
    ids = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.groupBy("embedding", "vec_id").agg(F.bool_or("asks").alias("asks")).withColumn("at", F.row_number().over(ids)).where(F.col("at") <= k + 1)
    points = written(few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("point", F.col("ids")[0]), "points")
    asks = written(rows.where("asks").select(F.col("vec_id").alias("query_id"), "embedding").distinct().join(points.select("embedding", "point"), "embedding").select("query_id", "point"), "asks")
    square = F.aggregate(F.transform(values, lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x * x)
    total, largest = points.agg(F.count("*"), F.max(square)).head()
    lists = max(1, min(most_lists, round(total**0.5)))
    share = min(1.0, lists * sample_per_list / total)
    sample = points.where(F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("embedding").limit(2 * lists * sample_per_list)
    fit = _matrix(sample.toArrow().column("embedding"))
    index = Index(fit, lists, largest)
    sent, probed = spark.sparkContext.broadcast(index), index.probes(fit, math.ceil(k * len(fit) / total), recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = sent.value.nearest(sent.value.rotated(_matrix(batch.column("embedding"))), sent.value.centres, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], [*batch.schema.names, "list"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = sent.value.nearest(sent.value.rotated(_matrix(batch.column("embedding")), True), sent.value.centres, probed)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32).tolist(), pa.list_(pa.int32()))], [*batch.schema.names, "lists"])

    placed = written(points.select("point", "ids", "embedding").mapInArrow(place, f"point long, ids array<long>, embedding {kind}, list int"), "placed")
    asking = points.join(asks.select("point").distinct(), "point", "left_semi").select("point", "embedding")
    asked = written(asking.mapInArrow(ask, f"point long, embedding {kind}, lists array<int>"), "asked").select("point", "embedding", F.explode("lists").alias("list"))
    counts = placed.groupBy("list").agg(F.count("*").alias("n")).join(asked.groupBy("list").agg(F.count("*").alias("m")), "list")
    cells = counts.select("list", F.ceil(F.col("n") / CELL_VECTORS).cast("int").alias("nc"), F.ceil(F.col("m") / CELL_QUERIES).cast("int").alias("nq"))
    cells = F.broadcast(spark.createDataFrame(cells.collect(), cells.schema))  # a row for each list, most_lists at most
    part = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(cells, "list").select("list", part("nc").alias("c"), every("nq").alias("q"), "ids", "embedding")
    right = asked.join(cells, "list").select("list", every("nc").alias("c"), part("nq").alias("q"), "point", "embedding")

    def scan(key, have: pa.Table, want: pa.Table) -> pa.Table:
        out = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))]
        if len(have) and len(want):
            x, q, ids = _matrix(have.column("embedding")), _matrix(want.column("embedding")), have.column("ids").combine_chunks()
            names, sizes = ids.flatten().to_numpy(), ids.value_lengths().to_numpy()
            point = want.column("point").to_numpy()
            found = scan_list(sent.value.rotated(x), sent.value.rotated(q, True), k + 1)
            for a in range(0, len(q), QUERIES_AT_ONCE):
                own, vec, score = ranked_ids(x, q[a : a + QUERIES_AT_ONCE], names, sizes, found[a : a + QUERIES_AT_ONCE], k + 1)
                out.append((point[a + own], vec, score))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["point", "vec_id", "score"])

    near = left.groupBy("list", "c", "q").cogroup(right.groupBy("list", "c", "q")).applyInArrow(scan, "point long, vec_id long, score double")
    order = Window.partitionBy("point").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    near = near.groupBy("point").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("near"))
    others = asks.join(near, "point").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("pos", "hit")).select("query_id", (F.col("pos") + 1).alias("rank"), "hit.vec_id", "hit.score")
