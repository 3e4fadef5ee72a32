"""Centroid clustering of integer vectors by a progressive search of Walsh-Hadamard coefficients.

The transform keeps squared distances up to the factor DIM and gathers what neighbouring components
have in common in its first coefficients. So differences are summed up coarse to fine: a centroid
whose sum so far exceeds the whole distance of another one is strictly worse and drops out; those
that stay are summed up over all coefficients. All of it is integer arithmetic, hence exact.

A round reads the vectors once. Tasks hand on the sums of their own vectors by centroid, so neither
a common vector nor a large cluster meets in one task, and K * DIM numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsignal.llm.common import longs, map_arrow
from fieldsignal.session import materialize

DIM, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Coefficients after which centroids are compared.
STEPS = (4, 16, DIM)
#: Components up to here keep every sum of squared coefficients within 64 bits; others take Python's integers.
SMALL = 1 << 24


def _sequency() -> np.ndarray:
    """The coefficients of the transform by their number of sign changes, the coarsest first."""
    signs = np.ones((1, 1), dtype=np.int64)
    while len(signs) < DIM:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1))


_ORDER = _sequency()


def transform(vectors: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard coefficients of each row, coarse to fine."""
    out, half = vectors, 1
    while half < DIM:
        pairs = out.reshape(len(out), -1, 2, half)
        left, right = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([left + right, left - right], axis=2).reshape(len(out), DIM)
        half *= 2
    return out[:, _ORDER]


def quantize(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite components: 64-bit integers, or Python's where those would not do."""
    if not len(vectors) or np.abs(vectors).max() <= SMALL // SCALE:
        return np.floor(vectors * SCALE).astype(np.int64)
    # Doubles from 2^53 on are whole, and their product may exceed a double.
    whole = [[int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in row] for row in vectors]
    return np.array(whole, dtype=object)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector the number of its nearest centroid, the smallest among equals, and the squared distance."""
    if not len(vectors):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if vectors.dtype == object or centroids.dtype == object:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    mine, theirs = transform(vectors), transform(centroids)
    row = np.repeat(np.arange(len(mine)), len(theirs))
    centroid = np.tile(np.arange(len(theirs)), len(mine))
    total = np.zeros(len(row), dtype=mine.dtype)
    done = 0
    for step in STEPS:
        difference = mine[row, done:step] - theirs[centroid, done:step]
        total = total + (difference * difference).sum(axis=1)
        done = step
        # Pairs stay sorted by row; of each row one at least stays.
        head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        least = np.minimum.reduceat(total, head)
        if step == DIM:
            break
        size = np.diff(np.r_[head, len(row)])
        best = np.flatnonzero(total == np.repeat(least, size))
        best = best[np.r_[True, row[best][1:] != row[best][:-1]]]
        rest = mine[row[best], step:] - theirs[centroid[best], step:]
        whole = total[best] + (rest * rest).sum(axis=1)
        stay = ~(total > np.repeat(whole, size)).astype(bool)
        row, centroid, total = row[stay], centroid[stay], total[stay]
    size = np.diff(np.r_[head, len(row)])
    won = np.flatnonzero(total == np.repeat(least, size))
    won = won[np.r_[True, row[won][1:] != row[won][:-1]]]
    return centroid[won], least // DIM


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), DIM)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows with DIM components, none of them null, NaN or infinite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where((F.size(x) == DIM) & finite).select(F.col("vec_id").cast("long"), x.alias("embedding"))


def first_centroids(kept: DataFrame, count: int = CENTROIDS) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in their order; rows of one id in that of their components.

    Null ids start no centroid, unless there are too few others.
    """
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "embedding").limit(count).collect()
    return quantize(np.array([r["embedding"] for r in rows], dtype=np.float64).reshape(len(rows), DIM))


def update(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's vectors; those without any stay."""
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total, count = np.zeros(known.shape, dtype=object), np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            vectors = quantize(_rows(batch.column(1)))
            if not len(vectors):
                continue
            cluster, _ = nearest(vectors, known)
            order = np.argsort(cluster, kind="stable")
            head = np.flatnonzero(np.r_[True, cluster[order][1:] != cluster[order][:-1]])
            found = cluster[order][head]
            total[found] += np.add.reduceat(vectors[order], head, axis=0)
            count[found] += np.diff(np.r_[head, len(order)])
        # Sums and counts as decimal text: any size, and few rows.
        names = ["cluster", "at", "total", "n"]
        held = [(c, d, str(int(total[c, d])), int(count[c])) for c in np.flatnonzero(count) for d in range(DIM)]
        columns = list(zip(*held)) or [()] * 4
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(columns, types)], names=names)

    parts = map_arrow(kept, sums, "cluster int, at int, total string, n long")
    whole = parts.groupBy("cluster", "at").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    out = centroids.astype(object)
    for row in whole.collect():
        out[row["cluster"], row["at"]] = int(row["total"]) // row["n"]
    return _narrow(out)


def _narrow(centroids: np.ndarray) -> np.ndarray:
    return centroids.astype(np.int64) if np.abs(centroids).max() <= SMALL else centroids


def fit(kept: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after all rounds, as integers; none for a table without usable vectors."""
    centroids = first_centroids(kept, count)
    if len(centroids):
        for _ in range(rounds):
            centroids = update(kept, centroids)
    return centroids


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every row."""
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(quantize(_rows(batch.column(1))), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), longs(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return map_arrow(kept, run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (its components) of every usable row.

    Rows without exactly DIM components, or with null, NaN or infinite ones, are left out. A null id
    is clustered as any other and starts no centroid while there are others. Repeated rows count each.
    With fewer than ``count`` usable rows each of them starts a centroid; without any the result is
    empty. A sum of squared distances beyond 64 bits raises an error.
    """
    spark, kept = vectors.sparkSession, usable(vectors)
    centroids = fit(kept, count, rounds)
    if not len(centroids):
        return kept.where("false").selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
            "array('') AS centroid",
        )
    assigned = materialize(assign(kept, centroids))
    # As many rows as there are centroids.
    sums = {r["cluster"]: r["sum"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    total = sum(sums.values())
    rows = [(c, s, total, [str(x) for x in centroids[c]]) for c, s in sums.items()]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<string>")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
