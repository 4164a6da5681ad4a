"""Centroid clustering of integer vectors; the nearest centroid wins a tournament of bisectors.

The points as far from centroid i as from centroid j are a plane.  Its normal ``2 (cj - ci)`` and
threshold ``|cj|^2 - |ci|^2`` are integers and are computed once per round for every pair of
centroids.  A vector's champion is centroid 0 at first; each further centroid challenges it, and
the sign of one linear form decides.  Zero, a tie, favours the smaller number.  After k - 1
tests the champion is the nearest centroid, and only its distance is computed, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import LONG, as_integers, column_sums, complete, largest, matrix, stored
from starforge.session import ship_package

col = F.col

@dataclass(frozen=True)
class Start:
    """Number of centroids, rounds, scale of the components, and what is hashed before a vector's id."""

    centroids: int = 8
    rounds: int = 10
    scale: int = 1024
    seed: int = 3


# --------------------------------------------------------------------------- the tournament


def exact_type(dim: int, *arrays: np.ndarray):
    """Longs if no sum that the tournament needs can leave their range, else Python's integers."""
    return np.int64 if 8 * dim * max(map(largest, arrays)) ** 2 < LONG else object


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals (k, k, dim) and thresholds (k, k) of all pairs; [i, j] is positive where j is nearer."""
    normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
    lengths = (centroids * centroids).sum(axis=1)
    return normals, lengths[None, :] - lengths[:, None]


def _forms(rows: np.ndarray, normals: np.ndarray) -> np.ndarray:
    if rows.dtype == object:
        return (rows * normals).sum(axis=1)
    return np.einsum("ij,ij->i", rows, normals)


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of integer rows, both exact; ties go to the smaller number."""
    kind = exact_type(rows.shape[1], rows, centroids)
    rows, centroids = rows.astype(kind), centroids.astype(kind)
    normals, thresholds = bisectors(centroids)
    champion = np.zeros(len(rows), dtype=np.int64)
    for challenger in range(1, len(centroids)):
        side = _forms(rows, normals[champion, challenger]) - thresholds[champion, challenger]
        champion[np.asarray(side > 0, dtype=bool)] = challenger
    apart = rows - centroids[champion]
    return champion, _forms(apart, apart)


# --------------------------------------------------------------------------- rounds


# Rows multiplied at a time; a row's normals are gathered beside it.
STEP = 4096


def _blocks(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    flat = matrix(batch.column("x"), dim)
    for start in range(0, len(flat), STEP):
        yield start, flat[start : start + STEP]


def _sums(centroids: np.ndarray):
    """Rows per centroid and sums per component of a task, as (cluster, at, n, s)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        counts, sums = [0] * k, np.zeros((k, dim), dtype=object)
        for batch in batches:
            for _, rows in _blocks(batch, dim):
                champion, _ = nearest(rows, centroids)
                for c in np.unique(champion):
                    own = rows[champion == c]
                    counts[c] += len(own)
                    sums[c] += column_sums(own)
        some = [c for c in range(k) if counts[c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, dim), pa.int32()),
                pa.array(np.tile(np.arange(dim), len(some)), pa.int32()),
                pa.array([counts[c] for c in some for _ in range(dim)], pa.int64()),
                pa.array([str(s) for c in some for s in sums[c]], pa.string()),
            ],
            ["cluster", "at", "n", "s"],
        )

    return add


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of their vectors' means; a centroid without vectors stays.

    The driver gets one row per centroid and component.
    """
    parts = points.select("x").mapInArrow(_sums(centroids), "cluster int, at int, n long, s string")
    total = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(col("s").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for r in total.collect():
        out[r["cluster"], r["at"]] = int(r["s"]) // r["n"]
    return out


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(col("id").cast("string"), F.lit("")))
    chosen = points.select(F.sha2(name, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in chosen], dtype=np.int64)


def fitted(points: DataFrame, start: Start) -> np.ndarray:
    """Centroids after all rounds.  A round that moves nothing ends them, as all others would move nothing."""
    centroids = first_centroids(points, start.centroids, start.seed)
    if len(centroids):
        for _ in range(start.rounds):
            before, centroids = centroids, moved(points, centroids)
            if (before == centroids).all():
                break
    return centroids


def _assigned(centroids: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in _blocks(batch, centroids.shape[1]):
                champion, distance = nearest(rows, centroids)
                fits = [int(d) if d <= LONG else None for d in distance] if distance.dtype == object else distance
                ids = batch.column("id").slice(start, len(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(champion, pa.int32()), pa.array(fits, pa.int64())], ["id", "cluster", "distance"])

    return assign


def clustered(
    vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", dim: int = 64, start: Start = Start()
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) per vector, centroids).

    Vectors count if they have ``dim`` components, none null or non-finite.  Their components
    become integers and all that follows is exact.  The distance is squared; one beyond the range
    of a long is null.  Of fewer vectors than centroids each is a centroid; an empty table gives
    an empty result.  Null ids hash like an empty text.  Repeated rows are vectors of their own
    and may all be centroids; of equal centroids the first gets the vectors.  Other columns are
    ignored, whatever their names.

    Each round reads the stored integers once and moves one row per task, centroid and component;
    nothing is grouped by cluster but these sums, so a cluster may hold any share of the vectors.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(col(id_).alias("id"), col(vector).alias("v")).where((F.size("v") == dim) & complete(col("v")))
    points = stored(rows.select("id", as_integers(col("v"), start.scale).alias("x")), "points")
    centroids = fitted(points, start)
    schema = f"id {points.schema['id'].dataType.simpleString()}, cluster int, distance long"
    if not len(centroids):
        return points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).withColumnRenamed("id", id_), centroids
    return points.mapInArrow(_assigned(centroids), schema).withColumnRenamed("id", id_), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256.

    Sums beyond the range of a long are null, as are those over a distance that is.
    """
    assigned = stored(assigned, "assigned")
    spark = assigned.sparkSession
    exact = F.sum(col("distance").cast("decimal(38,0)"))
    whole = F.when(F.count("distance") == F.count(F.lit(1)), exact)
    found = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(whole.alias("s")).collect()}

    def long(value) -> int | None:
        return int(value) if value is not None and value <= LONG else None

    total = None if any(s is None for s in found.values()) else sum(found.values())
    hashes = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    # one row per centroid
    facts = [(c, long(s), long(total), hashes[c]) for c, s in found.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster")
