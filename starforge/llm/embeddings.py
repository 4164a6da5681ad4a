"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by random signs and fast Hadamard transforms; the signed axis it lies
nearest to is its hash.  A key joins the hashes of several rotations, and each vector enters the
buckets of its nearest few axes of every rotation (multiprobe), in several tables.  Pairs that
share a bucket are verified by their cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import components, in_blocks, pairs_of_groups, prepare, spanning, stored, whole_groups

col = F.col


@dataclass(frozen=True)
class Hashing:
    """Tables, rotations joined into a key, nearest axes probed per rotation, seed."""

    tables: int = 4
    rotations: int = 2
    probes: int = 2
    seed: int = 11


# Distinct vectors of a bucket that one task compares with as many others, and pairs at a time.
BLOCK = 512
PAIRS = 1 << 15


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the width is a power of two."""
    n, width = rows.shape
    step = 1
    while step < width:
        rows = rows.reshape(n, -1, 2, step)
        rows = np.concatenate([rows[:, :, :1] + rows[:, :, 1:], rows[:, :, :1] - rows[:, :, 1:]], axis=2)
        step *= 2
    return rows.reshape(n, width)


def keys_of(vectors: np.ndarray, h: Hashing) -> np.ndarray:
    """Bucket keys of unit vectors, one row each: ``tables`` times all combinations of probed axes."""
    n, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    signs = np.random.default_rng(h.seed).choice([-1.0, 1.0], size=(h.tables, h.rotations, 3, width))
    probes = min(h.probes, width)
    out = []
    for t in range(h.tables):
        keys = np.full((n, 1), t, dtype=np.int64)
        for r in range(h.rotations):
            turned = padded
            for s in signs[t, r]:
                turned = hadamard(turned * s) / np.sqrt(width)
            near = np.argpartition(-np.abs(turned), probes - 1, axis=1)[:, :probes]
            axis = near * 2 + (np.take_along_axis(turned, near, axis=1) < 0)
            keys = (keys[:, :, None] * (2 * width) + axis[:, None, :]).reshape(n, -1)
        out.append(keys)
    return np.concatenate(out, axis=1)


def _unit(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    rows = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    lengths = np.linalg.norm(rows, axis=1)
    return rows, lengths


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and a length above zero."""
    as_doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(as_doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(as_doubles, lambda x: x != 0), F.lit(False))


def _near(least: float, h: Hashing):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, ["label", "dim", "k", "_i", "_j"]):
            own, weight, key = (table.column(c).to_numpy() for c in ("cid", "n", "k"))
            part, low, high = (table.column(c).to_numpy() for c in ("_part", "_i", "_j"))
            vectors = table.column("v").combine_chunks()
            dims = table.column("dim").to_numpy()
            flat, at = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum([0, *dims])
            for x, y in pairs_of_groups(first, part, low, high, PAIRS):
                for d in np.unique(dims[x]):
                    same = dims[x] == d
                    yield from _verified(x[same], y[same], int(d), flat, at, own, weight, key, least, h)

    return near


def _verified(x, y, dim, flat, at, own, weight, key, least, h) -> Iterator[pa.RecordBatch]:
    """Links among the pairs (x, y) that no other bucket reports: counts per vector, spanning links."""
    rows, inverse = np.unique(np.concatenate([x, y]), return_inverse=True)
    v = flat[at[rows][:, None] + np.arange(dim)]
    lengths = np.linalg.norm(v, axis=1)
    i, j = inverse[: len(x)], inverse[len(x) :]
    cosine = np.einsum("ij,ij->i", v[i], v[j]) / (lengths[i] * lengths[j])
    linked = cosine >= least
    if not linked.any():
        return
    i, j, bucket = i[linked], j[linked], key[x[linked]]
    used, inverse = np.unique(np.concatenate([i, j]), return_inverse=True)
    keys = keys_of(v[used] / lengths[used, None], h)
    a, b = keys[inverse[: len(i)]], keys[inverse[len(i) :]]
    # a pair may share several buckets; it counts in the one with the smallest key
    smallest = np.full(len(a), np.iinfo(np.int64).max)
    for c in range(keys.shape[1]):
        shared = (a[:, c : c + 1] == b).any(axis=1)
        smallest = np.where(shared, np.minimum(smallest, a[:, c]), smallest)
    counted = smallest == bucket
    i, j = rows[i[counted]], rows[j[counted]]
    if not len(i):
        return
    ends = np.concatenate([i, j])
    found, inverse = np.unique(ends, return_inverse=True)
    links = np.bincount(inverse, weights=np.concatenate([weight[j], weight[i]])).astype(np.int64)
    none = pa.nulls(len(found), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(own[found]), none, pa.array(links)], ["a", "b", "n"])
    kept = spanning(own[i], own[j])
    none = pa.nulls(len(kept), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(own[i][kept]), pa.array(own[j][kept]), none], ["a", "b", "n"])


def near_duplicates(
    vectors: DataFrame,
    id_: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.93,
    hashing: Hashing = Hashing(),
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) per vector.

    Vectors of one label (an integer) link at a cosine of ``least`` or more.  Equal vectors are
    one class and linked without a comparison.  A pair is counted once and a group's links are
    never spelled out: a block gives a number per vector and links that span it.  Vectors
    without a label or an id, that are null, zero or hold a null or non-finite component, and
    vectors of different length, link with nothing.  Repeated rows count as other vectors.  An
    empty table gives an empty result; other columns are ignored.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select(col(id_).alias("id"), col(vector).alias("v"), col(label).cast("bigint").alias("label"))
    good = rows.where(usable(col("v")) & col("label").isNotNull() & col("id").isNotNull())
    classes = stored(good.groupBy("label", "v").agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("n")), "classes")

    @F.arrow_udf("array<long>")
    def buckets(batch: pa.Array) -> pa.Array:
        out: list = [None] * len(batch)
        widths = np.diff(batch.offsets.to_numpy())
        for d in np.unique(widths):
            at = np.flatnonzero(widths == d)
            v, lengths = _unit(batch.take(pa.array(at)))
            for r, keys in zip(at.tolist(), keys_of(v / lengths[:, None], hashing)):
                out[r] = keys
        return pa.array(out, pa.list_(pa.int64()))

    keyed = classes.withColumn("dim", F.size("v")).withColumn("k", F.explode(buckets(col("v"))))
    placed = in_blocks(keyed, ["label", "dim", "k"], "cid", block)
    names = ["label", "dim", "k", "_i", "_j", "_part", "cid", "n", "v"]
    near = stored(placed.select(*names).mapInArrow(_near(least, hashing), "a long, b long, n long"), "near")
    counts = near.where(col("b").isNull()).groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "cid")
    roots = components(near.where(col("b").isNotNull()).select("a", "b")).withColumnRenamed("node", "cid")
    found = classes.join(counts, "cid", "left").join(roots, "cid", "left")
    found = found.select("label", "v", "n", "others", F.coalesce("root", "cid").alias("root"))
    marked = rows.withColumn("ok", usable(col("v")) & col("label").isNotNull() & col("id").isNotNull())
    key = F.when(col("ok"), F.xxhash64("label", "v"))
    key2 = F.xxhash64(F.lit(2), "label", "v")
    found = found.select(
        F.xxhash64("label", "v").alias("_k"), key2.alias("_k2"), (col("n") - 1 + F.coalesce("others", F.lit(0))).alias("m"), "root"
    )
    out = marked.select("id", key.alias("_k"), key2.alias("_k2")).join(found, ["_k", "_k2"], "left")
    component = F.coalesce("root", "id")
    return out.select(
        col("id").alias(id_),
        F.coalesce("m", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        col("id").eqNullSafe(component).alias("kept"),
    )
