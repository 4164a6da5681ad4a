"""Similarity search by blocks: exact over a whole index, approximate over trained cells.

Vectors of the index and of the queries are packed into blocks, a row each.  Blocks that belong
together are joined, a task multiplies the two blocks of a joined row and keeps the best hits of
its queries, and the hits of all tasks are merged.  In the exact search all blocks belong
together; in the approximate one those of a cell that the queries probe.  Neither vectors nor
queries pass the driver, but for the queries of a broadcast, whose size is measured first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starforge.operators.windows import top_n_per
from starforge.session import cut_lineage, ship_package

col = F.col

# Bytes of vectors in a block, bytes of an index slice that queries are copied to if they are not
# broadcast, and bytes of queries that may be broadcast.
BLOCK_BYTES, SLICE_BYTES, BROADCAST_BYTES = 1 << 20, 64 << 20, 32 << 20

# Hits that a task holds before it passes them on, and parts in which a query's hits are merged first.
HELD, PARTS = 1 << 21, 32


# --------------------------------------------------------------------------- blocks


def list_matrix(lists: pa.ListArray, dim: int | None = None) -> np.ndarray:
    """Rows of equally long lists, without a copy per row; another length is an error."""
    if not len(lists):
        return np.zeros((0, dim or 0))
    lengths = np.diff(lists.offsets.to_numpy())
    dim = int(lengths[0]) if dim is None else dim
    if (lengths != dim).any():
        raise ValueError(f"a vector has {int(lengths[lengths != dim][0])} numbers, not {dim}")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), dim)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows of zeros stay."""
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1, norms)


def _pack(id_: str, vector: str, keep_zeros: bool):
    """Unit vectors of a batch in blocks of one cell each: (cell, ids, dim, vectors)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list_matrix(batch.column(vector))
            some = np.arange(len(rows)) if keep_zeros else np.flatnonzero(rows.any(axis=1))  # zeros have no direction
            if not len(some):
                continue
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            some = some[np.argsort(cell[some], kind="stable")]
            rows, ids, cell = unit_rows(rows[some]), batch.column(id_).take(pa.array(some)), cell[some]
            dim = rows.shape[1]
            size = max(1, BLOCK_BYTES // (8 * max(1, dim)))
            first = np.r_[0, np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)]
            cuts = [b for lo, hi in zip(first, first[1:]) for b in range(lo, hi, size)] + [len(cell)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell[cuts[:-1]], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids),
                    pa.array([dim] * (len(cuts) - 1), pa.int32()),
                    pa.array([rows[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary()),
                ],
                ["cell", "ids", "dim", "vectors"],
            )

    return pack


def packed(rows: DataFrame, id_: str, vector: str, keep_zeros: bool = False) -> DataFrame:
    """Blocks of the rows (cell, id, vector) of a task, without a shuffle."""
    schema = f"cell int, ids array<{rows.schema[id_].dataType.simpleString()}>, dim int, vectors binary"
    return rows.where(col(vector).isNotNull()).select("cell", id_, vector).mapInArrow(_pack(id_, vector, keep_zeros), schema)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties by lower id."""
    return np.lexsort((ids, -scores))[:k]


class _Hits:
    """The best ``k`` hits of every query a task has met."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, names: list, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = queries @ rows.T
        least = np.array([self.held[q][0][-1] if q in self.held and len(self.held[q][0]) == self.k else -np.inf for q in names])
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        at, hit = np.nonzero(scores >= least[:, None])
        starts = np.searchsorted(at, np.arange(len(names) + 1))
        for q in np.unique(at):
            found = hit[starts[q] : starts[q + 1]]
            s, i = scores[q, found], ids[found]
            if names[q] in self.held:
                s, i = np.concatenate([self.held[names[q]][0], s]), np.concatenate([self.held[names[q]][1], i])
            top = _best(s, i, self.k)
            self.held[names[q]] = s[top], i[top]

    def taken(self) -> tuple[list, np.ndarray, np.ndarray] | None:
        """All hits, which are then forgotten."""
        if not self.held:
            return None
        held, self.held = self.held, {}
        names = [q for q, (s, _) in held.items() for _ in range(len(s))]
        return names, *(np.concatenate([v[j] for v in held.values()]) for j in (0, 1))


def _multiply(k: int, query_type: pa.DataType, id_type: pa.DataType, id_: str):
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _Hits(k)

        def out() -> Iterator[pa.RecordBatch]:
            if found := hits.taken():
                names, scores, ids = found
                yield pa.RecordBatch.from_arrays([pa.array(names, query_type), pa.array(ids, id_type), pa.array(scores)], ["query_id", id_, "score"])

        for batch in batches:
            names, ids = batch.column("query_ids"), batch.column("ids")
            for n in range(batch.num_rows):
                dim, asked = batch.column("dim")[n].as_py(), batch.column("query_dim")[n].as_py()
                if dim != asked:
                    raise ValueError(f"a vector has {dim} numbers, not {asked}")
                rows, queries = (np.frombuffer(batch.column(c)[n].as_buffer()).reshape(-1, dim) for c in ("vectors", "query_vectors"))
                hits.add(names[n].as_py(), queries, ids[n].values.to_numpy(zero_copy_only=False), rows)
                if len(hits.held) * k > HELD:
                    yield from out()
        yield from out()

    return multiply


def _joined(blocks: DataFrame, asked: DataFrame, sliced: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Blocks of the index beside the blocks of queries of their cell.

    Few queries are broadcast, and the index is read where it lies.  More are copied to every slice
    of their cell, whose number ``sliced`` adds; slices are of bounded size, so neither a large cell
    nor a large index is one task's.
    """
    asked = cut_lineage(asked)
    size = asked.agg(F.sum(F.length("vectors"))).first()[0] or 0
    asked = asked.select("cell", col("ids").alias("query_ids"), col("dim").alias("query_dim"), col("vectors").alias("query_vectors"))
    if size <= BROADCAST_BYTES:
        return blocks.join(F.broadcast(asked), "cell")
    dealt = sliced(blocks).withColumn("slice", F.pmod(F.xxhash64("ids"), "slices").cast("int"))
    copied = sliced(asked).withColumn("slice", F.explode(F.sequence(F.lit(0), col("slices") - 1)))
    return dealt.drop("slices").join(copied.drop("slices"), ["cell", "slice"])


def _searched(blocks: DataFrame, asked: DataFrame, sliced: Callable[[DataFrame], DataFrame], k: int, id_: str) -> DataFrame:
    """(query_id, id, score, rank), merged in two steps so that a query asked of very many tasks meets in none."""
    query_type, id_type = (b.schema["ids"].dataType.elementType for b in (asked, blocks))
    schema = f"query_id {query_type.simpleString()}, {id_} {id_type.simpleString()}, score double"
    names = ["query_ids", "query_dim", "query_vectors", "ids", "dim", "vectors"]
    multiply = _multiply(k, to_arrow_type(query_type), to_arrow_type(id_type), id_)
    found = _joined(blocks, asked, sliced).select(*names).mapInArrow(multiply, schema)
    order = ["-score", id_]
    parts = top_n_per(found.withColumn("_part", F.pmod(F.xxhash64(id_), F.lit(PARTS))), ["query_id", "_part"], order, k)
    return top_n_per(parts.drop("_part"), ["query_id"], order, k, "rank")


def top_k_cosine(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_: str = "vec_id",
    query_id: str = "query_id",
    vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` vectors with the highest cosine per query.

    ``where`` restricts the index before ranking.  Ties go to the lower id.  Null vectors and vectors
    of zeros of the index are no hits, a null query has none; vectors of another length are an error.
    """
    ship_package(index.sparkSession)
    candidates = index if where is None else index.where(where)
    whole = F.lit(0).alias("cell")
    asked = packed(queries.select(whole, col(query_id).alias("_query"), vector), "_query", vector, keep_zeros=True)
    blocks = packed(candidates.select(whole, id_, vector), id_, vector)

    @cache
    def slices() -> int:
        """Only asked for if queries are copied to slices; the number of rows tells it."""
        rows, dim = candidates.count(), candidates.select(F.size(vector)).where(col(vector).isNotNull()).first()
        return max(1, ceil(rows * (dim[0] if dim else 0) * 8 / SLICE_BYTES))

    return _searched(blocks, asked, lambda df: df.withColumn("slices", F.lit(slices())), k, id_)


# --------------------------------------------------------------------------- trained cells


# Cells at most, and vectors of the sample per cell: what the driver holds and what training reads.
MOST_CELLS, PER_CELL = 16384, 64

# Vectors that a folder of a stored index should hold at least, on average.
PER_FOLDER = 10_000

# Cells whose sums a task passes on at once.
SUMS = 1024

# Numbers in a product of vectors and centroids.
PRODUCT = 1 << 20


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroid with the highest cosine, of equal ones the first."""
    step = max(1, PRODUCT // max(1, len(centroids)))
    parts = [np.argmax(unit_rows(rows[s : s + step]) @ centroids.T, axis=1) for s in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _cell_sums(centroids, vector: str):
    """Unit vectors of a task summed per cell: (cell, n, total)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = centroids.value
        counts, sums = np.zeros(len(known), dtype=np.int64), np.zeros_like(known)
        for batch in batches:
            rows = list_matrix(batch.column(vector), known.shape[1])
            cell = nearest(rows, known)
            counts += np.bincount(cell, minlength=len(known))
            np.add.at(sums, cell, unit_rows(rows))
        cells = np.flatnonzero(counts)
        for start in range(0, len(cells), SUMS):
            some = cells[start : start + SUMS]
            ends = np.arange(len(some) + 1, dtype=np.int32) * known.shape[1]
            totals = pa.ListArray.from_arrays(ends, pa.array(sums[some].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), totals], ["cell", "n", "total"])

    return add


def _merge_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the same cell added up; a task holds the cells dealt to it."""
    found: dict[int, list] = {}
    for batch in batches:
        for c, n, total in zip(*(batch.column(k) for k in ("cell", "n", "total"))):
            own = found.setdefault(c.as_py(), [0, 0.0])
            own[0] += n.as_py()
            own[1] = own[1] + total.values.to_numpy()
    cells = sorted(found)
    totals = pa.array([found[c][1] for c in cells], pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array([found[c][0] for c in cells], pa.int64()), totals], ["cell", "n", "total"])


def train_cells(index: DataFrame, vector: str = "embedding", cells: int | None = None, per_cell: int = PER_CELL, rounds: int = 5) -> np.ndarray:
    """Unit centroids, one row per cell, by k-means with cosines on a sample of the distinct vectors.

    Eight times the root of the number of vectors, if not given, and ``MOST_CELLS`` at most.  The
    sample has about ``per_cell`` vectors per cell, chosen by their hash, so that a vector that many
    rows share is in it once at most.  A round deals sums per task and cell; the driver gets a row
    per cell.
    """
    spark = index.sparkSession
    ship_package(spark)
    usable = index.select(vector).where(F.exists(vector, lambda x: x != 0))
    rows = usable.count()
    cells = min(MOST_CELLS, cells or max(1, int(8 * rows**0.5)))
    order = F.xxhash64(vector)
    share = min(1.0, cells * per_cell / max(1, rows))
    sample = usable.where(order < F.lit(int(-(2**63) + share * (2**64 - 1)))) if share < 1 else usable
    sample = cut_lineage(sample.distinct())
    first = sample.orderBy(F.xxhash64(F.lit(1), vector)).limit(cells).collect()
    if not first:
        return np.zeros((0, 0))
    centroids = unit_rows(np.array([r[0] for r in first], dtype=np.float64))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)
        sums = sample.mapInArrow(_cell_sums(shared, vector), "cell int, n long, total array<double>")
        sums = sums.repartition("cell").mapInArrow(_merge_sums, "cell int, n long, total array<double>")
        centroids = centroids.copy()
        for r in sums.collect():
            if r["n"] and any(r["total"]):
                centroids[r["cell"]] = unit_rows(np.array([r["total"]]))[0]
        shared.destroy()
    return centroids


@dataclass(frozen=True)
class CellIndex:
    """An index stored by cell: ``path/vectors`` has a folder per cell, ``path/cells`` a row per cell.

    Where a cell has too few vectors for a folder, neighbours in number share one and lie in order
    within its files.  A search reads only the folders of the cells that some query probes, and
    compares a query only with the vectors of its own cells.
    """

    spark: SparkSession
    path: str
    id_: str = "vec_id"
    vector: str = "embedding"

    @classmethod
    def build(cls, index: DataFrame, path: str, id_: str = "vec_id", vector: str = "embedding", cells: int | None = None) -> CellIndex:
        """Train cells and store every vector with a direction; null vectors and zeros are no hits of any query."""
        spark = index.sparkSession
        shared = spark.sparkContext.broadcast(train_cells(index, vector, cells))

        @F.arrow_udf("int")
        def cell(batch: pa.Array) -> pa.Array:
            return pa.array(nearest(list_matrix(batch, shared.value.shape[1] or None), shared.value).astype(np.int32))

        rows = index.where(F.exists(vector, lambda x: x != 0)).select(id_, vector)
        cells = max(1, len(shared.value))
        folders = max(1, min(cells, rows.count() // PER_FOLDER))
        folder = F.floor(col("cell") * folders / cells).cast("int")
        celled = rows.withColumn("cell", cell(col(vector))).withColumn("folder", folder)
        celled.hint("rebalance", "folder").sortWithinPartitions("folder", "cell").write.partitionBy("folder").parquet(f"{path}/vectors")
        made = cls(spark, path, id_, vector)
        sizes = made._vectors(rows.schema).groupBy("cell").count()
        known = [(c, v.tolist()) for c, v in enumerate(shared.value)]
        known = spark.createDataFrame(known, "cell int, centroid array<double>").join(F.broadcast(sizes), "cell", "left")
        size = F.coalesce("count", F.lit(0)).alias("size")
        known.select("cell", "centroid", size, folder.alias("folder")).coalesce(1).write.parquet(f"{path}/cells")
        rows.limit(0).write.parquet(f"{path}/shape")
        return made

    def _vectors(self, schema: T.StructType) -> DataFrame:
        """All vectors with their cell; the schema is given as an index may hold no file."""
        whole = T.StructType([*schema.fields, *(T.StructField(c, T.IntegerType()) for c in ("cell", "folder"))])
        return self.spark.read.schema(whole).parquet(f"{self.path}/vectors")

    def vectors(self) -> DataFrame:
        return self._vectors(self.spark.read.parquet(f"{self.path}/shape").schema)

    def _stored_cells(self) -> DataFrame:
        """(cell, centroid, size, folder); at most ``MOST_CELLS`` rows."""
        return self.spark.read.parquet(f"{self.path}/cells")

    def _cells(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self._stored_cells().orderBy("cell").collect()
        return np.array([r["centroid"] for r in rows], dtype=np.float64), np.array([r["size"] for r in rows], dtype=np.int64)

    def probes(self, queries: DataFrame, k: int, share: float, query_id: str = "query_id") -> DataFrame:
        """(_query, vector, cells): the cells nearest to each query.

        As many as fit into ``share`` of the index, more only if they hold fewer than ``k`` vectors.
        """
        centroids, sizes = self._cells()
        shared = self.spark.sparkContext.broadcast((centroids, sizes, max(1, int(share * sizes.sum()))))

        @F.arrow_udf("array<int>")
        def probed(batch: pa.Array) -> pa.Array:
            known, held, most = shared.value
            out = []
            rows = list_matrix(batch, known.shape[1]) if len(known) else np.zeros((len(batch), 0))
            for q in unit_rows(rows):
                near = np.argsort(-(known @ q), kind="stable") if len(known) else np.zeros(0, dtype=np.int64)
                so_far = np.cumsum(held[near])
                n = max(np.searchsorted(so_far, most, side="right"), np.searchsorted(so_far, k) + 1)
                out.append(near[:n][held[near[:n]] > 0].astype(np.int32))
            return pa.array(out, pa.list_(pa.int32()))

        asked = queries.where(col(self.vector).isNotNull()).select(col(query_id).alias("_query"), self.vector)
        return cut_lineage(asked.withColumn("cells", probed(col(self.vector))))

    def compared(self, probes: DataFrame) -> DataFrame:
        """(_query, compared, share) per query: the vectors it is compared with, as a number and as a share of all."""
        sizes = self._stored_cells().select("cell", "size")
        whole = sizes.agg(F.sum("size")).first()[0] or 1
        each = probes.select("_query", F.explode("cells").alias("cell")).join(F.broadcast(sizes), "cell")
        return each.groupBy("_query").agg(F.sum("size").alias("compared"), (F.sum("size") / whole).alias("share"))

    def search(self, probes: DataFrame, k: int) -> DataFrame:
        """(query_id, id, score, rank) among the probed cells; scores are exact."""
        ship_package(self.spark)
        each = probes.select(F.explode("cells").alias("cell"), "_query", self.vector)
        # cell numbers, at most MOST_CELLS; other folders are not opened
        probed = self._stored_cells().select("cell", "folder").join(each.select("cell").distinct(), "cell", "left_semi").collect()
        folders = sorted({r["folder"] for r in probed})
        near = col("folder").isin(folders) & col("cell").isin([r["cell"] for r in probed])
        vectors = self.vectors().where(near) if probed else self.vectors().limit(0)
        asked = packed(each.hint("rebalance", "cell"), "_query", self.vector, keep_zeros=True)
        slices = F.greatest(F.lit(1), F.ceil(col("size") * F.size("centroid") * 8 / SLICE_BYTES)).cast("int")
        known = F.broadcast(self._stored_cells().select("cell", slices.alias("slices")))
        return _searched(packed(vectors, self.id_, self.vector), asked, lambda df: df.join(known, "cell"), k, self.id_)

    def top_k(self, queries: DataFrame, k: int = 5, share: float = 0.28, query_id: str = "query_id") -> DataFrame:
        """As :func:`top_k_cosine`, comparing a query with ``share`` of the index at most.

        ``share`` trades work for recall: vectors in clear groups need little of the index; vectors
        without structure, as in the supplied tables, a quarter for nine hits of ten.
        """
        return self.search(self.probes(queries, k, share, query_id), k)


def recall(found: DataFrame, truth: DataFrame, id_: str = "vec_id") -> DataFrame:
    """Share of the true hits that were found."""
    hits = truth.join(found.select("query_id", id_, F.lit(1).alias("_hit")), ["query_id", id_], "left")
    return hits.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
