"""Helpers of this subpackage: stored tables, bounded buckets, connected components, vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starforge.session import scratch_path, ship_package

col = F.col

# Python workers get at most so many rows and bytes of a partition at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the workers and bound what they get at a time."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder as Parquet and read again.

    It cuts the lineage, is computed once however often it is used, and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete what :func:`stored` wrote for ``df``, once nothing reads it any more."""
    path = getattr(df, "_stored_path", None)
    if path is not None:
        sc = df.sparkSession.sparkContext
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


# --------------------------------------------------------------------------- buckets


def in_blocks(rows: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """Rows of every bucket of two or more, dealt into blocks that a task can compare.

    A bucket of n rows is cut into ceil(n / size) parts by the hash of ``member``, and a block
    holds one or two parts: ``_i`` <= ``_j`` name them, ``_part`` is the row's own.  Each pair of
    rows of a bucket meets in exactly one block, if only rows of ``_i`` are compared with rows
    of ``_j``.  Buckets are counted before the shuffle, so a large one meets in no task.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(col("_n") > 1)
    parts = F.ceil(col("_n") / size).cast("int")
    placed = (
        rows.join(sizes, keys)
        .withColumn("_parts", parts)
        .withColumn("_part", F.pmod(F.xxhash64(member), col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), col("_parts") - 1)))
        .withColumn("_i", F.least("_part", "_other"))
        .withColumn("_j", F.greatest("_part", "_other"))
        .drop("_n", "_parts", "_other")
    )
    block = [*keys, "_i", "_j"]
    return placed.repartition(*block).sortWithinPartitions(*block)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by ``keys``, with the first row of each group.

    What is held is one batch and the group that is still open.
    """
    held: list[pa.RecordBatch] = []

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for k in keys:
            values = table.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        first = starts(table)
        if len(first) > 1:
            yield table.slice(0, first[-1]), first[:-1]
            held = table.slice(first[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


def pairs_of_groups(
    first: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray, most: int = 1 << 20
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs to compare, about ``most`` at a time: part ``_i`` with part ``_j`` of each group."""
    ends = np.append(first[1:], len(part))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    held = 0
    sizes = ends - first
    for n in np.unique(sizes[sizes > 1]):
        at = first[sizes == n]
        step = max(1, most // int(n * n))
        a, b = np.triu_indices(int(n), 1)
        for s in range(0, len(at), step):
            base = at[s : s + step, None]
            x, y = (base + a).ravel(), (base + b).ravel()
            # in a block of two parts only pairs across them count
            keep = (low[x] == high[x]) | (part[x] != part[y])
            left.append(x[keep])
            right.append(y[keep])
            held += len(left[-1])
            if held >= most:
                yield np.concatenate(left), np.concatenate(right)
                left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links that suffice to connect all that the links (a, b) connect."""
    parent: dict[int, int] = {}
    keep = []

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            keep.append(k)
    return np.array(keep, dtype=np.int64)


# --------------------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); the root is the smallest node reachable.

    Alternating stars: each round hangs the larger neighbours of a node, then the smaller ones,
    below the smallest.  Rounds grow with the logarithm of the longest chain.  Every step is a
    minimum per node, taken before the shuffle, and a join that Spark can split, so a node with
    very many neighbours meets in no task.  Each round is stored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.where(col("u") != col("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(col("v").alias("u"), col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where(col("v") > col("u")).join(least, "u").select(col("v").alias("u"), col("m").alias("v"))
        large = stored(large.where(col("u") != col("v")).distinct(), "large-star")
        forget(edges)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where(col("v") != col("m")).select(col("v").alias("u"), col("m").alias("v"))
        edges = stored(least.select("u", col("m").alias("v")).unionByName(hung).distinct(), "small-star")
        forget(large)
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == state:
            break
        state = now
    return edges.select(col("u").alias("node"), col("v").alias("root"))


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


# --------------------------------------------------------------------------- vectors


LONG = np.iinfo(np.int64).max


def complete(vector: Column) -> Column:
    """Whether a vector has components, none null or non-finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def as_integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; beyond the range of a long, the nearest long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    """Lists of ``dim`` numbers as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def largest(rows: np.ndarray) -> int:
    """The largest absolute value, as an integer without bounds."""
    return max(abs(int(rows.max())), abs(int(rows.min()))) if rows.size else 0


def column_sums(rows: np.ndarray) -> np.ndarray:
    """Exact sums of integer columns, as integers without bounds."""
    kind = np.int64 if len(rows) * largest(rows) <= LONG else object
    return rows.astype(kind).sum(axis=0).astype(object)


# --------------------------------------------------------------------------- native helpers


def let(value, body):
    """``body(value)`` with ``value`` computed once per row, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


# Elements that are added up at a time; sums of blocks of so many are kept for four levels.
_BLOCK, _LEVELS = 64, 4


def prefix_sums(values):
    """For each element of an array of numbers the sum of those before it, in time linear in the array.

    Sums of blocks, of blocks of blocks and so on are taken first; a prefix is less than a block's
    worth of each.
    """
    zero = F.lit(0).cast("bigint")

    def total(part):
        return F.aggregate(part, zero, lambda s, x: s + x)

    def blocks(level):
        count = F.ceil(F.size(level) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda j: total(F.slice(level, j * _BLOCK + 1, _BLOCK)))

    def of_levels(levels: list):
        if len(levels) < _LEVELS:
            return let(blocks(levels[-1]), lambda level: of_levels([*levels, level]))

        def before(_, i):
            out, width = F.lit(0).cast("bigint"), 1
            for k, level in enumerate(levels):
                at = F.floor(i / width).cast("int")
                first = F.lit(0) if k == _LEVELS - 1 else F.floor(at / _BLOCK).cast("int") * _BLOCK
                out = out + total(F.slice(level, first + 1, at - first))
                width *= _BLOCK
            return out

        return F.transform(levels[0], before)

    return let(F.transform(values, lambda v: v.cast("bigint")), lambda level: of_levels([level]))


def ranks(values, queries, inclusive: bool):
    """For each of the sorted ``queries`` the number of ``values`` below it, or up to it if ``inclusive``."""
    value, query = (0, 1) if inclusive else (1, 0)
    events = F.sort_array(
        F.concat(
            F.transform(values, lambda v: F.struct(v.cast("bigint").alias("p"), F.lit(value).alias("o"))),
            F.transform(queries, lambda q: F.struct(q.cast("bigint").alias("p"), F.lit(query).alias("o"))),
        )
    )

    def counted(e):
        before = prefix_sums(F.transform(e, lambda x: (x["o"] == value).cast("int")))
        both = F.zip_with(e, before, lambda x, n: F.struct(x["o"].alias("o"), n.alias("n")))
        return F.transform(F.filter(both, lambda x: x["o"] == query), lambda x: x["n"])

    return let(events, counted)


def words_of(text):
    """Words between ASCII white space; none for a null or blank text."""
    bare = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(bare) > 0, F.split(bare, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def numbered(df: DataFrame, order: list, name: str = "_nr") -> DataFrame:
    """0, 1, 2 .. over the whole table in the given order.

    Rows are range partitioned and stored with their place in the task; a task's first number is
    the count of the rows in the tasks before it, a table with one row per task.
    """
    order = [*order, F.monotonically_increasing_id()]  # spreads ties over tasks
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order[:-1])
    placed = stored(placed.withColumn("_pos", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_pos", 33)
    rows = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_task", task).join(F.broadcast(rows), "_task")
    return joined.withColumn(name, col("_pos") - col("_first") + col("_before")).drop("_task", "_pos", "_first", "_before")
