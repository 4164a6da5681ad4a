"""Substring dedup: words covered by a window that also starts in an earlier document go.

Every window of ``window`` words has a minimizer, the smallest hash among its short word groups.
Equal windows have equal minimizers, so runs of windows with one minimizer, the fragments, are
dealt to shards by it, and all occurrences of a window meet.  Only minimizers that occur in more
than one row matter; the others are dropped before any text moves.  Equal fragments are reduced
to one with its smallest document id.  A shard builds an FM-index of its fragments and streams
their windows through it; the rows of a window's interval give the smallest id it starts in.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import forget, prepare, stored
from starforge.llm.fmindex import FmIndex

col = F.col

WINDOW = 13
# Words whose joint hash is a candidate for a minimizer.
GROUP = 4
# Bytes of words that one index holds, but for the fragments of one minimizer.
SHARD_BYTES = 2 << 20
# Bytes of one minimizer's distinct fragments beyond which its windows are dealt one by one.
CROWD_BYTES = 16 << 20
# Rows of a result that leave the worker at a time.
BATCH = 10_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from minima over doubling spans."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def minimizers(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """First window of each fragment of a document, and its minimizer.

    A fragment is a run of windows with equal minimizers; of a text that repeats itself it may
    be long.
    """
    if len(words) < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    group = min(GROUP, window)
    single = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    joint = np.zeros(len(words) - group + 1, dtype=np.uint64)
    for k in range(group):
        joint = (joint ^ single[k : k + len(joint)]) * _MIX
        joint ^= joint >> np.uint64(29)
    least = _sliding_min(joint, window - group + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return first, least[first].view(np.int64)


def _marks(window: int):
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.unique(minimizers(words_of(text.as_py()), window)[1])
                ids.append(np.full(len(own), id_))
                found.append(own)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, ids)], ["m", "id"])

    return marks


def _fragments(window: int):
    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            pieces: list[bytes] = []
            columns: tuple[list, ...] = ([], [], [], [])
            for id_, packed, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = unpack(packed.as_py())
                words = data.split()
                first, m = minimizers(words, window)
                found = np.flatnonzero(np.isin(m, wanted.values.to_numpy()))
                # fragments are slices of the words joined by single spaces
                line, stops = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
                last = np.append(first[1:], len(words) - window + 1)[found] + window - 2
                begins = np.concatenate([[0], stops])[first[found]]
                pieces += [line[x:y] for x, y in zip(begins.tolist(), (stops[last] - 1).tolist())]
                n, row = len(found), xxhash.xxh3_64_intdigest(data) - (1 << 63)
                for column, values in zip(columns, (m[found], np.full(n, id_), np.full(n, row), first[found])):
                    column.append(values)
            if pieces:
                m, ids, rows, at = (np.concatenate(c).astype(np.int64) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m), pa.array(pieces, pa.binary()), pa.array(ids), pa.array(rows), pa.array(at.astype(np.int32))],
                    ["m", "words", "id", "row", "at"],
                )

    return fragments


def _single_windows(window: int):
    @F.arrow_udf("array<binary>")
    def cut(batch: pa.Array) -> pa.Array:
        out = []
        for data in batch.to_pylist():
            words = data.split()
            out.append([b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)])
        return pa.array(out, pa.list_(pa.binary()))

    return cut


def shard_firsts(pieces: list[bytes], firsts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each fragment, the smallest id it starts in within the shard, end to end.

    Also the number of windows of each fragment.
    """
    words = b" ".join(pieces).split()
    known = {w: n for n, w in enumerate(dict.fromkeys(words), 1)}
    lengths = np.array([p.count(b" ") + 1 for p in pieces])
    symbols = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
    index = FmIndex(symbols, lengths, len(known) + 1)
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    at = index.starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    least = firsts[owner]
    lane, low, high = index.matches(at, window)
    if len(lane):
        ids = np.append(firsts[index.owners()], np.iinfo(np.int64).max)
        start, back = np.unique(low, return_inverse=True)
        stop = np.zeros(len(start), dtype=np.int64)
        stop[back] = high
        # intervals of windows of one length are disjoint
        least[lane] = np.minimum.reduceat(ids, np.stack([start, stop], axis=1).ravel())[::2][back]
    return least, counts


def _search(window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            pieces = shard.column("words").to_pylist()
            least, counts = shard_firsts(pieces, shard.column("first").to_numpy(), window)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            columns = [shard.column(c).combine_chunks() for c in ("route", "key", "alone")]
            found = pa.ListArray.from_arrays(ends, pa.array(least))
            yield from pa.table([*columns, found], names=["route", "key", "alone", "least"]).to_batches(max_chunksize=BATCH)

    return search


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole routes that hold about ``SHARD_BYTES`` of words."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        route = batch.column("route").to_numpy()
        while size + batch.column("words").nbytes >= SHARD_BYTES and held and batch.num_rows:
            # up to the end of the route that is open
            same = route != held[-1].column("route")[-1].as_py()
            cut = int(same.argmax()) if same.any() else len(route)
            if cut:
                held.append(batch.slice(0, cut))
            if cut == len(route):
                batch = batch.slice(cut)
                break
            yield pa.Table.from_batches(held)
            held, size = [], 0
            batch, route = batch.slice(cut), route[cut:]
        if batch.num_rows:
            held.append(batch)
            size += batch.column("words").nbytes
    if held:
        yield pa.Table.from_batches(held)


def _packed(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """Ids with compressed texts, for the two joins that move texts."""

    @F.arrow_udf("binary")
    def pack(batch: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=1).compress
        return pa.array([press((t or "").encode("utf-8", "surrogatepass")) for t in batch.to_pylist()], pa.binary())

    return docs.select(col(id_).alias("id"), pack(col(text)).alias("packed"))


def repeated_windows(docs: DataFrame, id_: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, row, starts): word positions of the windows that also start in a document of a smaller id.

    ``row`` is the hash of the text, which tells apart different texts of one id.  Documents
    without such windows are not listed.  Windows never span documents; a document without an
    id is neither earlier nor later than others.
    """
    prepare(docs.sparkSession)
    known = docs.where(col(id_).isNotNull() & col(text).isNotNull())
    marks = known.select(col(id_).cast("bigint").alias("id"), text).mapInArrow(_marks(window), "m long, id long")
    marks = stored(marks, "minimizers")
    repeated = marks.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where(col("n") > 1).select("m")
    wanted = marks.join(repeated, "m").groupBy("id").agg(F.collect_set("m").alias("wanted"))
    rows = _packed(known, id_, text).join(wanted, "id").select("id", "packed", "wanted")
    fragments = "m long, words binary, id long, row long, at int"
    fragments = stored(rows.mapInArrow(_fragments(window), fragments), "fragments")
    forget(marks)
    distinct = fragments.groupBy("m", "words").agg(F.min("id").alias("first"))
    distinct = stored(distinct.withColumn("key", F.xxhash64("words")), "distinct-fragments")
    found = least_ids(distinct, window)
    hits = fragments.select("m", F.xxhash64("words").alias("key"), "id", "row", "at").join(found, ["m", "key"])
    starts = F.filter(
        F.transform("least", lambda f, i: F.when(f < col("id"), col("at") + i)), lambda s: s.isNotNull()
    )
    hits = hits.select("id", "row", starts.alias("starts")).where(F.size("starts") > 0)
    return hits.groupBy("id", "row").agg(F.array_sort(F.flatten(F.collect_list("starts"))).alias("starts"))


def least_ids(distinct: DataFrame, window: int) -> DataFrame:
    """(m, key, least): for each window of the distinct fragments, the smallest id it starts in.

    The fragments of a minimizer go to one shard.  Where they are very many, as at the edge of a
    passage that very many documents share, each window is dealt by itself, and the fragments'
    results are put together again.
    """
    sizes = distinct.groupBy("m").agg(F.sum(F.octet_length("words")).alias("size"))
    crowded = sizes.where(col("size") > CROWD_BYTES).select("m")
    calm = distinct.join(crowded, "m", "left_anti")
    single = distinct.join(crowded, "m", "left_semi").select(
        "m", "key", "first", F.posexplode(_single_windows(window)(col("words"))).alias("i", "words")
    )
    single = stored(single.withColumn("route", F.xxhash64("m", "words")), "single-windows")
    alone = single.groupBy("route", "words").agg(F.min("first").alias("first"))
    shards = calm.select(col("m").alias("route"), "key", F.lit(False).alias("alone"), "words", "first").unionByName(
        alone.select("route", F.xxhash64("words").alias("key"), F.lit(True).alias("alone"), "words", "first")
    )
    shards = shards.repartition("route").sortWithinPartitions("route", "alone")
    found = shards.mapInArrow(_search(window), "route long, key long, alone boolean, least array<long>")
    found = stored(found, "least-ids")
    whole = found.where(~col("alone")).select(col("route").alias("m"), "key", "least")
    parts = single.select("m", "key", "i", "route", F.xxhash64("words").alias("k")).join(
        found.where("alone").select("route", col("key").alias("k"), "least"), ["route", "k"]
    )
    parts = parts.groupBy("m", "key").agg(F.array_sort(F.collect_list(F.struct("i", col("least")[0].alias("f")))).alias("w"))
    return whole.unionByName(parts.select("m", "key", F.transform("w", lambda x: x["f"]).alias("least")))


def _covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + window, minlength=n + 1)[: n + 1]
    return np.cumsum(edges)[:n] > 0


def _keep(window: int, schema: pa.Schema):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for id_, packed, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = unpack(packed.as_py())
                words = data.split()
                n = len(words)
                if spans:
                    row = xxhash.xxh3_64_intdigest(data) - (1 << 63)
                    for s in spans:
                        if s["row"] == row:
                            gone = _covered(np.array(s["starts"]), n, window)
                            words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words).decode("utf-8", "replace")
                for column, value in zip(out, (id_, n, n - len(words), kept)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return keep


def without_repeats(docs: DataFrame, id_: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept) per document; ``kept`` joins what is left by single spaces.

    A word goes if a window over it also starts in a document with a smaller id.  Windows are
    those of the input.  Null and empty texts have no words; a document without an id keeps all
    of its own; rows of one id never remove each other's words, repeated rows get equal results,
    other columns are ignored and an empty table gives an empty result.
    """
    found = repeated_windows(docs, id_, text, window)
    found = found.groupBy("id").agg(F.collect_list(F.struct("row", "starts")).alias("spans"))
    rows = _packed(docs.withColumn(id_, col(id_).cast("bigint")), id_, text).join(found, "id", "left")
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    out = rows.select("id", "packed", "spans").mapInArrow(_keep(window, schema), "id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_)
