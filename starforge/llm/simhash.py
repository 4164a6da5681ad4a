"""SimHash near-duplicates through an index of fingerprint bytes by position.

Two 64-bit fingerprints at ``d`` <= 3 differing bits differ in at most three of their eight
bytes, so at least five bytes agree at their position.  Lists for single bytes would hold a
256th of all fingerprints each, so the index is keyed by four positional bytes: any five of
eight positions contain one of the few sets of :func:`position_sets`, which brings every linked
pair together.  In a bucket the bytes that a pair shares are tallied, pairs below the guaranteed
five are dropped, and the rest is verified by its differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import components, in_blocks, pairs_of_groups, prepare, spanning, stored, whole_groups

col = F.col

SEED = 42
BYTES = 8
# Distinct fingerprints of a bucket that one task compares with as many others.
BLOCK = 512


def position_sets(agree: int, size: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions such that any ``agree`` positions contain one of them.

    Chosen greedily, so that few sets cover all choices of ``agree`` positions.
    """
    open_ = {c for c in combinations(range(BYTES), agree)}
    sets = list(combinations(range(BYTES), size))
    chosen = []
    while open_:
        best = max(sets, key=lambda s: sum(set(s) <= set(c) for c in open_))
        chosen.append(best)
        open_ = {c for c in open_ if not set(best) <= set(c)}
    return chosen


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """The fingerprint of a text as a signed 64-bit number; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    # shingles are slices of the words joined by single spaces
    ends = np.cumsum([len(w) + 1 for w in words])
    last = min(words_per_shingle, len(words)) - 1
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[last : last + n] - 1).tolist()
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for s in range(0, n, 65536):
        part = zip(starts[s : s + 65536], stops[s : s + 65536])
        hashes = np.array([digest(line[a:b], SEED) for a, b in part], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, name: str = "_fp") -> DataFrame:
    """Add the fingerprint column.  Only the text goes to Python."""
    prepare(docs.sparkSession)

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())

    return docs.withColumn(name, of(col(text)))


def _links_in_buckets(most_bits: int, agree: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, ["k", "_i", "_j"]):
            fps = table.column("fp").to_numpy()
            part, low, high = (table.column(c).to_numpy() for c in ("_part", "_i", "_j"))
            for x, y in pairs_of_groups(first, part, low, high):
                differ = fps[x] ^ fps[y]
                shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
                near = shared >= agree
                x, y, differ = x[near], y[near], differ[near]
                near = np.bitwise_count(differ.view(np.uint64)) <= most_bits
                a, b = fps[x[near]], fps[y[near]]
                if len(a):
                    kept = spanning(a, b)
                    yield pa.RecordBatch.from_arrays([pa.array(a[kept]), pa.array(b[kept])], ["a", "b"])

    return links


def near_links(prints: DataFrame, most_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at ``most_bits`` or fewer.

    Of the links within a block only a spanning set is given, never all pairs of a group.
    """
    agree = BYTES - most_bits
    if not 4 <= agree < BYTES:
        raise ValueError("between one and four differing bits are supported")
    sets = position_sets(agree, 4)
    masks = [sum(0xFF << (8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(n), col("fp").bitwiseAND(F.lit(m))) for n, m in enumerate(signed)])
    keyed = prints.select("fp", F.explode(keys).alias("k"))
    placed = in_blocks(keyed, ["k"], "fp", block)
    return placed.select("k", "_i", "_j", "_part", "fp").mapInArrow(_links_in_buckets(most_bits, agree), "a long, b long")


def _rooted(docs: DataFrame, id_: str, text: str, words: int, most_bits: int, extra: list) -> DataFrame:
    """(_id, fp, extra columns, root, component_id) per document."""
    own = docs.select(col(id_).alias("_id"), col(text).alias("_text"), *extra)
    prints = stored(with_fingerprint(own, "_text", words, "fp").drop("_text"), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("_id").alias("first"))
    roots = components(near_links(prints.select("fp").distinct(), most_bits))
    rooted = classes.join(roots, col("fp") == col("node"), "left")
    rooted = stored(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")), "classes")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", words: int = 3, most_bits: int = 3
) -> DataFrame:
    """(id, fingerprint, component_id) per document.

    Documents with equal fingerprints are one class; classes link at ``most_bits`` differing
    bits or fewer, and ``component_id`` is the smallest id reachable.  Null and empty texts have
    fingerprint zero and link like any other.  A document without an id gets its component's
    smallest id, which is null if no member has one.  Repeated rows each get their row.  A text of
    any length is read whole, once, where it lies; only fingerprints move.  An empty table gives an
    empty result, and other columns are ignored.
    """
    found = _rooted(docs, id_, text, words, most_bits, [])
    return found.select(col("_id").alias(id_), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", words: int = 3, most_bits: int = 3
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Rows without an id stay only where no other member has one; of several rows with that id the
    one with the lowest hash stays, repeated rows once.
    """
    row = [F.xxhash64(F.lit(n), *docs.columns) for n in (1, 2)]
    found = _rooted(docs, id_, text, words, most_bits, [row[0].alias("_r1"), row[1].alias("_r2")])
    best = F.min(F.struct(col("_id").isNull(), "_id", "_r1", "_r2")).alias("best")
    kept = found.groupBy("root").agg(best).select(col("best._r1").alias("_r1"), col("best._r2").alias("_r2"))
    # repeated rows collapse before the shuffle, which the join then shares
    whole = docs.select(F.struct(*docs.columns).alias("whole"), row[0].alias("_r1"), row[1].alias("_r2"))
    single = whole.dropDuplicates(["_r1", "_r2"])
    return single.join(kept, ["_r1", "_r2"], "left_semi").select("whole.*")
