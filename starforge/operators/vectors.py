"""Embeddings, the index of a text collection, and the context built from what a search finds."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions.batches import text_parts
from starforge.operators import loads
from starforge.operators.relational import keys_of
from starforge.operators.search import unit_rows

col = F.col

Encoder = Callable[[list[str]], np.ndarray]

# Words whose hash an encoder keeps.
KNOWN_WORDS = 1 << 14


# --------------------------------------------------------------------------- embedding


def hashing_encoder(dim: int = 384) -> Encoder:
    """Word counts hashed to ``dim`` signed buckets: a stand-in where no language model is at hand."""
    words = re.compile(r"\w+").findall
    hashed = lru_cache(KNOWN_WORDS)(lambda word: zlib.crc32(word.encode()))

    def encode(texts: list[str]) -> np.ndarray:
        found = [[hashed(w) for w in words(text.lower())] for text in texts]
        rows = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        hashes = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=len(rows))
        out = np.zeros((len(texts), dim))
        np.add.at(out, (rows, hashes % dim), np.where(hashes & 0x80000000, 1.0, -1.0))
        return out

    return encode


def embed(df: DataFrame, text: str, make_encoder: Callable[[], Encoder] = hashing_encoder, out: str = "embedding") -> DataFrame:
    """Add unit vectors of ``text``; the encoder is built once per task and called for parts of a batch."""

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = make_encoder()
        for texts in text_parts(batches):
            vectors = unit_rows(np.asarray(encoder([t or "" for t in texts]), dtype=np.float64)).astype(np.float32)
            ends = np.arange(len(texts) + 1, dtype=np.int32) * vectors.shape[1]
            yield pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))

    return df.withColumn(out, encode(col(text)))


def _carried(chunks: DataFrame) -> list[str]:
    return [c for c in ("chunk_id", "ticket_id", "category", "created_at") if c in chunks.columns]


def with_content(chunks: DataFrame) -> DataFrame:
    """Chunks with a hash of their text."""
    return chunks.withColumn("content", F.sha2(F.coalesce("text", F.lit("")), 256))


def build_index(chunks: DataFrame, make_encoder: Callable[[], Encoder] = hashing_encoder) -> DataFrame:
    """Vectors of chunks, with what a search may filter on and a hash of the text."""
    return embed(with_content(chunks), "text", make_encoder).select(*_carried(chunks), "content", "embedding")


def index_changes(
    index: DataFrame,
    chunks: DataFrame,
    parents: DataFrame,
    make_encoder: Callable[[], Encoder] = hashing_encoder,
    key: str = "chunk_id",
    parent: str = "ticket_id",
) -> tuple[DataFrame, DataFrame]:
    """What an edit of ``parents`` changes in an index: rows to insert or replace, and keys to drop.

    ``chunks`` are all chunks that the parents have now.  A chunk that kept its place and text is left
    alone.  A text that the index has anywhere, as when an insertion moves the chunks after it, keeps
    its vector; each other text is embedded once.
    """
    old = index.join(keys_of(parents, parent), parent, "left_semi")
    now = with_content(chunks)
    other = now.join(old.select(key, "content"), [key, "content"], "left_anti")
    # one vector per text, found among the texts that are wanted only
    have = index.join(keys_of(other, "content"), "content", "left_semi").groupBy("content").agg(F.first("embedding").alias("embedding"))
    missing = other.groupBy("content").agg(F.min("text").alias("text")).join(have.select("content"), "content", "left_anti")
    vectors = have.unionByName(embed(missing, "text", make_encoder).select("content", "embedding"))
    changed = other.select(*_carried(chunks), "content").join(vectors, "content").select(*_carried(chunks), "content", "embedding")
    return changed, old.select(key).join(now.select(key), key, "left_anti")


def update_index(index: DataFrame, fresh: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Insert new vectors and replace those of known chunks."""
    return loads.upsert(index, fresh, [key], [c for c in fresh.columns if c != key], [key])


# --------------------------------------------------------------------------- context for an answer


def with_text(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits with the text and response of their chunk."""
    return hits.join(chunks.select("chunk_id", "ticket_id", "category", "text", "response"), "chunk_id")


# Fixed value: what stands in for the context when nothing was found.
NO_HITS = "No related tickets were found."


def build_context(queries: DataFrame, hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """One context text per query, its hits in order of rank.

    A query has at most ``k`` hits, so a group stays small.
    """
    header = F.concat(
        F.lit("[Ticket #"), col("ticket_id"), F.lit(" | category="), col("category"), F.lit("]\nQ: "), col("text")
    )
    answer = F.when(F.length("response") > 0, F.concat(F.lit("\nResolution: "), col("response"))).otherwise("")
    entry = F.concat(header, answer)
    ordered = F.array_sort(F.collect_list(F.struct(col("rank"), entry.alias("entry"))))
    per_query = hits.groupBy(query_id).agg(F.array_join(ordered["entry"], "\n\n").alias("context"))
    joined = queries.select(query_id).join(per_query, query_id, "left")
    return joined.withColumn("context", F.coalesce("context", F.lit(NO_HITS)))


def sources(hits: DataFrame) -> DataFrame:
    """What is shown of each hit."""
    return hits.select(
        "query_id",
        "rank",
        "ticket_id",
        "category",
        F.round("score", 4).alias("score"),
        F.substring("text", 1, 300).alias("text"),
        F.substring(F.coalesce(col("response"), F.lit("")), 1, 300).alias("response"),
    )
