"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

Two fingerprints are samples of the same part of the hash range, so their overlap estimates
that of the shingle sets, however unequal the documents are, and the fingerprint of several
documents is the union of theirs.  A document without a hash below the fraction keeps its
smallest one.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import let, numbered, words_of

col = F.col

SHINGLE = 5
# One of so many hashes is retained.
ONE_IN = 8
# Documents whose neighbours are found together.
BLOCK = 256

_LOWEST = -(1 << 63)


def sketch(text: Column, shingle: int = SHINGLE, one_in: int = ONE_IN) -> Column:
    """Sorted hashes of a text's word shingles below 1 / ``one_in`` of the range.

    Fewer words than a shingle has are one shingle; no words have no hash.
    """
    limit = _LOWEST + (1 << 64) // one_in - 1

    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - shingle, F.lit(0))
        every = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, shingle)))
        every = F.when(F.size(words) > 0, every).otherwise(F.array().cast("array<bigint>"))
        return let(every, lambda h: retained(h, limit))

    return let(words_of(text), hashes)


def retained(hashes: Column, limit: int) -> Column:
    """What a fingerprint keeps of ``hashes``."""
    below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h <= limit)))
    smallest = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)
    return let(below, lambda b: F.when(F.size(b) > 0, b).otherwise(smallest))


def merged(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """The fingerprint of two documents' shingles together, from their fingerprints."""
    limit = _LOWEST + (1 << 64) // one_in - 1
    return let(F.array_union(a, b), lambda h: retained(h, limit))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both, 0 to 1; 1 for two empty fingerprints."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; 1 if ``a`` is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ",")


def with_next(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """(_id, _text, _next) of each document: its text and that of the next by descending id.

    After the last comes the first.  Documents without an id come last, several texts of one id
    in the order of their hashes; of repeated rows each is followed by the next copy.  Ids are
    numbered by themselves.  A text is shuffled twice: to its number, and to its block, where the
    first document of a block is also put at the end of the block before.
    """
    own = docs.select(
        col(id_).alias("_id"),
        col(text).alias("_text"),
        F.coalesce(id_, F.lit(0)).alias("_key"),
        F.xxhash64(text, col(id_).isNull()).alias("_hash"),
    )
    ids = own.groupBy("_key", "_hash").agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_copies"))
    ids = numbered(ids, [col("_id").desc_nulls_last(), col("_hash").desc()]).drop("_id")
    total = ids.count()
    texts = own.dropDuplicates(["_key", "_hash"]).join(ids, ["_key", "_hash"])
    again = F.when(col("_nr") == 0, F.lit(total)).when(col("_nr") % BLOCK == 0, col("_nr"))
    places = F.array_compact(
        F.array(
            F.struct(F.floor(col("_nr") / BLOCK).alias("block"), col("_nr").alias("nr"), F.lit(True).alias("own")),
            F.when(
                again.isNotNull(),
                F.struct(F.floor((again - 1) / BLOCK).alias("block"), again.alias("nr"), F.lit(False).alias("own")),
            ),
        )
    )
    placed = texts.select("_id", "_text", "_copies", F.explode(places).alias("_at"))
    placed = placed.select("_id", "_text", "_copies", "_at.*")
    # plain columns, as a struct would be built before the shuffle and move the text twice
    follower = F.lead("_text").over(Window.partitionBy("block").orderBy("nr"))
    paired = placed.withColumn("_next", F.coalesce(follower, col("_text"))).where("own")
    # a copy is followed by the next copy, the last one by the next document
    followers = F.concat(F.array_repeat("_text", (col("_copies") - 1).cast("int")), F.array("_next"))
    return paired.select("_id", "_text", F.explode(followers).alias("_next"))


def compared_with_edits(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has its last half, floor(n / 2) code points, replaced by the first as many
    of the next document by descending id (all, if it has fewer).  Returns id, n_chars, edited,
    sketch, edited_sketch, next_sketch.  A null text is an empty one.  A text of any length is sketched
    whole; a sketch has about an eighth of its shingles.  A text with no hash below the fraction, as
    a short one may be, keeps its smallest, so its likeness to others is 0 or 1; a larger fraction for
    short texts would make sketches that cannot be merged or compared.  Repeated rows follow each
    other in the order.  Other columns are ignored; an empty table gives an empty result.
    """
    plain = docs.select(col(id_), F.coalesce(text, F.lit("")).alias(text))
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(col("_text"), n - half), F.left(col("_next"), half))
    rows = with_next(plain, id_, text).withColumn("edited", edited)
    # sketched here rather than before the shuffles: they would add a quarter to what is moved
    return rows.select(
        col("_id").alias(id_),
        n.cast("long").alias("n_chars"),
        "edited",
        sketch(col("_text")).alias("sketch"),
        sketch(col("edited")).alias("edited_sketch"),
        sketch(col("_next")).alias("next_sketch"),
    )
