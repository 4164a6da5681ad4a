"""Exact duplicates of texts by a tree-merge of sorted runs of digests.

Every task of the input makes one run: its texts' digests, sorted, equal ones reduced to one entry
with the identifier that stays and the number of rows.  The runs are merged in rounds.  Runs have
numbers; written to the base f, round j replaces digit j of a run's number by digit j of the
digests, so a partition exchanges entries with the f partitions that differ in that digit, merges
what it gets from them, and reduces equal entries again.  After the last round a partition's
number is a part of its digests, and every digest is in one place.

An entry is sorted and dealt by a short digest.  Entries with the same short digest are one only
if a cryptographic digest and the length of their texts agree as well; this is verified whenever
entries meet, at every level.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import stored

col = F.col

# Runs that a merge takes at most.
FAN = 8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What two entries must share to be of one text.
SAME = ["digest", "proof", "size"]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def rounds_of(partitions: int, fan: int = FAN) -> tuple[int, int]:
    """(rounds, runs per merge), so that the merges together reach ``partitions`` runs or a few more."""
    rounds = 1
    while fan**rounds < partitions:
        rounds += 1
    width = 1
    while width**rounds < partitions:
        width += 1
    return rounds, max(2, width)


def digests(docs: DataFrame, id_: str, text: str, normalise) -> DataFrame:
    """(id, row, digest, proof, size) per row; ``row`` tells rows apart and holds the task's number."""
    rows = docs.select(col(id_).alias("id"), normalise(F.coalesce(col(text), F.lit(""))).alias("_t"))
    return rows.select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("_t").alias("digest"),
        F.unhex(F.sha2("_t", 256)).alias("proof"),
        F.octet_length("_t").alias("size"),
    )


def _merged(entries: DataFrame, partitions: int, best) -> DataFrame:
    """Entries sent to the partition their cell names, sorted there, equal ones reduced to one."""
    sent = entries.withColumn("cell", col("cell").cast("int")).repartitionById(partitions, col("cell"))
    runs = sent.sortWithinPartitions("cell", *SAME)
    return runs.groupBy("cell", *SAME).agg(best("best").alias("best"), F.sum("n").alias("n"))


def tree_merged(runs: DataFrame, rounds: int, width: int, best) -> DataFrame:
    """Entries of all runs, each text once, after ``rounds`` of merging ``width`` runs."""
    for done in range(1, rounds + 1):
        step = width**done
        fixed, left = F.pmod(col("digest"), F.lit(step)), col("cell") - col("cell") % step
        runs = _merged(runs.withColumn("cell", fixed + left), width**rounds, best)
    return runs


def duplicates(
    docs: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    keep: str = "largest",
    normalise=lower_ascii,
    fan: int = FAN,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) per row.

    Texts are equal when they are identical after ``normalise`` (A-Z in lower case).  Of equal texts
    the row with the ``largest`` or the ``smallest`` id stays.

    A null text counts as an empty one; empty texts are copies of each other.  Texts of any length
    are read once, as a whole, and only digests move.  Null ids lose to all others.  Of rows
    repeated with the id that stays, one is kept.  An empty table gives an empty result; other
    columns are ignored, whatever their names.

    A text shared by a third of all rows is one entry per run after the first step and an entry in
    ``width`` runs in any merge.  On the way back its verdict goes to the runs that hold it, and
    rows meet it by run and digest, so they are spread over as many places as there are runs.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    spark = docs.sparkSession
    rounds, width = rounds_of(int(spark.conf.get("spark.sql.shuffle.partitions")), fan)
    rows = stored(digests(docs, id_, text, normalise), "digests")
    rows = rows.withColumn("cell", F.pmod(F.shiftright("row", 33), F.lit(width**rounds)).cast("int"))
    best = F.max if keep == "largest" else F.min
    if keep == "largest":
        order = F.struct(col("id").isNotNull().alias("known"), "id", "row")
    else:
        order = F.struct(col("id").isNull().alias("unknown"), "id", "row")
    runs = _merged(rows.select("cell", *SAME, order.alias("best"), F.lit(1).cast("bigint").alias("n")), width**rounds, best)
    whole = tree_merged(runs, rounds, width, best).where(col("n") > 1).drop("cell")
    verdicts = runs.select("cell", *SAME).join(whole, SAME)
    joined = rows.join(verdicts, ["cell", *SAME], "left")
    return joined.select(
        col("id").alias(id_),
        F.when(col("n").isNull(), col("id")).otherwise(col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(col("best.row") == col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("proof")).alias("text_sha256"),
    )
