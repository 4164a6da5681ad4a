"""The corpus pipeline: documents in, token ids of a clean and balanced selection out.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and returns a DataFrame,
which :func:`run` writes as Parquet to the shared folder and reads as the next one's documents.
All but the last keep the columns of ``documents`` and no others.

1. quality: documents below the classifier's threshold go.
2. near_duplicates: one document of each SimHash component stays.
3. secrets: spans that the scan finds are replaced by a mark in the text.
4. mixing: documents are taken to the target weights, once for each epoch that reaches them.
5. tokens: whole texts are encoded.

Null and empty texts, null ids, repeated rows, empty tables and further columns are handled as
each operator states; rows that are repeated are one document from the second stage on.  Texts of any
length pass whole, each within one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm import bpe, mixing, quality, secrets, simhash
from starforge.llm.common import stored
from starforge.llm.queries import GOOD, domain_of, production_mix, table, tokenizer_path

col = F.col

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select(*COLUMNS), machine, name="_score").where(col("_score") >= GOOD).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs.select(*COLUMNS), words=3, most_bits=3)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan(docs.select(*COLUMNS).withColumn("_text", col("text")), text="_text", keep=COLUMNS)
    # under a name of its own: Spark would take an alias "text" for the column within the lambdas
    found = found.withColumn("_hidden", F.when(col("text").isNotNull(), secrets.redacted(col("text"), col("spans"))))
    sized = F.when(F.size("spans") > 0, F.char_length("_hidden").cast("bigint")).otherwise(col("n_chars"))
    return found.select("doc_id", col("_hidden").alias("text"), "lang", "source", sized.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = docs.select(*COLUMNS).withColumn("_domain", domain_of(col("source")))
    mix = production_mix()
    mix = mixing.Mix(["_domain", *mix.levels[1:]], mix.weights, mix.share, mix.epochs, mix.seed)
    taken = mixing.mixed(own, mix, keep=COLUMNS)
    # once for every epoch that takes some of it
    times = F.ceil(col("tokens_taken") / F.greatest(col("n_tokens"), F.lit(1))).cast("int")
    return taken.withColumn("_epoch", F.explode(F.sequence(F.lit(0), times))).where(col("_epoch") > 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("tokens", encode),
]

# The classifier, the fingerprints' components and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
