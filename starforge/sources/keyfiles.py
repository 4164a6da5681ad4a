"""What is known of the keys in the files of a batch, so that a look-up opens few of them.

Beside a batch lie two small tables: per file its number of keys and their smallest and largest,
and a Bloom filter cut into buckets of 32,768 bits.  A key sets ``HASHES`` bits of one bucket, so
whether a file may hold it is seen in one row.  A file passes if a key of the look-up lies in its
range and, for look-ups that are small enough, if the filter has a key's bits.  A batch without
these tables is read as a whole; they decide what is read, never what is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.operators.relational import all_known

col = F.col

# Bits of a bucket, as Spark's bitmaps have them; bits per key; bits that a key sets.
BUCKET, PER_KEY, HASHES = 32768, 16, 4

# Ranges that stand for the keys of a look-up, and tests of a key with a file at most.
RANGES, MOST_TESTS = 64, 1 << 30


def _hash(number: int, keys: list[str]) -> Column:
    return F.xxhash64(F.lit(number), *keys)


def _bits(keys: list[str]) -> Column:
    return F.array(*[F.pmod(_hash(n, keys), F.lit(BUCKET)) for n in range(1, HASHES + 1)])


def with_file(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with the path of their file, from the name of ``folder`` on."""
    name = folder.rstrip("/").split("/")[-1]
    # the path is that of a URI, where a plus sign stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.withColumn("_file", F.concat(F.lit(f"{name}/"), F.substring_index(path, f"/{name}/", -1)))


def write(rows: DataFrame, keys: list[str], folder: str, path: str) -> None:
    """Describe the keys of the stored ``rows`` of ``folder`` in ``path``; rows without a full key are left out."""
    known = with_file(rows, folder).where(all_known(keys)).select("_file", *keys)
    key = F.struct(*keys)
    # powers of two, so that all files of a table share few sizes
    buckets = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.count(F.lit(1)) * PER_KEY / BUCKET)))).cast("long")
    files = known.groupBy("_file").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), buckets.alias("buckets"))
    files.write.mode("overwrite").parquet(f"{path}/files")
    sizes = rows.sparkSession.read.parquet(f"{path}/files").select("_file", "buckets")
    placed = known.join(sizes, "_file").select("_file", "buckets", F.pmod(_hash(0, keys), "buckets").alias("bucket"), F.explode(_bits(keys)).alias("bit"))
    bitmaps = placed.groupBy("_file", "buckets", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    bitmaps.write.mode("overwrite").parquet(f"{path}/bits")


def _is_set(bitmap: Column, bit: Column) -> Column:
    """Byte ``bit / 8`` holds it, its lowest bit first."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) > 0


def candidates(spark: SparkSession, paths: list[str], wanted: DataFrame, keys: list[str]) -> list[str]:
    """Files of the batches described in ``paths`` that may hold a key of ``wanted``, distinct keys without nulls.

    The driver gets the files' names, which a scan of them needs.
    """
    if not paths:
        return []
    files = spark.read.parquet(*[f"{path}/files" for path in paths])
    key = F.struct(*keys)
    dealt = wanted.repartitionByRange(RANGES, *keys).groupBy(F.spark_partition_id().alias("_range"))
    ranges = dealt.agg(F.min(key).alias("from"), F.max(key).alias("to"))  # a row per range
    near = files.join(F.broadcast(ranges), (col("lo") <= col("to")) & (col("hi") >= col("from")), "left_semi")
    sizes = {r["_file"]: r["buckets"] for r in near.select("_file", "buckets").collect()}
    if not sizes or wanted.count() * len(sizes) > MOST_TESTS:
        return sorted(sizes)
    asked = wanted.select(_hash(0, keys).alias("h"), _bits(keys).alias("bits"))
    asked = asked.withColumn("buckets", F.explode(F.lit(sorted(set(sizes.values()))).cast("array<long>")))
    asked = asked.withColumn("bucket", F.pmod("h", "buckets"))
    bitmaps = spark.read.parquet(*[f"{path}/bits" for path in paths]).join(near.select("_file"), "_file", "left_semi")
    hit = F.forall("bits", lambda b: _is_set(col("bitmap"), b))
    found = bitmaps.join(asked, ["buckets", "bucket"]).where(hit).select("_file").distinct()
    return sorted(r["_file"] for r in found.collect())


def below(files: list[str], folder: str) -> list[str]:
    """The paths below ``folder`` of its files."""
    return [f[len(folder) + 1 :] for f in files if f.startswith(f"{folder}/")]
