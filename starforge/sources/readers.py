"""Readers: CSV, raw landing, tables, and JSON documents."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators.movies import MOVIE_SCHEMA
from starforge.sources.records import csv_records

col = F.col

CSV_OPTIONS = {"header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """CSV with a header; an empty field is NULL; a field that does not fit its type is an error.

    With ``line_breaks``, quoted fields may span lines; a large file is read by many tasks all the same.
    """
    if line_breaks:
        return _parsed(csv_records(spark, path), schema, {**CSV_OPTIONS, "mode": "FAILFAST"}).select("row.*")
    return spark.read.schema(schema).options(**CSV_OPTIONS, mode="FAILFAST").csv(path)


def _parsed(records: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    return records.select("file", F.from_csv("record", ", ".join(names), {**options, "multiLine": "true", "header": "false"}).alias("row"))


def land_csv(
    spark: SparkSession, path: str, columns: list[str], load_ts: Column, optional: tuple[str, ...] = ("response",)
) -> DataFrame:
    """CSV as text, with the file it came from and the load time.

    Empty fields stay empty text, except in ``optional`` columns, where they become NULL.
    Fields may span lines; a large file is read by many tasks all the same.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = _parsed(csv_records(spark, path), schema, {**CSV_OPTIONS, "nullValue": "\u0000"})
    field = {c: col("row")[c] for c in columns}
    return raw.select(
        *[(F.nullif(f, F.lit("")) if c in optional else F.coalesce(f, F.lit(""))).alias(c) for c, f in field.items()],
        F.substring_index(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), "/", -1).alias("source"),
        load_ts.alias("ingested_at"),
    )


def scan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the named columns are read."""
    return spark.read.parquet(path).select(*columns)


def scan_jdbc(
    spark: SparkSession, url: str, table: str, columns: list[str], split_on: str, low: int, high: int, parts: int
) -> DataFrame:
    """A database table in ``parts`` ranges of an integer column, read in parallel."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_on, lowerBound=low, upperBound=high, numPartitions=parts
    )
    return reader.load().select(*columns)


def land_raw(sources: dict[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """Copy tables as they are; every run replaces the copies.

    The write jobs run side by side, as small tables do not fill a cluster.
    """

    def land(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, df = item
        df.write.mode("overwrite").parquet(f"{target}/{name}")
        return name, df.sparkSession.read.parquet(f"{target}/{name}")

    with ThreadPoolExecutor(8) as pool:
        return dict(pool.map(land, sources.items()))


def read_movies(spark: SparkSession, path: str, pattern: str = "tt*.json", whole_files: bool = True) -> DataFrame:
    """Movie documents, one per file (or one per line); search listings do not match the pattern."""
    return (
        spark.read.schema(MOVIE_SCHEMA)
        .option("multiLine", whole_files)
        .option("pathGlobFilter", pattern)
        .json(path)
    )
