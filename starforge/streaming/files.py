"""Loading daily files exactly once, with a ledger of what was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators import loads
from starforge.session import cut_lineage
from starforge.sources import keyfiles
from starforge.sources.readers import CSV_OPTIONS
from starforge.sources.tables import exists, names

# Fixed value: daily files are named rides_YYYYMMDD.csv.
DAILY_FILE = r"rides_(\d{8})\.csv"

_BAD = "_bad_record"


def _file_name(path: str, pattern: str):
    """The last part of a path, if all of it has the shape of a daily file's name."""
    return F.regexp_extract(path, rf"(?:^|/)({pattern})$", 1)


def pending_files(spark: SparkSession, path: str, ledger: DataFrame, pattern: str = DAILY_FILE) -> DataFrame:
    """(filename, day) of the files not in the ledger, in order of the day in their name.

    Only the listing is read, not the content.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(_file_name("path", pattern).alias("filename"))
        .where(F.col("filename") != "")
        .withColumn("day", F.to_date(F.regexp_extract("filename", pattern, 1), "yyyyMMdd"))
    )
    return files.join(ledger.select("filename"), "filename", "left_anti").orderBy("day", "filename")


class DailyLoad:
    """Streams the files of a folder into ``rows``; a file is loaded once, an id stays single.

    Rows, rejected lines and ledger entries of a micro-batch go into directories named after its
    number.  If a run dies, the next one repeats that micro-batch and replaces them.  A line with
    a field that does not fit its type is rejected as a whole and counted in the ledger; a file
    without lines gets an entry too.  Of several rows with an id the first by file name counts,
    within a file the smallest, so that a repeat decides alike.
    """

    def __init__(self, spark: SparkSession, source: str, root: str, schema: T.StructType, key: str, pattern: str = DAILY_FILE):
        self.spark, self.source, self.schema, self.key, self.pattern = spark, source, schema, key, pattern
        self.rows_dir, self.ledger_dir, self.checkpoint = f"{root}/rows", f"{root}/ledger", f"{root}/checkpoint"
        self.rejected_dir, self.keys_dir = f"{root}/rejected", f"{root}/keys"

    def _before(self, wanted: DataFrame, epoch: int) -> DataFrame:
        """What earlier micro-batches stored in files that may hold a key of ``wanted``."""
        known = [f for f in names(self.spark, self.rows_dir) if f.startswith("epoch=") and int(f[6:]) < epoch]
        described = [f for f in known if exists(self.spark, f"{self.keys_dir}/{f}/bits/_SUCCESS")]
        files = keyfiles.candidates(self.spark, [f"{self.keys_dir}/{f}" for f in described], wanted, [self.key])
        paths = [f"{self.rows_dir}/{f}" for f in [*files, *(f for f in known if f not in described)]]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _load(self, batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        keep = [f.name for f in self.schema.fields]
        good = batch.where(F.col(_BAD).isNull()).drop(_BAD)
        wanted = cut_lineage(good.select(self.key).where(F.col(self.key).isNotNull()).distinct())
        fresh = loads.new_rows(self._before(wanted, epoch), good, [self.key], ["filename", *keep])
        folder = f"{self.rows_dir}/epoch={epoch}"
        fresh.select(*keep).write.mode("overwrite").parquet(folder)
        stored = self.spark.read.schema(self.schema).parquet(folder)
        keyfiles.write(stored, [self.key], folder, f"{self.keys_dir}/epoch={epoch}")
        bad = batch.where(F.col(_BAD).isNotNull()).select("filename", F.col(_BAD).alias("record"))
        bad.write.mode("overwrite").parquet(f"{self.rejected_dir}/epoch={epoch}")
        entries = batch.groupBy("filename").agg(
            F.localtimestamp().alias("processed_at"),
            F.count_if(F.col(_BAD).isNull()).alias("row_count"),
            F.count(_BAD).alias("rejected_count"),
        )
        entries.write.mode("overwrite").parquet(f"{self.ledger_dir}/epoch={epoch}")
        batch.unpersist()

    def run(self) -> None:
        """Load every file that is new since the last run, then stop."""
        # files that are here now are part of this run, whether they have lines or not
        listed = cut_lineage(pending_files(self.spark, self.source, self.ledger(), self.pattern).select("filename"))
        schema = T.StructType([*self.schema.fields, T.StructField(_BAD, T.StringType())])
        stream = (
            self.spark.readStream.schema(schema)
            .options(**CSV_OPTIONS, recursiveFileLookup="true", mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
            .csv(self.source)
            .withColumn("filename", _file_name("_metadata.file_path", self.pattern))
            .where(F.col("filename") != "")
        )
        run = (
            stream.writeStream.foreachBatch(self._load)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
        empty = listed.join(self.ledger().select("filename"), "filename", "left_anti").select(
            "filename",
            F.localtimestamp().alias("processed_at"),
            F.lit(0).cast("bigint").alias("row_count"),
            F.lit(0).cast("bigint").alias("rejected_count"),
        )
        empty.write.mode("append").parquet(f"{self.ledger_dir}/epoch=-1")

    def _stored(self, path: str, schema: str | T.StructType) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).drop("epoch")

    def rows(self) -> DataFrame:
        return self._stored(self.rows_dir, self.schema)

    def rejected(self) -> DataFrame:
        return self._stored(self.rejected_dir, "filename string, record string")

    def ledger(self) -> DataFrame:
        schema = "filename string, processed_at timestamp_ntz, row_count bigint, rejected_count bigint"
        return self._stored(self.ledger_dir, schema)
