"""Stored tables: versioned parquet tables, batch-scoped staging tables, and plain sinks."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions.columns import now
from starforge.operators import loads
from starforge.operators.relational import all_known, keys_of, union_all
from starforge.session import cut_lineage
from starforge.sources import keyfiles


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order; nothing if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all as far as readers of its name can tell."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    stream.write(text.encode())
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text


# --------------------------------------------------------------------------- plain sinks


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Store a query result as a new table; an existing one is an error."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# --------------------------------------------------------------------------- versioned tables


# Changes that lie beside a version before it is compacted.
MOST_CHANGES = 16


@dataclass
class Table:
    """A parquet table in versions, with batches and changes beside the current one.

    A version is a folder ``v<n>``, an appended batch a folder ``v<n>.<id>`` next to it.  Either
    counts once its write job has committed, or, if it was staged together with others, once
    their common marker exists; so readers see a write as a whole or not at all.  With
    ``partition_by``, rows are balanced over tasks before they are written, so that a large
    partition gets several files and a small one does not get many.

    A change is a batch that stands in place of the rows with its keys in the folders that were
    there when it was made; ``changes/<folder>`` has these keys.  Changes are folded in when the
    table is read, and :meth:`compact` writes the next version without them.  With ``keys``, the
    key ranges and Bloom filters of a folder's files are stored in ``keys/<folder>``, and look-ups
    by these keys open only files that may hold one.
    """

    spark: SparkSession
    path: str
    schema: T.StructType | None = None
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    # an upsert of more than this share of the table writes the next version
    rewrite_share: float = 0.25

    def _counts(self, folder: str) -> bool:
        if exists(self.spark, f"{folder}/_SUCCESS"):
            return True
        staged = f"{folder}/_commit"
        return exists(self.spark, staged) and exists(self.spark, read_text(self.spark, staged))

    def _folders(self) -> dict[int, list[str]]:
        """Folders that count, by version, the version itself first."""
        found: dict[int, list[str]] = {}
        for name in names(self.spark, self.path):
            number = name[1:].split(".")[0]
            if name.startswith("v") and number.isdigit() and self._counts(f"{self.path}/{name}"):
                found.setdefault(int(number), []).append(name)
        return {n: folders for n, folders in sorted(found.items()) if f"v{n}" in folders}

    def exists(self) -> bool:
        return bool(self._folders())

    def read(self) -> DataFrame:
        versions = self._folders()
        if not versions:
            if self.schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], self.schema)
        latest = versions[max(versions)]
        return self._folded({folder: self._read_folder(folder) for folder in latest})

    def _changes(self, folders: list[str]) -> list[tuple[str, dict]]:
        """(folder, what it stands in place of) of the changes among ``folders``, the earliest first."""
        known = ((f, f"{self.path}/changes/{f}.json") for f in folders)
        found = [(f, json.loads(read_text(self.spark, about))) for f, about in known if exists(self.spark, about)]
        return sorted(found, key=lambda change: len(change[1]["over"]))

    def _folded(self, parts: dict[str, DataFrame]) -> DataFrame:
        """The rows of all folders but those that a later change stands in place of."""
        changes = self._changes(list(parts))
        if not changes:
            return union_all(list(parts.values()))
        # the number of the last change that a folder is not below; only later ones concern it
        above = {f: max([n for n, (_, c) in enumerate(changes, 1) if f not in c["over"]], default=0) for f in parts}
        rows = union_all([part.withColumn("_after", F.lit(above[f])) for f, part in parts.items()])
        for keys in sorted({tuple(c["keys"]) for _, c in changes}):
            numbered = [(n, f) for n, (f, c) in enumerate(changes, 1) if tuple(c["keys"]) == keys]
            replaced = [self.spark.read.parquet(f"{self.path}/changes/{f}").withColumn("_change", F.lit(n)) for n, f in numbered]
            last = union_all(replaced).groupBy(*keys).agg(F.max("_change").alias("_change"))
            complete = all_known(keys)
            kept = rows.where(complete).join(last, list(keys), "left").where(F.col("_change").isNull() | (F.col("_change") <= F.col("_after")))
            rows = kept.select(*rows.columns).unionByName(rows.where(~complete))
        return rows.drop("_after")

    def _holding(self, wanted: DataFrame, keys: list[str]) -> DataFrame:
        """The table's rows that may have a key of ``wanted``; files that cannot are not opened."""
        versions = self._folders()
        latest = versions[max(versions)]
        if tuple(keys) != tuple(self.keys):
            return self.read()
        wanted = cut_lineage(wanted.where(all_known(keys)).distinct())
        described = {f: f"{self.path}/keys/{f}" for f in latest if exists(self.spark, f"{self.path}/keys/{f}/bits/_SUCCESS")}
        files = keyfiles.candidates(self.spark, list(described.values()), wanted, keys)
        return self._folded({f: self._read_folder(f, only=keyfiles.below(files, f) if f in described else None) for f in latest})

    def _read_folder(self, folder: str, schema: T.StructType | None = None, only: list[str] | None = None) -> DataFrame:
        """A partitioned folder is read with the schema it was written with, as it may hold no file.

        ``only`` names the files to read; by default all.
        """
        known = f"{self.path}/_schema-{folder}"
        if schema is None and exists(self.spark, known):
            schema = T.StructType.fromJson(json.loads(read_text(self.spark, known)))
        place = f"{self.path}/{folder}"
        whole = (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(place)
        if only is None:
            return whole
        if not only:
            return self.spark.createDataFrame([], whole.schema)
        return self.spark.read.schema(whole.schema).option("basePath", place).parquet(*[f"{place}/{file}" for file in only])

    def _write(self, df: DataFrame, folder: str, committed: bool = True) -> None:
        if self.partition_by:
            df = df.hint("rebalance", *self.partition_by)
            write_text(self.spark, f"{self.path}/_schema-{folder}", df.schema.json())
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.partition_by)
        if not committed:
            writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        writer.parquet(f"{self.path}/{folder}")
        if self.keys and committed:
            stored = self._read_folder(folder, df.schema)
            keyfiles.write(stored, list(self.keys), f"{self.path}/{folder}", f"{self.path}/keys/{folder}")

    def overwrite(self, df: DataFrame) -> None:
        """Write the next version; ``df`` may read the current one."""
        # a failed attempt at this number is replaced
        self._write(df, f"v{max(self._folders(), default=0) + 1}")

    def _next_batch(self) -> str:
        versions = self._folders()
        return f"v{max(versions)}.{uuid.uuid4().hex[:12]}" if versions else "v1"

    def append(self, df: DataFrame) -> None:
        """Add rows to the current version; they appear when the write job commits."""
        self._write(df, self._next_batch())

    def stage(self, df: DataFrame, marker: str) -> str:
        """Write rows that count once the file ``marker`` exists; returns their folder."""
        folder = self._next_batch()
        known = f"{self.path}/{folder}/_commit"
        if exists(self.spark, known) and read_text(self.spark, known) == marker:
            folder = f"{folder}.{uuid.uuid4().hex[:12]}"  # a second batch for a table that is not there yet
        self._write(df, folder, committed=False)
        write_text(self.spark, f"{self.path}/{folder}/_commit", marker)
        return folder

    def staged(self, folder: str, schema: T.StructType) -> DataFrame:
        return self._read_folder(folder, schema)

    def publish(self, marker: str) -> None:
        """Let everything that was staged under ``marker`` count."""
        write_text(self.spark, marker, "committed")

    def discard(self, folder: str) -> None:
        remove(self.spark, f"{self.path}/{folder}")

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the newest versions, with what was appended to the others."""
        for folders in list(self._folders().values())[:-keep]:
            for folder in folders:
                for place in (folder, f"keys/{folder}", f"changes/{folder}", f"changes/{folder}.json"):
                    remove(self.spark, f"{self.path}/{place}")

    def insert_new(self, src: DataFrame, keys: list[str], order: list[str]) -> None:
        """Append the rows with new keys to the current version; nothing is rewritten.

        A repeat after a crash adds only what is still missing.
        """
        target = self._holding(src.select(*keys), keys) if self.exists() else src.limit(0)
        fresh = loads.new_rows(target, src, keys, order)
        known = [c for c in src.columns if c in target.columns]
        self.append(target.limit(0).unionByName(fresh.select(*known), allowMissingColumns=True))

    def upsert(self, src: DataFrame, keys: list[str], update: list[str], order: list[str]) -> None:
        """Insert or update as :func:`starforge.operators.loads.upsert`, by one writer at a time.

        What is written is a change: the rows with the keys of ``src`` as they are now.  A change
        that is large beside the table, or one too many, makes the next version instead.
        """
        if not self.exists():
            return self.overwrite(loads.upsert(self.read(), src, keys, update, order))
        folders = self._folders()
        over = folders[max(folders)]
        wanted = cut_lineage(src.select(*keys).where(all_known(keys)).distinct())
        stored = union_all([self._read_folder(f).select(*keys) for f in over]).count()
        if wanted.count() > self.rewrite_share * stored or len(self._changes(over)) >= MOST_CHANGES:
            return self.overwrite(loads.upsert(self.read(), src, keys, update, order))
        touched = self._holding(wanted, keys).join(wanted, keys, "left_semi")
        self._change(wanted, keys, loads.upsert(touched, src, keys, update, order), over)

    def _change(self, wanted: DataFrame, keys: list[str], rows: DataFrame, over: list[str]) -> None:
        """Store ``rows`` in place of those of the folders ``over`` with a key of ``wanted``."""
        folder = self._next_batch()
        # nothing of this counts until the rows have been written
        wanted.write.parquet(f"{self.path}/changes/{folder}")
        write_text(self.spark, f"{self.path}/changes/{folder}.json", json.dumps({"over": over, "keys": keys}))
        self._write(rows, folder)

    def delete(self, gone: DataFrame, keys: list[str]) -> None:
        """Drop the rows with a key of ``gone``, by one writer at a time: a change without rows."""
        if self.exists():
            folders = self._folders()
            wanted = gone.select(*keys).where(all_known(keys)).distinct()
            self._change(wanted, keys, self.read().limit(0), folders[max(folders)])

    def compact(self) -> None:
        """Write the next version with all batches and changes folded in."""
        self.overwrite(self.read())

    def full_refresh(self, src: DataFrame) -> None:
        self.overwrite(src)


def upsert_partitions(
    spark: SparkSession, path: str, src: DataFrame, keys: list[str], order: list[str], part: str
) -> None:
    """Upsert whole rows into a large parquet table partitioned by ``part``.

    Only partitions that hold an old or a new row of the batch are read in full and
    rewritten.  A repeat after a crash gives the same table.
    """
    if not exists(spark, path):
        latest = loads.upsert(src.limit(0), src, keys, src.columns, order)
        latest.write.partitionBy(part).parquet(path)
        return
    target = spark.read.parquet(path)
    old = target.select(*keys, part).join(keys_of(src, *keys), keys, "left_semi").select(part)
    touched = [r[0] for r in old.union(src.select(part)).distinct().collect()]  # partition values only
    before = target.where(F.col(part).isin(touched))
    update = [c for c in src.columns if c not in keys]
    after = cut_lineage(loads.upsert(before, src, keys, update, order))
    after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    left = {r[0] for r in after.select(part).distinct().collect()}
    for value in touched:
        if value not in left:
            remove(spark, f"{path}/{part}={quote(str(value), safe=' -_.')}")


# --------------------------------------------------------------------------- batch staging


@dataclass
class Staging:
    """Rows staged per batch, one directory each, so that a retry replaces only its own batch."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def _dir(self, batch_id: str) -> str:
        return f"{self.path}/batch_id={quote(batch_id, safe='')}"

    def replace_batch(self, df: DataFrame, batch_id: str, staged_at=None) -> None:
        """Delete-then-insert of one batch; an empty batch leaves none of the old rows."""
        stamp = now(staged_at)
        df.withColumn("staged_at", stamp).write.mode("overwrite").parquet(self._dir(batch_id))

    def read(self) -> DataFrame:
        stamp, batch = T.StructField("staged_at", T.TimestampNTZType()), T.StructField("batch_id", T.StringType())
        schema = T.StructType([*self.schema.fields, stamp, batch])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read_batch(self, batch_id: str) -> DataFrame:
        """Rows of one batch; other batches' directories are not listed into the scan."""
        return self.read().where(F.col("batch_id") == batch_id)

    def drop_batch(self, batch_id: str) -> None:
        remove(self.spark, self._dir(batch_id))


def clean_up(stagings: list[Staging], batch_id: str) -> None:
    """Remove a finished batch from every staging table."""
    for s in stagings:
        s.drop_batch(batch_id)
