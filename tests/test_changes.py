"""Changes merged on read, and look-ups that open only files that may hold a key."""

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.operators import loads
from starforge.session import scratch_path
from starforge.sources import keyfiles, tables

col = F.col
SCHEMA = "id int, v string, w int, seq int"


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def batch(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed, keys", [(1, ()), (2, ("id",)), (3, ("id",))])
def test_any_order_of_writes_gives_what_rewriting_gives(spark, seed, keys):
    rng = random.Random(seed)
    table = tables.Table(spark, scratch_path(spark, "t"), keys=keys, rewrite_share=9.0)
    now = batch(spark, [(i, f"v{i}", 0, 0) for i in range(20)] + [(None, "keyless", 0, 0)])
    table.overwrite(now)
    now = spark.createDataFrame(now.collect(), SCHEMA)
    for step in range(1, 6):
        new = [(rng.choice([rng.randrange(30), rng.randrange(30), None]), f"s{step}-{k}", step, k) for k in range(6)]
        src = batch(spark, new)
        kind = rng.choice(["upsert", "part", "insert", "append", "compact"])
        if kind in ("upsert", "part"):
            update = ["v", "w", "seq"] if kind == "upsert" else ["v"]
            table.upsert(src, ["id"], update, ["seq"])
            now = loads.upsert(now, src, ["id"], update, ["seq"])
        elif kind == "insert":
            table.insert_new(src, ["id"], ["seq"])
            now = loads.insert_new(now, src, ["id"], ["seq"])
        elif kind == "append":
            table.append(src)
            now = now.unionByName(src)
        else:
            table.compact()
        now = spark.createDataFrame(now.collect(), SCHEMA)
        assert rows(table.read().select(*now.columns)) == rows(now)


def test_an_upsert_writes_what_changes(spark):
    table = tables.Table(spark, scratch_path(spark, "t"))
    big = spark.range(200_000).select(col("id"), F.sha2(col("id").cast("string"), 256).alias("v"), F.lit(0).alias("seq"))
    table.overwrite(big)
    before = written(table.path)
    table.upsert(big.where("id % 100 = 7").withColumn("v", F.lit("new")).withColumn("seq", F.lit(1)), ["id"], ["v", "seq"], ["seq"])
    assert written(table.path) - before < 0.02 * before
    assert table.read().count() == 200_000 and table.read().where("v = 'new'").count() == 2000
    table.compact()
    assert table.read().where("v = 'new'").count() == 2000 and len(table._folders()[2]) == 1
    table.vacuum(keep=1)
    assert table.read().count() == 200_000 and tables.names(spark, f"{table.path}/changes") == []


def test_a_large_change_and_many_changes_make_a_version(spark, monkeypatch):
    monkeypatch.setattr(tables, "MOST_CHANGES", 2)
    table = tables.Table(spark, scratch_path(spark, "t"))
    table.overwrite(batch(spark, [(i, "a", 0, 0) for i in range(40)]))
    table.upsert(batch(spark, [(i, "b", 0, 1) for i in range(30)]), ["id"], ["v"], ["seq"])
    assert list(table._folders()) == [1, 2]
    for step in range(3):
        table.upsert(batch(spark, [(step, "c", 0, 1)]), ["id"], ["v"], ["seq"])
    assert list(table._folders()) == [1, 2, 3]
    assert rows(table.read().groupBy("v").count()) == [("a", 10), ("b", 27), ("c", 3)]


def test_a_change_counts_as_a_whole(spark):
    """A crash after the keys were written, and before the rows were, changes nothing."""
    table = tables.Table(spark, scratch_path(spark, "t"), rewrite_share=9.0)
    table.overwrite(batch(spark, [(1, "a", 0, 0), (2, "b", 0, 0)]))
    broken = batch(spark, [(1, "x", 0, 1)]).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        table.upsert(broken, ["id"], ["v"], ["seq"])
    assert rows(table.read(), "id", "v") == [(1, "a"), (2, "b")]
    table.upsert(batch(spark, [(1, "y", 0, 1)]), ["id"], ["v"], ["seq"])
    assert rows(table.read(), "id", "v") == [(1, "y"), (2, "b")]


def opened(df):
    return len({r[0] for r in df.select("_metadata.file_path").distinct().collect()})


def test_look_ups_open_the_files_that_may_hold_a_key(spark):
    path = scratch_path(spark, "keyed")
    # four files of ranges, four of scattered keys
    spark.range(0, 4000, 2, 4).write.parquet(f"{path}/v1")
    spark.range(0, 4000, 2, 4).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) + 10**6).alias("id")).write.parquet(f"{path}/v2")
    for folder in ("v1", "v2"):
        keyfiles.write(spark.read.parquet(f"{path}/{folder}"), ["id"], f"{path}/{folder}", f"{path}/keys/{folder}")
    described = [f"{path}/keys/v1", f"{path}/keys/v2"]

    def found(wanted):
        return keyfiles.candidates(spark, described, wanted, ["id"])

    files = [f"{f}/{n}" for f in ("v1", "v2") for n in tables.names(spark, f"{path}/{f}") if n.startswith("part-")]
    stored = {f: {r[0] for r in spark.read.parquet(f"{path}/{f}").collect()} for f in files}
    scattered = sorted(stored[files[-1]])
    assert len(found(spark.range(2000, 2010))) == 1
    assert found(spark.range(2001, 2002)) == [] and found(spark.range(-9, 0)) == []
    for key in scattered[:5]:
        passed = found(spark.createDataFrame([(key,)], "id long"))
        assert files[-1] in passed and len(passed) <= 2
    # keys that no file has: the filters let hardly any pass
    absent = [k for k in range(10**6, 10**6 + 4 * 10**9, 10**8 + 7)]
    assert sum(len(found(spark.createDataFrame([(k,)], "id long"))) for k in absent[:10]) <= 2


def test_no_key_is_ever_missed(spark):
    path = scratch_path(spark, "keyed")
    src = spark.range(3000).select((col("id") * 7919 % 100_003).alias("a"), F.concat(F.lit("k"), col("id") % 50).alias("b"))
    src.unionByName(spark.createDataFrame([(None, "x"), (5, None)], "a long, b string")).repartition(6).write.parquet(f"{path}/v1")
    stored = spark.read.parquet(f"{path}/v1")
    keyfiles.write(stored, ["a", "b"], f"{path}/v1", f"{path}/keys/v1")
    some = src.where("a % 97 = 3")
    files = keyfiles.candidates(spark, [f"{path}/keys/v1"], some, ["a", "b"])
    held = spark.read.parquet(*[f"{path}/{f}" for f in files])
    assert some.join(held, ["a", "b"], "left_anti").count() == 0


def test_an_incremental_load_opens_no_file_of_other_keys(spark, monkeypatch):
    table = tables.Table(spark, scratch_path(spark, "t"), keys=("id",))
    seen = []
    read = tables.Table._read_folder
    monkeypatch.setattr(tables.Table, "_read_folder", lambda self, folder, *a, only=None, **k: (seen.append((folder, only)), read(self, folder, *a, only=only, **k))[1])
    for day in range(4):
        src = spark.range(day * 100, day * 100 + 110).select("id", F.lit(day).alias("day"))  # ten ids come again
        seen.clear()
        table.insert_new(src, ["id"], ["day"])
        looked_up = [len(only) for _, only in seen if only is not None]
        assert sum(n > 0 for n in looked_up) == min(day, 1)
    got = table.read()
    assert got.count() == 410 and got.groupBy("id").count().where("count > 1").count() == 0


def test_partitioned_tables_are_looked_up_too(spark):
    table = tables.Table(spark, scratch_path(spark, "t"), partition_by=("part",), keys=("id",), rewrite_share=9.0)
    src = spark.range(60).select("id", F.concat(F.lit("a+b /"), col("id") % 3).alias("part"), F.lit("x").alias("v"))
    table.insert_new(src, ["id"], ["part"])
    table.insert_new(src.withColumn("v", F.lit("y")).unionByName(spark.range(60, 63).select("id", F.lit("a+b /1").alias("part"), F.lit("z").alias("v"))), ["id"], ["part"])
    table.upsert(src.where("id = 7").withColumn("v", F.lit("u")), ["id"], ["v"], ["part"])
    assert rows(table.read().groupBy("v").count()) == [("u", 1), ("x", 59), ("z", 3)]
    assert rows(table.read().where("part = 'a+b /1'").groupBy("v").count()) == [("u", 1), ("x", 19), ("z", 3)]
