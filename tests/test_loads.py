import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.operators import loads, quality
from starforge.session import scratch_path
from starforge.sources import tables
from starforge.streaming import incremental

col = F.col


def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")


def source(spark):
    return spark.createDataFrame([(2, "c", 1), (3, "d", 2), (3, "e", 3)], "id int, v string, seq int")


def test_insert_new_and_upsert(spark):
    inserted = loads.insert_new(target(spark), source(spark), ["id"], ["seq"])
    assert rows(inserted) == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(loads.insert_new(inserted, source(spark), ["id"], ["seq"])) == rows(inserted)
    merged = loads.upsert(target(spark), source(spark), ["id"], ["v"], ["seq"])
    assert rows(merged) == [(1, "a"), (2, "c"), (3, "e")]
    assert rows(loads.upsert(merged, source(spark), ["id"], ["v"], ["seq"])) == rows(merged)


def test_rows_without_a_key_never_conflict(spark):
    t = spark.createDataFrame([(None, "a")], "id int, v string")
    s = spark.createDataFrame([(None, "b", 1), (None, "c", 2)], "id int, v string, seq int")
    assert rows(loads.insert_new(t, s, ["id"], ["seq"]), "v") == [("a",), ("b",), ("c",)]
    assert rows(loads.upsert(t, s, ["id"], ["v"], ["seq"]), "v") == [("a",), ("b",), ("c",)]


def test_upsert_keeps_the_surrogate_key_and_null_updates(spark):
    t = spark.createDataFrame([(10, 1, "a")], "sk int, id int, v string")
    s = spark.createDataFrame([(1, None, 1), (2, "x", 1)], "id int, v string, seq int")
    assert rows(loads.upsert(t, s, ["id"], ["v"], ["seq"]), "sk", "id", "v") == [(10, 1, None), (None, 2, "x")]


def test_fact_modes(spark):
    t, s = target(spark), source(spark).where("seq < 3")
    assert rows(loads.load_fact(t, s, ["id"], ["seq"])) == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(loads.load_fact(t, s, ["id"], ["seq"], full_reload=True), "id", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_children_follow_their_parent(spark):
    chunks = spark.createDataFrame([("1-0", 1), ("1-1", 1), ("2-0", 2)], "chunk_id string, ticket int")
    fresh = spark.createDataFrame([("1-0", 1)], "chunk_id string, ticket int")
    changed = spark.createDataFrame([(1,)], "ticket int")
    now = loads.replace_children(chunks, fresh, changed, "ticket")
    assert rows(now, "chunk_id") == [("1-0",), ("2-0",)]
    assert rows(loads.drop_orphans(chunks, now, "chunk_id"), "chunk_id") == [("1-0",), ("2-0",)]


def test_update_and_delete(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, r int")
    assert rows(loads.update_where(df, col("r") > 4, r=F.lit(9))) == [(1, 9), (2, None)]
    assert rows(loads.delete_where(df, col("r") > 4)) == [(2, None)]
    assert loads.add_column(loads.add_column(df, "x", "string"), "x", "string").columns == ["id", "r", "x"]


def test_versioned_table(spark):
    table = tables.Table(spark, scratch_path(spark, "t"), target(spark).schema)
    assert table.read().count() == 0
    table.full_refresh(target(spark))
    table.upsert(source(spark), ["id"], ["v"], ["seq"])
    table.upsert(source(spark), ["id"], ["v"], ["seq"])
    assert rows(table.read()) == [(1, "a"), (2, "c"), (3, "e")]
    table.insert_new(source(spark).withColumn("id", col("id") + 1), ["id"], ["seq"])
    assert rows(table.read(), "id") == [(1,), (2,), (3,), (4,)]
    table.insert_new(source(spark).withColumn("id", col("id") + 1), ["id"], ["seq"])
    assert table.read().count() == 4
    table.vacuum(keep=1)
    assert len(table._folders()) == 1 and table.read().count() == 4


def test_a_failed_write_leaves_the_table(spark):
    table = tables.Table(spark, scratch_path(spark, "t"))
    table.overwrite(target(spark))
    broken = target(spark).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        table.overwrite(broken)
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    table.overwrite(target(spark).limit(1))
    assert table.read().count() == 1


def test_atomic_load_of_two_tables(spark):
    drivers = tables.Table(spark, scratch_path(spark, "drivers"))
    trips = tables.Table(spark, scratch_path(spark, "trips"))
    drivers.overwrite(target(spark))
    trips.overwrite(target(spark))
    new_driver = spark.createDataFrame([(3, "x")], "id int, v string")
    bad_trips = spark.createDataFrame([(3, "x"), (4, None)], "id int, v string")
    rules = [quality.not_null("v")]
    with pytest.raises(quality.DataQualityError, match="not_null_v"):
        loads.load_atomic((drivers, new_driver, rules), (trips, bad_trips, rules))
    assert drivers.read().count() == 2 and trips.read().count() == 2
    loads.load_atomic((drivers, new_driver, rules), (trips, new_driver, rules))
    assert drivers.read().count() == 3 and trips.read().count() == 3
    # the second table fails while it is written
    failing = new_driver.withColumn("v", F.raise_error(F.lit("disk full")).cast(new_driver.schema["v"].dataType))
    with pytest.raises(Exception, match="disk full"):
        loads.load_atomic((drivers, new_driver, rules), (trips, failing, rules))
    assert drivers.read().count() == 3 and trips.read().count() == 3


def test_staged_rows_count_with_their_marker(spark):
    table = tables.Table(spark, scratch_path(spark, "staged"))
    table.overwrite(spark.range(3))
    marker = f"{table.path}/commits/x"
    table.stage(spark.range(3, 5), marker)
    assert table.read().count() == 3
    table.publish(marker)
    assert table.read().count() == 5
    fresh = tables.Table(spark, scratch_path(spark, "fresh"))
    for _ in range(2):
        fresh.stage(spark.range(2), f"{fresh.path}/commits/y")
    assert not fresh.exists()
    fresh.publish(f"{fresh.path}/commits/y")
    assert fresh.read().count() == 4


def test_partitioned_table(spark):
    table = tables.Table(spark, scratch_path(spark, "p"), partition_by=("month",))
    df = spark.range(100).select("id", (col("id") % 3).cast("int").alias("month"))
    table.insert_new(df, ["id"], ["id"])
    table.insert_new(spark.range(120).select("id", F.lit(5).alias("month")), ["id"], ["id"])
    assert table.read().count() == 120 and table.read().where("month = 5").count() == 20
    assert "PartitionFilters: [isnotnull(month" in table.read().where("month = 5")._jdf.queryExecution().executedPlan().toString()


def test_partitioned_upsert_moves_rows(spark):
    path = scratch_path(spark, "parts")
    schema = "id int, v string, month string, seq int"
    first = spark.createDataFrame([(1, "a", "m1", 1), (2, "b", "m2", 1), (3, "c", "m3", 1), (3, "d", "m3", 2)], schema)
    tables.upsert_partitions(spark, path, first, ["id"], ["seq"], "month")
    batch = spark.createDataFrame([(1, "x", "m2", 3), (4, "n", "m4", 3)], schema)
    for _ in range(2):  # a repeat changes nothing
        tables.upsert_partitions(spark, path, batch, ["id"], ["seq"], "month")
        now = spark.read.parquet(path)
        assert rows(now, "id", "v", "month") == [(1, "x", "m2"), (2, "b", "m2"), (3, "d", "m3"), (4, "n", "m4")]


def test_staging_by_batch(spark):
    schema = target(spark).schema
    staging = tables.Staging(spark, scratch_path(spark, "s"), schema)
    assert staging.read().count() == 0
    a, b = "scheduled__2026-08-12T00:00:00+00:00", "007"
    staging.replace_batch(target(spark), a)
    staging.replace_batch(target(spark).limit(1), b)
    staging.replace_batch(target(spark).limit(1), a)
    assert staging.read_batch(a).count() == 1 and staging.read_batch(b).count() == 1
    staging.replace_batch(target(spark).limit(0), b)
    assert staging.read_batch(b).count() == 0
    tables.clean_up([staging], a)
    assert staging.read().count() == 0


def stamped(spark, *times):
    data = [(i, dt.datetime(2024, 1, 1, *t)) for i, t in enumerate(times)]
    return spark.createDataFrame(data, "id int, at timestamp_ntz")


def test_high_water_is_strict(spark):
    loaded = stamped(spark, (10, 0))
    src = stamped(spark, (9, 59), (10, 0), (10, 1))
    mark = incremental.high_water(loaded, "at")
    assert rows(incremental.newer_than(src, "at", mark), "id") == [(2,)]
    assert incremental.newer_than(src, "at", mark, dt.timedelta(minutes=1)).count() == 2
    empty = incremental.high_water(loaded.limit(0), "at")
    assert empty == dt.datetime(2000, 1, 1) and incremental.newer_than(src, "at", empty).count() == 3


def test_run_modes(spark):
    table = tables.Table(spark, scratch_path(spark, "runs"), stamped(spark, (1,)).schema)
    src = stamped(spark, (1,), (2,))
    for _ in range(2):
        incremental.run_load(table, src, "at", ["id"])
        assert table.read().count() == 2
    later = stamped(spark, (1,), (5,), (6,))
    incremental.run_load(table, later, "at", ["id"])  # id 1 is newer but exists: left alone
    assert rows(table.read().withColumn("h", F.hour("at")), "id", "h") == [(0, 1), (1, 2), (2, 6)]
    incremental.run_load(table, later.where("id < 2"), "at", ["id"], full_reload=True)
    assert rows(table.read().withColumn("h", F.hour("at")), "id", "h") == [(0, 1), (1, 5), (2, 6)]
    incremental.run_load(table, later.where("id < 2"), "at", ["id"], full_reload=True, truncate=True)
    assert rows(table.read(), "id") == [(0,), (1,)]
