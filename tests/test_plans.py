"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.operators import loads, relational as r
from starforge.operators import star
from starforge.plans import registry
from starforge.session import scratch_path
from starforge.sources import tables

col = F.col


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_are_pushed_to_the_scan(tables):
    late = tables.events.where(c.in_range(col("ts"), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))).select("event_id")
    text = plan(late)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00), LessThan(ts,2024-01-12T00:00)]" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    day = tables.orders.where(c.later_than_day(col("o_orderdate"), dt.date(1999, 6, 1)))
    assert "GreaterThanOrEqual(o_orderdate,1999-06-02T00:00)" in plan(day)


def test_scorecard_shuffles_partial_aggregates_only(tables):
    text = plan(r.scorecard(tables.drivers, tables.trips))
    # the exchange on the trips side sits above the partial aggregate
    assert text.count("Exchange hashpartitioning(driver_id") <= 2
    assert "partial_count" in text


def test_contradictions_read_nothing(tables):
    text = tables.rides.where(c.equals_sql_null(col("rating")))._jdf.queryExecution().optimizedPlan().toString()
    assert text.startswith("LocalRelation <empty>")


def test_top_k_needs_no_full_sort(tables):
    assert "TakeOrderedAndProject" in plan(r.top_k(tables.orders, ["-o_totalprice", "o_orderkey"], 5))


def test_batches_prune_partitions(spark, tables):
    from starforge.sources.tables import Staging

    staging = Staging(spark, scratch_path(spark, "prune"), tables.drivers.schema)
    staging.replace_batch(tables.drivers, "a")
    staging.replace_batch(tables.drivers, "b")
    assert "PartitionFilters: [isnotnull(batch_id" in plan(staging.read_batch("a"))


def test_no_forced_broadcasts_of_tables(spark, tables):
    """What is broadcast is Spark's choice by size; numbering broadcasts a row per task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = star.calendar(spark, dt.date(1995, 1, 1), dt.date(2000, 12, 31))
        text = plan(star.resolve_trips(tables.trips, star.etl_lookups(tables, days)))
        hinted = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
        assert all("[_task#" in line for line in hinted) and "CartesianProduct" not in text and "NestedLoop" not in text
        target = tables.trips.select("trip_id", "base_fare")
        text = plan(loads.insert_new(target, target, ["trip_id"], ["base_fare"]))
        assert "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["joi_5", "joi_7", "joi_8", "joi_13", "sub_1", "sub_2", "sub_3", "fct_2", "fct_3", "nrm_2"])
def test_no_pairings(spark, tables, key):
    text = plan(registry.all_queries()[key](spark, tables.dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_distinct_windows_stay_in_the_jvm(spark, tables):
    for key in ("win_1", "win_3", "str_6", "txt_4", "txt_6", "fct_2"):
        assert "Python" not in plan(registry.all_queries()[key](spark, tables.dir)), key
