"""Joins keep a shape in which Spark can split a heavy key at run time."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.operators import relational as r
from starforge.operators import windows as w

col = F.col

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_session(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(skew_session):
    df = skew_session.range(0, 200_000, 1, 8)
    key = F.when(col("id") % 3 == 0, 7).otherwise(col("id") % 5000)
    return df.select("id", key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("v"))


@pytest.fixture
def parents(skew_session):
    return skew_session.range(0, 5200, 1, 4).select(col("id").alias("k"), F.xxhash64("id").alias("p"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_the_heavy_key(skewed, parents):
    joined = r.look_up(skewed, parents, {"k": "k"}, {"p": "p"})
    assert "skew=true" in final_plan(joined)
    assert joined.where("p IS NULL").count() == 0


def test_full_join_splits_the_heavy_key(skewed, parents):
    assert "skew=true" in final_plan(r.full_join(skewed, parents, "k"))


def test_group_shares_split_the_heavy_key(skewed):
    assert "skew=true" in final_plan(w.share_of_group(skewed, ["k"], "v"))


def test_semi_join_reduces_the_heavy_side(skewed, parents):
    found = r.semi(parents, skewed, "k")
    plan = final_plan(found)
    assert "HashAggregate(keys=[k" in plan
    assert found.count() == skewed.select("k").distinct().count()


def test_first_per_never_joins_on_the_key(skewed):
    plan = w.first_per(skewed, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [id" in plan and "SortMergeJoin [k" not in plan
    assert rows(w.first_per(skewed, "k", "id").where("k = 7"), "id") == [(0,)]
