from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from starforge.operators import relational as r
from starforge.operators import windows

col = F.col


def drivers(spark):
    return spark.createDataFrame(
        [("Ramesh", "Bike"), ("Anita", "Bike"), ("Hari", "Car"), ("Maya", None)], "driver string, kind string"
    )


def kinds(spark):
    return spark.createDataFrame([("Bike", 50), ("Car", 120), ("Electric", 150)], "kind string, fare int")


INNER = [("Anita", "Bike"), ("Hari", "Car"), ("Ramesh", "Bike")]


def joined(spark, how):
    d, k = drivers(spark), kinds(spark).select("kind", col("kind").alias("type_name"))
    return rows(d.join(k, "kind", how), "driver", "type_name")


def test_join_kinds(spark):
    assert joined(spark, "inner") == INNER
    assert joined(spark, "left") == sorted(INNER + [("Maya", None)])
    assert joined(spark, "right") == INNER + [(None, "Electric")]
    assert rows(drivers(spark).join(kinds(spark), "kind", "left_anti"), "driver") == [("Maya",)]


def test_full_join_equals_the_built_in(spark):
    d, k = drivers(spark), kinds(spark).select("kind", col("kind").alias("type_name"))
    ours = rows(r.full_join(d, k, "kind"), "driver", "type_name")
    assert ours == rows(d.join(k, "kind", "full"), "driver", "type_name")
    assert (None, "Electric") in ours and ("Maya", None) in ours


def test_not_in_follows_null_rules(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    for values in ([1], [1, None], [], [None], [5]):
        b = spark.createDataFrame([(v,) for v in values], "x int")
        a.createOrReplaceTempView("a")
        b.createOrReplaceTempView("b")
        expected = rows(spark.sql("SELECT x FROM a WHERE x NOT IN (SELECT x FROM b)"))
        assert rows(r.not_in(a, b, "x")) == expected, values


def test_join_null_safe_matches_nulls_once(spark):
    a = spark.createDataFrame([(1, None), (2, 7), (3, 8)], "id int, k int")
    b = spark.createDataFrame([(None, "Unknown"), (7, "seven")], "k int, name string")
    assert rows(r.join_null_safe(a, b, ["k"], "left")) == [(1, None, "Unknown"), (2, 7, "seven"), (3, 8, None)]


def test_scorecard_keeps_drivers_without_trips(spark):
    d = spark.createDataFrame([(1, "A"), (2, "B")], "driver_id int, name string")
    t = spark.createDataFrame(
        [(10, 1, "completed", Decimal("4.0")), (11, 1, "cancelled", None), (12, 1, "completed", Decimal("5.0"))],
        "trip_id int, driver_id int, status string, driver_rating decimal(2,1)",
    )
    got = rows(r.scorecard(d, t), "driver_name", "total_trips", "cancelled_trips", "cancellation_rate", "avg_rating")
    assert got == [("A", 3, 1, Decimal("33.33"), Decimal("4.50")), ("B", 0, 0, None, None)]
    assert rows(r.cancellation_above(d, t, 20), "driver_name") == [("A",)]


def test_scalar_lookup(spark):
    import pytest

    df = spark.createDataFrame([(1, "x"), (2, "z")], "id int, name string")
    dim = spark.createDataFrame([(5, "x"), (6, "y")], "key int, label string")
    assert rows(r.scalar_lookup(df, dim, ("name", "label"), "key", "k")) == [(1, "x", 5), (2, "z", None)]
    twice = dim.union(dim)
    with pytest.raises(Exception, match="more than one key"):
        r.scalar_lookup(df, twice, ("name", "label"), "key", "k").collect()


def test_sort_orders_nulls_like_the_source_database(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [x[0] for x in df.orderBy(*r.order_by("x")).collect()] == [1, 2, None]
    assert [x[0] for x in df.orderBy(*r.order_by("-x")).collect()] == [None, 2, 1]
    assert [x[0] for x in windows.page(df, ["x"], 1, 2).collect()] == [2, None]


def test_above_average_and_group_max(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 3), ("b", 3)], "g string, v int")
    assert rows(r.above_average(df, "v")) == [("a", 3), ("b", 3), ("b", 3)]
    assert rows(r.rows_at_group_max(df, "g", "v")) == [("a", 3), ("b", 3), ("b", 3)]
    assert rows(r.usage_count(df.select("g").distinct(), df.where("g = 'a'"), "g", "n")) == [("a", 2), ("b", 0)]


def test_rows_without_a_key_are_dealt_over_tasks(spark):
    left = spark.range(2000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN id % 7 END AS k")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c"), (None, "d"), (None, "e"), (9, "f")], "k long, v string")
    for how in ("inner", "left"):
        found = r.join_optional(left, right, "k", "id", how)
        assert found.columns == ["id", "k", "v"]
        assert rows(found) == rows(r.join_null_safe(left, right, ["k"], how))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = r.join_optional(left, right, "k", "id", "left").where("k IS NULL")
        assert found.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
