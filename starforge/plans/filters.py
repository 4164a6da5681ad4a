"""Projection and filter queries."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import columns as c
from starforge.plans.registry import query

col = F.col
RIDE_MONEY = "fare_amount ride_distance_km rating"


@query("fil_1", "SELECT ride_id, driver_name AS driver, passenger_name AS passenger FROM rides")
def fil_1(t):
    return t.rides.select("ride_id", col("driver_name").alias("driver"), col("passenger_name").alias("passenger"))


@query("fil_2", "SELECT * FROM rides WHERE ride_status = 'cancelled' AND payment_method = 'esewa'", doubles=RIDE_MONEY)
def fil_2(t):
    return t.rides.where((col("ride_status") == "cancelled") & (col("payment_method") == "esewa"))


@query(
    "fil_3",
    """SELECT ride_id, driver_name, passenger_name, fare_amount FROM rides
       WHERE lower(pickup_city) = 'city 3' AND lower(dropoff_city) = 'city 7' AND ride_status = 'completed'""",
    doubles="fare_amount",
)
def fil_3(t):
    return t.rides.where(
        c.equals_ignoring_case(col("pickup_city"), "City 3")
        & c.equals_ignoring_case(col("dropoff_city"), "CITY 7")
        & (col("ride_status") == "completed")
    ).select("ride_id", "driver_name", "passenger_name", "fare_amount")


@query(
    "fil_4",
    """SELECT ride_id, driver_name FROM rides
       WHERE driver_name LIKE 'Dri%' OR driver_name LIKE '%-7 %' OR driver_name LIKE '%  %'""",
)
def fil_4(t):
    d = col("driver_name")
    return t.rides.where(d.startswith("Dri") | d.like("%-7 %") | d.contains("  ")).select("ride_id", "driver_name")


@query("fil_5", "SELECT * FROM rides WHERE driver_name ILIKE '%DRIVER o''NEIL-1%'", doubles=RIDE_MONEY)
def fil_5(t):
    return t.rides.where(col("driver_name").ilike("%DRIVER o'NEIL-1%"))


@query(
    "fil_6",
    """SELECT count(*) FILTER (WHERE rating IS NULL) AS unrated, count(*) FILTER (WHERE rating IS NOT NULL) AS rated
       FROM rides""",
)
def fil_6(t):
    rated = t.rides.where(col("rating").isNotNull()).agg(F.count(F.lit(1))).scalar()
    unrated = t.rides.where(col("rating").isNull()).agg(F.count(F.lit(1)).alias("unrated"))
    return unrated.select("unrated", rated.alias("rated"))


@query(
    "fil_7",
    """SELECT ride_id, driver_name, payment_method FROM rides
       WHERE payment_method IS NULL OR payment_method <> 'cash'""",
)
def fil_7(t):
    return t.rides.where(c.differs_or_null(col("payment_method"), "cash")).select(
        "ride_id", "driver_name", "payment_method"
    )


@query("fil_8", "SELECT count(*) AS n_rows FROM rides WHERE rating = NULL OR 1 = 2")
def fil_8(t):
    return t.rides.where(c.equals_sql_null(col("rating")) | (F.lit(1) == 2)).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "fil_9",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE CAST(o_orderdate AS DATE) > DATE '1999-06-01' ORDER BY o_orderdate""",
)
def fil_9(t):
    later = c.later_than_day(col("o_orderdate"), dt.date(1999, 6, 1))
    return t.orders.where(later).select("o_orderkey", "o_orderdate").orderBy(F.asc_nulls_last("o_orderdate"))


@query(
    "fil_10",
    """SELECT event_id, ts, event_type FROM events
       WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:30:00'""",
)
def fil_10(t):
    window = c.in_range(col("ts"), dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 12, 18, 30))
    return t.events.where(window).select("event_id", "ts", "event_type")


@query("fil_11", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')")
def fil_11(t):
    return t.raw("customer").where(col("c_mktsegment").isin("MACHINERY", "BUILDING")).select("c_custkey", "c_name")


@query("fil_12", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20", bigints="p_size")
def fil_12(t):
    return t.raw("part").where(col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query(
    "fil_13",
    """SELECT CAST(2307 + 2292 AS BIGINT) AS not_null_methods, 1 = 1 AS same, (NULL = NULL) IS NULL AS unknown,
              count(*) AS n_rows FROM orders""",
)
def fil_13(t):
    return t.orders.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.expr("CAST(2307 + 2292 AS BIGINT)").alias("not_null_methods"),
        F.expr("1 = 1").alias("same"),
        F.expr("(NULL = NULL) IS NULL").alias("unknown"),
        "n_rows",
    )
